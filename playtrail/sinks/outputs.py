"""Several tables that appear together, with the rows that each write counted.

A run writes every table into a folder of its own and then one small manifest that names them. Readers ask the manifests:
a run that broke off has none and is not seen; a repeated run replaces the whole of the earlier one. What a write counts
comes out of the writing pass itself and stands in the manifest.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .files import remove

TOTAL = ""  # the destination under which all rows are counted, as in route_counts
MANIFEST = "table string, folder string, destination string, rows bigint, run bigint"


def counted(rows: DataFrame, routes: tuple[str, ...], route: str) -> tuple[DataFrame, Observation]:
    """Rows that count themselves per route while an action runs over them, and where the counts will be."""
    seen = Observation()
    per_route = [F.count_if(F.col(route) == r).alias(f"r{n}") for n, r in enumerate(routes)]
    return rows.observe(seen, F.count(F.lit(1)).alias("all"), *per_route), seen


@dataclass
class Outputs:
    """The tables below ``path``. Run numbers ascend; those of a stream are its batch numbers."""

    path: str

    def _manifests(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def write(self, tables: dict[str, DataFrame], run: int, routes: dict[str, tuple[str, ...]] | None = None, route: str = "route") -> None:
        """Write all tables of a run, one pass each, then its manifest.

        ``routes`` names the destinations of a table whose rows carry ``route``; they become its folders, and the manifest
        has a count for each. Rows on a route that is not named are written and are in the total.
        """
        spark = next(iter(tables.values())).sparkSession
        found = self._manifests(spark)
        before = {r.folder for r in found.where(F.col("run") == run).select("folder").distinct().collect()} if found is not None else set()
        attempt, lines = uuid.uuid4().hex, []
        for name, rows in tables.items():
            chosen = (routes or {}).get(name, ())
            folder = f"{name}/run-{run}-{attempt}"
            # counted behind the exchange, in the stage that writes: a repeated earlier stage counts nothing twice
            watched, seen = counted(rows.hint("rebalance", route) if chosen else rows, chosen, route)
            writer = watched.write.partitionBy(route) if chosen else watched.write
            writer.parquet(f"{self.path}/{folder}")
            lines += [(name, folder, TOTAL, seen.get["all"])] + [(name, folder, r, seen.get[f"r{n}"]) for n, r in enumerate(chosen) if seen.get[f"r{n}"]]
        (spark.createDataFrame(lines, "table string, folder string, destination string, rows bigint").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/manifest/run={run}"))
        remove(spark, [f"{self.path}/{folder}" for folder in before])

    def runs(self, spark: SparkSession, table: str) -> list[tuple[int, str]]:
        """(run, folder) of every whole run that wrote the table."""
        found = self._manifests(spark)
        if found is None:
            return []
        rows = found.where((F.col("table") == table) & (F.col("destination") == TOTAL)).select("run", "folder").collect()
        return sorted((r.run, r.folder) for r in rows)

    def read(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        """The rows of all whole runs, one reader's view of every table being of the same runs if it asks once a run."""
        folders = [f"{self.path}/{folder}" for _, folder in self.runs(spark, table)]
        if not folders:
            return spark.createDataFrame([], schema)
        parts = [spark.read.schema(schema).parquet(f) for f in folders]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionAll(part)
        return rows

    def counts(self, spark: SparkSession, source: str) -> DataFrame:
        """Rows per destination of all whole runs, and under a blank destination all rows: source, destination, value."""
        found = self._manifests(spark)
        rows = spark.createDataFrame([], MANIFEST) if found is None else found
        return rows.groupBy(F.lit(source).alias("source"), "destination").agg(F.sum("rows").alias("value"))
