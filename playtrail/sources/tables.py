"""Text, snapshot, warehouse, rule-file and IP-database reads."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def text_scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of text files; globs allowed, files are split over tasks."""
    return spark.read.text(paths)


def snapshot_scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per snapshot file: ``name, version, value`` for ``dims.snapshot_rows``.

    The version is the file's modification time, the name its first name part.
    """
    whole = spark.read.text(paths, wholetext=True)
    file = F.col("_metadata.file_name")
    return whole.select(F.split_part(file, F.lit("."), F.lit(1)).alias("name"),
                        F.unix_micros("_metadata.file_modification_time").alias("version"), "value")


def jdbc_table(spark: SparkSession, table: str, options: dict[str, str]) -> DataFrame:
    """A warehouse table; address and credentials come from the caller's options."""
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def warehouse_exists(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """How many stored rows each requested key has (0 when none).

    Only rows of requested keys are counted; the joins choose their way by size at run time.
    """
    asked = rows.select(*keys).distinct()
    counts = table.select(*keys).join(asked, keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("stored"))
    return rows.join(counts, keys, "left").withColumn("stored", F.coalesce("stored", F.lit(0).cast("bigint")))


def rule_scan(spark: SparkSession, path: str) -> DataFrame:
    """Rows of XML rule files, a file or a folder or a glob: file, pos (in the file), event, grp, field, rule.

    A file is parsed by the task that reads it; many files are parsed by many tasks.
    """
    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for file, text in zip(pdf["file"], pdf["value"]):
                rows = [(file, n, *rule) for n, rule in enumerate(rules_of_xml(text))]
                yield pd.DataFrame(rows, columns=["file", "pos", "event", "grp", "field", "rule"])

    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return files.mapInPandas(parse, "file string, pos int, event string, grp string, field string, rule string")


def read_rules(spark: SparkSession, path: str) -> list[tuple[str, str, str, str]]:
    """(event, group, field, rule) of an XML rule file, or of all files of a folder by name, in file order."""
    return [tuple(r) for r in rule_scan(spark, path).orderBy("file", "pos").select("event", "grp", "field", "rule").collect()]


def rules_of_xml(text: str) -> list[tuple[str, str, str, str]]:
    return [(event.tag, group.tag, leaf.tag, (leaf.text or "").strip())
            for event in ET.fromstring(text) for group in event for leaf in group]


def rule_frame(spark: SparkSession, rules: list[tuple[str, str, str, str]]) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "pos int, event string, grp string, field string, rule string")


def read_ip_database(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """Upper bounds with labels of a binary IP database, for ``geo.ranges_from_upper_bounds``.

    Fixed layout: 4-byte index length, a jump table of one (``wide``: two) address
    bytes, entries of 8 (9) bytes - upper bound, 3-byte little-endian text offset,
    1-byte (2-byte) text length - a closing block as long as the jump table, texts.
    """
    table, step = (262144, 9) if wide else (1024, 8)

    def unpack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for pdf in parts:
            for raw in pdf["content"]:
                size = int.from_bytes(raw[:4], "big")
                body = np.frombuffer(raw[4 + table:size - table], dtype=np.uint8)
                e = body[:len(body) // step * step].reshape(-1, step).astype(np.int64)
                upper = (e[:, 0] << 24) | (e[:, 1] << 16) | (e[:, 2] << 8) | e[:, 3]
                offset = e[:, 4] | (e[:, 5] << 8) | (e[:, 6] << 16)
                length = (e[:, 7] << 8) | e[:, 8] if wide else e[:, 7]
                at = size - table + offset
                texts = [raw[a:a + n].decode("utf-8").split("\t") for a, n in zip(at, length)]
                yield pd.DataFrame({"ip_hi": upper, **{
                    name: [t[i] if len(t) > i else "" for t in texts]
                    for i, name in enumerate(("country", "province", "city"))}})

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(unpack, "ip_hi bigint, country string, province string, city string")
