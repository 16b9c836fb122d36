"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playtrail.session import fresh_path

WORD = r"[^\x20\x09-\x0D]+"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """The same rows; from now on the session hands at most BATCH_ROWS of them to Python at a time.

    Texts are long: the usual 10,000 rows of them, held several times over, would not fit beside the heap.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(ARROW_ROWS)) <= BATCH_ROWS:
        conf.set(ARROW_ROWS, str(BATCH_ROWS))
    return df


def words(text: str | None) -> list[bytes]:
    """Words between the white space \\x20 \\x09-\\x0D, A-Z lower-cased, as UTF-8; none for null.

    `bytes.split` and `bytes.lower` know exactly these six separators and these 26 letters.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def in_fold(key: str | Column, folds: int, which: int) -> Column:
    """True for rows whose crc32(key as text) mod folds is `which`; null keys are in no fold."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string")) % folds == which, F.lit(False))


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drops columns that an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows under the column names c0, c1, ..., which an operator's own names never meet, and those names by lower-case name."""
    names = {c.lower(): f"c{n}" for n, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(names[c.lower()]) for c in df.columns]), names


def own_names(df: DataFrame) -> list[Column]:
    """The columns of df, to be selected from its renamed rows."""
    return [F.col(f"c{n}").alias(c) for n, c in enumerate(df.columns)]


def pieces(column, rows: int = 256):
    """Values of an Arrow column, a few rows at a time, so that a batch of long texts is never copied whole."""
    for start in range(0, len(column), rows):
        yield from column.slice(start, rows).to_pylist()


def bit_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit set of 2 ** bits cells, by the leading bits of a long column `hash`, whatever the number of rows.

    Its size is fixed, so it may be broadcast; a hash whose bit is unset is certainly not among the rows.
    """
    cell = F.shiftrightunsigned("hash", 64 - bits)
    words = (hashes.select(F.shiftright(cell, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(63).cast("int")).alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")))
    table = np.zeros(max(1, 2 ** bits // 64), dtype=np.int64)
    rows = words.toArrow()
    table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return table.view(np.uint64)


def passes(table: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) have their bit set."""
    cell = hashes >> np.uint64(64 - bits)
    return (table[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1
