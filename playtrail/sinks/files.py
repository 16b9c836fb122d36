"""Writes. Addresses and credentials always come from the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import row_identity
from ..operators.events import texts_to_time


def write_topics(rows: DataFrame, path: str, topic: str = "topic", mode: str = "append") -> None:
    """One pass over the rows, one folder per topic (file stand-in of a topic write).

    Rows of a topic are brought together before the write and large topics are split again, so that the number of
    files follows the bytes and not tasks times topics.
    """
    rows.hint("rebalance", topic).write.mode(mode).partitionBy(topic).parquet(path)


def write_kafka(rows: DataFrame, options: dict[str, str], topic: str = "topic", value: str = "value") -> None:
    """Per-row topic; the producer retries until acknowledged unless the options say otherwise."""
    (rows.select(F.col(topic).alias("topic"), F.col(value).cast("string").alias("value"))
     .write.format("kafka").options(**options).save())


def record_json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))


def write_json(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).json(path)


def write_text(rows: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    rows.select(F.col(column).alias("value")).write.mode(mode).text(path)


def write_dated(rows: DataFrame, path: str, day: str = "dt", fmt: str = "parquet") -> None:
    """Replace exactly the days the rows contain; files per day follow its bytes."""
    (rows.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day).format(fmt).save(path))


def write_jdbc(rows: DataFrame, table: str, options: dict[str, str], writers: int = 16, batch: int = 5000) -> None:
    """Batched insert with a bounded number of connections; the stages before it keep their own width."""
    (rows.repartition(writers).write.format("jdbc").options(**options)
     .option("dbtable", table).option("batchsize", batch).mode("append").save())


def rewrite_days(table: DataFrame, changed: DataFrame, path: str, day: str) -> None:
    """Keyed update of a dated table: write the changed days to ``path``, other days stay."""
    days = changed.select(day).distinct()
    write_dated(table.join(days, day, "left_semi"), path, day)


# Topic -> table and the text fields of each table that are times.
TOPIC_TABLES = {"activeTopic": "ad_active", "loginTopic": "ad_login", "orderTopic": "ad_pay", "userTopic": "ad_reg"}
TABLE_TIMES = {"ad_active": ["active_time"], "ad_login": ["login_time"], "ad_reg": ["reg_time"],
               "ad_pay": ["pay_time"]}


def topic_table_rows(df: DataFrame, topic: str, tables: dict[str, str] | None = None,
                     times: dict[str, list[str]] | None = None) -> DataFrame:
    """Records of a topic as rows of its table: id over the record, time texts as timestamps."""
    table = (tables or TOPIC_TABLES)[topic]
    fields = [c for c in (times or TABLE_TIMES).get(table, []) if c in df.columns]
    rows = df.select(row_identity(df.columns).alias("id"), "*")
    return texts_to_time(rows, fields).withColumn("table_name", F.lit(table))


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that this library wrote and no reader needs any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
