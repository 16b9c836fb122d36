"""Counts a run reports about itself. All are partial + final aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.hashing import glued, md5_upper

SENT, RECEIVED, LOG_FILE = "sendToKafka", "receivedFromMQ", "logFile"


def route_counts(routed: DataFrame, source: str, route: str = "route") -> DataFrame:
    """Rows per destination plus one line (blank destination) with the total read."""
    per_route = routed.groupBy(F.col(route).alias("destination")).agg(F.count(F.lit(1)).alias("value"))
    both = per_route.rollup("destination").agg(F.sum("value").alias("value"))
    return both.select(F.lit(source).alias("source"), F.coalesce("destination", F.lit("")).alias("destination"),
                       F.coalesce("value", F.lit(0).cast("bigint")).alias("value"))


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows while another action runs over them: no job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def sent_metrics(rows: DataFrame, host: str, run_id: str, time: Column, topic: str = "topic",
                 data_source: Column | None = None) -> DataFrame:
    """One metric row per topic written."""
    counts = rows.groupBy(F.col(topic).alias("topic")).agg(F.count(F.lit(1)).cast("int").alias("value"))
    src = F.col("topic") if data_source is None else data_source
    return metric_rows(counts, src, F.lit(host), SENT, F.lit(""), time, run_id)


def received_metrics(lines: DataFrame) -> DataFrame:
    """Lines read per (source, ip, file): those the text of each message splits into, whatever it declares.

    Closing line breaks do not count; a text without any character is one line.
    """
    raw = F.col("message_body").cast("string")
    text = F.regexp_replace(raw, "\n+$", "")
    counted = F.when((text == "") & (raw != ""), F.lit(0)).otherwise(F.size(F.split(text, "\n")))
    return (lines.where(F.col("ok") & (F.col("file_path") != "") & (F.col("ip") != ""))
            .groupBy("data_system", "ip", "file_path").agg(F.sum(counted.cast("bigint")).alias("value")))


def metric_rows(counts: DataFrame, data_source: Column, host: Column, name: str, file_name: Column,
                time: Column, run_id: str, kind: str = LOG_FILE, tags: Column | None = None) -> DataFrame:
    """Metric records; the id is a digest of content and run, so a retry writes the same row."""
    rows = counts.select(data_source.alias("data_source"), host.alias("host"), F.lit(name).alias("metric_name"),
                         time.alias("time"), F.col("value"), file_name.alias("file_name"), F.lit(kind).alias("type"),
                         F.col("topic"), (F.lit("") if tags is None else tags).alias("tags"))
    identity = glued(F.lit(run_id), *[F.col(c) for c in ("data_source", "host", "metric_name", "value", "file_name",
                                                         "type", "topic", "tags")])
    return rows.select(md5_upper(identity).alias("id"), "*")


def collectors(lines: DataFrame) -> DataFrame:
    return lines.select("ip").distinct()


def collector_last_seen(lines: DataFrame, ip: str, ts: str) -> DataFrame:
    return lines.groupBy(ip).agg(F.max(ts).alias("last_seen"))
