"""Structured Streaming forms. Offsets live in the checkpoint; outputs are keyed by batch number,
so a repeated batch replaces its own rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import times
from ..operators import state as st
from ..operators.clicks import ad_clicks_per_minute
from ..operators.dedupe import dedupe_ttl
from ..sinks.state_table import EXPIRES, StateTable


def read_topics(spark: SparkSession, topics: list[str], servers: str, options: dict[str, str] | None = None) -> DataFrame:
    """Text of Kafka topics. Start position, rate limit and loss policy pass through:
    ``startingOffsets``, ``startingOffsetsByTimestamp``, ``maxOffsetsPerTrigger``, ``failOnDataLoss``."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(topics)))
    return (reader.options(**(options or {})).load()
            .select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp"))


def read_folder(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                options: dict[str, str] | None = None) -> DataFrame:
    """New files of a folder; ``maxFilesPerTrigger`` is the rate limit."""
    return spark.readStream.schema(schema).format(fmt).options(**(options or {})).load(path)


def trigger_args(interval: str | None) -> dict:
    """``60 seconds`` and the like; without interval everything available once."""
    return {"processingTime": interval} if interval else {"availableNow": True}


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
                interval: str | None = None) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(**trigger_args(interval)).start())


def batch_folder(out: str, batch: int) -> str:
    return f"{out}/batch={batch}"


def append_once(out: str, make: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Handler that writes ``make(batch)`` under the batch number."""
    def handle(batch: DataFrame, number: int) -> None:
        make(batch).write.mode("overwrite").parquet(batch_folder(out, number))
    return handle


def first_events_stream(stream: DataFrame, out: str, table: StateTable, checkpoint: str, columns: dict[str, Column],
                        arrival: str, interval: str | None = None, flag_only: bool = False,
                        tz: str = times.DEFAULT_TZ) -> StreamingQuery:
    """First login and payment dates across batches: same window code as batch, state in ``table``.

    ``columns`` names key, event, ts, is_test, pay_status and status. A batch reads and writes the buckets of its keys.
    """
    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            keys = kept.select(columns["key"].alias("key")).where("key IS NOT NULL")
            before = table.read(spark, number, keys)
            st.first_events(kept, arrival, **columns, flag_only=flag_only, state=before, tz=tz) \
                .write.mode("overwrite").parquet(batch_folder(out, number))
            table.append(st.first_event_state(kept, **columns, flag_only=flag_only), number)
        finally:
            kept.unpersist()
    return run_batches(stream, handle, checkpoint, interval)


def stateful(out: str, table: StateTable, make: Callable[[DataFrame, Callable[[DataFrame], DataFrame]], DataFrame],
             delta: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Handler of a whole job with state: ``make(batch, known)`` is written, ``delta(result)`` enters the state.

    ``known`` gives the state of the keys it is called with, as the job finds them. A repeated batch reads the state
    before it and replaces both its rows and its state.
    """
    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        make(batch, lambda keys: table.read(spark, number, keys)).write.mode("overwrite").parquet(batch_folder(out, number))
        table.append(delta(spark.read.parquet(batch_folder(out, number))), number)
    return handle


def deduplicated_by_window(out: str, table: StateTable, key: str, ts: str, arrival: str, ttl: int = 300) -> Callable[[DataFrame, int], None]:
    """Handler that keeps a row when ``ttl`` seconds passed since the last kept row of its key, in whichever batch.

    ``table`` holds ``key`` and ``sec``, the last kept second, with the larger one winning, and ``expires_at``, from
    which second on the row says nothing. Batches come in order of time; a row older than the last kept one of its key
    lies inside the window and goes. Rows that were left out never extend the window.
    """
    if (table.keys, table.values, table.merge, table.ends) != (["key"], ["sec"], "max", True):
        raise ValueError("the state of a window is key, sec and expires_at, merged by max")

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            now = kept.agg(F.min(ts)).first()[0]
            before = table.read(spark, number, kept.select(F.col(key).cast("string").alias("key")).where("key IS NOT NULL"), now)
            dedupe_ttl(kept, key, ts, arrival, ttl, state=before).write.mode("overwrite").parquet(batch_folder(out, number))
            done = spark.read.schema(batch.schema).parquet(batch_folder(out, number)).where(F.col(key).isNotNull() & F.col(ts).isNotNull())
            last = done.groupBy(F.col(key).cast("string").alias("key")).agg(F.max(ts).alias("sec"))
            table.append(last.withColumn(EXPIRES, F.col("sec") + ttl), number, now)
        finally:
            kept.unpersist()
    return handle


def deduplicated(stream: DataFrame, key: list[str], event_time: str, ttl: str = "300 seconds") -> DataFrame:
    """First row per key within the delay, by event time."""
    return stream.withWatermark(event_time, ttl).dropDuplicatesWithinWatermark(key)


def clicks_per_minute(stream: DataFrame, event_time: str, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    """One final row per minute and key once the watermark has passed it."""
    counted = (stream.withWatermark(event_time, delay)
               .groupBy(F.window(event_time, "1 minute").alias("_w"), *keys)
               .agg(F.count(F.lit(1)).alias("click_cnt")))
    return counted.select(F.col("_w.start").alias("minute"), *keys, "click_cnt")


def clicks_per_batch(out: str) -> Callable[[DataFrame, int], None]:
    """Counts per minute of each batch; a minute that spans batches has one row in each."""
    return append_once(out, ad_clicks_per_minute)
