"""Streams over the events table as a file source, each run until nothing is left."""

from pyspark.sql import functions as F

from playtrail.operators import state as st
from playtrail.operators.lines import ad_click_lines
from playtrail.plans import logins
from playtrail.session import fresh_path
from playtrail.sinks.state_table import StateTable
from playtrail.streaming import jobs

from . import inputs as i
from .q_decode import CLICK_SQL
from .q_jobs import LOGIN_CLEAN_SQL, LOGIN_RULES, login_columns
from .q_state import DEDUPE_TTL_SQL, PAID, columns, running, stamped_sql
from .registry import query
from .sql import EV, w


FILE_ROWS = 250_000


def event_stream(spark, sf, batches=4):
    """The events as a growing folder, in order of arrival; a batch has as many files as its rows ask for, and one for each core."""
    events, path = i.table(spark, sf, "events"), fresh_path(spark, "events")
    top, rows = events.agg(F.max("event_id") + 1, F.count("*")).first()
    files = max(spark.sparkContext.defaultParallelism, 1 + rows // (batches * FILE_ROWS))
    for n in range(batches):  # bounds instead of a quotient: the reader skips what lies outside
        first, last = -(-n * top // batches), -(-(n + 1) * top // batches)
        part = (F.col("event_id") >= first) & (F.col("event_id") < last)
        events.where(part).repartition(files).write.mode("append").parquet(path)
    return jobs.read_folder(spark, path, events.schema, options={"maxFilesPerTrigger": str(files)})


def finish(query_handle):
    query_handle.awaitTermination()
    if query_handle.exception():
        raise query_handle.exception()


def read_batches(spark, path, schema=None):
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).drop("batch")


@query("stream_ingest_files", w(EV) + "SELECT eid, uid, kind FROM ev")
def stream_ingest_files(spark, sf):
    out, check = fresh_path(spark, "ingest"), fresh_path(spark, "ingest-offsets")
    stream = i.ev_of(event_stream(spark, sf)).select("eid", "uid", "kind")
    finish(jobs.run_batches(stream, jobs.append_once(out, lambda b: b), check))
    return read_batches(spark, out)


@query("stream_login", LOGIN_CLEAN_SQL)
def stream_login(spark, sf):
    """The login job over eight batches, its state carried between them, gives the rows of the batch job."""
    out, check = fresh_path(spark, "login"), fresh_path(spark, "login-offsets")
    d, regions, state = i.dims(spark, sf), i.regions(spark, sf), i.stored_state(spark, sf)

    table = StateTable(fresh_path(spark, "login-state"), ["key"], ["login_ts", "order_ts"], buckets=8, deltas=3)

    def clean(batch, known):
        lines = i.old_login_lines_of(i.ev_of(batch), wrapped=True)
        return logins.agency_logins(lines, d, regions, d.special, "eid", rules=LOGIN_RULES, state=lambda keys: state.unionByName(known(keys)))

    def seen(done):
        key = F.when(F.col("ok"), st.state_key(F.col("user-user_id"), F.col("agent-game_channel_id")))
        return st.first_event_state(done, key, F.col("event"), F.col("server_ts"), F.col("is_test"), F.lit(""), F.lit(""))

    finish(jobs.run_batches(event_stream(spark, sf, 8), jobs.stateful(out, table, clean, seen), check))
    return login_columns(read_batches(spark, out))


@query("stream_first_event", w(EV, running(PAID)) + f"SELECT eid, first_order_date, reg_date FROM (SELECT eid, {stamped_sql('sts', 'kind', 'login_ts', 'order_ts')} FROM se)")
def stream_first_event(spark, sf):
    out, check = fresh_path(spark, "first"), fresh_path(spark, "first-offsets")
    table = StateTable(fresh_path(spark, "first-state"), ["key"], ["login_ts", "order_ts"], buckets=8, deltas=3)
    e = i.ev_of(event_stream(spark, sf, 8))
    gc = F.when(F.col("k") == 5, F.lit("error")).when(F.col("k") == 6, F.lit("")).otherwise(F.col("gc"))
    rows = e.select("eid", "uid", "sts", "kind", gc.alias("gc"), F.when(F.col("k") != 77, F.lit("regular")).otherwise(F.lit("test")).alias("is_test"),
                    F.when(F.col("k") < 70, F.lit("1")).otherwise(F.lit("0")).alias("pay"),
                    F.when(F.col("k") >= 20, F.lit("2")).otherwise(F.lit("1")).alias("step"))
    finish(jobs.first_events_stream(rows, out, table, check, columns(), "eid"))
    return read_batches(spark, out).select("eid", "first_order_date", "reg_date")


@query("stream_click_minute", w(EV, CLICK_SQL) + """SELECT CAST(eid * 4 // (SELECT max(eid) + 1 FROM ev) AS INTEGER) AS batch, CASE WHEN ad0 = '' THEN 0 ELSE CAST(ad0 AS INTEGER) END AS ad_id, cgame AS game, channel,
  CASE WHEN pf = '' THEN 2 ELSE CAST(pf AS INTEGER) END AS pf, CAST(replace(substr(click_time, 1, 10), '-', '') AS INTEGER) AS click_date, CAST(substr(click_time, 12, 2) AS INTEGER) AS click_hour,
  CAST(substr(click_time, 15, 2) AS INTEGER) AS click_minute, count(*)::INTEGER AS click_cnt FROM clicks WHERE reason IS NULL GROUP BY ALL""")
def stream_click_minute(spark, sf):
    """Counts per minute and batch."""
    out, check = fresh_path(spark, "minute"), fresh_path(spark, "minute-offsets")
    parsed = ad_click_lines(i.click_lines_of(i.ev_of(event_stream(spark, sf)))).where("ok")
    finish(jobs.run_batches(parsed, jobs.clicks_per_batch(out), check))
    return spark.read.parquet(out).select("batch", "ad_id", "game", "channel", "pf", "click_date", "click_hour", "click_minute", "click_cnt")


@query("stream_dedupe", w(EV) + "SELECT DISTINCT uid, k FROM ev")
def stream_dedupe(spark, sf):
    """First row per (user, k) inside a delay longer than the data."""
    out, check = fresh_path(spark, "dedupe"), fresh_path(spark, "dedupe-offsets")
    e = i.ev_of(event_stream(spark, sf)).select("eid", "uid", "k", F.timestamp_seconds("t").alias("at"))
    unique = jobs.deduplicated(e, ["uid", "k"], "at", "60 days")
    finish(jobs.run_batches(unique, jobs.append_once(out, lambda b: b.select("eid", "uid", "k")), check))
    return read_batches(spark, out).select("uid", "k")


@query("stream_dedupe_ttl", DEDUPE_TTL_SQL)
def stream_dedupe_ttl(spark, sf):
    """The window of dedupe_ttl over eight batches: the last kept second of each key goes from one to the next."""
    out, check = fresh_path(spark, "window"), fresh_path(spark, "window-offsets")
    table = StateTable(fresh_path(spark, "window-state"), ["key"], ["sec"], buckets=4, merge="max", ends=True, deltas=3)
    e = i.ev_of(event_stream(spark, sf, 8)).selectExpr("uid % 10 AS key", "t", "eid")
    finish(jobs.run_batches(e, jobs.deduplicated_by_window(out, table, "key", "t", "eid", 900), check))
    return read_batches(spark, out)
