"""Duplicate removal: whole lines, and a time window that starts at the last kept row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .state import prior_minimum

SPAN = 86400


def distinct_lines(df: DataFrame, column: str = "value") -> DataFrame:
    return df.select(column).distinct()


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _runs(points: DataFrame, ttl: int, span: int) -> DataFrame:
    """Adds ``head``: the first second of the run that a second belongs to. A gap of ``ttl`` or more begins a new run.

    Both windows go over (key, span): the seconds at the end of a span are lent to the next one, where they only serve
    as predecessors, and the heads of earlier spans enter by one row per key and span.
    """
    here = F.floor(F.col("sec") / span).cast("bigint")
    lent = F.when(F.pmod("sec", F.lit(span)) >= span - ttl, F.array(here, here + 1)).otherwise(F.array(here))
    order = Window.partitionBy("k", "span").orderBy("sec")
    spread = points.withColumn("span", F.explode(lent)).withColumn("gap", F.col("sec") - F.lag("sec").over(order))
    own = spread.where(F.col("span") == here).drop("span")
    mark = F.when(F.coalesce(F.col("gap") >= ttl, F.lit(True)), -F.col("sec"))
    seen = prior_minimum(own, ["k"], "sec", {"head": mark}, block_rows=span)
    return seen.select("k", "sec", "no", F.coalesce(-mark, -F.col("head")).alias("head"))


def _greedy(runs: DataFrame, ttl: int) -> DataFrame:
    """Kept seconds of each run's first span, in order from its head."""
    packed = runs.groupBy("k", "head").agg(F.sort_array(F.collect_list(F.struct("sec", "no"))).alias("p"))
    none = F.array().cast(packed.schema["p"].dataType)
    kept = F.aggregate("p", F.struct(F.lit(None).cast("bigint").alias("last"), none.alias("kept")), lambda acc, x: F.when(
        F.coalesce(x["sec"] < acc["last"] + ttl, F.lit(False)), acc).otherwise(
        F.struct(x["sec"].alias("last"), F.concat(acc["kept"], F.array(x)).alias("kept"))), lambda acc: acc["kept"])
    return packed.select("k", "head", F.inline(kept))


def _pointers(late: DataFrame, extra: DataFrame, ttl: int, span: int) -> DataFrame:
    """(k, head, sec, nxt) for the seconds of ``late`` and ``extra``: the first second of ``late`` in the same run that
    lies ``ttl`` or more behind. Inside a run that is less than two ``ttl`` away, or there is none."""
    probes = late.select("k", "head", "sec").union(extra.select("k", "head", "sec"))
    asked = probes.select("k", "head", (F.col("sec") + ttl).alias("at"), F.col("sec").alias("asks"))
    given = late.select("k", "head", F.col("sec").alias("at"), F.lit(None).cast("bigint").alias("asks"))
    here = F.floor(F.col("at") / span).cast("bigint")
    lent = F.when(F.col("asks").isNull() & (F.pmod("at", F.lit(span)) < 2 * ttl), F.array(here, here - 1)).otherwise(F.array(here))
    behind = (Window.partitionBy("k", "head", "span").orderBy(F.desc("at"), F.col("asks").isNotNull())
              .rowsBetween(Window.unboundedPreceding, 0))
    found = F.last(F.when(F.col("asks").isNull(), F.col("at")), ignorenulls=True).over(behind)
    return (asked.union(given).withColumn("span", F.explode(lent)).withColumn("nxt", found)
            .where(F.col("asks").isNotNull()).select("k", "head", F.col("asks").alias("sec"), "nxt"))


def _followed(pointers: DataFrame, starts: DataFrame) -> DataFrame:
    """All seconds that the pointers reach from ``starts``. Each round doubles the stride of the pointers, so the number
    of rounds is the logarithm of the longest chain."""
    stride = _written(pointers.where("nxt IS NOT NULL"), "window-stride")
    reached = _written(starts.select("k", "head", "sec"), "window-reached")
    while not stride.isEmpty():
        hop = stride.select("k", "head", "sec", "nxt")
        more = reached.join(hop, ["k", "head", "sec"]).select("k", "head", F.col("nxt").alias("sec"))
        reached = _written(reached.union(more).distinct(), "window-reached")
        onward = hop.select("k", "head", F.col("sec").alias("nxt"), F.col("nxt").alias("then"))
        stride = _written(stride.join(onward, ["k", "head", "nxt"]).select("k", "head", "sec", F.col("then").alias("nxt")), "window-stride")
    return reached


def dedupe_ttl(df: DataFrame, key: str, ts: str, arrival: str, ttl: int = 300,
               span: int = SPAN, state: DataFrame | None = None) -> DataFrame:
    """Keep a row when at least ``ttl`` seconds passed since the last kept row of its key.

    Dropped rows do not extend the window. ``ts`` is BIGINT seconds, ``arrival`` a
    BIGINT unique within a key. Two rows of one key and second can never both be
    kept, so only the first of each second is looked at. A gap of ``ttl`` starts a new run, whose first row is kept
    whatever came before: runs are independent. The first ``span`` seconds of a run are followed in order, one run a
    group. Runs that go on have pointers from each later second to the next one that may be kept; pointers of pointers
    are formed until the longest chain is covered, all by joins, so a key that never pauses is spread like any other.
    Rows without key or time have no window and stay; so do all rows when ``ttl`` is not positive. ``state`` (key as
    text, sec) names the last kept second of earlier batches.
    """
    if span < 2 * ttl:
        raise ValueError("span must be at least twice ttl")
    if ttl <= 0:  # no window: every row stays
        return df
    timed = F.col(key).isNotNull() & F.col(ts).isNotNull()
    points = df.where(timed).groupBy(F.col(key).alias("k"), F.col(ts).cast("bigint").alias("sec")).agg(F.min(arrival).alias("no"))
    if state is not None:
        last = state.select(F.col("key").alias("_k"), F.col("sec").alias("_last"))
        points = (points.join(last, F.col("k").cast("string") == F.col("_k"), "left")
                  .where(F.col("_last").isNull() | (F.col("sec") >= F.col("_last") + ttl)).drop("_k", "_last"))
    runs = _written(_runs(points, ttl, span), "window-runs")
    kept = _greedy(runs.where(F.col("sec") < F.col("head") + span), ttl)
    late = runs.where(F.col("sec") >= F.col("head") + span)
    if not late.isEmpty():
        kept = _written(kept, "window-kept")
        last = kept.groupBy("k", "head").agg(F.max("sec").alias("sec"))
        pointers = _written(_pointers(late, last, ttl, span), "window-pointers")
        starts = pointers.join(last, ["k", "head", "sec"], "left_semi").where("nxt IS NOT NULL").select("k", "head", F.col("nxt").alias("sec"))
        reached = _followed(pointers, starts)
        kept = kept.union(late.join(reached, ["k", "head", "sec"], "left_semi").select("k", "head", "sec", "no"))
    side = kept.select(F.col("k").alias("_kept_key"), F.col("sec").alias("_kept_sec"), F.col("no").alias("_kept_no"))
    first = ((F.col(key) == F.col("_kept_key")) & (F.col(ts) == F.col("_kept_sec"))
             & (F.col(arrival) == F.col("_kept_no")))
    return df.join(side, first, "left_semi").unionByName(df.where(~timed))
