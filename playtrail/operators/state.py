"""First-event state: what was known about a key just before each row.

The state of a key is the running minimum of its qualifying timestamps in
arrival order. The minimum is computed in blocks of arrival numbers:

1. one small row per (key, block) with the block's minimum (map-side combine),
2. a running minimum over those rows per key, together with the stored state,
3. the result enters each block as one extra row ahead of the real ones, and a
   window over (key, block) finishes the job.

So the rows of one key, however many, are spread over as many tasks as the key
has blocks; rows are shuffled once and nothing is joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times
from ..functions.coerce import blank
from ..session import fresh_path

BLOCK_ROWS = 1 << 20
# Fixed value: stands for a device without history in the back-fill.
NO_HISTORY = 999999999
LOGIN, ORDER, REGISTER, ACTIVE = "login", "order", "register", "active"


def prior_minimum(df: DataFrame, keys: list[str], arrival: str | list[str], marks: dict[str, Column],
                  state: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add, per entry of ``marks``, the minimum of that expression over earlier rows of the key.

    ``arrival`` is a BIGINT that orders the rows of a key, or such a column and further ones that order rows with
    the same number (the rows of one line); together they are unique within a key. A block spans ``block_rows``
    numbers of the first: widely spaced numbers ask for a larger value.
    ``state`` holds ``keys`` plus one column per mark with earlier knowledge.
    Rows with a NULL in any key get NULL; each is a group of its own, so that any number of them spreads over all tasks.
    """
    names = list(marks)
    tmp = [f"_m_{n}" for n in names]
    order = [arrival] if isinstance(arrival, str) else arrival
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    block = F.when(known, F.expr(f"cast(`{order[0]}` AS bigint) div {int(block_rows)}L")).otherwise(F.xxhash64(*order))
    base = df.select("*", *[marks[n].cast("bigint").alias(t) for n, t in zip(names, tmp)],
                     block.alias("_block"))

    per_block = (base.where(known).groupBy(*keys, "_block")
                 .agg(*[F.min(t).alias(t) for t in tmp]))
    if state is not None:
        floor_block = F.lit(-(2 ** 62)).cast("bigint")
        stored = state.groupBy(*keys).agg(*[F.min(F.col(n).cast("bigint")).alias(t)
                                            for n, t in zip(names, tmp)])
        per_block = per_block.unionByName(stored.withColumn("_block", floor_block))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(*keys, "_block", *[F.min(t).over(earlier).alias(t) for t in tmp])
    if state is not None:
        carried = carried.where(F.col("_block") > floor_block)
    carried = carried.where(reduce(lambda a, b: a | b, [F.col(t).isNotNull() for t in tmp]))

    rows = base.withColumn("_real", F.lit(1))
    both = rows.unionByName(carried.withColumn("_real", F.lit(0)), allowMissingColumns=True)
    within = (Window.partitionBy(*keys, "_block").orderBy("_real", *order)
              .rowsBetween(Window.unboundedPreceding, -1))
    keep = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return (both.select("*", *[F.min(t).over(within).alias(f"_p{t}") for t in tmp])
            .where(F.col("_real") == 1)
            .select(*keep, *[F.when(known, F.col(f"_p{t}")).alias(n) for n, t in zip(names, tmp)]))


def settled(df: DataFrame, label: str = "rows") -> DataFrame:
    """The rows, written once to the shared folder.

    `prior_minimum` reads its rows twice, and of the first reading only the key, the number and the marks. Where they
    come out of parsing and lookups, both would run twice; a written table is read by columns instead.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled_minimum(df: DataFrame, keys: list[str], marks: dict[str, Column],
                    state: DataFrame | None = None) -> DataFrame:
    """Order-free form: the final state per key, merged with the stored one."""
    found = df.groupBy(*keys).agg(*[F.min(c.cast("bigint")).alias(n) for n, c in marks.items()])
    if state is not None:
        found = (found.unionByName(state.select(*keys, *marks))
                 .groupBy(*keys).agg(*[F.min(n).alias(n) for n in marks]))
    return found.where(reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in marks]))


def usable(part: Column) -> Column:
    """A key part that may enter the state."""
    return ~blank(part) & (part != "error")


def state_key(*parts: Column) -> Column:
    """Joined key text; NULL when a part may not enter the state."""
    ok = reduce(lambda a, b: a & b, [usable(p) for p in parts])
    return F.when(ok, F.concat_ws("_", *parts))


# Services whose key is that of the agency, and services that write state.
AGENCY, DOMESTIC, OVERSEAS, SDK, CHANNEL = "agent", "domestic", "overseas", "sdk", "channel"
AGENCY_KEYED, WRITERS = (AGENCY, DOMESTIC), (AGENCY, DOMESTIC, OVERSEAS)


def service_key(service: str, event: Column, *, channel_id: Column, game_id: Column, user_id: Column,
                device_id: Column, game_name: Column | None = None, app_id: Column | None = None) -> Column:
    """State key of a service's row, the same in every job: a missing part is blank, no part bars a key.

    Agency and domestic own channel share agent_channel_game_user; other own channels have
    channel_service_game_user; analytics go by game name and app. Activations and crashes
    are keyed by device, and by channel alone where the channel is part of the key.
    """
    part = lambda c: F.coalesce(F.lit("") if c is None else c.cast("string"), F.lit(""))
    by_device = F.coalesce(event.isin("active", "crash"), F.lit(False))
    who = F.when(by_device, part(device_id)).otherwise(part(user_id))
    if service in AGENCY_KEYED:
        return F.concat_ws("_", F.lit("agent"), part(channel_id), F.when(~by_device, part(game_id)), who)
    if service == SDK:
        return F.concat_ws("_", F.lit("agent"), part(game_name), part(app_id), who)
    if service == CHANNEL:
        return F.when(by_device, F.concat(F.lit("agent_channel"), who)) \
            .otherwise(F.concat(F.lit("agent_channel_"), part(game_id), who))
    return F.concat_ws("_", F.lit("channel"), F.lit(service), part(game_id), who)


def paid(pay_status: Column, status: Column, flag_only: bool = False) -> Column:
    """A paid order; history exports only carry the pay flag."""
    if flag_only:
        return pay_status.isin("success", "1")
    return ((pay_status == "success") & (status == "paid_success")) | ((pay_status == "1") & (status == "2"))


def login_mark(event: Column, ts: Column, is_test: Column) -> Column:
    return F.when((event == LOGIN) & (is_test == "regular"), ts)


def order_mark(event: Column, ts: Column, is_test: Column, is_paid: Column) -> Column:
    return F.when((event == ORDER) & (is_test == "regular") & is_paid, ts)


def date_columns(event: Column, ts: Column, login_ts: Column, order_ts: Column,
                 tz: str = times.DEFAULT_TZ) -> dict[str, Column]:
    """The five columns stamped on every surviving row, from the prior state."""
    today = times.day(ts, tz)
    first_order = (F.when(order_ts.isNull() | ((event == ORDER) & (order_ts > ts)),
                          F.when(event == ORDER, today).otherwise(F.lit("")))
                   .otherwise(times.day(order_ts, tz)))
    first_login = (F.when(login_ts.isNull() | ((event == LOGIN) & (login_ts > ts)), today)
                   .otherwise(times.day(login_ts, tz)))
    return {"first_order_date": first_order, "server_date_day": today,
            "server_date_hour": times.hour(ts, tz), "server_date_minute": times.minute(ts, tz),
            "reg_date": first_login}


def first_events(df: DataFrame, arrival: str | list[str], key: Column, event: Column, ts: Column,
                 is_test: Column, pay_status: Column, status: Column, *,
                 flag_only: bool = False, state: DataFrame | None = None,
                 tz: str = times.DEFAULT_TZ, block_rows: int = BLOCK_ROWS,
                 shortest: int = 0, writes: bool = True) -> DataFrame:
    """Stamp first login and first payment dates in arrival order.

    ``state`` is ``key, login_ts, order_ts``. ``shortest`` drops history below that
    value (10-digit rule of the service-scoped store). Without ``writes`` the rows only
    read the stored state.
    """
    work = df.select("*", key.alias("__key"), event.alias("__event"), ts.cast("bigint").alias("__ts"),
                     is_test.alias("__test"), pay_status.alias("__pay"), status.alias("__status"))
    long_enough = F.lit(writes) & (F.col("__ts") >= shortest if shortest else F.lit(True))
    marks = {
        "login_ts": F.when(long_enough, login_mark(F.col("__event"), F.col("__ts"), F.col("__test"))),
        "order_ts": F.when(long_enough, order_mark(
            F.col("__event"), F.col("__ts"), F.col("__test"),
            paid(F.col("__pay"), F.col("__status"), flag_only)))}
    before = None
    if state is not None:
        keep = {c: (F.when(F.col(c) >= shortest, F.col(c)) if shortest else F.col(c)) for c in marks}
        before = state.select(F.col("key").alias("__key"), *[v.alias(c) for c, v in keep.items()])
    seen = prior_minimum(work, ["__key"], arrival, marks, before, block_rows)
    out = date_columns(F.col("__event"), F.col("__ts"), F.col("login_ts"), F.col("order_ts"), tz)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in out]
    return seen.select(*kept, *[c.alias(n) for n, c in out.items()])


def first_event_state(df: DataFrame, key: Column, event: Column, ts: Column, is_test: Column,
                      pay_status: Column, status: Column, *, flag_only: bool = False,
                      state: DataFrame | None = None) -> DataFrame:
    """State after the whole input: ``key, login_ts, order_ts``."""
    marks = {"login_ts": login_mark(event, ts, is_test),
             "order_ts": order_mark(event, ts, is_test, paid(pay_status, status, flag_only))}
    work = df.select(key.alias("key"), *[c.alias(n) for n, c in marks.items()]).where("key is not null")
    return settled_minimum(work, ["key"], {n: F.col(n) for n in marks}, state)


def first_order_dates(df: DataFrame, arrival: str | list[str], key: Column, ts: Column, is_paid: Column, *,
                      state: DataFrame | None = None, tz: str = times.DEFAULT_TZ,
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Database orders: first payment date even while unpaid, first login from the stored state."""
    work = df.select("*", key.alias("__key"), ts.cast("bigint").alias("__ts"), is_paid.alias("__paid"))
    before = None
    if state is not None:
        before = state.select(F.col("key").alias("__key"), "order_ts", "login_ts")
    marks = {"order_ts": F.when(F.col("__paid"), F.col("__ts")), "login_ts": F.lit(None)}
    seen = prior_minimum(work, ["__key"], arrival, marks, before, block_rows)
    now, hist, login = F.col("__ts"), F.col("order_ts"), F.col("login_ts")
    today = times.day(now, tz)
    out = {"first_order_date": F.when(hist.isNull() | (hist > now), today).otherwise(times.day(hist, tz)),
           "server_date_day": today, "server_date_hour": times.hour(now, tz),
           "server_date_minute": times.minute(now, tz),
           "reg_date": F.when(login.isNull(), today).otherwise(times.day(login, tz))}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in out]
    return seen.select(*kept, *[c.alias(n) for n, c in out.items()])


def new_device(df: DataFrame, keys: list[str], arrival: str | list[str], ts: str, *,
               state: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """1 when the key has no history or the row is not later than it, else 0."""
    seen = prior_minimum(df, keys, arrival, {"_first": F.col(ts)},
                         None if state is None else state.select(*keys, F.col("first_ts").alias("_first")),
                         block_rows)
    fresh = F.col("_first").isNull() | (F.col(ts) <= F.col("_first"))
    return seen.withColumn("new_device", F.when(fresh, 1).otherwise(0)).drop("_first")


def first_seen(df: DataFrame, keys: list[str], arrival: str | list[str], *, state: DataFrame | None = None,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """1 for the first row of a key that the stored state does not know, else 0."""
    before = None if state is None else state.select(*keys, F.lit(-1).cast("bigint").alias("_seen"))
    seen = prior_minimum(df, keys, arrival, {"_seen": F.lit(1)}, before, block_rows)
    return seen.withColumn("new_device", F.when(F.col("_seen").isNull(), 1).otherwise(0)).drop("_seen")


def read_through(keys: DataFrame, hot: DataFrame, cold: DataFrame) -> DataFrame:
    """State of each key: both values from the durable store unless the hot login value exists."""
    h = hot.select("key", F.struct("login_ts", "order_ts").alias("_hot"))
    c = cold.select("key", F.struct("login_ts", "order_ts").alias("_cold"))
    pick = F.when(F.col("_hot.login_ts").isNull(), F.col("_cold")).otherwise(F.col("_hot"))
    return (keys.join(h, "key", "left").join(c, "key", "left")
            .select("key", pick["login_ts"].alias("login_ts"), pick["order_ts"].alias("order_ts")))


def insert_if_absent(rows: DataFrame, target: DataFrame | None, key: str, arrival: str, day: str | None = None) -> DataFrame:
    """Rows whose key the target lacks; of several rows with one key the first wins.

    ``day`` names a column of both by which the target is partitioned, and says that rows of one key are of one day, as
    keys made of a record with its time are. The days of the load, a short list, then reach the target's scan as a
    partition filter, and of these days only the keys at hand are carried on.
    """
    others = [c for c in rows.columns if c != key]
    packed = F.min_by(F.struct(*[F.col(f"`{c}`") for c in others]), F.col(arrival)).alias("_v")
    first = rows.groupBy(key).agg(packed).select(key, *[F.col(f"_v.`{c}`").alias(c) for c in others])
    if target is None:
        return first
    if day is None:
        return first.join(target.select(key), key, "left_anti")
    days = [r[0] for r in rows.select(day).distinct().collect()]
    held = target.where(F.col(day).isin(days)).select(key)
    known = held.join(rows.select(key), key, "left_semi")
    return first.join(known, key, "left_anti")


def latest_with_ttl(df: DataFrame, key: str, value: str, ts: str, arrival: str, ttl: int,
                    now: Column) -> DataFrame:
    """Key-value store after the input: last write per key, gone ``ttl`` seconds later."""
    last = F.max_by(F.struct(F.col(value), F.col(ts)), F.col(arrival)).alias("_v")
    kept = df.groupBy(key).agg(last).select(
        key, F.col(f"_v.{value}").alias(value),
        (F.col(f"_v.{ts}") + (ttl if ttl else 2 ** 40)).alias("expires_at"))
    return kept.where(F.col("expires_at") > now)


def backfill_new_device(rows: DataFrame, state: DataFrame, keys: list[str], registered: str) -> DataFrame:
    """Recompute the flag of stored rows from the state; without state the row is not new."""
    known = rows.join(state.select(*keys, F.col("first_ts").alias("_first")), keys, "left")
    flag = F.when(F.coalesce(F.col("_first"), F.lit(NO_HISTORY)) < F.col(registered), 0).otherwise(1)
    return known.withColumn("new_device", flag).drop("_first")
