"""Activation, forwarding, clicks, coins, analytics, narrow feed and export jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import times
from ..functions.coerce import long_of, text_of
from ..operators import clicks, events, guards, lines, resolve, state as st
from ..operators.dims import Dims
from ..sinks.files import write_dated
from ..sources import messages


def activations(df: DataFrame, dims: Dims, arrival: str, *, state: DataFrame | None = None,
                tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Activation lines with channel, company, day parts and new-device flag; rejects stay, marked."""
    parsed = lines.active_lines(df.select(arrival, "value"), "value", tz)
    r = F.col("record")
    get = lambda n: F.try_element_at(r, F.lit(n))
    work = resolve.resolve_active(parsed, dims, game_id=get("agent_game_id"), game_channel_id=get("game_channel_id"))
    reason = F.coalesce("reject_reason", F.when(~F.col("resolved"), F.lit("game_channel_id error")))
    ts = F.col("line_ts")
    work = (work.withColumn("reject_reason", reason).withColumn("ok", F.col("reject_reason").isNull())
            .withColumn("device_id", text_of(get("device_id"))).withColumn("server_ts", ts)
            .withColumn("event", F.lit("active")).withColumn("ip", F.col("line_ip"))
            .withColumn("server_date_day", times.day(ts, tz)).withColumn("server_date_hour", times.hour(ts, tz))
            .withColumn("server_date_minute", times.minute(ts, tz))
            .withColumn("_key", F.when(F.col("ok"), F.concat_ws("_", F.lit("agent"), "channel_id", "game_id",
                                                                 "device_id"))))
    before = None if state is None else state.select(F.col("key").alias("_key"), "first_ts")
    flagged = st.new_device(work, ["_key"], arrival, "server_ts", state=before)
    return flagged.drop("record", "resolved", "line_ts", "line_ip", "_key")


def forward(df: DataFrame, pulled_at: Column | None = None, lz4: bool = True) -> DataFrame:
    """Queue messages -> (topic, value) per line; the topic is the data system."""
    named = messages.drop_unnamed(messages.message_lines(df, pulled_at, lz4))
    return named.select("*", F.col("data_system").alias("topic"), F.col("line").alias("value"))


def ad_clicks(df: DataFrame, ad_field: str = "adid") -> DataFrame:
    """Click lines, parsed and checked; feed for counts, details and lookup keys."""
    return lines.ad_click_lines(df, "value", ad_field)


def ad_click_counts(parsed: DataFrame, companies: dict[str, str]) -> DataFrame:
    """Per-minute counts of each company's target table."""
    split = clicks.company_split(parsed.where("ok"), companies).where(F.col("target").isNotNull())
    counts = (split.groupBy("target", "ad_id", F.substring("click_time", 1, 16).alias("_minute"), "game", "pf",
                            "channel").agg(F.count(F.lit(1)).cast("int").alias("click_cnt")))
    return clicks.ad_click_rows(counts, ["target"])


def ad_click_job(df: DataFrame, arrival: str, companies: dict[str, str], *, now: Column, ttl: int = 259200,
                 ad_field: str = "adid", tz: str = times.DEFAULT_TZ) -> dict[str, DataFrame]:
    """The whole click job from one parse: topic records, detail rows, store keys, counts per minute, rejects."""
    parsed = ad_clicks(df, ad_field)
    good = parsed.where("ok")
    split = clicks.company_split(good, companies).where(F.col("target").isNotNull())
    at = times.parse(F.col("click_time"), times.FULL, tz)
    keyed = clicks.lookup_keys(good).select("key", F.col(arrival).alias("value"), at.alias("at"), arrival)
    return {"topic": clicks.click_detail(split, [arrival, "target"]), "detail": clicks.click_detail_rows(good, [arrival]),
            "keys": st.latest_with_ttl(keyed, "key", "value", "at", arrival, ttl, now),
            "counts": ad_click_counts(parsed, companies), "rejects": lines.rejects(parsed, "ad_click", kept=[arrival])}


def page_clicks(df: DataFrame, tz: str = times.DEFAULT_TZ) -> DataFrame:
    return clicks.page_clicks_per_minute(lines.access_lines(df, "value", tz).where("ok"))


def coin_trades(df: DataFrame, dims: Dims, *, tsv: bool = False, tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Coin trades with resolved channel; a record with an unresolved field is a reject."""
    parsed = lines.coin_tsv_lines(df) if tsv else lines.coin_json_lines(df)
    work = resolve.resolve_coin(parsed.withColumnRenamed("ok", "_parsed"), dims)
    dated = work.withColumn("trade_date", times.render(long_of(F.col("trade_time")), "yyyyMMdd", tz))
    reason = (F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
              .when(F.col("game_id") == "", F.lit("game_id is empty"))
              .when(~F.coalesce(F.col("resolved"), F.lit(False)), F.lit("game_id is no number"))
              .when(guards.has_error(schemas.COIN), F.lit("unresolved field")))
    return (dated.withColumn("reject_reason", reason).withColumn("ok", F.col("reject_reason").isNull())
            .drop("_parsed", "resolved"))


def sdk_events(df: DataFrame, tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Analytics lines -> one JSON record per event; a line that gives none stays as it came, with a reason."""
    fan = lines.sdk_fanout(df, "value", tz)
    return fan.withColumn("value", F.when(F.col("ok"), F.to_json("record")).otherwise(F.col("value")))


def sdk_flat(df: DataFrame, groups: list[str], tz: str = times.DEFAULT_TZ) -> DataFrame:
    """``DATA[`` analytics lines flattened, with ip, time and day of the line; rejects stay, marked, without fields."""
    framed = lines.framed_lines(df, schemas.event_schema(groups), "DATA[", "value", tz)
    kept = [c for c in df.columns if c != "value"]
    flat = events.flatten_dashed(framed.select(*kept, "ok", "reject_reason", "line_ts", "line_ip", "doc.*").drop("_bad", "server_ts"))
    return (flat.withColumnsRenamed({"line_ip": "ip", "line_ts": "server_ts"})
            .withColumn("server_date_day", times.day(F.col("server_ts"), tz)))


def olap_feed(logins: DataFrame, orders: DataFrame) -> DataFrame:
    """Flattened logins and orders -> one narrow feed; only regular logins and paid orders."""
    none = F.lit("")
    lg = logins.where(events.olap_kept(F.col("event"), F.col("is_test"), none, none))
    od = orders.where(events.olap_kept(F.col("event"), F.col("is_test"), F.col("pay_status"), F.col("status")))
    left = events.olap_shape(lg, True).withColumns({"event": F.lit("login"), "money": F.lit(None).cast("double")})
    right = events.olap_shape(od, False, {"event": F.lit("order"), "money": F.col("money").try_cast("double")})
    return left.unionByName(right)


def cohort_export(df: DataFrame, game_channel_id: str, dates: list[str], path: str) -> None:
    """Device ids of new users, one folder per date."""
    write_dated(guards.new_user_cohort(df, game_channel_id, dates), path, "reg_date")


def replay(df: DataFrame, topic: str) -> DataFrame:
    """Text lines as they are, for one topic."""
    return df.select(F.lit(topic).alias("topic"), "value")

