"""Order and own-channel database jobs.

Every line comes out: changed rows on their route with the whole record, lines and rows that cannot be read on the
``Error`` route with the line and a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import times
from ..functions.coerce import epoch_of_text, text_of
from ..operators import events, guards, lines, records, resolve, route, state as st
from ..operators.dims import Dims
from ..operators.geo import add_region
from ..operators.lookup import Dimension
from ..sinks.files import record_json

STAMPS = ["first_order_date", "server_date_day", "server_date_hour", "server_date_minute", "reg_date"]
REGION = ["country", "province", "city"]
RESOLVED = ["channel_id", "game_channel_id", "os_type", "company_id"]
COPY_TABLE = "agent_order_copy"


def _changed_rows(df: DataFrame, fields: list[str], wrapped: bool, arrival: str, names: dict[str, str] | None = None,
                  tables: dict[str, str] | None = None) -> DataFrame:
    """arrival, value (of a reject: the line, or the row's text), row_no, table, raw, data, reject_reason, broken."""
    inner = lines.wrapped_lines(df, out="_line") if wrapped else df.withColumn("_line", F.col("value"))
    rows = lines.binlog_rows(inner.select(arrival, "value", "_line"), fields, "_line", names, tables, aside=("value",))
    return rows.select(arrival, F.coalesce("value", F.when(F.col("reject_reason").isNotNull(), F.col("raw"))).alias("value"), F.coalesce("row_no", F.lit(0)).alias("row_no"), "table", "raw", "data",
                       "reject_reason", F.col("reject_reason").isNotNull().alias("broken"))


def _agency_rows(df: DataFrame, wrapped: bool, arrival: str) -> DataFrame:
    rows = _changed_rows(df, schemas.AGENCY_ORDER, wrapped, arrival)
    return rows.select("*", *[F.col("data")[c].alias(c) for c in schemas.AGENCY_ORDER]).drop("data")


def agency_orders(df: DataFrame, dims: Dims, regions: Dimension, special: Dimension, test_rules: guards.ServerRules,
                  arrival: str, *, source: str = "agentDBSrc", state: DataFrame | None = None,
                  wrapped: bool = True, flag_only: bool = False, tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Agency order change data: channel, exclusions, first payment, region, route, whole record.

    Copy rows keep their ids and only get a region. Stamps are set on rows of the main route.
    The key needs no region, so the state step runs before the region lookup.
    """
    dims.measured(*resolve.AGENCY_DIMS, also=(regions, special, *test_rules.dimensions()))
    rows = _agency_rows(df, wrapped, arrival)
    copied = F.col("table") == COPY_TABLE
    rows = rows.withColumn("_order", ~F.col("broken") & ~F.coalesce(copied, F.lit(False))).withColumn("_given", F.col("channel_id"))
    work = resolve.resolve_order(rows, dims, game_id=F.when(F.col("_order"), F.col("game_id")), column=F.col("channel_id"))
    work = work.withColumn("_joined", F.col("_order") & F.col("resolved"))
    work = guards.flag_test_orders(work, test_rules)
    work = guards.member(work, F.col("game_channel_id"), special, "_special")
    target = route.route_order(source, F.coalesce(copied, F.lit(False)), F.col("resolved"),
                               ~guards.not_in(F.col("channel_id")), F.col("is_test_order"), F.col("_special"))
    work = work.withColumn("route", F.when(F.col("broken"), F.lit(route.destination(source) + route.ERROR_END)).otherwise(target))
    joined = lambda c: F.when(F.col("_joined"), c)
    work = work.withColumns({
        **{c: joined(F.col(c)) for c in RESOLVED[1:]}, "channel_id": F.when(F.col("_joined"), F.col("channel_id")).otherwise(F.col("_given")),
        "server_ts": joined(epoch_of_text(F.col("update_time"), times.FULL, tz)), "event": joined(F.lit("order")),
        "is_test": joined(F.lit(events.REGULAR))})
    work = st.settled(work, "agency-orders")
    main = F.col("route") == route.destination(source)
    key = F.when(main, st.state_key(F.col("user_id"), F.col("game_channel_id")))
    out = st.first_events(work, [arrival, "row_no"], key, F.col("event"), F.col("server_ts"), F.col("is_test"),
                          F.col("pay_status"), F.col("status"), flag_only=flag_only, state=state, tz=tz)
    out = out.withColumns({c: F.when(main, F.col(c)) for c in STAMPS})
    out = add_region(out, regions, F.lit(""), F.col("create_ip"), work)
    located = {c: F.when(~F.col("broken"), F.col(c)) for c in REGION}
    moved = F.when(F.col("channel_id") != F.col("_given"), F.col("channel_id"))
    changed = {"order_sn": F.col("order_sn"), **located, "channel_id": moved, **{c: F.col(c) for c in RESOLVED[1:]},
               "server_ts": F.col("server_ts"), "update_time": F.col("server_ts"), "event": F.col("event"),
               "is_test": F.col("is_test"), **{c: F.col(c) for c in STAMPS}}
    whole = records.with_record(out, "value", F.when(~F.col("broken"), records.entries(F.col("raw"))), changed, F.col("value"))
    return (whole.withColumn("update_time", F.coalesce(F.col("server_ts").cast("string"), F.col("update_time")))
            .drop("_special", "_order", "_given", "_joined", "is_test_order", "resolved", "raw", "broken"))


def own_orders(df: DataFrame, dims: Dims, special: Dimension | None, arrival: str, *, source: str,
               overseas: bool = False, folded_into: str | None = None, state: DataFrame | None = None,
               wrapped: bool = True, names: dict[str, str] | None = None, tables: dict[str, str] | None = None,
               tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Own-channel change data: order rows become flat order events; all other tables are filtered.

    A row of another table is nested under the table's name; an order row without a game stays as it came.
    """
    dims.measured("belong", "company", "os", *(("rate",) if overseas else ()), also=(special,))
    rows = _changed_rows(df, schemas.OWN_ORDER, wrapped, arrival, names, tables)
    is_order = F.coalesce((F.col("table") == "order") & (text_of(F.col("data.game_id")) != ""), F.lit(False))
    work = events.order_event(rows.withColumn("_order", is_order & ~F.col("broken")), dims, overseas=overseas, flat=True,
                              only=F.col("_order"), tz=tz)
    ok = F.col("_order")
    if overseas:
        work = resolve.fx_convert(work, dims, F.col("currency_type"), F.col("money"))
    if special is not None:
        work = guards.member(work, F.col("game_channel_id"), special, "_special")
        ok = ok & F.col("_special")
    work = st.settled(work.withColumn("ok", ok), "own-orders")
    key = F.when(F.col("ok"), st.state_key(F.col("user_id"), F.col("game_channel_id")))
    stamped = st.first_events(work, [arrival, "row_no"], key, F.col("event"), F.col("server_ts"), F.col("is_test"),
                              F.col("pay_status"), F.col("status"), state=state, tz=tz)
    stamped = stamped.withColumns({c: F.when(F.col("ok"), F.col(c)) for c in STAMPS})
    target = F.when(F.col("broken"), F.lit(route.destination(source) + route.ERROR_END)).otherwise(
        route.route_own_order(source, F.col("table"), F.col("ok"), folded_into))
    aside = (arrival, "value", "row_no", "table", "raw", "data", "reject_reason", "broken", "ok", "_special", "_order")
    body = [c for c in stamped.columns if c not in aside]
    nested = F.to_json(F.create_map(F.coalesce("table", F.lit("")), F.try_parse_json("raw")))
    value = (F.when(F.col("broken"), F.col("value")).when(F.col("_order"), record_json(body))
             .when(F.col("table") == "order", F.col("raw")).otherwise(nested))
    fields = ["game_id", "channel_id", "game_channel_id", "company_id", "cny_amount", "usd_amount", "order_type", *STAMPS]
    return stamped.select(arrival, "row_no", target.alias("route"), "reject_reason", value.alias("value"),
                          *[F.when(F.col("_order"), F.col(c)).alias(c) for c in fields])


def channel_database(df: DataFrame, dims: Dims, special: Dimension | None, arrival: str, *, service: str,
                     overseas: bool = False, state: DataFrame | None = None, leaf_names: bool = False,
                     names: dict[str, str] | None = None, tables: dict[str, str] | None = None,
                     tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Orders and registers of an own channel as flattened events with stamps, other tables as they are.

    Result: arrival, row_no, route (``orders``, ``side_orders``, ``others``, ``rejects``), reason, the event as JSON.
    Orders, side orders and registers share the key of the user; whether they write state goes by ``service``.
    With ``special`` (the domestic form) registers and orders outside the set go to the others, nested and unstamped.
    """
    fields = list(dict.fromkeys(schemas.OWN_ORDER + schemas.USER_ROW))
    rows = _changed_rows(df, fields, False, arrival, names, tables)
    dims.measured("belong", "company", "os", "by_game_channel", *(("rate",) if overseas else ()), also=(special,))
    work = events.database_events(rows, dims, F.col("table"), overseas=overseas, tz=tz)
    apart = F.lit(False)
    if special is not None:
        work = guards.member(work, F.col("agent.game_channel_id"), special, "_special")
        apart = (F.col("table") == "user") | ((F.col("table") == "order") & ~F.col("_special"))
    work = work.withColumn("_apart", F.coalesce(apart, F.lit(False))).drop("_special")
    work = st.settled(work, "channel-database")
    stamps = F.col("is_event") & ~F.col("_apart")
    key = F.when(stamps, st.service_key(
        service, F.col("event"), channel_id=F.col("agent.channel_id"), game_id=F.col("game.game_id"),
        user_id=F.col("user.user_id"), device_id=F.col("device.device_id")))
    stamped = st.first_events(work, [arrival, "row_no"], key, F.col("event"), F.col("server_ts"), F.col("is_test"),
                              F.col("order.order_status"), F.col("order.order_step"), state=state, tz=tz,
                              shortest=10 ** 9, writes=service in st.WRITERS)
    target = (F.when(F.col("broken"), F.lit("rejects")).when(~F.col("is_event") | F.col("_apart"), F.lit("others"))
              .when(F.col("table") == "order_side", F.lit("side_orders")).otherwise(F.lit("orders")))
    aside = (arrival, "value", "row_no", "table", "raw", "data", "reject_reason", "broken", "is_event", "_apart")
    plain = [c for c in stamped.columns if c not in aside]
    nested = stamped.select(F.struct(arrival, "row_no", target.alias("route"), "is_event", "reject_reason", "broken", "_apart",
                                     "raw", "value").alias("h"), *plain)
    flat_of = events.flatten_leaf if leaf_names else events.flatten_dashed
    body = [c.alias(n) for n, c in flat_of(nested.select(*plain), as_columns=True).items()]
    whole = F.struct(*[F.col(c) for c in plain if c not in STAMPS])
    value = (F.when(F.col("h.broken"), F.col("h.value")).when(~F.col("h.is_event"), F.col("h.raw"))
             .when(F.col("h._apart"), F.to_json(whole)).otherwise(F.to_json(F.struct(*body))))
    return nested.select(f"h.{arrival}", "h.row_no", "h.route", "h.reject_reason", value.alias("value"))


def agency_order_join(df: DataFrame, dims: Dims, regions: Dimension, special: Dimension, test_rules: guards.ServerRules,
                      arrival: str, *, topic: str, state: DataFrame | None = None, batch: bool = False,
                      tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Agency order join: copy rows get a region and a day, order rows channel, dates and a route; whole records.

    ``batch`` reads exports: text times, pay flag alone, all own channels excluded. The key is that of the login
    history, ``agent_channel_game_user``, whatever its parts hold. Rows of other tables and of excluded channels
    are not part of the result.
    """
    dims.measured(*resolve.AGENCY_DIMS, also=(regions, special, *test_rules.dimensions()))
    rows = _agency_rows(df, False, arrival)
    rows = rows.where(F.col("broken") | F.col("table").isin("agent_order", COPY_TABLE))
    copied = F.coalesce(F.col("table") == COPY_TABLE, F.lit(False))
    rows = rows.withColumn("_given", F.col("channel_id")).withColumn("_main", ~F.col("broken") & ~copied)
    work = resolve.resolve_order(rows, dims, game_id=F.when(F.col("_main"), F.col("game_id")), column=F.col("channel_id"))
    work = events.cast_columns(work, {"pay_status": "int", "status": "int", "money": "double"})
    excluded = guards.OWN_CHANNELS if batch else guards.OVERSEAS_CHANNELS
    work = work.where(~F.col("_main") | guards.not_in(F.col("channel_id"), excluded))
    ts = epoch_of_text(F.when(copied, F.col("create_time")).otherwise(F.col("update_time")), times.FULL, tz)
    work = st.settled(work.withColumn("_ts", ts), "agency-order-join")
    paid = (F.col("pay_status") == 1) if batch else (F.col("pay_status") == 1) & (F.col("status") == 2)
    key = F.when(F.col("_main"), st.service_key(st.AGENCY, F.lit(st.ORDER), channel_id=F.col("channel_id"),
                                                game_id=F.col("game_id"), user_id=F.col("user_id"), device_id=F.lit("")))
    stamped = st.first_order_dates(work, [arrival, "row_no"], key, F.col("_ts"), paid, state=state, tz=tz)
    flagged = guards.flag_test_orders(stamped, test_rules)
    flagged = guards.member(flagged, F.col("game_channel_id"), special, "_special")
    flagged = add_region(flagged, regions, F.when(copied, F.col("create_ip")), counted=work)
    target = (F.when(F.col("broken"), F.lit(topic + route.ERROR_END)).when(copied, F.lit(topic + route.COPY))
              .when(F.col("is_test_order"), F.lit(topic + route.TEST))
              .when(F.col("_special"), F.lit(topic + route.OTHER)).otherwise(F.lit(topic)))
    main = lambda c: F.when(F.col("_main"), c)
    own = ["game_channel_id", "os_type", "company_id", "first_order_date", "server_date_hour",
           "server_date_minute", "reg_date"]
    done = (flagged.withColumn("route", target).withColumns({c: main(F.col(c)) for c in own})
            .withColumns({c: F.when(copied, F.col(c)) for c in REGION})
            .withColumn("server_date_day", F.when(~F.col("broken"), F.col("server_date_day")))
            .withColumn("channel_id", F.when(F.col("_main"), F.col("channel_id")).otherwise(F.col("_given"))))
    changed = {"order_sn": F.col("order_sn"), "channel_id": F.when(F.col("channel_id") != F.col("_given"), F.col("channel_id")),
               "game_channel_id": F.col("game_channel_id"), "sub_pf": F.col("os_type"), "company_id": F.col("company_id"),
               "update_time": main(F.col("_ts")), **{c: F.col(c) for c in STAMPS}, **{c: F.col(c) for c in REGION}}
    staged = records.once(done, {"_items": F.when(~F.col("broken"), records.entries(F.col("raw")))})
    items = F.when(copied, F.col("_items")).otherwise(records.flat(F.col("_items")))
    return (records.with_record(staged, "value", items, changed, F.col("value"))
            .drop("_items", "_given", "_main", "_ts", "_special", "is_test_order", "resolved", "raw", "broken"))
