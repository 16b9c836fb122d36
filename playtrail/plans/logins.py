"""Login cleaning: parse, check, locate, resolve, stamp, route."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import times
from ..functions.coerce import double_of, int_of, text_of
from ..operators import guards, lines, records, resolve, route, rules as rl, state as st
from ..operators.dims import Dims
from ..operators.events import flatten_dashed, login_event
from ..operators.geo import add_region
from ..operators.lookup import Dimension
from ..sinks.files import record_json

STAMPS = ["first_order_date", "server_date_day", "server_date_hour", "server_date_minute", "reg_date"]
GROUPS = ["user", "game", "agent", "device", "channel_platform"]
REGION = ["country", "province", "city"]


def _field_set(struct: str, df: DataFrame, given: dict[str, Column]) -> Column:
    names = df.schema[struct].dataType.names
    cols = [given.get(n, F.col(struct)[n]).alias(n) for n in names]
    return F.struct(*cols, *[c.alias(n) for n, c in given.items() if n not in names])


State = DataFrame | Callable[[DataFrame], DataFrame] | None


def _stamp(df: DataFrame, arrival: str, state: State, flag_only: bool, tz: str) -> DataFrame:
    """``state`` is the stored state, or gives that of the keys it is called with."""
    key = F.when(F.col("ok"), st.state_key(F.col("user.user_id"), F.col("agent.game_channel_id")))
    if callable(state):
        state = state(df.select(key.alias("key")).where("key IS NOT NULL"))
    return st.first_events(df, arrival, key, F.col("event"), int_of(F.col("server_ts").cast("string")),
                           F.col("is_test"), F.lit(""), F.lit(""), flag_only=flag_only, state=state, tz=tz)


def agency_logins(df: DataFrame, dims: Dims, regions: Dimension, special: Dimension, arrival: str, *,
                  rules: list[rl.Rule], source: str = "agentLoginSrc", state: State = None,
                  wrapped: bool = True, strict: bool = True, flag_only: bool = False,
                  tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Old-format agency logins. Result: arrival, route, value, reject_reason and the stamps.

    ``flag_only`` is the batch replay, which reads only the durable state.
    """
    dims.measured(*resolve.AGENCY_DIMS, also=(regions, special))
    inner = lines.wrapped_lines(df, out="_line") if wrapped else df.withColumn("_line", F.col("value"))
    parsed = login_event(lines.old_login_lines(inner, "_line", tz))
    guard = guards.threshold_guard(F.col("game.game_id"), F.col("agent.game_channel_id"))
    named = parsed.withColumn("reject_reason", F.coalesce(
        F.col("reject_reason"), F.when(~guard, F.lit("game channel missing"))))
    # a login event built from a flat record has every common field by construction
    failing = rl.first_failure(F.struct(*[F.col(c) for c in ("event", "user", "game", "agent", "device")]),
                               [r for r in rules if r[0] == "login"])
    checked = named.withColumn("reject_reason", F.coalesce("reject_reason", rl.failure_text(failing)))
    work = resolve.resolve_login(checked.withColumn("ok", F.col("reject_reason").isNull()), dims, agent=F.col("agent"), game_id=F.col("game.game_id"),
                                 channel_id=F.col("agent.channel_id"),
                                 game_channel_id=F.col("agent.game_channel_id"), strict=strict)
    merged = (work.withColumn("agent", _field_set("agent", work, {
        "channel_id": F.col("channel_id"), "game_channel_id": F.col("game_channel_id")}))
        .withColumn("game", _field_set("game", work, {"company_id": F.col("company_id")}))
        .withColumn("device", _field_set("device", work, {"os_type": F.col("os_type")}))
        .withColumn("reject_reason", F.coalesce("reject_reason", F.when(~F.col("resolved"), F.lit("channel excluded"))))
        .withColumn("ok", F.col("reject_reason").isNull())
        .drop("channel_id", "game_channel_id", "company_id", "os_type", "resolved"))
    flagged = guards.member(merged, F.col("agent.game_channel_id"), special, "_special")
    rows = st.settled(flagged, "agency-logins")
    stamped = _stamp(rows, arrival, state, flag_only, tz)
    stamped = add_region(stamped, regions, F.col("client_ip"), counted=rows)
    return _routed(stamped, arrival, route.route_login(source, F.col("ok"), F.col("_special")))


def own_logins(df: DataFrame, dims: Dims, regions: Dimension, special: Dimension | None, arrival: str, *,
               rules: list[rl.Rule], source: str, folded_into: str | None = None, wrapped: bool = True,
               state: State = None, strict: bool = True, flag_only: bool = False,
               aliases: dict[str, str] | None = None, names: dict[str, str] | None = None,
               tz: str = times.DEFAULT_TZ) -> DataFrame:
    """New-format own-channel logins; with ``special`` only logins inside the set count.

    ``names`` maps the groups of a log that calls them otherwise to the names used here; the record keeps its own.
    """
    dims.measured("belong", "company", also=(regions, special))
    inner = lines.wrapped_lines(df, out="_line") if wrapped else df.withColumn("_line", F.col("value"))
    if names:
        inner = inner.withColumn("_renamed", lines.renamed_line(F.col("_line"), "DATA[", names))
    framed = lines.framed_lines(inner, schemas.event_schema(GROUPS), "DATA[", "_renamed" if names else "_line", tz, frame=False)
    checked = rl.validated(framed, "doc", [r for r in rules if r[0] == "login"])
    d = F.col("doc")
    is_login = F.when(text_of(d["event"]) != "login", F.lit("not a login"))
    platform = guards.channel_guard(d["channel_platform"], d["channel_platform"]["ad_id"], d["game"]["game_id"])
    reason = F.coalesce("reject_reason", is_login)
    if strict and special is None:
        reason = F.coalesce(reason, F.when(~F.coalesce(platform, F.lit(False)), F.lit("channel platform missing")))
    opened = checked.withColumn("reject_reason", reason).select(
        *[c for c in df.columns if c != "value"], "value", "reject_reason", "line_ip", "line_ts",
        lines.payload_of(F.col("_line"), "DATA[").alias("_raw"), "doc.*")
    work = resolve.resolve_own(opened.withColumn("ok", F.col("reject_reason").isNull()).drop("_bad", *REGION), dims, game_id=text_of(F.col("game.game_id")), aliases=aliases)
    work = work.withColumn("game", _field_set("game", work, {
        "app_id": F.col("app_id"), "company_id": F.col("company_id")}))
    swapped, not_web = resolve.game_app_swap(F.col("game"))
    reason = F.coalesce("reject_reason", F.when(~not_web, F.lit("web pay game")))
    if special is not None:
        work = guards.member(work, F.col("game_channel_id"), special, "_special")
        reason = F.coalesce(reason, F.when(~resolve.own_login_kept(F.col("event"), F.col("_special")),
                                           F.lit("outside the special set")))
    merged = (work.withColumn("reject_reason", reason).withColumn("ok", F.col("reject_reason").isNull())
              .withColumn("game", swapped)
              .withColumn("agent", F.struct(F.col("channel_id"), F.col("game_channel_id"),
                                            text_of(F.col("agent.access_token")).alias("access_token")))
              .drop("app_id", "channel_id", "game_channel_id", "company_id"))
    rows = st.settled(merged, "own-logins")
    stamped = _stamp(rows, arrival, state, flag_only, tz)
    stamped = add_region(stamped, regions, F.col("client_ip"), counted=rows)
    return _routed(stamped, arrival, route.route_login(source, F.col("ok"), None, folded_into), "_raw")


OWN_CHANGED = ["agent-channel_id", "agent-game_channel_id", "game-game_id", "game-app_id", "game-company_id", *REGION, *STAMPS]


def _routed(df: DataFrame, arrival: str, destination: Column, raw: str | None = None) -> DataFrame:
    """Flattened columns, and as ``value`` the record: made of them, or the whole of ``raw`` with the changed fields."""
    groups = [g for g in GROUPS if g in df.columns]
    tops = [c for c in schemas.TOP if c in df.columns and c != "status"]
    given = [F.col(raw).alias("_raw")] if raw else []
    flat = flatten_dashed(df.select(arrival, "value", "ok", "reject_reason", destination.alias("route"), *given,
                                    *groups, *tops, *STAMPS))
    if raw:
        staged = records.once(flat, {"_items": F.when(F.col("ok"), records.entries(F.col("_raw")))})
        whole = records.with_record(staged, "value", records.flat(F.col("_items")), {c: F.col(f"`{c}`") for c in OWN_CHANGED}, F.col("value"))
        return whole.drop("_items", "_raw")
    body = [c for c in flat.columns if c not in (arrival, "value", "ok", "reject_reason", "route")]
    record = F.when(F.col("ok"), record_json(body)).otherwise(F.col("value"))
    return flat.withColumn("value", record)


def service_shape(rules: list[rl.Rule], groups: list[str] | None = None) -> T.StructType:
    """Fields of the chosen groups (default: all) and every field a rule names."""
    wanted = {g: list(schemas.GROUPS[g]) for g in (groups or schemas.GROUPS)}
    for _, grp, name, _ in rules:
        if name not in wanted.setdefault(grp, []):
            wanted[grp].append(name)
    return schemas.event_fields(wanted)


def _agency_lines(df: DataFrame, arrival: str, rules: list[rl.Rule], tz: str) -> DataFrame:
    """Agency lines of the generic clean: old-format logins as events; activation lines are only marked."""
    parsed = login_event(lines.old_login_lines(df.select(arrival, "value"), "value", tz))
    guard = guards.threshold_guard(F.col("game.game_id"), F.col("agent.game_channel_id"))
    failing = rl.first_failure(F.struct(*[F.col(c) for c in ("event", "user", "game", "agent", "device")]),
                               [r for r in rules if r[0] == "login"])
    reason = F.coalesce("reject_reason", F.when(~guard, F.lit("game channel missing")), rl.failure_text(failing))
    absent = {g: F.lit(None).cast(schemas.texts(schemas.GROUPS[g])) for g in ("order", "sdk_platform", "channel_platform")}
    return (parsed.withColumn("reject_reason", reason).withColumns(absent).drop("ok")
            .withColumn("_active", F.col("value").contains("ACTIVE_LOG")))


def service_events(df: DataFrame, dims: Dims, regions: Dimension, special: Dimension, arrival: str, *,
                   service: str, rules: list[rl.Rule] = rl.DEFAULT_RULES, state: DataFrame | None = None,
                   batch: bool = False, int_strict: bool = False, folded: dict[str, str] | None = None,
                   overseas: bool = False, only_special_logins: str | None = None,
                   aliases: dict[str, str] | None = None, names: dict[str, str] | None = None,
                   tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Generic clean of one service: ``agent``, ``sdk``, ``channel`` or an own-channel name.

    Agency lines are old-format logins; their activation lines go on as they are (route ``agentActive``). Lines of the
    other services need the tag, not the frame. ``overseas`` adds converted amounts to orders; ``only_special_logins``
    (``keep`` or ``drop`` for other events) limits own-channel logins to the special set. ``value`` is the flattened
    whole record, or the raw line of a reject. State is written by the services of ``state.WRITERS`` only. ``names``
    maps the groups of a log that calls them otherwise to the names used here; the record keeps its own.
    """
    agency = service == st.AGENCY
    needed = {st.AGENCY: resolve.AGENCY_DIMS, st.SDK: (), st.CHANNEL: ()}.get(
        service, ("belong", "company", *(("rate",) if overseas else ())))
    dims.measured(*needed, also=(regions, special))
    if agency:
        work = _agency_lines(df, arrival, rules, tz)
    else:
        given = df.withColumn("_renamed", lines.renamed_line(F.col("value"), "DATA[", names)) if names else df
        framed = lines.framed_lines(given, service_shape(rules), "DATA[", "_renamed" if names else "value", tz, frame=False)
        checked = rl.validated(framed, "doc", rules, batch=batch, int_strict=int_strict)
        work = (checked.select(arrival, "value", "reject_reason", "doc.*").drop("_bad", *REGION)
                .withColumn("_active", F.lit(False)))
    game = text_of(F.col("game.game_id"))
    if agency:
        work = resolve.resolve_login(work, dims, agent=F.col("agent"), game_id=game,
                                     channel_id=text_of(F.col("agent.channel_id")),
                                     game_channel_id=text_of(F.col("agent.game_channel_id")))
        work = (_put(work, "agent", "channel_id", "game_channel_id").transform(_put, "game", "company_id")
                .transform(_put, "device", "os_type").withColumnRenamed("resolved", "_fine"))
    elif service == st.SDK:
        work = work.withColumn("_fine", guards.sdk_guard(F.col("sdk_platform"), F.col("sdk_platform.app_id")))
    else:
        fine = guards.channel_guard(F.col("channel_platform"), F.col("channel_platform.ad_id"), F.col("game.game_id"))
        work = work.withColumn("_fine", F.coalesce(fine, F.lit(False)))
        if service != st.CHANNEL:
            work = _own_channel(work, dims, special, overseas, only_special_logins, aliases)
    done = (work.withColumn("reject_reason", F.when(~F.col("_active"), F.coalesce("reject_reason", F.when(
        ~F.coalesce(F.col("_fine"), F.lit(False)), F.lit("service check")))))
        .withColumn("ok", F.col("reject_reason").isNull() & ~F.col("_active")).drop("_fine"))
    key = F.when(F.col("ok"), st.service_key(
        service, F.col("event"), channel_id=F.col("agent.channel_id"), game_id=game, user_id=F.col("user.user_id"),
        device_id=F.col("device.device_id"), game_name=F.col("game.game_name"), app_id=F.col("sdk_platform.app_id")))
    flagged = st.settled(guards.member(done, F.col("agent.game_channel_id"), special, "_special"), "service-events")
    ts = F.col("server_ts").cast("bigint") if agency else int_of(F.col("server_ts"))
    stamped = st.first_events(flagged, arrival, key, F.col("event"), ts, F.col("is_test"),
                              text_of(F.col("order.order_status")), text_of(F.col("order.order_step")), flag_only=batch,
                              state=state, tz=tz, shortest=10 ** 9, writes=service in st.WRITERS)
    stamped = add_region(stamped, regions, F.col("client_ip"), counted=flagged)
    target = F.when(F.col("_active"), F.lit("agentActive")).otherwise(
        route.route_service(F.lit(service), F.col("ok"), F.col("_special"), folded))
    # activations have no user, but the narrow feed expects the field
    no_user = F.when(F.col("event") == "active", F.lit(""))
    if agency:
        body = flatten_dashed(stamped.select("user", "game", "agent", "device", *[c for c in schemas.TOP if c in stamped.columns and c != "status"],
                                             *STAMPS), as_columns=True)
        record = F.to_json(F.struct(*[c.alias(n) for n, c in body.items()]))
        whole = stamped.withColumn("value", F.when(F.col("ok"), record).otherwise(F.col("value")))
    else:
        changed = {**{c: F.col(c) for c in [*REGION, *STAMPS]}, "user-user_id": no_user}
        if service != st.CHANNEL and service != st.SDK:
            changed |= {f"agent-{c}": F.col(f"agent.{c}") for c in ("channel_id", "game_channel_id")}
            changed |= {f"game-{c}": F.col(f"game.{c}") for c in ("game_id", "app_id", "company_id")}
        if overseas:
            changed |= {f"order-{c}": F.col(f"order.{c}").cast("double") for c in ("cny_amount", "usd_amount")}
        items = F.when(F.col("ok"), records.entries(lines.payload_of(F.col("value"), "DATA[")))
        staged = records.once(stamped, {"_items": items})
        whole = records.with_record(staged, "value", records.flat(F.col("_items")), changed, F.col("value"))
    return whole.select(arrival, "ok", "reject_reason", target.alias("route"), "event",
                        F.col("agent.game_channel_id").alias("game_channel_id"), *REGION, *STAMPS, "value")


def _put(df: DataFrame, struct: str, *names: str) -> DataFrame:
    """Move columns into a struct of the record."""
    return df.withColumn(struct, _field_set(struct, df, {n: F.col(n) for n in names})).drop(*names)


def _own_channel(df: DataFrame, dims: Dims, special: Dimension, overseas: bool, only_special_logins: str | None,
                 aliases: dict[str, str] | None) -> DataFrame:
    """Own game -> agency ids, changed places of game and app, amounts, and the login limit."""
    work = resolve.resolve_own(df, dims, game_id=text_of(F.col("game.game_id")), aliases=aliases)
    work = _put(work, "game", "app_id", "company_id").transform(_put, "agent", "channel_id", "game_channel_id")
    swapped, not_web = resolve.game_app_swap(F.col("game"))
    fine = F.col("_fine") & not_web
    if only_special_logins is not None:
        work = guards.member(work, F.col("agent.game_channel_id"), special, "_in")
        fine = fine & resolve.own_login_kept(F.col("event"), F.col("_in"), only_special_logins)
    work = work.withColumn("_fine", fine).withColumn("game", swapped)
    if overseas:
        is_order = F.col("event") == "order"
        amount = double_of(F.col("order.currency_amount"))
        work = resolve.fx_convert(work, dims, F.when(is_order, F.col("order.currency_type")), F.when(is_order, amount))
        given = {c: F.col(c).cast("string") for c in ("cny_amount", "usd_amount")}
        work = work.withColumn("order", F.when(is_order, _field_set("order", work, given))).drop(*given)
    return work.drop("_in")


def old_logins(df: DataFrame, dims: Dims, regions: Dimension, arrival: str, *,
               state: DataFrame | None = None, tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Back-fill of stored login events (JSON lines): guard, region, channel, os, own channels out, stamps."""
    from ..functions import codes

    shape = schemas.event_schema(["user", "game", "agent", "device"])
    parsed = lines.with_document(df, F.col("value"), shape, "d", [arrival])
    d = F.col("d")
    good = parsed.where(guards.old_login_guard(d.isNotNull(), d["game"]["game_id"], d["agent"]["channel_id"],
                                               int_of(d["server_ts"])))
    opened = good.select(arrival, "d.*").drop("_bad", *REGION)
    located = add_region(opened, regions, F.col("client_ip"))
    work = resolve.resolve_old_login(located, dims, game_id=F.col("game.game_id"),
                                     channel_id=F.col("agent.channel_id"),
                                     game_channel_id=text_of(F.col("agent.game_channel_id")))
    kept = work.where(guards.not_in(F.col("channel_id"), guards.OWN_CHANNELS))
    os_type = F.when(text_of(F.col("agent.game_channel_id")) == "",
                     codes.label(F.col("sub_pf"), codes.OS_BY_PLATFORM)).otherwise(text_of(F.col("device.os_type")))
    key = st.service_key(st.AGENCY, F.col("event"), channel_id=F.col("channel_id"), game_id=F.col("game.game_id"),
                         user_id=F.col("user.user_id"), device_id=F.col("device.device_id"))
    return st.first_events(kept.withColumn("os_type", os_type), arrival, key, F.col("event"),
                           int_of(F.col("server_ts")), F.col("is_test"), F.lit(""), F.lit(""), state=state, tz=tz,
                           shortest=10 ** 9)
