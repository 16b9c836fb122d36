"""Canonical events, flattening and the narrow shapes made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import codes, times
from ..functions.coerce import double_of, epoch_of_leaf, epoch_of_text, int_of, int_string_of, text_of
from .dims import Dims
from .lookup import lookup
from .resolve import fx_convert, resolve_own


def leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of all leaves, in order."""
    found: list[tuple[str, ...]] = []
    for f in schema.fields:
        here = path + (f.name,)
        found += leaves(f.dataType, here) if isinstance(f.dataType, T.StructType) else [here]
    return found


def _ref(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{p}`" for p in path))


def flatten_dashed(df: DataFrame, as_columns: bool = False) -> DataFrame | dict[str, Column]:
    """Nested fields become ``group-field`` columns."""
    found = {"-".join(p): _ref(p) for p in leaves(df.schema)}
    return found if as_columns else df.select(*[c.alias(n) for n, c in found.items()])


def flatten_leaf(df: DataFrame, as_columns: bool = False) -> DataFrame | dict[str, Column]:
    """Nested fields keep their leaf name only; a later leaf replaces an earlier one."""
    last: dict[str, tuple[str, ...]] = {}
    for p in leaves(df.schema):
        last.pop(p[-1], None)
        last[p[-1]] = p
    found = {n: _ref(p) for n, p in last.items()}
    return found if as_columns else df.select(*[c.alias(n) for n, c in found.items()])


def group(names: list[str], given: dict[str, Column]) -> Column:
    """A struct with all ``names``; those not given are empty text."""
    return F.struct(*[given.get(n, F.lit("")).alias(n) for n in names])


# Constants of a canonical event.
DATA_VERSION, SERVER_ZONE, REGULAR = "1.0", "+08:00", "regular"


def _tops(event: str, server_ts: Column, client_ip: Column) -> dict[str, Column]:
    return {"event": F.lit(event), "is_test": F.lit(REGULAR), "data_ver": F.lit(DATA_VERSION),
            "client_time_zone": F.lit(""), "client_ts": F.lit(0), "server_time_zone": F.lit(SERVER_ZONE),
            "server_ts": server_ts, "client_ip": client_ip}


def login_event(df: DataFrame, doc: str = "doc", ts: str = "line_ts", ip: str = "line_ip") -> DataFrame:
    """Old flat login -> nested login event; fields the old log lacks are empty."""
    d = F.col(doc)
    out = {"user": group(schemas.USER[:5], {"user_id": text_of(d["user_id"])}),
           "game": group(["game_id", "game_name", "game_ver"], {"game_id": text_of(d["game_id"])}),
           "agent": group(schemas.AGENT, {c: text_of(d[c]) for c in schemas.AGENT}),
           "device": group(schemas.DEVICE, {}), **_tops("login", F.col(ts), F.col(ip))}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in out and c not in (doc, ts, ip)]
    return df.select(*kept, *[c.alias(n) for n, c in out.items()])


def _own_ids(df: DataFrame, dims: Dims, own_game: Column | None, own_channel: Column | None) -> DataFrame:
    """_game_channel, _channel, _game, _company of own-channel rows.

    A row is resolved by its own game where ``own_game`` is not NULL, by its game
    channel where ``own_channel`` is not NULL.
    """
    if own_channel is None:
        work = resolve_own(df, dims, game_id=own_game, aliases={"": ""})
        return work.withColumnsRenamed({"app_id": "_game", "channel_id": "_channel",
                                        "game_channel_id": "_game_channel", "company_id": "_company"})
    work = df.select("*", own_channel.alias("_side"))
    work = lookup(work, dims.by_game_channel, [F.col("_side")], {"_bc": "channel_id", "_bg": "game_id"})
    if own_game is None:
        work = work.withColumnsRenamed({"_bc": "_channel", "_bg": "_game", "_side": "_game_channel"})
    else:
        work = lookup(work, dims.belong, [own_game],
                      {"_oc": "channel_id", "_og": "game_id", "_ogc": "game_channel_id"})
        side = F.col("_side").isNotNull()
        pick = lambda a, b: F.when(side, F.col(a)).otherwise(F.col(b))
        work = work.select(*[F.col(f"`{c}`") for c in df.columns], pick("_bc", "_oc").alias("_channel"),
                           pick("_bg", "_og").alias("_game"), pick("_side", "_ogc").alias("_game_channel"))
    return lookup(work, dims.company, [F.col("_game")], {"_company": "company_id"})


def _register_parts(d: Column) -> tuple[dict[str, Column], dict[str, Column]]:
    user = {"user_id": text_of(d["user_id"]), "gender": codes.label(text_of(d["sex"]), codes.GENDER),
            "birth": text_of(d["birth"]), "phone_num": text_of(d["tel_num"]),
            "email_num": text_of(d["email"]), "login_type": text_of(d["reg_type"])}
    return user, {"device_id": text_of(d["device_id"]), "android_imei": text_of(d["imei"])}


def _order_parts(d: Column, pay_types: dict[str, str]) -> tuple[dict, dict, dict, dict]:
    device = {"device_id": text_of(d["device_id"]), "android_imei": text_of(d["imei"]), "os_type": F.col("_os")}
    role = {"role_server": text_of(d["server"]), "role_id": text_of(d["game_role_id"]),
            "role_name": text_of(d["game_role_name"])}
    order = {"order_sn": text_of(d["order_sn"]), "cp_trade_sn": text_of(d["cp_trade_sn"]),
             "channel_trade_sn": text_of(d["payment_trade_sn"]), "currency_type": text_of(d["money_type"]),
             "order_type": codes.label(int_string_of(d["pay_type"]), pay_types)}
    money = double_of(d["money"])
    numbers = {"cny_amount": F.lit(0.0), "usd_amount": F.lit(0.0), "money": money, "currency_amount": money,
               "order_step": codes.label(int_of(d["status"]), codes.ORDER_STEP),
               "order_status": codes.label(int_of(d["pay_status"]), codes.PAY_STATUS)}
    return device, role, order, numbers


# groups of a canonical order or register event
EVENT_GAME = [c for c in schemas.GAME if c != "app_id"]


def order_event(df: DataFrame, dims: Dims, data: str = "data", *, overseas: bool = False,
                combined: bool = True, flat: bool = False, only: Column | None = None,
                tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Own-channel order row -> canonical order event, nested or flat.

    ``combined=False`` resolves by the row's game channel instead of its own game.
    Rows without a game are not orders and are left out; with ``only`` all rows stay
    and just those it names are resolved.
    """
    d = F.col(data)
    rows = df.where(text_of(d["game_id"]) != "") if only is None else df
    given = (lambda c: c) if only is None else (lambda c: F.when(only, c))
    if combined:
        work = _own_ids(rows, dims, given(text_of(d["game_id"])), None)
    else:
        work = _own_ids(rows, dims, None, given(text_of(d["own_channel"])))
    work = lookup(work, dims.os, [F.col("_channel")], {"_os": "pf"}, default="")
    device, role, order, numbers = _order_parts(d, codes.PAY_TYPE_OVERSEAS if overseas else codes.PAY_TYPE_DOMESTIC)
    user = {"user_id": text_of(d["user_id"])}
    game = {"game_id": F.col("_game"), "company_id": F.col("_company"), "app_key": text_of(d["game_id"])}
    agent = {"channel_id": F.col("_channel"), "game_channel_id": F.col("_game_channel")}
    tops = _tops("order", epoch_of_text(d["update_time"], times.FULL, tz), text_of(d["create_ip"]))
    kept = [F.col(f"`{c}`") for c in df.columns if only is not None or c != data]
    if flat:
        plain = {**user, **game, **agent, **device, **role, **order}
        names = [n for n in dict.fromkeys(schemas.USER + schemas.GAME + schemas.AGENT + schemas.DEVICE
                                          + schemas.ROLE + schemas.ORDER) if n not in numbers and n != "app_id"]
        cols = [plain.get(n, F.lit("")).alias(n) for n in names]
        cols += [numbers[n].alias(n) for n in ("cny_amount", "currency_amount", "money", "usd_amount")]
        cols += [text_of(d["pay_status"]).alias("pay_status"), text_of(d["status"]).alias("status"),
                 F.col("_os").alias("sub_pf")]
        return work.select(*kept, *cols, *[c.alias(n) for n, c in tops.items()])
    return work.select(
        *kept, group(schemas.USER, user).alias("user"), group(EVENT_GAME, game).alias("game"),
        group(schemas.AGENT, agent).alias("agent"), group(schemas.DEVICE, device).alias("device"),
        group(schemas.ROLE, role).alias("role"), group(schemas.ORDER, {**order, **numbers}).alias("order"),
        *[c.alias(n) for n, c in tops.items()],
        int_of(d["pay_status"]).alias("pay_status"), int_of(d["status"]).alias("status"),
        F.col("_os").alias("sub_pf"))


def database_events(df: DataFrame, dims: Dims, kind: Column, data: str = "data", *, overseas: bool = False,
                    tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Rows of all own-channel tables as canonical events in one pass.

    ``kind`` is ``order``, ``order_side`` (resolved by game channel), ``user`` or anything
    else; other rows, and rows without a game or app, stay unresolved.
    """
    d = F.col(data)
    base = df.select("*", kind.alias("_kind"))
    is_user, is_side = F.col("_kind") == "user", F.col("_kind") == "order_side"
    has_game = text_of(d["game_id"]) != ""
    own_game = (F.when((F.col("_kind") == "order") & has_game, d["game_id"]).when(is_user, d["own_app_id"]))
    work = _own_ids(base, dims, own_game, F.when(is_side & has_game, text_of(d["own_channel"])))
    work = lookup(work, dims.os, [F.when(~is_user, F.col("_channel"))], {"_os": "pf"}, default="")
    device, role, order, numbers = _order_parts(d, codes.PAY_TYPE_OVERSEAS if overseas else codes.PAY_TYPE_DOMESTIC)
    if overseas:
        work = fx_convert(work, dims, F.when(F.col("_kind") == "order", text_of(d["money_type"])), double_of(d["money"]))
        for c in ("cny_amount", "usd_amount"):
            numbers[c] = F.when(is_side, F.lit(0.0)).otherwise(F.col(c))
    user, _ = _register_parts(d)
    user = {n: (c if n == "user_id" else F.when(is_user, c).otherwise(F.lit(""))) for n, c in user.items()}
    device["os_type"] = F.when(is_user, F.lit("")).otherwise(F.col("_os"))
    game = {"game_id": F.col("_game"), "company_id": F.col("_company"),
            "app_key": text_of(F.when(is_user, d["own_app_id"]).otherwise(d["game_id"]))}
    agent = {"channel_id": F.col("_channel"), "game_channel_id": F.col("_game_channel")}
    tops = _tops("order", F.when(is_user, epoch_of_leaf(d["register_time"], times.FULL, tz))
                 .otherwise(epoch_of_text(d["update_time"], times.FULL, tz)),
                 F.when(is_user, F.lit("")).otherwise(text_of(d["create_ip"])))
    tops["event"] = F.when(is_user, F.lit("register")).otherwise(F.lit("order"))
    event = F.col("_kind").isin("order", "order_side", "user") & F.when(is_user, d["own_app_id"].isNotNull()).otherwise(has_game)
    order_only = lambda c: F.when(~is_user, c)
    return work.select(
        *[F.col(f"`{c}`") for c in df.columns], F.coalesce(event, F.lit(False)).alias("is_event"),
        group(schemas.USER, user).alias("user"), group(EVENT_GAME, game).alias("game"),
        group(schemas.AGENT, agent).alias("agent"), group(schemas.DEVICE, device).alias("device"),
        order_only(group(schemas.ROLE, role)).alias("role"),
        order_only(group(schemas.ORDER, {**order, **numbers})).alias("order"),
        *[c.alias(n) for n, c in tops.items()], order_only(int_of(d["pay_status"])).alias("pay_status"),
        order_only(int_of(d["status"])).alias("status"), order_only(F.col("_os")).alias("sub_pf"))


def register_event(df: DataFrame, dims: Dims, data: str = "data", tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Own-channel user row -> canonical register event. Rows without an app are left out."""
    d = F.col(data)
    work = resolve_own(df.where(d["own_app_id"].isNotNull()), dims, game_id=text_of(d["own_app_id"]),
                       aliases={"": ""})
    user, device = _register_parts(d)
    game = {"game_id": F.col("app_id"), "company_id": F.col("company_id"), "app_key": text_of(d["own_app_id"])}
    agent = {"channel_id": F.col("channel_id"), "game_channel_id": F.col("game_channel_id")}
    tops = _tops("register", epoch_of_leaf(d["register_time"], times.FULL, tz), F.lit(""))
    kept = [F.col(f"`{c}`") for c in df.columns if c != data]
    return work.select(
        *kept, group(schemas.USER, user).alias("user"),
        group(EVENT_GAME, game).alias("game"),
        group(schemas.AGENT, agent).alias("agent"), group(schemas.DEVICE, device).alias("device"),
        *[c.alias(n) for n, c in tops.items()], F.lit("").alias("status"))


def union_events(*parts: DataFrame) -> DataFrame:
    """All events in one frame; fields a part lacks are NULL."""
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p, allowMissingColumns=True)
    return result


def olap_kept(event: Column, is_test: Column, pay_status: Column, status: Column) -> Column:
    """Regular logins and paid orders."""
    done = (int_of(pay_status) == 1) & (int_of(status) == 2)
    return F.coalesce((is_test == REGULAR) & ((event == "login") | ((event == "order") & done)), F.lit(False))


OLAP_NAMES = {"game_id": "game-game_id", "channel_id": "agent-channel_id",
              "game_channel_id": "agent-game_channel_id", "os_type": "device-os_type",
              "user_id": "user-user_id"}


def olap_shape(df: DataFrame, from_login: bool, extra: dict[str, Column] | None = None) -> DataFrame:
    """Nine columns from a flattened login (prefixed names) or order (plain names)."""
    dates = ["server_date_day", "server_date_hour", "reg_date", "first_order_date"]
    source = OLAP_NAMES if from_login else {n: n for n in OLAP_NAMES}
    return df.select(*dates, *[text_of(F.col(f"`{s}`").cast("string")).alias(n) for n, s in source.items()],
                     *[c.alias(n) for n, c in (extra or {}).items()])


def dates_to_text(df: DataFrame) -> DataFrame:
    """Timestamps of a record as full text."""
    return df.select(*[
        F.date_format(F.col(f"`{f.name}`"), times.FULL).alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def texts_to_time(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: times.text_to_time(F.col(c)) for c in columns})


def cast_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Export texts to numbers; text that is no number becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(k) for c, k in kinds.items()})
