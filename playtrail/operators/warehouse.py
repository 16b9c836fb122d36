"""Projections to the fixed warehouse rows. Missing texts are empty, missing whole numbers -1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import codes, times
from ..functions.coerce import double_of, int_of, long_of, text_of
from ..functions.hashing import glued, md5_upper
from .lookup import Dimension, lookup

# Fixed value: code of the own platform in every warehouse row.
PLATFORM = 4


def _out(df: DataFrame, kept: list[str], columns: dict[str, Column]) -> DataFrame:
    return df.select(*kept, *[c.alias(n) for n, c in columns.items()])


def login_rows(df: DataFrame, doc: str = "doc", kept: list[str] = (), tz: str = times.DEFAULT_TZ,
               overseas: bool = False) -> DataFrame:
    """Login event -> login_log."""
    d = F.col(doc)
    ts = long_of(d["server_ts"])
    channel = text_of(d["channel_platform"]["ad_id"])
    cols = {"login_date": times.day_key(ts, tz), "user_id": text_of(d["user"]["user_id"]),
            "user_name": text_of(d["user"]["user_name"]), "game": text_of(d["game"]["game_id"]),
            "channel": channel, "device_id": text_of(d["device"]["device_id"]),
            "login_ip": text_of(d["client_ip"]), "login_time": times.local_ntz(ts, tz),
            "pf": codes.store_flag(channel)}
    identity = glued(ts, times.day(ts, tz), cols["login_date"], cols["user_id"], cols["user_name"],
                     cols["game"], channel, cols["device_id"], cols["login_ip"], cols["pf"])
    if overseas:
        cols["imei"] = text_of(d["device"]["android_imei"])
    return _out(df, list(kept), {"id": md5_upper(identity), **cols})


def active_rows(df: DataFrame, doc: str = "doc", kept: list[str] = (), tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Activation event -> active_log; one id per app and device."""
    d = F.col(doc)
    ts = long_of(d["server_ts"])
    dev = lambda n: text_of(d["device"][n])
    game = text_of(d["game"]["game_id"])
    app = F.when(game == "", F.lit(-1)).otherwise(game.try_cast("int"))
    cols = {"active_date": times.day_key(ts, tz), "union_app_id": app,
            "union_channel": text_of(d["channel_platform"]["ad_id"]), "action_type": F.lit(""),
            "client_time": times.local_ntz(ts, tz),
            "screen_size": F.concat(dev("screen_height"), F.lit("|"), dev("screen_width")),
            "device_id": dev("device_id"), "device_name": dev("device_name"), "imsi": F.lit(""),
            "imei": dev("android_imei"), "system_version": dev("os_ver"), "sdk_version": dev("sdk_ver"),
            "package_name": dev("package_name"), "application_name": text_of(d["game"]["game_name"]),
            "application_version": text_of(d["game"]["game_ver"]), "create_time": times.local_ntz(ts, tz),
            "server_ip": text_of(d["client_ip"])}
    return _out(df, list(kept), {"id": md5_upper(glued(app, cols["device_id"])), **cols})


def _order_core(d: Column, status: Column, pay_status: Column) -> dict[str, Column]:
    channel = text_of(d["own_channel"])
    return {"order_sn": text_of(d["order_sn"]), "user_id": text_of(d["user_id"]), "type": text_of(d["type"]),
            "status": status, "pay_status": pay_status, "game": text_of(d["game_id"]), "channel": channel,
            "device_id": text_of(d["device_id"]), "server": int_of(d["server"]),
            "pay_type": text_of(d["pay_type"]), "cp_trade_sn": text_of(d["cp_trade_sn"]),
            "goods_id": text_of(d["goods_id"]), "goods_name": text_of(d["goods_name"]),
            "game_role_id": text_of(d["game_role_id"]), "game_role_name": text_of(d["game_role_name"]),
            "game_url": text_of(d["game_url"]), "pf": codes.store_flag(channel)}


def _optional(d: Column, data_fields: set[str], name: str, kind: str = "text") -> Column:
    if name not in data_fields:
        return {"text": F.lit(""), "int": F.lit(-1), "double": F.lit(0.0)}[kind]
    return {"text": text_of, "int": int_of, "double": double_of}[kind](d[name])


def _struct_fields(df: DataFrame, data: str) -> set[str]:
    return set(df.schema[data].dataType.names)


def order_rows(df: DataFrame, data: str = "data", kept: list[str] = (), tz: str = times.DEFAULT_TZ,
               batch: bool = False) -> DataFrame:
    """Order row -> order_log. ``batch``: a paid order has status 2 and both times are text."""
    d, names = F.col(data), _struct_fields(df, data)
    pay, status = int_of(d["pay_status"]), int_of(d["status"])
    identity = glued(text_of(d["order_sn"]), F.when(pay == 1, 2).otherwise(status) if batch else status, pay)
    if batch:
        status = F.when(pay == 1, 2).otherwise(status)
        update = times.time_or_default(text_of(d["update_time"]))
        date = F.date_format(update, "yyyyMMdd").cast("int")
    else:
        seconds = F.floor(long_of(d["update_time"]) / 1000).cast("bigint")
        update, date = times.local_ntz(seconds, tz), times.day_key(seconds, tz)
    cols = {"id": md5_upper(identity), **_order_core(d, status, pay), "money": double_of(d["money"]),
            "local_money": _optional(d, names, "local_money", "double"),
            "imf_money": _optional(d, names, "imf_money", "double"),
            "big_channel": _optional(d, names, "big_channel", "int"),
            "channel_trade_sn": _optional(d, names, "channel_trade_sn"),
            "create_time": times.time_or_default(text_of(d["create_time"])), "update_time": update,
            "platform": F.lit(PLATFORM), "imei": text_of(d["imei"]), "order_date": date,
            "create_ip": text_of(d["create_ip"])}
    return _out(df, list(kept), cols)


def order_rows_fx(df: DataFrame, data: str = "data", kept: list[str] = (), tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Overseas order row with cny_amount and usd_amount -> order_log of the overseas warehouse."""
    d = F.col(data)
    pay, status = int_of(d["pay_status"]), int_of(d["status"])
    create_ts = times.parse(text_of(d["create_time"]), times.FULL, tz)
    update_ms = long_of(d["update_time"])
    cols = {"id": md5_upper(glued(text_of(d["order_sn"]), status, pay, create_ts * 1000, update_ms)),
            **_order_core(d, status, pay), "money_type": text_of(d["money_type"]), "money": F.col("cny_amount"),
            "local_money": double_of(d["money"]), "imf_money": F.col("usd_amount"),
            "channel_trade_sn": text_of(d["payment_trade_sn"]),
            "create_time": times.local_ntz(create_ts, tz),
            "update_time": times.local_ntz(F.floor(update_ms / 1000).cast("bigint"), tz),
            "order_date": times.day_key(create_ts, tz)}
    return _out(df, list(kept), cols)


def user_rows(df: DataFrame, data: str = "data", kept: list[str] = (), tz: str = times.DEFAULT_TZ,
              overseas: bool = False) -> DataFrame:
    """User row -> user (registration)."""
    d = F.col(data)
    ts = int_of(d["register_time"]).cast("bigint")
    channel = text_of(d["own_channel"])
    cols = {"user_id": text_of(d["user_id"]), "user_name": text_of(d["user_name"]),
            "tel_num": text_of(d["tel_num"]), "tel_status": int_of(d["tel_status"]),
            "email": text_of(d["email"]), "reg_type": int_of(d["reg_type"]), "channel": channel,
            "game": text_of(d["own_app_id"]), "device_id": text_of(d["device_id"]),
            "register_ip": text_of(d["register_ip"]), "register_time": times.local_ntz(ts, tz),
            "status": int_of(d["status"]), "pf": codes.store_flag(channel)}
    if overseas:
        identity = glued(*[cols[c] for c in ("user_id", "user_name", "tel_num", "tel_status", "email", "reg_type",
                                             "channel", "game", "device_id", "register_ip")],
                         times.day(ts, tz), cols["status"], cols["pf"], F.lit(0))
        cols["new_device"] = F.lit(0)
    else:
        identity = cols["user_id"]
        cols["platform"] = F.lit(PLATFORM)
        cols["new_device"] = F.lit(-1)
    cols["imei"] = text_of(d["imei"])
    cols["reg_date"] = times.day_key(ts, tz)
    return _out(df, list(kept), {"id": md5_upper(identity), **cols})


# Text fields of an install-attribution record that pass as they are.
INSTALL_TEXTS = ["agency", "media_source", "campaign", "fb_campaign_name", "fb_campaign_id", "fb_adset_name",
                 "fb_adset_id", "fb_adgroup_name", "fb_adgroup_id", "af_siteid", "cost_per_install",
                 "country_code", "city", "ip", "language", "appsflyer_device_id", "customer_user_id",
                 "advertising_id", "mac", "os_version", "sdk_version", "app_version", "event_type",
                 "event_name", "event_value", "currency", "af_sub1", "af_sub2", "af_sub3", "af_sub4",
                 "af_sub5", "attribution_type"]
INSTALL_OTHERS = ["bundle_id", "platform", "event_time", "install_time", "click_time", "click_url",
                  "http_referrer", "android_id", "imei", "idfa", "idfv", "device_brand", "device_type",
                  "device_model"]
URL_LIMIT, URL_KEPT = 512, 500
INSTALL_SHAPE = T.StructType([T.StructField(n, T.StringType()) for n in INSTALL_TEXTS + INSTALL_OTHERS]
                             + [T.StructField("wifi", T.BooleanType())])


def _cut(url: Column) -> Column:
    return F.when(F.length(url) >= URL_LIMIT, F.substring(url, 1, URL_KEPT)).otherwise(url)


def install_rows(df: DataFrame, packages: Dimension, doc: str = "doc", kept: list[str] = ()) -> DataFrame:
    """Install attribution -> af_active; the game comes from the package name."""
    d = F.col(doc)
    t = lambda n: text_of(d[n])
    android, ios = t("platform") == "android", t("platform") == "ios"
    either = lambda a, i: F.when(android, t(a)).when(ios, t(i)).otherwise(F.lit(""))
    pf = F.when(ios, F.lit(1)).otherwise(F.lit(0))
    event_time, install_time = times.time_or_default(t("event_time")), times.time_or_default(t("install_time"))
    blank_event = t("event_time") == ""
    key = lambda ts: F.date_format(ts, "yyyyMMdd").cast("int")
    work = lookup(df, packages, [t("bundle_id")], {"_game": "game_id"}, default=None)
    cols = {"id": md5_upper(glued(t("appsflyer_device_id"), t("bundle_id"), pf, t("event_time"))),
            "event_date": F.when(blank_event, F.lit(0)).otherwise(key(event_time)),
            "active_date": key(install_time), "game": t("bundle_id"), "game_id": F.col("_game"), "pf": pf,
            "click_time": times.time_or_default(t("click_time")), "install_time": install_time,
            "event_time": event_time, "wifi": F.when(F.coalesce(d["wifi"], F.lit(False)), 1).otherwise(0),
            "device_id": either("customer_user_id", "customer_user_id"),
            "device_idfa1": either("android_id", "idfa"), "device_idfa2": either("imei", "idfv"),
            "device_brand": either("device_brand", "device_type"),
            "device_type": either("device_model", "device_model"),
            "click_url": _cut(t("click_url")), "http_referrer": _cut(t("http_referrer")),
            **{n: t(n) for n in INSTALL_TEXTS}}
    return _out(work, list(kept), cols)


PURCHASE_SHAPE = T.StructType(
    [T.StructField(n, T.StringType()) for n in
     ("mPurchaseTime", "mDeveloperPayload", "mItemType", "mOrderId", "mToken", "own_app_id", "order_id", "amount")]
    + [T.StructField("mOriginalJson", schemas.texts(["packageName", "productId", "mPurchaseState"]))])


def purchase_rows(df: DataFrame, doc: str = "doc", kept: list[str] = (), tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Store purchase -> voided_order, the rows refunds are matched against."""
    d = F.col(doc)
    ms = long_of(d["mPurchaseTime"])
    seconds = F.floor(ms / 1000).cast("bigint")
    inner = d["mOriginalJson"]
    cols = {"id": md5_upper(glued(text_of(d["mToken"]), text_of(d["order_id"]), ms)),
            "purchase_time": times.local_ntz(seconds, tz), "purchase_date": times.day_key(seconds, tz),
            "mDeveloperPayload": text_of(d["mDeveloperPayload"]), "mItemType": text_of(d["mItemType"]),
            "order_id": text_of(d["mOrderId"]), "pack_name": text_of(inner["packageName"]),
            "product_id": text_of(inner["productId"]), "purchase_state": long_of(inner["mPurchaseState"]).cast("int"),
            "purchase_token": text_of(d["mToken"]), "game_id": text_of(d["own_app_id"]),
            "amount": double_of(d["amount"]) / 100, "order_sn": text_of(d["order_id"])}
    return _out(df, list(kept), cols)


REFUND_SHAPE = T.StructType([
    T.StructField("package_name", T.StringType()),
    T.StructField("google_data", T.StructType([T.StructField("voidedPurchases", T.ArrayType(
        schemas.texts(["purchaseToken", "purchaseTimeMillis", "voidedTimeMillis"])))]))])


def refund_rows(df: DataFrame, doc: str = "doc", kept: list[str] = (), tz: str = times.DEFAULT_TZ) -> DataFrame:
    """Refund list -> one row per refund with its time, day and whole hours since the purchase."""
    d = F.col(doc)
    each = df.select(*kept, text_of(d["package_name"]).alias("pack_name"),
                     F.explode(d["google_data"]["voidedPurchases"]).alias("_v"))
    voided = long_of(F.col("_v.voidedTimeMillis"))
    hours = ((voided - long_of(F.col("_v.purchaseTimeMillis"))) / 3600000).cast("bigint")
    seconds = F.floor(voided / 1000).cast("bigint")
    return each.select(*kept, "pack_name", text_of(F.col("_v.purchaseToken")).alias("purchase_token"),
                       times.render(seconds, times.FULL, tz).alias("voided_time"),
                       times.day_key(seconds, tz).alias("voided_date"), hours.alias("time_interval"),
                       voided.alias("voided_ms"))


def refund_match(refunds: DataFrame, purchases: DataFrame) -> DataFrame:
    """Refunds whose purchase is stored."""
    known = purchases.select("pack_name", "purchase_token").distinct()
    return refunds.join(known, ["pack_name", "purchase_token"], "left_semi")


def refund_update(purchases: DataFrame, refunds: DataFrame, order: str = "voided_ms") -> DataFrame:
    """Purchases with mark, voided_time, voided_date and time_interval set by their last refund."""
    values = ["voided_time", "voided_date", "time_interval"]
    last = (refunds.groupBy("pack_name", "purchase_token")
            .agg(F.max_by(F.struct(*values), F.col(order)).alias("_r"))
            .select("pack_name", "purchase_token", *[F.col(f"_r.{v}").alias(v) for v in values]))
    out = purchases.drop(*values).join(last.withColumn("_hit", F.lit(True)), ["pack_name", "purchase_token"], "left")
    return out.withColumn("mark", F.when(F.col("_hit"), 1).otherwise(0)).drop("_hit")

