"""Record shapes. Input leaves are STRING (dirty data); outputs get fixed types."""

from __future__ import annotations

from pyspark.sql import types as T

USER = ["user_id", "user_name", "gender", "birth", "age", "open_id", "phone_num", "email_num",
        "login_type"]
GAME = ["game_id", "app_id", "game_name", "game_ver", "company_id", "app_key"]
AGENT = ["channel_id", "game_channel_id", "access_token"]
DEVICE = ["screen_height", "screen_width", "device_id", "ios_idfa", "android_imei",
          "android_adv_id", "android_id", "device_name", "os_ver", "os_type", "sdk_ver",
          "package_name", "net_type", "user_agent"]
ROLE = ["role_level", "role_name", "role_server", "role_id", "role_type", "role_gender",
        "association_id", "association_name", "association_rank"]
MISSION = ["mission_id", "mission_name"]
COPY = ["copy_id", "copy_name"]
TRADE = ["trade_type", "trade_amount", "remain_amount", "item_name", "item_amount", "trade_desc"]
ORDER = ["order_sn", "cp_trade_sn", "channel_trade_sn", "request_url", "http_code",
         "request_result", "order_step", "cny_amount", "currency_amount", "currency_type",
         "usd_amount", "order_status", "order_type", "money"]
CLICK = ["event_tag", "click_time"]
TOP = ["event", "is_test", "data_ver", "status", "client_time_zone", "client_ts",
       "server_time_zone", "server_ts", "client_ip", "country", "province", "city"]

GROUPS = {"user": USER, "game": GAME, "agent": AGENT, "device": DEVICE, "role": ROLE,
          "mission": MISSION, "copy": COPY, "trade": TRADE, "order": ORDER, "click": CLICK,
          "channel_platform": ["ad_id"], "sdk_platform": ["app_id"]}


def texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def event_schema(groups: list[str] | None = None) -> T.StructType:
    """The nested event; pass the groups a job needs so that only they are parsed."""
    chosen = GROUPS if groups is None else {g: GROUPS[g] for g in groups}
    fields = [T.StructField(g, texts(cols)) for g, cols in chosen.items()]
    return T.StructType(fields + list(texts(TOP).fields))


def event_fields(wanted: dict[str, list[str]]) -> T.StructType:
    """An event with only the wanted leaves of each group; the parser skips the others."""
    fields = [T.StructField(g, texts(cols)) for g, cols in wanted.items()]
    return T.StructType(fields + list(texts(TOP).fields))


OLD_LOGIN = texts(["user_id", "channel_id", "game_id", "channel_name", "game_channel_id",
                   "access_token"])
COIN = ["game_id", "channel_id", "game_channel_id", "user_id", "role_id", "role_name", "server",
        "type", "trade_count", "remain_count", "item_name", "item_count", "trade_desc",
        "trade_time"]
AD_CLICK = ["adid", "game", "channel", "device_id", "click_time", "company_id", "pf"]
AGENCY_ORDER = ["order_sn", "game_id", "channel_id", "user_id", "server", "money", "pay_status",
                "status", "create_ip", "update_time", "create_time"]
OWN_ORDER = ["order_sn", "user_id", "money", "money_type", "type", "status", "pay_status",
             "game_id", "own_channel", "device_id", "server", "pay_type", "cp_trade_sn",
             "payment_trade_sn", "goods_id", "goods_name", "game_role_id", "game_role_name",
             "game_url", "create_time", "update_time", "create_ip", "imei"]
USER_ROW = ["user_id", "user_name", "tel_num", "tel_status", "email", "reg_type", "own_channel",
            "own_app_id", "device_id", "register_ip", "register_time", "status", "imei", "sex",
            "birth"]


# the row's object stays text, so that no field of it is lost
BINLOG = T.StructType([T.StructField("rows", T.ArrayType(texts(["database", "table", "type", "data"])))])


ENVELOPE = T.StructType([
    T.StructField("data_system", T.StringType()), T.StructField("ip", T.StringType()),
    T.StructField("file_path", T.StringType()), T.StructField("line_count", T.LongType()),
    T.StructField("message_body", T.BinaryType())])

STATE = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("login_ts", T.LongType()),
    T.StructField("order_ts", T.LongType())])
