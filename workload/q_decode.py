"""Decoding of lines, envelopes and records."""

from pyspark.sql import functions as F

from playtrail import schemas
from playtrail.functions import times
from playtrail.operators import lines
from playtrail.operators.once import once
from playtrail.sources import messages

from . import inputs as i
from .registry import query
from .sql import EV, OD, day, loc, w

GROUPS = ["user", "game", "agent", "device"]


@query("framed_line_parse", w(EV) + f"""SELECT eid, t AS line_ts, ip AS line_ip, {loc('t')} AS line_time,
  et <> 'error' AS ok, CASE WHEN et = 'error' THEN 'json parse error' END AS reject_reason,
  CASE WHEN et <> 'error' THEN kind END AS event, CASE WHEN et <> 'error' THEN CAST(uid AS VARCHAR) END AS user_id,
  CASE WHEN et <> 'error' AND k <> 50 THEN 'g' END AS game_name,
  CASE WHEN et <> 'error' THEN CAST(sts AS VARCHAR) END AS server_ts FROM ev""")
def framed_line_parse(spark, sf):
    d = lines.framed_lines(i.event_lines(spark, sf), schemas.event_schema(GROUPS))
    return d.select("eid", "line_ts", "line_ip", times.render(F.col("line_ts")).alias("line_time"), "ok",
                    "reject_reason", "doc.event", "doc.user.user_id", "doc.game.game_name", "doc.server_ts")


@query("old_login_parse", w(EV) + """SELECT eid, et <> 'error' AS ok, CASE WHEN et = 'error' THEN 'bad frame' END AS reject_reason,
  CAST(uid AS VARCHAR) AS user_id, game AS game_id,
  CASE et WHEN 'view' THEN '' WHEN 'signup' THEN sub ELSE ch END AS channel_id,
  CASE et WHEN 'signup' THEN '' WHEN 'click' THEN '0' ELSE gc END AS game_channel_id FROM ev""")
def old_login_parse(spark, sf):
    d = lines.old_login_lines(i.old_login_lines(spark, sf))
    return d.select("eid", "ok", "reject_reason", "doc.user_id", "doc.game_id", "doc.channel_id", "doc.game_channel_id")


@query("tag_payload_parse", w(EV) + """SELECT eid, et <> 'click' AND et <> 'error' AS ok,
  CASE WHEN et = 'click' THEN 'no tag' WHEN et = 'error' THEN 'json parse error' END AS reject_reason,
  CASE WHEN et NOT IN ('click', 'error') THEN 'dev-' || (uid % 40) END AS device_id FROM ev""")
def tag_payload_parse(spark, sf):
    e = i.ev(spark, sf)
    body = i.obj(device=F.struct(F.col("device").alias("device_id")))
    text = F.when(F.col("et") == "click", F.concat(F.lit("INSTALL["), body, F.lit("]"))) \
        .when(F.col("et") == "error", F.lit("DATA[{broken]")).otherwise(F.concat(F.lit("DATA["), body, F.lit("]")))
    d = lines.framed_lines(e.select("eid", text.alias("value")), schemas.event_schema(["device"]), "DATA[", frame=False)
    return d.select("eid", "ok", "reject_reason", "doc.device.device_id")


@query("nested_message_parse", w(EV) + """SELECT eid, et <> 'error' AS ok, ip AS line_ip_or_null,
  CASE WHEN et <> 'error' THEN CAST(uid AS VARCHAR) END AS user_id FROM ev""")
def nested_message_parse(spark, sf):
    e = i.event_lines(spark, sf).select("eid", i.wrap(F.col("value")).alias("value"))
    inner = lines.wrapped_lines(e, out="line")
    d = lines.framed_lines(inner, schemas.event_schema(["user"]), "DATA[", "line")
    return d.select("eid", "ok", F.col("line_ip").alias("line_ip_or_null"), "doc.user.user_id")


CLICK_SQL = f"""clk AS (SELECT *, CASE WHEN k = 11 THEN 'ad-x' WHEN k = 12 THEN '' ELSE CAST(uid % 9 AS VARCHAR) END AS ad0,
  (CASE WHEN et = 'signup' THEN 'V' ELSE 'U' END) || (uid % 5) AS cgame, CASE WHEN k >= 20 THEN 'c' || (uid % 3) ELSE '' END AS channel,
  CASE WHEN et <> 'view' THEN device ELSE '' END AS cdev,
  CASE WHEN et = 'purchase' THEN {loc('sts')} ELSE {loc('t')} END AS click_time,
  CASE WHEN k <> 13 THEN CASE WHEN uid % 2 = 0 THEN '1' ELSE '5' END ELSE '' END AS company_id,
  CASE WHEN k > 90 THEN '1' ELSE '' END AS pf FROM ev),
clicks AS (SELECT *, CASE WHEN et = 'error' THEN 'json parse error' WHEN k = 13 THEN 'company or ad missing'
  WHEN k = 11 THEN 'ad not numeric' END AS reason FROM clk)"""


@query("ad_click_parse", w(EV, CLICK_SQL) + """SELECT eid, reason IS NULL AS ok, reason AS reject_reason, ip AS client_ip,
  CASE WHEN et = 'error' THEN '' ELSE ad0 END AS ad_id, CASE WHEN et = 'error' THEN '' ELSE cgame END AS game,
  CASE WHEN et = 'error' THEN '' ELSE channel END AS channel, CASE WHEN et = 'error' THEN '' ELSE cdev END AS device_id,
  CASE WHEN et = 'error' THEN '' ELSE company_id END AS company_id, CASE WHEN et = 'error' THEN '' ELSE pf END AS pf, click_time
  FROM clicks""")
def ad_click_parse(spark, sf):
    return lines.ad_click_lines(i.click_lines(spark, sf)).drop("value", "t")


def access_input(spark, sf):
    e = i.ev(spark, sf)
    stamp = F.concat(times.render(F.col("t") + 86400 * (F.col("k") % 300), "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0800"))
    apk = F.when(F.col("et") == "error", F.lit("/none/")).otherwise(
        F.concat(F.lit("/apk_sem/pkg_"), F.col("uid") % 6, F.lit(".apk")))
    line = F.concat(F.col("ip"), F.lit(" - - ["), stamp, F.lit('] "GET /collect.gif?act='), F.col("et"),
                    F.lit("&url=http://h.example"), apk, F.lit('&timestamp=1 HTTP/1.1" 200 43'))
    return once(e, {"value": line}, ["eid"])


CLICKED = "t + 86400 * (k % 300)"


@query("access_log_parse", w(EV) + f"""SELECT eid, et <> 'error' AS ok, {loc(CLICKED)} AS click_time, et AS event_tag,
  CASE WHEN et = 'error' THEN '' ELSE 'pkg_' || (uid % 6) END AS apk_name, CASE WHEN et = 'error' THEN 'access line error' END AS reject_reason FROM ev""")
def access_log_parse(spark, sf):
    return lines.access_lines(access_input(spark, sf)).drop("value")


COIN_COLS = "game_id channel_id game_channel_id user_id trade_count trade_time".split()


def coin_record(extra=0):
    """Coin trade: own games, untouched, small and big games."""
    e = F.col
    gid = (F.when(e("et") == "view", (100000000 + e("uid") % 80).cast("string"))
           .when(e("et") == "error", F.concat(F.lit("SA"), e("uid"))).otherwise(e("game")))
    gch = F.when(e("k") < 10, F.lit("2050")).otherwise(e("gc"))
    channel = F.when(e("et") == "signup", e("sub")).otherwise(e("ch"))
    return {"game_id": gid, "channel_id": channel, "game_channel_id": gch, "user_id": e("uid").cast("string"),
            "role_id": F.lit("r"), "role_name": F.lit("n"), "server": e("k").cast("string"), "type": F.lit("1"),
            "trade_count": (e("k") + extra).cast("string"), "remain_count": F.lit("5"), "item_name": F.lit("i"),
            "item_count": F.lit("1"), "trade_desc": F.lit("d"), "trade_time": e("t").cast("string")}


COIN_SQL = """coin AS (SELECT *, CASE et WHEN 'view' THEN CAST(100000000 + uid % 80 AS VARCHAR) WHEN 'error' THEN 'SA' || uid
  ELSE game END AS gid, CASE WHEN k < 10 THEN '2050' ELSE gc END AS gch, CASE WHEN et = 'signup' THEN sub ELSE ch END AS chn FROM ev)"""


def coin_json_input(spark, sf):
    """Clicks carry two trades in one line, one of them broken when k is 20; some lines have another tag."""
    e = i.ev(spark, sf)
    one, two = i.obj(**coin_record()), i.obj(**coin_record(1000))
    second = F.when(F.col("k") == 20, F.lit('{"game_id":"1","x":}')).otherwise(two)
    body = F.when(F.col("et") == "click", F.concat(F.lit("["), one, F.lit(","), second, F.lit("]"))).otherwise(one)
    line = F.when(F.col("k") == 8, i.frame("OTHER", body)).otherwise(i.frame("GAME_COIN_LOG", body))
    return once(e, {"value": line}, ["eid"])


def coin_tsv_input(spark, sf):
    e = i.ev(spark, sf)
    row = F.concat_ws("\t", *[c for c in coin_record().values()])
    text = F.when(F.col("k") == 20, F.concat(row, F.lit("\tmore"))).when(F.col("k") == 21, F.lit("short\tline")).otherwise(row)
    return once(e, {"value": text}, ["eid"])


@query("coin_json_explode", w(EV, COIN_SQL) + """SELECT eid, 0 AS object_no, TRUE AS ok, CAST(NULL AS VARCHAR) AS reject_reason, gid AS game_id, chn AS channel_id,
  gch AS game_channel_id, CAST(uid AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS trade_count, CAST(t AS VARCHAR) AS trade_time FROM coin WHERE k <> 8
 UNION ALL SELECT eid, NULL, FALSE, 'no tag', '', '', '', '', '', '' FROM coin WHERE k = 8
 UNION ALL SELECT eid, 1, k <> 20, CASE WHEN k = 20 THEN 'json parse error' END, CASE WHEN k = 20 THEN '' ELSE gid END,
  CASE WHEN k = 20 THEN '' ELSE chn END, CASE WHEN k = 20 THEN '' ELSE gch END, CASE WHEN k = 20 THEN '' ELSE CAST(uid AS VARCHAR) END,
  CASE WHEN k = 20 THEN '' ELSE CAST(k + 1000 AS VARCHAR) END, CASE WHEN k = 20 THEN '' ELSE CAST(t AS VARCHAR) END
  FROM coin WHERE et = 'click' AND k <> 8""")
def coin_json_explode(spark, sf):
    return lines.coin_json_lines(coin_json_input(spark, sf)).select("eid", "object_no", "ok", "reject_reason", *COIN_COLS)


@query("coin_tsv_parse", w(EV, COIN_SQL) + """SELECT eid, k NOT IN (20, 21) AS ok, CASE WHEN k IN (20, 21) THEN 'not 14 fields' END AS reject_reason,
  CASE WHEN k IN (20, 21) THEN '' ELSE gid END AS game_id, CASE WHEN k IN (20, 21) THEN '' ELSE chn END AS channel_id,
  CASE WHEN k IN (20, 21) THEN '' ELSE gch END AS game_channel_id, CASE WHEN k IN (20, 21) THEN '' ELSE CAST(uid AS VARCHAR) END AS user_id,
  CASE WHEN k IN (20, 21) THEN '' ELSE CAST(k AS VARCHAR) END AS trade_count,
  CASE WHEN k IN (20, 21) THEN '' ELSE CAST(t AS VARCHAR) END AS trade_time FROM coin""")
def coin_tsv_parse(spark, sf):
    return lines.coin_tsv_lines(coin_tsv_input(spark, sf)).select("eid", "ok", "reject_reason", *COIN_COLS)


@query("binlog_explode", w(OD) + """SELECT oid, 0 AS row_no, 'd' AS database, 'agent_order' AS "table", 'INSERT' AS type, CAST(oid AS VARCHAR) AS order_sn,
  CAST(col AS VARCHAR) AS channel_id, server, CAST(t * 1000 AS VARCHAR) AS update_time, '{"a":' || (oid % 7) || ',"list":[1,2]}' AS ext, CAST(NULL AS VARCHAR) AS reject_reason
  FROM od WHERE oid % 37 <> 5
 UNION ALL SELECT oid, 1, 'd', 'agent_order_copy', 'INSERT', CAST(oid AS VARCHAR), CAST(col AS VARCHAR), server, CAST(t * 1000 AS VARCHAR), '{"a":' || (oid % 7) || ',"list":[1,2]}', NULL
  FROM od WHERE pr = '4-NOT SPECIFIED' AND oid % 37 <> 5
 UNION ALL SELECT oid, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'json parse error' FROM od WHERE oid % 37 = 5""")
def binlog_explode(spark, sf):
    rows = lines.binlog_rows(i.agency_order_lines(spark, sf), schemas.AGENCY_ORDER)
    return rows.select("oid", "row_no", "database", "table", "type", "data.order_sn", "data.channel_id", "data.server",
                       "data.update_time", F.get_json_object("raw", "$.ext").alias("ext"), "reject_reason")


def sdk_input(spark, sf):
    """Views carry an array of two records, the others one object; one header key clashes; errors break off."""
    e = i.ev(spark, sf)
    rec = lambda n: F.struct(F.concat(F.lit(f"e{n}-"), F.col("k")).alias("event"), F.lit(str(n)).alias("id"),
                             F.lit("own").alias("device_id"))
    head = F.struct(F.col("device").alias("device_id"), F.lit("4.1").alias("sdk_version"))
    aid = F.concat(F.lit("A"), F.col("eid")).alias("analysis_id")
    doc = F.when(F.col("et") == "view", F.to_json(F.struct(head.alias("device"), aid, F.array(rec(1), rec(2)).alias("event_record")))) \
        .when(F.col("k") == 9, F.to_json(F.struct(head.alias("device"), aid))) \
        .otherwise(F.to_json(F.struct(head.alias("device"), aid, rec(1).alias("event_record"))))
    doc = F.when(F.col("et") == "error", F.substring(doc, F.lit(1), F.length(doc) - 5)).otherwise(doc)
    return once(e, {"value": i.frame("ANALYSIS", doc)}, ["eid"])


SDK_SQL = w(EV) + f"""SELECT eid, n - 1 AS record_no, 'e' || n || '-' || k AS event, CAST(n AS VARCHAR) AS id, device AS device_id,
  '4.1' AS sdk_version, 'A' || eid AS analysis_id, CAST(t AS VARCHAR) AS server_ts, {day('t')} AS server_date_day, ip, CAST(NULL AS VARCHAR) AS reject_reason
  FROM ev, (VALUES (1), (2)) AS r(n) WHERE (n = 1 AND et <> 'error' AND (k <> 9 OR et = 'view')) OR et = 'view'
  UNION ALL SELECT eid, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN et = 'error' THEN 'json parse error' ELSE 'no event record' END FROM ev WHERE et = 'error' OR (k = 9 AND et <> 'view')"""
SDK_KEYS = ["event", "id", "device_id", "sdk_version", "analysis_id", "server_ts", "server_date_day", "ip"]


@query("sdk_fanout", SDK_SQL)
def sdk_fanout(spark, sf):
    fan = lines.sdk_fanout(sdk_input(spark, sf))
    return fan.select("eid", "record_no", *[F.col("record")[k].alias(k) for k in SDK_KEYS], "reject_reason")


def active_input(spark, sf):
    """Activations; ``device_id`` occurs on both sides, error events are cut off."""
    e = i.ev(spark, sf)
    given = (F.when(F.col("et") == "view", F.col("ch")).when(F.col("et") == "signup", F.col("sub"))
             .when(F.col("k") == 5, F.lit("0")).otherwise(F.col("gc")))
    app = F.struct(F.col("game").alias("agent_game_id"), given.alias("game_channel_id"), F.lit("start").alias("action_type"),
                   F.lit("app").alias("device_id"))
    extra = F.struct(F.col("device").alias("device_id"), F.lit("1920|1080").alias("screen_size"), F.lit(208).alias("application_version"))
    body = i.obj(app_data=app, extra_data=extra)
    text = F.when(F.col("et") == "error", F.substring(body, 1, 20)).otherwise(body)
    return once(e, {"value": i.frame("ACTIVE_LOG", text, "sts")}, ["eid"])


@query("subdoc_merge", w(EV) + """SELECT eid, device AS device_id, '1920|1080' AS screen_size, '208' AS application_version,
  game AS agent_game_id, 'start' AS action_type FROM ev WHERE et <> 'error'""")
def subdoc_merge(spark, sf):
    framed = lines.framed_lines(active_input(spark, sf), lines.ACTIVE_SHAPE, "ACTIVE_LOG[").where("ok")
    one = lines.subdoc_merge(framed.select("eid", "doc.app_data", "doc.extra_data"), "app_data", "extra_data")
    return one.select("eid", *[F.col("record")[k].alias(k) for k in (
        "device_id", "screen_size", "application_version", "agent_game_id", "action_type")])


@query("parse_rejects", w(EV) + f"""SELECT eid, 'login' AS source, 'json parse error' AS info, ip, {loc('t')} AS line_time
  FROM ev WHERE et = 'error'""")
def parse_rejects(spark, sf):
    parsed = lines.framed_lines(i.event_lines(spark, sf), schemas.event_schema(["user"]))
    out = lines.rejects(parsed, "login", kept=["eid"])
    # the raw text is kept whole: read back what it was made from
    return out.select("eid", "source", "info", F.regexp_extract("data", r"CIP\[([^\]]*)\]", 1).alias("ip"),
                      F.regexp_extract("data", r"^NORMAL: \[([^\]]*)\]", 1).alias("line_time"))


@query("line_day_wrap", w(EV) + f"""SELECT eid, {day('t')} AS server_date_day, {day('t')} AS day_in_record, TRUE AS whole FROM ev""")
def line_day_wrap(spark, sf):
    d = lines.line_day_wrap(i.event_lines(spark, sf))
    return d.select("eid", "server_date_day", F.get_json_object("record", "$.server_date_day").alias("day_in_record"),
                    (F.get_json_object("record", "$.msg") == F.col("value")).alias("whole"))


MSG_SQL = """msg AS (SELECT *, 'top-' || et AS topic, 'b1' AS broker, CAST(eid % 4 AS INTEGER) AS queue_id, eid // 4 AS queue_offset,
  CASE WHEN et = 'error' THEN '' ELSE 'sys-' || et END AS data_system, CASE WHEN et = 'error' THEN '' ELSE '10.0.0.' || (uid % 7) END AS mip,
  CASE WHEN et = 'error' THEN '' ELSE '/log/' || (k % 3) END AS file_path FROM ev)"""


@query("envelope_decode", w(EV, MSG_SQL) + """SELECT eid, CASE WHEN k = 3 THEN '' ELSE data_system END AS data_system, CASE WHEN k = 3 THEN '' ELSE mip END AS ip,
  CASE WHEN k = 3 THEN '' ELSE file_path END AS file_path, CASE WHEN k = 3 THEN 1 ELSE 2 + eid % 3 END::BIGINT AS line_count,
  CASE WHEN k = 4 THEN NULL WHEN k = 3 THEN 'plain text' ELSE 'line ' || eid || chr(10) || 'value ' || k || CASE WHEN et = 'click' THEN chr(10) ELSE '' END END AS text,
  k <> 4 AS ok FROM msg WHERE k <> 4 UNION ALL SELECT eid, '', '', '', 0, NULL, FALSE FROM msg WHERE k = 4""")
def envelope_decode(spark, sf):
    """Plain, compressed, unmarked and damaged bodies."""
    m = messages.envelope_encode(i.messages(spark, sf), compress_from=19).select("eid", "k", "body")
    body = F.when(F.col("k") == 3, F.lit("plain text").cast("binary")).when(F.col("k") == 4, F.unhex(F.lit("00112233FF"))) \
        .otherwise(F.col("body"))
    out = messages.envelope_decode(m.withColumn("body", body))
    return out.select("eid", "data_system", "ip", "file_path", "line_count", F.col("message_body").cast("string").alias("text"), "ok")


@query("envelope_roundtrip", w(EV, MSG_SQL) + """SELECT topic, count(*) AS messages, count(*) AS same FROM msg GROUP BY 1""")
def envelope_roundtrip(spark, sf):
    src = i.messages(spark, sf)
    renamed = messages.envelope_encode(src, compress_from=messages.COMPRESS_FROM).select(
        "topic", "body", *[F.col(c).alias("_" + c) for c in ("data_system", "ip", "file_path", "line_count", "message_body")])
    out = messages.envelope_decode(renamed)
    same = None
    for c in ("data_system", "ip", "file_path", "line_count", "message_body"):
        eq = F.col(c) == F.col("_" + c)
        same = eq if same is None else same & eq
    return out.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"), F.count_if(same).alias("same"))


@query("message_lines", w(EV, MSG_SQL) + """SELECT eid, n - 1 AS line_no, CASE WHEN n = 1 THEN 'line ' || eid ELSE 'value ' || k END AS line, data_system,
  mip AS ip, file_path FROM msg, (VALUES (1), (2)) AS r(n) WHERE data_system <> ''""")
def message_lines(spark, sf):
    coded = messages.envelope_encode(i.messages(spark, sf)).select("eid", "body")
    return messages.drop_unnamed(messages.message_lines(coded, lz4=False)).select(
        "eid", "line_no", "line", "data_system", "ip", "file_path")

