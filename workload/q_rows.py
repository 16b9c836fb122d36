"""Warehouse rows and canonical events."""

from pyspark.sql import functions as F

from playtrail import schemas
from playtrail.operators import clicks as ck, events, lines, resolve, warehouse as wh
from playtrail.operators.metrics import metric_rows
from playtrail.operators.once import once
from playtrail.sinks.files import topic_table_rows

from . import inputs as i
from .q_decode import CLICK_SQL
from .registry import query
from .sql import DIMS, EV, OD, day, daykey, loc, w


def load_docs(spark, sf):
    return lines.framed_lines(i.event_lines(spark, sf), schemas.event_schema(
        ["user", "game", "device", "channel_platform"]), "DATA[", frame=False).where("ok")


AD = "CASE WHEN k = 30 THEN '' WHEN k < 40 THEN 'appstore' ELSE 'web' END"
UNAME = "CASE WHEN k >= 10 THEN 'u' || uid ELSE '' END"
GID = "CAST(100000000 + uid % 80 AS VARCHAR)"
PF = f"(CASE WHEN {AD} = 'appstore' THEN 2 ELSE 0 END)"


@query("project_login", w(EV) + f"""SELECT eid, upper(md5(sts || {day('sts')} || {daykey('sts')} || uid || {UNAME} || {GID} || {AD} || device || ip || {PF})) AS id,
  {daykey('sts')} AS login_date, CAST(uid AS VARCHAR) AS user_id, {UNAME} AS user_name, {GID} AS game, {AD} AS channel, device AS device_id,
  ip AS login_ip, make_timestamp((sts + 28800) * 1000000) AS login_time, {PF} AS pf, 'im' || uid AS imei FROM ev WHERE et <> 'error'""")
def project_login(spark, sf):
    return wh.login_rows(load_docs(spark, sf), "doc", ["eid"], overseas=True)


@query("project_active", w(EV) + f"""SELECT eid, upper(md5({GID} || device)) AS id, {daykey('sts')} AS active_date, 100000000 + (uid % 80)::INTEGER AS union_app_id,
  {AD} AS union_channel, '' AS action_type, make_timestamp((sts + 28800) * 1000000) AS client_time, '1920|1080' AS screen_size, device AS device_id,
  'phone' AS device_name, '' AS imsi, 'im' || uid AS imei, '9' AS system_version, '2.1' AS sdk_version, 'pkg' AS package_name,
  CASE WHEN k <> 50 THEN 'g' ELSE '' END AS application_name, '1.2' AS application_version,
  make_timestamp((sts + 28800) * 1000000) AS create_time, ip AS server_ip FROM ev WHERE et <> 'error'""")
def project_active(spark, sf):
    return wh.active_rows(load_docs(spark, sf), "doc", ["eid"])


def own_rows(spark, sf):
    fields = list(dict.fromkeys(schemas.OWN_ORDER + schemas.USER_ROW))
    return lines.binlog_rows(i.own_order_lines(spark, sf), fields).select("oid", "table", "type", "data")


OWNCH = "CASE WHEN oid % 5 = 0 THEN 'appstore' ELSE CAST(5000 + s AS VARCHAR) END"
OPF = "CASE WHEN oid % 5 = 0 THEN 2 ELSE 0 END"
ORDER_CORE = f"""oid, CAST(oid AS VARCHAR) AS order_sn, CAST(uid AS VARCHAR) AS user_id, '1' AS type, {GID} AS game, {OWNCH} AS channel,
  'dev-' || (uid % 40) AS device_id, TRY_CAST(server AS INTEGER) AS server, CAST(oid % 24 AS VARCHAR) AS pay_type, 'cp' || oid AS cp_trade_sn,
  '2' AS goods_id, 'gem' AS goods_name, CAST(uid AS VARCHAR) AS game_role_id, 'role' AS game_role_name, 'http://h.example/p' AS game_url, {OPF} AS pf, pay AS pay_status"""


@query("project_order", w(OD) + f"""SELECT {ORDER_CORE}, step AS status, upper(md5(oid || '' || step || pay)) AS id, money, 0.0::DOUBLE AS local_money, 0.0::DOUBLE AS imf_money, -1 AS big_channel,
  '' AS channel_trade_sn, make_timestamp((t + 28800) * 1000000) AS create_time, make_timestamp((t + 28800) * 1000000) AS update_time, 4 AS platform,
  'im' AS imei, {daykey('t')} AS order_date, ip AS create_ip FROM od""")
def project_order(spark, sf):
    return wh.order_rows(own_rows(spark, sf), "data", ["oid"])


@query("project_order_batch", w(OD) + f"""SELECT oid, upper(md5(oid || '' || (CASE WHEN pay = 1 THEN 2 ELSE step END) || pay)) AS id,
  CASE WHEN pay = 1 THEN 2 ELSE step END AS status, pay AS pay_status, make_timestamp((t + 28800) * 1000000) AS update_time, {daykey('t')} AS order_date FROM od""")
def project_order_batch(spark, sf):
    o = own_rows(spark, sf)
    text = o.withColumn("data", F.col("data").withField("update_time", F.col("data.create_time")))
    return wh.order_rows(text, "data", ["oid"], batch=True).select("oid", "id", "status", "pay_status", "update_time", "order_date")


@query("project_order_fx", w(OD, DIMS) + f"""SELECT {ORDER_CORE}, step AS status, cur AS money_type, upper(md5(oid || '' || step || pay || (t * 1000) || (t * 1000))) AS id,
  coalesce(cny, 1.0) * money AS money, money AS local_money, coalesce(usd, 1.0) * money AS imf_money, 'pt' || oid AS channel_trade_sn,
  make_timestamp((t + 28800) * 1000000) AS create_time, make_timestamp((t + 28800) * 1000000) AS update_time, {daykey('t')} AS order_date
  FROM od LEFT JOIN rate ON cur = currency""")
def project_order_fx(spark, sf):
    o = own_rows(spark, sf)
    fx = resolve.fx_convert(o, i.dims(spark, sf), F.col("data.money_type"), F.col("data.money").cast("double"))
    return wh.order_rows_fx(fx, "data", ["oid"])


@query("project_user", w(OD) + f"""SELECT oid, upper(md5(CAST(uid AS VARCHAR))) AS id, CAST(uid AS VARCHAR) AS user_id, 'u' || uid AS user_name, '1' AS tel_num, 0 AS tel_status,
  'e' AS email, 3 AS reg_type, {OWNCH} AS channel, {GID} AS game, 'dev-' || (uid % 40) AS device_id, ip AS register_ip,
  make_timestamp((t + 28800) * 1000000) AS register_time, step AS status, {OPF} AS pf, 4 AS platform, -1 AS new_device, 'im' AS imei, {daykey('t')} AS reg_date FROM od""")
def project_user(spark, sf):
    return wh.user_rows(own_rows(spark, sf), "data", ["oid"])


@query("project_user_overseas", w(OD) + f"""SELECT oid, upper(md5(uid || 'u' || uid || '1' || '0' || 'e' || '3' || {OWNCH} || {GID} || 'dev-' || (uid % 40) || ip || {day('t')} || step || {OPF} || '0')) AS id,
  0 AS new_device FROM od""")
def project_user_overseas(spark, sf):
    return wh.user_rows(own_rows(spark, sf), "data", ["oid"], overseas=True).select("oid", "id", "new_device")


def install_docs(spark, sf):
    """Install attributions of both platforms; long urls, missing times, unknown packages."""
    e = i.ev(spark, sf)
    url = F.when(F.col("k") < 20, F.concat(F.lit("http://x/"), F.repeat(F.lit("a"), 600))).otherwise(F.lit("http://x/a"))
    doc = i.obj(platform=F.when(F.col("uid") % 3 == 0, F.lit("ios")).when(F.col("uid") % 3 == 1, F.lit("android")).otherwise(F.lit("web")),
                bundle_id=F.concat(F.lit("com.game.p"), F.col("k") * 30), event_type="install",
                event_time=F.when(F.col("et") != "view", i.stamp("sts")), install_time=i.stamp(), click_url=url, wifi=F.col("k") % 2 == 0,
                customer_user_id=F.col("uid").cast("string"), android_id="aid", imei="imei", idfa="idfa", idfv="idfv",
                device_brand="brand", device_type="dtype", device_model="model", appsflyer_device_id=F.col("device"),
                media_source=F.col("et"), country_code="XX")
    line = once(e, {"value": F.concat(F.lit("DATA["), doc, F.lit("]"))}, ["eid"])
    return lines.framed_lines(line, wh.INSTALL_SHAPE, "DATA[", frame=False)


@query("project_install", w(EV) + f"""SELECT eid, upper(md5(device || 'com.game.p' || (k * 30) || (CASE WHEN uid % 3 = 0 THEN 1 ELSE 0 END) || CASE WHEN et <> 'view' THEN {loc('sts')} ELSE '' END)) AS id,
  CASE WHEN et <> 'view' THEN {daykey('sts')} ELSE 0 END AS event_date, {daykey('t')} AS active_date, 'com.game.p' || (k * 30) AS game,
  CAST(1 + p_partkey % 97 AS VARCHAR) AS game_id, CASE WHEN uid % 3 = 0 THEN 1 ELSE 0 END AS pf,
  CASE WHEN et <> 'view' THEN make_timestamp((sts + 28800) * 1000000) ELSE TIMESTAMP '1970-07-01 00:00:00' END AS event_time, TIMESTAMP '1970-07-01 00:00:00' AS click_time,
  CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS wifi, CASE WHEN uid % 3 = 2 THEN '' ELSE CAST(uid AS VARCHAR) END AS device_id,
  CASE uid % 3 WHEN 0 THEN 'idfa' WHEN 1 THEN 'aid' ELSE '' END AS device_idfa1, CASE uid % 3 WHEN 0 THEN 'idfv' WHEN 1 THEN 'imei' ELSE '' END AS device_idfa2,
  CASE uid % 3 WHEN 0 THEN 'dtype' WHEN 1 THEN 'brand' ELSE '' END AS device_brand, CASE WHEN uid % 3 = 2 THEN '' ELSE 'model' END AS device_type,
  CASE WHEN k < 20 THEN 500 ELSE 10 END AS url_length, et AS media_source, '' AS campaign
  FROM ev LEFT JOIN part ON p_partkey = k * 30""")
def project_install(spark, sf):
    rows = wh.install_rows(install_docs(spark, sf), i.dims(spark, sf).package_game, "doc", ["eid"])
    return rows.select("eid", "id", "event_date", "active_date", "game", "game_id", "pf", "event_time", "click_time", "wifi", "device_id",
                       "device_idfa1", "device_idfa2", "device_brand", "device_type", F.length("click_url").alias("url_length"),
                       "media_source", "campaign")


def purchase_docs(spark, sf):
    e = i.ev(spark, sf)
    doc = i.obj(event_order="event_order", mPurchaseTime=F.col("t") * 1000, mDeveloperPayload="p", mItemType="inapp",
                mOrderId=F.concat(F.lit("GPA."), F.col("eid")), mToken=F.concat(F.lit("tok-"), F.col("eid")), own_app_id=F.col("game"),
                order_id=F.col("eid").cast("string"), amount=F.col("val"),
                mOriginalJson=F.struct(F.concat(F.lit("com.game.p"), F.col("uid")).alias("packageName"), F.lit("prod").alias("productId"),
                                       F.col("k").alias("mPurchaseState")))
    line = once(e, {"value": F.concat(F.lit("DATA["), doc, F.lit("]"))}, ["eid", "t"])
    return lines.framed_lines(line, wh.PURCHASE_SHAPE, "DATA[", frame=False)


@query("project_purchase", w(EV) + f"""SELECT eid, upper(md5('tok-' || eid || eid || (t * 1000))) AS id, make_timestamp((t + 28800) * 1000000) AS purchase_time, {daykey('t')} AS purchase_date,
  'p' AS mDeveloperPayload, 'inapp' AS mItemType, 'GPA.' || eid AS order_id, 'com.game.p' || uid AS pack_name, 'prod' AS product_id, k AS purchase_state,
  'tok-' || eid AS purchase_token, game AS game_id, val / 100 AS amount, CAST(eid AS VARCHAR) AS order_sn FROM ev""")
def project_purchase(spark, sf):
    return wh.purchase_rows(purchase_docs(spark, sf), "doc", ["eid"])


@query("project_metric", w(EV) + """SELECT upper(md5('run1' || et || 'h1' || 'sendToKafka' || n || 'f' || 'logFile' || et)) AS id, et AS data_source, 'h1' AS host,
  'sendToKafka' AS metric_name, n::INTEGER AS value, 'f' AS file_name, 'logFile' AS type, et AS topic, '' AS tags, 0 AS time
  FROM (SELECT et, count(*) AS n FROM ev GROUP BY 1)""")
def project_metric(spark, sf):
    counts = i.ev(spark, sf).groupBy(F.col("et").alias("topic")).agg(F.count(F.lit(1)).cast("int").alias("value"))
    return metric_rows(counts, F.col("topic"), F.lit("h1"), "sendToKafka", F.lit("f"), F.lit(0), "run1")


ORDER_IDS = f"""oj AS (SELECT od.*, coalesce(b.game_channel_id, 'error') AS jgc, coalesce(b.channel_id, 'error') AS jch, coalesce(b.game_id, 'error') AS jg FROM od
  LEFT JOIN BELONG b ON b.belong_game_id = {GID}),
ok AS (SELECT oj.*, coalesce(c.company_id, 'error') AS company, coalesce(os.pf, '') AS os FROM oj LEFT JOIN company c ON c.game_id = jg LEFT JOIN os ON os.channel_id = jch)"""
STEPS = "CASE step WHEN 1 THEN 'create_order' WHEN 2 THEN 'paid_success' ELSE 'notify_cp_success' END"
# Payment type codes and their labels, code by code.
DOM = ("CASE oid % 24 WHEN 1 THEN 'alipay' WHEN 5 THEN 'yeebao' WHEN 6 THEN 'weichat_pay' WHEN 7 THEN 'apple_pay' WHEN 8 THEN 'iapppay' WHEN 9 THEN 'alipay' "
       "WHEN 10 THEN 'alipay' WHEN 12 THEN 'weichat_pay' WHEN 13 THEN 'weichat_pay' WHEN 14 THEN 'alipay' WHEN 15 THEN 'weichat_pay' WHEN 17 THEN 'weichat_pay' "
       "WHEN 18 THEN 'weichat_pay' WHEN 19 THEN 'weichat_pay' WHEN 20 THEN 'unionpay' WHEN 21 THEN 'weichat_pay' WHEN 22 THEN 'weichat_pay' "
       "ELSE CAST(oid % 24 AS VARCHAR) END")
EVENT_COLS = ["user.user_id", "game.game_id", "game.company_id", "game.app_key", "agent.channel_id", "agent.game_channel_id", "device.os_type",
              "device.device_id", "role.role_id", "role.role_server", "order.order_sn", "order.order_step", "order.order_status", "order.order_type",
              "order.money", "order.currency_type", "order.channel_trade_sn", "event", "is_test", "server_ts", "client_ip", "sub_pf"]


def order_event_sql(belong, ids=ORDER_IDS, gc="jgc"):
    return w(OD, DIMS, ids.replace("BELONG", belong)) + f"""SELECT oid, CAST(uid AS VARCHAR) AS user_id, jg AS game_id, company AS company_id, {GID} AS app_key, jch AS channel_id,
  {gc} AS game_channel_id, os AS os_type, 'dev-' || (uid % 40) AS device_id, CAST(uid AS VARCHAR) AS role_id, server AS role_server, CAST(oid AS VARCHAR) AS order_sn,
  {STEPS} AS order_step, CASE pay WHEN 1 THEN 'success' ELSE 'failure' END AS order_status, {DOM} AS order_type, money, cur AS currency_type, 'pt' || oid AS channel_trade_sn,
  'order' AS event, 'regular' AS is_test, t AS server_ts, ip AS client_ip, os AS sub_pf FROM ok"""


@query("order_event", order_event_sql("belong"))
def order_event(spark, sf):
    return events.order_event(own_rows(spark, sf), i.dims(spark, sf)).select("oid", *EVENT_COLS)


@query("order_event_by_channel", order_event_sql("", f"""oj AS (SELECT od.*, coalesce(b.channel_id, 'error') AS jch, coalesce(b.game_id, 'error') AS jg FROM od
  LEFT JOIN by_game_channel b ON b.game_channel_id = {OWNCH}),
ok AS (SELECT oj.*, coalesce(c.company_id, 'error') AS company, coalesce(os.pf, '') AS os FROM oj LEFT JOIN company c ON c.game_id = jg LEFT JOIN os ON os.channel_id = jch)""", OWNCH))
def order_event_by_channel(spark, sf):
    return events.order_event(own_rows(spark, sf), i.dims(spark, sf), combined=False).select("oid", *EVENT_COLS)


@query("order_event_flat", w(OD, DIMS, ORDER_IDS.replace("BELONG", "belong_overseas")) + f"""SELECT oid, CAST(uid AS VARCHAR) AS user_id, jg AS game_id, jch AS channel_id, jgc AS game_channel_id,
  CAST(pay AS VARCHAR) AS pay_status, CAST(step AS VARCHAR) AS status, money, money AS currency_amount, 'im' AS android_imei, '' AS user_name,
  CASE WHEN oid % 24 BETWEEN 1 AND 7 THEN ['google_pay','mycard','visa_global','apple_pay','mol','huawei','onestore'][(oid % 24)::INTEGER] ELSE CAST(oid % 24 AS VARCHAR) END AS order_type FROM ok""")
def order_event_flat(spark, sf):
    d = i.dims(spark, sf, platforms=("4", "5"))
    flat = events.order_event(own_rows(spark, sf), d, overseas=True, flat=True)
    return flat.select("oid", "user_id", "game_id", "channel_id", "game_channel_id", "pay_status", "status", "money", "currency_amount",
                       "android_imei", "user_name", "order_type")


REGISTER_COLS = ["user.user_id", "user.gender", "user.phone_num", "user.email_num", "user.login_type", "game.game_id", "game.app_key",
                 "game.company_id", "agent.channel_id", "agent.game_channel_id", "device.device_id", "event", "server_ts", "is_test"]
REGISTER_SQL = f"""SELECT oid, CAST(uid AS VARCHAR) AS user_id, CASE oid % 3 WHEN 1 THEN 'male' WHEN 2 THEN 'female' ELSE '0' END AS gender, '1' AS phone_num, 'e' AS email_num,
  '3' AS login_type, jg AS game_id, {GID} AS app_key, company AS company_id, jch AS channel_id, jgc AS game_channel_id, 'dev-' || (uid % 40) AS device_id,
  'register' AS event, t AS server_ts, 'regular' AS is_test FROM ok"""


@query("register_event", w(OD, DIMS, ORDER_IDS.replace("BELONG", "belong")) + REGISTER_SQL)
def register_event(spark, sf):
    return events.register_event(own_rows(spark, sf), i.dims(spark, sf)).select("oid", *REGISTER_COLS)


@query("union_events", w(OD, DIMS, ORDER_IDS.replace("BELONG", "belong")) + """SELECT oid, 'order' AS event, jg AS game_id, CAST(oid AS VARCHAR) AS order_sn, t AS server_ts FROM ok WHERE tab = 'order' UNION ALL SELECT oid, 'register', jg, NULL, t FROM ok WHERE tab = 'user'""")
def union_events(spark, sf):
    rows, d = own_rows(spark, sf), i.dims(spark, sf)
    both = events.union_events(events.order_event(rows.where(F.col("table") == "order"), d),
                               events.register_event(rows.where(F.col("table") == "user"), d).drop("status"))
    return both.select("oid", "event", "game.game_id", "order.order_sn", "server_ts")


@query("login_event", w(EV) + """SELECT eid, CAST(uid AS VARCHAR) AS user_id, '' AS user_name, game AS game_id, CASE et WHEN 'view' THEN '' WHEN 'signup' THEN sub ELSE ch END AS channel_id,
  '' AS device_id, 'login' AS event, 'regular' AS is_test, '+08:00' AS server_time_zone, 0 AS client_ts, t AS server_ts, ip AS client_ip FROM ev WHERE et <> 'error'""")
def login_event(spark, sf):
    parsed = lines.old_login_lines(i.old_login_lines(spark, sf)).where("ok")
    return events.login_event(parsed).select("eid", "user.user_id", "user.user_name", "game.game_id", "agent.channel_id", "device.device_id", "event",
                                             "is_test", "server_time_zone", "client_ts", "server_ts", "client_ip")


def good_clicks(spark, sf):
    return lines.ad_click_lines(i.click_lines(spark, sf)).where("ok")


SOURCE_JSON = """'{"ad_id":"' || ad0 || '","channel":"' || channel || '","click_time":"' || click_time || '","client_ip":"' || ip || '","company_id":"' || company_id
  || '","device_id":"' || cdev || '","game":"' || cgame || '","pf":"' || pf || '"}'"""


@query("click_detail", w(EV, CLICK_SQL) + f"""SELECT eid, upper(md5({SOURCE_JSON})) AS id, cgame AS game, channel, ad0 AS ad_id, ip AS client_ip, company_id, click_time,
  {SOURCE_JSON} AS click_source, substr(click_time, 12, 2) AS hour, channel <> '' AS ok FROM clicks WHERE reason IS NULL""")
def click_detail(spark, sf):
    return ck.click_detail_rows(good_clicks(spark, sf), ["eid"]).drop("click_day", "is_used")


@query("click_lookup_keys", w(EV, CLICK_SQL) + """SELECT eid, 'company_id_' || company_id || '_api_click_detail_' || cgame || '_' || ip AS key FROM clicks WHERE reason IS NULL
 UNION ALL SELECT eid, 'company_id_' || company_id || '_api_click_detail_' || cgame || '_' || cdev FROM clicks WHERE reason IS NULL AND cdev <> ''""")
def click_lookup_keys(spark, sf):
    return ck.lookup_keys(good_clicks(spark, sf)).select("eid", "key")


@query("topic_table_load", w(OD) + f"""SELECT upper(md5('{{"order_sn":"' || oid || '","pay_time":"' || {loc('t')} || '"}}')) AS id, CAST(oid AS VARCHAR) AS order_sn,
  make_timestamp((t + 28800) * 1000000) AS pay_time, 'ad_pay' AS table_name FROM od""")
def topic_table_load(spark, sf):
    rec = i.od(spark, sf).select(F.col("oid").cast("string").alias("order_sn"), i.stamp().alias("pay_time"))
    return topic_table_rows(rec, "orderTopic")
