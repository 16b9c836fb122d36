"""Routing and file sinks."""

from pyspark.sql import functions as F

from playtrail.functions import times
from playtrail.operators import clicks as ck, events, guards, lines, resolve, route
from playtrail.session import fresh_path
from playtrail.sinks import files

from . import inputs as i
from .q_decode import CLICK_SQL
from .q_joins import LOGIN_SQL, ORDER_SQL
from .registry import query
from .sql import DIMS, EV, OD, day, w


@query("route_login", w(EV, DIMS) + """SELECT eid, CASE WHEN et = 'error' THEN 'agentLoginFilter' WHEN gc IN (SELECT game_channel_id FROM special) THEN 'agentLoginOther' ELSE 'agentLogin' END AS route,
  CASE WHEN et = 'error' THEN 'ownLoginFilter' ELSE 'agentLogin' END AS folded FROM ev""")
def route_login(spark, sf):
    flagged = guards.member(i.ev(spark, sf).select("eid", "et", "gc"), F.col("gc"), i.dims(spark, sf).special, "s")
    ok = F.col("et") != "error"
    return flagged.select("eid", route.route_login("agentLoginSrc", ok, F.col("s")).alias("route"),
                          route.route_login("ownLoginSrc", ok, None, "agentLogin").alias("folded"))


@query("route_order", w(OD, DIMS, ORDER_SQL) + """SELECT oid, CASE WHEN pr = '4-NOT SPECIFIED' THEN 'agentDBCopy' WHEN channel_id IN ('6001', '10081', '20') THEN 'agentDBFilter'
  WHEN oid % 10 = 0 THEN 'agentDBTest' WHEN game_channel_id IN (SELECT game_channel_id FROM special) THEN 'agentDBOther' ELSE 'agentDB' END AS route FROM oc""")
def route_order(spark, sf):
    o = i.od(spark, sf).select("oid", "pr", F.col("game").cast("string").alias("g"), F.col("col").cast("string").alias("c"))
    d = i.dims(spark, sf)
    out = resolve.resolve_order(o, d, game_id=F.col("g"), column=F.col("c"))
    out = guards.member(out, F.col("game_channel_id"), d.special, "s")
    return out.select("oid", route.route_order("agentDBSrc", F.col("pr") == "4-NOT SPECIFIED", F.col("resolved"),
                                               ~guards.not_in(F.col("channel_id"), ("6001", "10081", "20")), F.col("oid") % 10 == 0, F.col("s")).alias("route"))


@query("route_service", w(EV) + """SELECT eid, CASE WHEN k < 10 THEN svc || 'Error' WHEN svc = 'agent' AND s < 20 THEN 'agentStdOther' WHEN svc = 'merged' THEN 'agentStd' ELSE svc || 'Std' END AS route
  FROM (SELECT *, CASE et WHEN 'view' THEN 'agent' WHEN 'click' THEN 'merged' ELSE 'sdk' END AS svc FROM ev)""")
def route_service(spark, sf):
    e = i.ev(spark, sf)
    svc = F.when(F.col("et") == "view", F.lit("agent")).when(F.col("et") == "click", F.lit("merged")).otherwise(F.lit("sdk"))
    return e.select("eid", route.route_service(svc, F.col("k") >= 10, F.col("s") < 20, {"merged": "agent"}).alias("route"))


@query("route_table", w(OD) + """SELECT oid, CASE WHEN tab = 'misc' THEN 'others' ELSE tab END AS route, CASE WHEN tab = 'order' AND pay = 1 THEN 'agentDB' ELSE 'ownDBFilter' END AS target FROM od""")
def route_table(spark, sf):
    o = i.od(spark, sf).withColumn("tab", i.own_tables())
    return o.select("oid", route.route_table(F.col("tab")).alias("route"),
                    route.route_own_order("ownDBSrc", F.col("tab"), F.col("pay") == 1, "agentDB").alias("target"))


@query("route_event", w(EV) + """SELECT eid, CASE et WHEN 'view' THEN 'login' WHEN 'error' THEN 'active' WHEN 'signup' THEN 'install' WHEN 'purchase' THEN 'purchase' ELSE CASE WHEN k < 50 THEN 'refund' ELSE 'none' END END AS route FROM ev""")
def route_event(spark, sf):
    e = i.ev(spark, sf)
    when = lambda kind, value: F.when(F.col("et") == kind, F.lit(value)).otherwise(F.lit(""))
    return e.select("eid", route.route_event(F.when(F.col("et").isin("view", "error"), F.col("kind")).otherwise(F.lit("")), when("signup", "install"),
                                             when("purchase", "event_order"), F.when((F.col("et") == "click") & (F.col("k") < 50), F.lit("g"))
                                             .otherwise(F.lit(""))).alias("route"))


@query("every_row_one_route", w(EV, DIMS, LOGIN_SQL) + """SELECT CASE WHEN game_channel_id IN (SELECT game_channel_id FROM special) THEN 'agentLoginOther' ELSE 'agentLogin' END AS route,
  count(*) AS n FROM lr GROUP BY 1""")
def every_row_one_route(spark, sf):
    e = i.ev(spark, sf)
    c0 = F.when(F.col("et") == "view", F.lit("")).when(F.col("et") == "signup", F.col("sub")).otherwise(F.col("ch"))
    g0 = F.when(F.col("et") == "signup", F.lit("")).when(F.col("et") == "click", F.lit("0")).otherwise(F.col("gc"))
    d = i.dims(spark, sf)
    out = resolve.resolve_login(e.select("eid", "game", c0.alias("c0"), g0.alias("g0")), d, agent=F.lit(1), game_id=F.col("game"),
                                channel_id=F.col("c0"), game_channel_id=F.col("g0"))
    out = guards.member(out, F.col("game_channel_id"), d.special, "s")
    return out.groupBy(route.route_login("agentLoginSrc", F.col("resolved"), F.col("s")).alias("route")).agg(F.count(F.lit(1)).alias("n"))


@query("sink_topics", w(EV) + """SELECT 'top-' || et AS topic, 'v' || eid AS value FROM ev""")
def sink_topics(spark, sf):
    path = fresh_path(spark, "sink_topics")
    rows = i.ev(spark, sf).select(F.concat(F.lit("top-"), "et").alias("topic"), F.concat(F.lit("v"), "eid").alias("value"))
    files.write_topics(rows, path)
    return spark.read.schema("value string, topic string").parquet(path)


@query("sink_json", w(EV) + """SELECT eid, et, device, val FROM ev""")
def sink_json(spark, sf):
    path = fresh_path(spark, "sink_json")
    files.write_json(i.ev(spark, sf).select("eid", "et", "device", "val"), path)
    return spark.read.schema("eid bigint, et string, device string, val double").json(path)


@query("sink_partitioned", w(EV) + f"""SELECT {day('t')} AS dt, eid FROM ev""")
def sink_partitioned(spark, sf):
    """Days written twice: the second write replaces exactly its own days."""
    path = fresh_path(spark, "sink_partitioned")
    rows = i.ev(spark, sf).select(times.day(F.col("t")).alias("dt"), "eid")
    files.write_dated(rows.where("dt < '2024-01-20'").withColumn("eid", F.lit(-1).cast("bigint")), path)
    files.write_dated(rows, path)
    return spark.read.schema("eid bigint, dt string").parquet(path)


@query("click_detail_by_day", w(EV, CLICK_SQL) + """SELECT eid, substr(click_time, 1, 10) AS click_day, company_id, click_time, channel, 0::SMALLINT AS is_used FROM clicks WHERE reason IS NULL AND channel <> ''""")
def click_detail_by_day(spark, sf):
    path = fresh_path(spark, "click_detail")
    rows = ck.click_detail_rows(lines.ad_click_lines(i.click_lines(spark, sf)).where("ok"), ["eid"])
    files.write_dated(rows.where("ok").drop("ok"), path, "click_day")
    return spark.read.schema("eid bigint, company_id string, click_time string, channel string, is_used smallint, click_day string").parquet(path)


def flat_logins(spark, sf):
    """Flattened login rows of the narrow feed."""
    t = F.col("t")
    return i.ev(spark, sf).select("eid", F.col("kind").alias("event"), F.when(F.col("k") != 77, F.lit("regular")).otherwise(F.lit("test")).alias("is_test"),
                                  times.day(t).alias("server_date_day"), times.hour(t).alias("server_date_hour"), times.day(F.col("sts")).alias("reg_date"),
                                  F.lit("").alias("first_order_date"), F.col("game").alias("game-game_id"), F.col("ch").alias("agent-channel_id"),
                                  F.col("gc").alias("agent-game_channel_id"), F.lit("ios").alias("device-os_type"), F.col("uid").alias("user-user_id"))


@query("olap_shape", w(EV) + f"""SELECT {day('t')} AS server_date_day, strftime(make_timestamp((t + 28800) * 1000000), '%H') AS server_date_hour, {day('sts')} AS reg_date, '' AS first_order_date,
  game AS game_id, ch AS channel_id, gc AS game_channel_id, 'ios' AS os_type, CAST(uid AS VARCHAR) AS user_id FROM ev""")
def olap_shape(spark, sf):
    return events.olap_shape(flat_logins(spark, sf), True)
