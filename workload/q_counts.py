"""Counts and run metrics."""

from pyspark.sql import functions as F

from playtrail.operators import clicks as ck, lines, metrics as mt
from playtrail.sources import messages

from . import inputs as i
from .q_decode import CLICKED, CLICK_SQL, MSG_SQL, access_input
from .registry import query
from .sql import EV, w

MINUTE = """CAST(replace(substr(m, 1, 10), '-', '') AS INTEGER) AS click_date, CAST(substr(m, 12, 2) AS INTEGER) AS click_hour, CAST(substr(m, 15, 2) AS INTEGER) AS click_minute"""


@query("ad_click_per_minute", w(EV, CLICK_SQL, """cc AS (SELECT ad0, substr(click_time, 1, 16) AS m, cgame, pf, channel, count(*) AS n FROM clicks WHERE reason IS NULL GROUP BY ALL)""")
       + f"""SELECT upper(md5(ad0 || '|' || m || '|' || cgame || '|' || pf || '|' || channel || n)) AS id, CASE WHEN ad0 = '' THEN 0 ELSE CAST(ad0 AS INTEGER) END AS ad_id, {MINUTE},
  n::INTEGER AS click_cnt, cgame AS game, channel, CASE WHEN pf = '' THEN 2 ELSE CAST(pf AS INTEGER) END AS pf, 4 AS platform FROM cc""")
def ad_click_per_minute(spark, sf):
    return ck.ad_clicks_per_minute(lines.ad_click_lines(i.click_lines(spark, sf)).where("ok"))


@query("page_click_per_minute", w(EV, f"""pc AS (SELECT strftime(make_timestamp(({CLICKED} + 28800) * 1000000), '%Y-%m-%d %H:%M') AS m, et, 'pkg_' || (uid % 6) AS apk, count(*) AS n FROM ev WHERE et <> 'error' GROUP BY ALL)""")
       + f"""SELECT upper(md5(m || '`' || et || '`' || apk || n)) AS id, et AS event_tag, apk AS apk_name, {MINUTE}, n::INTEGER AS click_cnt FROM pc""")
def page_click_per_minute(spark, sf):
    return ck.page_clicks_per_minute(lines.access_lines(access_input(spark, sf)).where("ok"))


@query("route_counts", w(EV) + """SELECT 'eventSrc' AS source, destination, value FROM (SELECT et AS destination, count(*) AS value FROM ev GROUP BY 1
  UNION ALL SELECT '', count(*) FROM ev)""")
def route_counts(spark, sf):
    return mt.route_counts(i.ev(spark, sf), "eventSrc", "et")


@query("sent_metrics", w(EV) + """SELECT upper(md5('run7' || et || 'host' || 'sendToKafka' || n || 'logFile' || et)) AS id, et AS data_source, 'host' AS host, 'sendToKafka' AS metric_name,
  0 AS time, n::INTEGER AS value, '' AS file_name, 'logFile' AS type, et AS topic, '' AS tags FROM (SELECT et, count(*) AS n FROM ev GROUP BY 1)""")
def sent_metrics(spark, sf):
    return mt.sent_metrics(i.ev(spark, sf), "host", "run7", F.lit(0), "et")


@query("received_metrics", w(EV, MSG_SQL) + """SELECT data_system, mip AS ip, file_path, count(*) * 2 AS value FROM msg WHERE file_path <> '' GROUP BY ALL""")
def received_metrics(spark, sf):
    coded = messages.envelope_encode(i.messages(spark, sf)).select("eid", "body")
    decoded = messages.envelope_decode(coded, lz4=False)
    return mt.received_metrics(decoded)


@query("collector_last_seen", w(EV, MSG_SQL) + "SELECT mip AS ip, max(t) AS last_seen FROM msg GROUP BY 1")
def collector_last_seen(spark, sf):
    return mt.collector_last_seen(i.messages(spark, sf), "ip", "t")


@query("collector_ips", w(EV, MSG_SQL) + "SELECT DISTINCT mip AS ip FROM msg")
def collector_ips(spark, sf):
    return mt.collectors(i.messages(spark, sf))
