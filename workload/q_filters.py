"""Checks, guards and exclusions."""

from pyspark.sql import functions as F

from playtrail import schemas
from playtrail.functions.coerce import int_of
from playtrail.operators import clicks as ck, dedupe, events, guards, lines, rules
from playtrail.operators.lookup import Dimension
from playtrail.sources import messages

from . import inputs as i
from .q_decode import CLICK_SQL
from .q_rows import own_rows
from .registry import query
from .sql import DIMS, EV, OD, day, w


def parsed(spark, sf, groups=None):
    return lines.framed_lines(i.event_lines(spark, sf), schemas.event_schema(groups))


@query("require_common", w(EV) + """SELECT eid, et <> 'error' AND k <> 33 AS stream_ok, et <> 'error' AS batch_ok FROM ev""")
def require_common(spark, sf):
    d = parsed(spark, sf, ["device", "game"])
    ts = int_of(F.col("doc.server_ts"))
    return d.select("eid", rules.require_common(F.col("doc"), ts).alias("stream_ok"),
                    rules.require_common(F.col("doc"), ts, batch=True).alias("batch_ok"))


# first broken rule per event, in rule order, written out from the stand-in's own gaps
FIRST = """CASE WHEN et IN ('view', 'signup', 'purchase', 'click') AND k < 10 THEN 'user_name'
  WHEN et IN ('view', 'signup', 'purchase', 'click') AND k = 50 THEN 'game_name'
  WHEN et = 'purchase' AND val <= 0 THEN 'currency_amount' WHEN et = 'click' AND k - 20 < 0 THEN 'click_time' END"""


@query("rule_validate", w(EV) + f"""SELECT eid, et <> 'error' AND k <> 33 AND ({FIRST}) IS NULL AS ok, CASE WHEN et = 'error' THEN 'json parse error'
  WHEN k = 33 THEN '1.Error value in common column may be null.' WHEN ({FIRST}) IS NOT NULL THEN 'Error value in ' || ({FIRST}) || ' column may be null.' END AS reject_reason FROM ev""")
def rule_validate(spark, sf):
    return rules.validated(parsed(spark, sf)).select("eid", "ok", "reject_reason")


@query("rule_validate_batch", w(EV) + """SELECT eid, et <> 'error' AND NOT coalesce(et = 'click' AND k - 20 <= 0, FALSE) AS ok FROM ev""")
def rule_validate_batch(spark, sf):
    """Six common fields; whole numbers above zero; only the click rule is given."""
    only = [r for r in rules.DEFAULT_RULES if r[3] == "2"]
    return rules.validated(parsed(spark, sf), rules=only, batch=True, int_strict=True).select("eid", "ok")


@query("rule_first_failure", w(EV) + f"""SELECT eid, {FIRST} AS field, CASE WHEN et NOT IN ('error') AND NOT regexp_full_match(gc, '50[0-4].') THEN 'game_channel_id' END AS by_pattern FROM ev""")
def rule_first_failure(spark, sf):
    d = parsed(spark, sf)
    pattern = [(e, "agent", "game_channel_id", "50[0-4].") for e in ("login", "register", "order", "click")]
    return d.select("eid", rules.first_failure(F.col("doc")).alias("field"), rules.first_failure(F.col("doc"), pattern).alias("by_pattern"))


@query("threshold_guard", w(EV) + """SELECT eid, NOT (uid % 97 + 1 >= 63 AND et = 'signup') AS ok FROM ev""")
def threshold_guard(spark, sf):
    e = i.ev(spark, sf)
    gc = F.when(F.col("et") != "signup", F.col("gc")).otherwise(F.lit(""))
    return e.select("eid", guards.threshold_guard(F.col("game"), gc).alias("ok"))


@query("agent_guard", w(EV) + """SELECT eid, et <> 'error' AND et <> 'click' AND NOT (et = 'view' AND k < 50) AS ok, et <> 'error' AND NOT (et = 'view' AND k < 50) AND et = 'purchase' AS digits_ok FROM ev""")
def agent_guard(spark, sf):
    e = i.ev(spark, sf)
    agent = F.when(F.col("et") != "error", F.struct(F.lit(1)))
    game = F.when(F.col("et") == "click", F.lit("")).when(F.col("et") == "purchase", F.col("game")).otherwise(F.concat(F.lit("g"), "game"))
    ch = F.when((F.col("et") == "view") & (F.col("k") < 50), F.lit("")).otherwise(F.col("ch"))
    gc = F.when(F.col("et") == "view", F.lit("")).otherwise(F.col("gc"))
    return e.select("eid", guards.agent_guard(agent, game, ch, gc).alias("ok"), guards.agent_guard(agent, game, ch, gc, digits=True).alias("digits_ok"))


@query("channel_guard", w(EV) + """SELECT eid, et <> 'error' AND k <> 30 AS ok FROM ev""")
def channel_guard(spark, sf):
    d = F.col("doc")
    return parsed(spark, sf, ["channel_platform", "game"]).select("eid", F.coalesce(guards.channel_guard(
        d["channel_platform"], d["channel_platform"]["ad_id"], d["game"]["game_id"]), F.lit(False)).alias("ok"))


@query("sdk_guard", w(EV) + """SELECT eid, et <> 'error' AND k % 9 <> 0 AS ok FROM ev""")
def sdk_guard(spark, sf):
    d = F.col("doc")
    return parsed(spark, sf, ["sdk_platform"]).select("eid", F.coalesce(guards.sdk_guard(
        d["sdk_platform"], d["sdk_platform"]["app_id"]), F.lit(False)).alias("ok"))


@query("old_login_guard", w(EV) + """SELECT eid, et NOT IN ('error', 'view') AND k >= 5 AS ok FROM ev""")
def old_login_guard(spark, sf):
    e = i.ev(spark, sf)
    game = F.when(F.col("et") != "view", F.col("game"))
    ts = F.when(F.col("k") >= 5, F.col("t")).otherwise(F.lit(0))
    return e.select("eid", guards.old_login_guard(F.col("et") != "error", game, F.col("ch"), ts).alias("ok"))


@query("exclude_ids", w(OD) + """SELECT oid, uid FROM od WHERE uid NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
  AND CAST(10080 + oid % 20 AS VARCHAR) NOT IN ('10081', '10082', '10085', '10086', '10087', '10088', '10089', '10099')""")
def exclude_ids(spark, sf):
    """By a literal set, then by a table of ids."""
    o = i.od(spark, sf).where(guards.not_in((10080 + F.col("oid") % 20).cast("string")))
    bad = i.table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("id"))
    return guards.exclude_ids(o.select("oid", "uid"), "uid", Dimension(bad, ["id"], ["id"]))


@query("test_order_semi", w(OD, DIMS) + """SELECT oid, CAST(game AS VARCHAR) AS game_id, server FROM od JOIN test_rule ON test_rule.game_id = CAST(game AS VARCHAR)
  WHERE server IN (CAST(n AS VARCHAR), CAST(n + 100 AS VARCHAR)) OR TRY_CAST(server AS INTEGER) BETWEEN 200 + n AND 260 + n""")
def test_order_semi(spark, sf):
    o = i.od(spark, sf).select("oid", F.col("game").cast("string").alias("game_id"), "server")
    return guards.test_order_rows(o, i.test_rules(spark, sf))


@query("membership_split", w(EV, DIMS) + """SELECT eid, gc, gc IN (SELECT game_channel_id FROM special) AS other FROM ev""")
def membership_split(spark, sf):
    return guards.member(i.ev(spark, sf).select("eid", "gc"), F.col("gc"), i.dims(spark, sf).special, "other")


@query("binlog_order_states", w(OD) + """SELECT oid, tab AS "table", CASE WHEN tab = 'user' THEN 'user' ELSE 'order' END AS kind FROM od
  WHERE (tab = 'order' AND ((pay = 0 AND step = 1) OR (pay = 1 AND step = 2))) OR (tab = 'user' AND oid % 2 = 0)""")
def binlog_order_states(spark, sf):
    rows = own_rows(spark, sf)
    d = F.col("data")
    order = guards.order_states(F.col("table"), int_of(d["pay_status"]), int_of(d["status"]))
    user = guards.user_inserts(F.col("table"), F.col("type"))
    return rows.where(order | user).select("oid", "table", F.when(user, F.lit("user")).otherwise(F.lit("order")).alias("kind"))


@query("olap_filter", w(EV) + """SELECT eid, kind AS event FROM ev WHERE k <> 77 AND (et = 'view' OR (et = 'purchase' AND k < 60 AND k >= 20))""")
def olap_filter(spark, sf):
    e = i.ev(spark, sf)
    pay = F.when(F.col("k") < 60, F.lit("1")).otherwise(F.lit("0"))
    status = F.when(F.col("k") >= 20, F.lit("2")).otherwise(F.lit("1"))
    test = F.when(F.col("k") != 77, F.lit("regular")).otherwise(F.lit("test"))
    return e.where(events.olap_kept(F.col("kind"), test, pay, status)).select("eid", F.col("kind").alias("event"))


@query("new_user_cohort", w(EV) + f"""SELECT {day('t')} AS reg_date, 'im' || uid AS android_imei FROM ev WHERE {day('t')} = {day('sts')} AND gc = '5007'
  UNION ALL SELECT {day('t')}, 'im' || uid FROM ev WHERE FALSE""")
def new_user_cohort(spark, sf):
    from playtrail.functions import times

    e = i.ev(spark, sf).select(times.day(F.col("t")).alias("reg_date"), times.day(F.col("sts")).alias("server_date_day"),
                               F.col("gc").alias("game_channel_id"), F.concat(F.lit("im"), "uid").alias("android_imei"))
    return guards.new_user_cohort(e, "5007", [f"2024-01-{d:02d}" for d in range(1, 32)])


@query("click_company_split", w(EV, CLICK_SQL) + """SELECT eid, CASE company_id WHEN '1' THEN 'ad_click_a' WHEN '5' THEN 'ad_click_b' END AS target
  FROM clicks WHERE reason IS NULL AND cgame LIKE 'U%'""")
def click_company_split(spark, sf):
    good = lines.ad_click_lines(i.click_lines(spark, sf)).where("ok")
    return ck.company_split(good, {"1": "ad_click_a", "5": "ad_click_b"}).select("eid", "target")


@query("metric_nonzero", w(EV) + """SELECT eid, 'm' AS name FROM ev WHERE et = 'error' AND (k % 4 <> 0)""")
def metric_nonzero(spark, sf):
    """0, 0.0 and \"0\" are dropped; 0.5 and 01-like values stay."""
    e = i.ev(spark, sf)
    value = F.expr("CASE k % 4 WHEN 0 THEN element_at(array('0', '0.0', '\"0\"'), cast(1 + k % 3 AS int)) WHEN 1 THEN '0.5' ELSE cast(k AS string) END")
    text = F.concat(F.lit('{"name":"m","value":'), value, F.lit("}"))
    m = e.select("eid", F.lit("x").alias("ip"), text.alias("line"), F.when(F.col("et") == "error", F.lit("")).otherwise(F.lit("s")).alias("data_system"))
    return messages.metric_lines(m).select("eid", F.get_json_object("line", "$.name").alias("name"))


@query("coin_reject", w(EV) + """SELECT eid, k = 3 OR et = 'error' AS bad FROM ev""")
def coin_reject(spark, sf):
    e = i.ev(spark, sf).select("eid", F.when(F.col("k") == 3, F.lit("error")).otherwise(F.lit("x")).alias("a"), F.col("et").alias("b"))
    return e.select("eid", guards.has_error(["a", "b"]).alias("bad"))


@query("distinct_lines", """SELECT DISTINCT regexp_replace(text, '[^a-z ]', '', 'g') AS value FROM conversations UNION SELECT text FROM documents""")
def distinct_lines(spark, sf):
    """Whole texts, exact copies removed."""
    turns = i.table(spark, sf, "conversations").select(F.regexp_replace("text", "[^a-z ]", "").alias("value"))
    docs = i.table(spark, sf, "documents").select(F.col("text").alias("value"))
    return dedupe.distinct_lines(turns.unionByName(docs))


