"""Scalar functions and single-record projections."""

from pyspark.sql import functions as F

from playtrail import schemas
from playtrail.functions import codes, coerce as co, hashing as hs, times
from playtrail.operators import events, lines, resolve
from playtrail.operators.lookup import Dimension
from playtrail.operators.once import once

from . import inputs as i
from .registry import query
from .sql import DIMS, EV, OD, day, daykey, loc, w


def variants(spark, sf):
    """One field whose type changes with the event type, parsed as VARIANT."""
    text = F.expr("""CASE et WHEN 'view' THEN concat('{"g":{"x":', k, '}}') WHEN 'click' THEN concat('{"g":{"x":"', k, '"}}')
      WHEN 'purchase' THEN concat('{"g":{"x":', k, '.5}}') WHEN 'signup' THEN '{"g":{"x":true}}' ELSE '{"g":{"y":1}}' END""")
    return once(i.ev(spark, sf), {"doc": F.try_parse_json(text)}, ["eid"])


@query("coerce_scalars", w(EV) + """SELECT eid, CASE WHEN et IN ('view', 'click') THEN CAST(k AS VARCHAR) WHEN et = 'purchase' THEN k || '.5' ELSE '' END AS s,
  CASE WHEN et IN ('view', 'click', 'purchase') THEN k ELSE -1 END AS i,
  CASE WHEN et IN ('view', 'click', 'purchase') THEN k ELSE 0 END::BIGINT AS l,
  CASE WHEN et IN ('view', 'click') THEN k WHEN et = 'purchase' THEN k + 0.5 ELSE 0 END::DOUBLE AS d,
  CASE WHEN et IN ('view', 'click', 'purchase') THEN CAST(k AS VARCHAR) ELSE '0' END AS int_text,
  CASE WHEN et IN ('view', 'click') THEN k || '.0' WHEN et = 'purchase' THEN k || '.5' ELSE '0.0' END AS double_text,
  et = 'signup' AS b, '' AS missing_group FROM ev""")
def coerce_scalars(spark, sf):
    v = variants(spark, sf)
    f = co.field(F.col("doc"), "g", "x")
    return v.select("eid", co.as_string(f).alias("s"), co.as_int(f).alias("i"), co.as_long(f).alias("l"),
                    co.as_double(f).alias("d"), co.as_int_string(f).alias("int_text"),
                    co.as_double_string(f).alias("double_text"), co.as_boolean(f).alias("b"),
                    co.as_string(co.field(F.col("doc"), "none", "x")).alias("missing_group"))


@query("coerce_epoch", w(EV) + """SELECT eid, CASE et WHEN 'error' THEN 0 ELSE t END AS ts FROM ev""")
def coerce_epoch(spark, sf):
    e = i.ev(spark, sf)
    text = (F.when(F.col("et") == "view", F.to_json(F.struct(F.col("t").alias("x"))))
            .when(F.col("et") == "click", F.to_json(F.struct((F.col("t") * 1000 + 7).alias("x"))))
            .when(F.col("et") == "purchase", F.when(F.col("k") < 50, F.to_json(F.struct(F.col("t").cast("string").alias("x"))))
                  .otherwise(F.to_json(F.struct((F.col("t") * 1000).cast("string").alias("x")))))
            .when(F.col("et") == "signup", F.to_json(F.struct(i.stamp().alias("x")))).otherwise(F.lit('{"x":""}')))
    doc = once(e, {"doc": F.try_parse_json(text)}, ["eid"])
    return doc.select("eid", co.as_epoch(co.field(F.col("doc"), "x")).alias("ts"))


@query("epoch_parts", w(EV) + f"""SELECT eid, {loc('sts')} AS full_text, {day('sts')} AS day, {loc('sts', '%H')} AS hour, {loc('sts', '%M')} AS minute,
  {daykey('sts')} AS day_key, sts AS back, strftime(make_timestamp(sts * 1000000), '%Y-%m-%d %H:%M') AS utc_minute FROM ev""")
def epoch_parts(spark, sf):
    s = F.col("sts")
    e = i.ev(spark, sf).select("eid", "sts", times.render(s).alias("full_text"))
    return e.select("eid", "full_text", times.day(s).alias("day"), times.hour(s).alias("hour"), times.minute(s).alias("minute"),
                    times.day_key(s).alias("day_key"), times.parse(F.col("full_text")).alias("back"),
                    times.render(s, "yyyy-MM-dd HH:mm", "UTC").alias("utc_minute"))


@query("md5_forms", """SELECT o_orderkey, upper(md5(CAST(o_orderkey AS VARCHAR))) AS up, md5(CAST(o_orderkey AS VARCHAR)) AS low,
  to_base64(from_hex(md5(CAST(o_orderkey AS VARCHAR)))) AS b64 FROM orders""")
def md5_forms(spark, sf):
    x = F.col("o_orderkey").cast("string")
    return i.table(spark, sf, "orders").select("o_orderkey", hs.md5_upper(x).alias("up"), hs.md5_lower(x).alias("low"),
                                               hs.md5_base64(x).alias("b64"))


@query("row_identity", """SELECT o_orderkey, upper(md5('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}')) AS id
  FROM orders""")
def row_identity(spark, sf):
    return i.table(spark, sf, "orders").select("o_orderkey", hs.row_identity(["o_orderstatus", "o_orderkey", "o_custkey"]).alias("id"))


@query("is_number", """SELECT doc_id, regexp_full_match(text, '[0-9]*') AS whole, regexp_full_match(source, '[0-9]*') AS src,
  regexp_full_match(CAST(n_chars AS VARCHAR), '[0-9]*') AS num FROM documents""")
def is_number(spark, sf):
    return i.table(spark, sf, "documents").select("doc_id", co.is_number(F.col("text")).alias("whole"),
                                                  co.is_number(F.col("source")).alias("src"),
                                                  co.is_number(F.col("n_chars").cast("string")).alias("num"))


def label_sql(col, table):
    return f"CASE CAST({col} AS VARCHAR) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE CAST({col} AS VARCHAR) END"


# the expected labels are written out here on their own, not taken from the library
STEP = {"1": "create_order", "2": "paid_success", "4": "notify_cp_success"}
# Payment type codes and their labels, code by code.
DOMESTIC = {"1": "alipay", "5": "yeebao", "6": "weichat_pay", "7": "apple_pay", "8": "iapppay", "9": "alipay", "10": "alipay",
            "12": "weichat_pay", "13": "weichat_pay", "14": "alipay", "15": "weichat_pay", "17": "weichat_pay", "18": "weichat_pay",
            "19": "weichat_pay", "20": "unionpay", "21": "weichat_pay", "22": "weichat_pay"}
OVERSEAS = {"1": "google_pay", "2": "mycard", "3": "visa_global", "4": "apple_pay", "5": "mol", "6": "huawei", "7": "onestore"}


@query("code_labels", w(OD) + f"""SELECT oid, {label_sql('step', STEP)} AS step_label, CASE pay WHEN 0 THEN 'failure' ELSE 'success' END AS pay_label,
  {label_sql('oid % 24', DOMESTIC)} AS domestic, {label_sql('oid % 24', OVERSEAS)} AS overseas,
  CASE oid % 3 WHEN 1 THEN 'male' WHEN 2 THEN 'female' ELSE '0' END AS gender FROM od""")
def code_labels(spark, sf):
    kind = F.col("oid") % 24
    return i.od(spark, sf).select("oid", codes.label(F.col("step"), codes.ORDER_STEP).alias("step_label"),
                                  codes.label(F.col("pay"), codes.PAY_STATUS).alias("pay_label"),
                                  codes.label(kind, codes.PAY_TYPE_DOMESTIC).alias("domestic"),
                                  codes.label(kind, codes.PAY_TYPE_OVERSEAS).alias("overseas"),
                                  codes.label(F.col("oid") % 3, codes.GENDER).alias("gender"))


@query("os_label", """SELECT o_orderkey, CASE WHEN o_orderkey % 9 IN (0, 4) THEN 'android' WHEN o_orderkey % 9 > 6 THEN CAST(o_orderkey % 9 AS VARCHAR) ELSE 'ios' END AS os_type FROM orders""")
def os_label(spark, sf):
    return i.table(spark, sf, "orders").select("o_orderkey", codes.label(F.col("o_orderkey") % 9, codes.OS_BY_PLATFORM).alias("os_type"))


@query("game_alias", """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '100000000' WHEN 1 THEN '100000021' WHEN 2 THEN '100000029' ELSE 'own' || p_partkey END AS game_id,
  CASE p_partkey % 2 WHEN 0 THEN 'G' || p_brand ELSE 'own' || p_partkey END AS by_table FROM part""")
def game_alias(spark, sf):
    p = i.table(spark, sf, "part")
    name = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'hw_csgj' WHEN 1 THEN 'hw_XJZZ' WHEN 2 THEN 'hw_hw_tw_ios_xjzz' ELSE concat('own', p_partkey) END")
    base = p.select("p_partkey", resolve.game_alias(name).alias("game_id"), F.concat(F.lit("own"), "p_partkey").alias("by_table"))
    table = p.where("p_partkey % 2 = 0").select(F.concat(F.lit("own"), "p_partkey").alias("alias"), F.concat(F.lit("G"), "p_brand").alias("game_id"))
    out = resolve.alias_lookup(base.withColumnRenamed("game_id", "_g"), "by_table", Dimension(table, ["alias"], ["game_id"]))
    return out.withColumnRenamed("_g", "game_id").select("p_partkey", "game_id", "by_table")


@query("game_app_swap", w(EV) + """SELECT eid, gc AS game_id, CAST(100000000 + uid % 80 AS VARCHAR) AS app_id, '1.2' AS game_ver, 'n' AS game_name, 'c' AS company_id,
  uid % 80 <> 11 AS ok FROM ev""")
def game_app_swap(spark, sf):
    game = F.struct((100000000 + F.col("uid") % 80).cast("string").alias("game_id"), F.col("gc").alias("app_id"),
                    F.lit("n").alias("game_name"), F.lit("1.2").alias("game_ver"), F.lit("c").alias("company_id"), F.lit("z").alias("app_key"))
    base = i.ev(spark, sf).select("eid", game.alias("game"))
    swapped, ok = resolve.game_app_swap(F.col("game"))
    return base.select("eid", swapped.alias("g"), ok.alias("ok")).select("eid", "ok", "g.*")


@query("fx_convert", w(OD, DIMS) + """SELECT oid, coalesce(cny, 1.0) * money AS cny_amount, coalesce(usd, 1.0) * money AS usd_amount
  FROM od LEFT JOIN rate ON cur2 = currency""".replace("cur2", "(CASE WHEN oid % 10 = 0 THEN 'XX' ELSE cur END)"))
def fx_convert(spark, sf):
    cur = F.when(F.col("oid") % 10 == 0, F.lit("XX")).otherwise(F.col("cur"))
    out = resolve.fx_convert(i.od(spark, sf), i.dims(spark, sf), cur, F.col("money"))
    return out.select("oid", "cny_amount", "usd_amount")


@query("date_fields_to_ts", w(OD) + f"""SELECT oid, CASE WHEN pay = 1 THEN {loc('t')} ELSE {day('t')} || ' 00:00:00' END AS pay_time, {loc('t')} AS back FROM od""")
def date_fields_to_ts(spark, sf):
    o = i.od(spark, sf).select("oid", F.when(F.col("pay") == 1, times.render(F.col("t"))).otherwise(times.day(F.col("t"))).alias("pay_time"),
                               times.local_ntz(F.col("t")).alias("back"))
    return events.dates_to_text(events.texts_to_time(o, ["pay_time"]))


@query("topic_source", """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'overseas' WHEN l_linestatus = 'O' THEN 'agent' ELSE 'Misc' || l_returnflag END AS source
  FROM lineitem""")
def topic_source(spark, sf):
    li = i.table(spark, sf, "lineitem")
    topic = F.when(F.col("l_returnflag") == "R", F.lit("myOverseasAgent")).when(F.col("l_linestatus") == "O", F.lit("theAGENTLogin")) \
        .otherwise(F.concat(F.lit("Misc"), "l_returnflag"))
    rules = [(("overseas", "abroad"), "overseas"), (("agent",), "agent")]
    return li.select("l_orderkey", "l_linenumber", codes.topic_source(topic, rules).alias("source"))


@query("cast_columns", """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey AS INTEGER) END AS id, o_totalprice AS money,
  CAST(o_custkey AS INTEGER) AS server FROM orders""")
def cast_columns(spark, sf):
    o = i.table(spark, sf, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE cast(o_orderkey AS string) END").alias("id"),
                                            F.col("o_totalprice").cast("string").alias("money"), F.col("o_custkey").cast("string").alias("server"))
    return events.cast_columns(o, {"id": "int", "money": "double", "server": "int"})


@query("flatten_dashed", w(EV) + """SELECT eid, CAST(uid AS VARCHAR) AS "user-user_id", CASE WHEN k <> 50 THEN 'g' END AS "game-game_name", gc AS "agent-game_channel_id",
  kind AS event, CAST(sts AS VARCHAR) AS server_ts FROM ev WHERE et <> 'error'""")
def flatten_dashed(spark, sf):
    d = lines.framed_lines(i.event_lines(spark, sf), schemas.event_schema(["user", "game", "agent"])).where("ok")
    flat = events.flatten_dashed(d.select("eid", "doc.*"))
    return flat.select("eid", "user-user_id", "game-game_name", "agent-game_channel_id", "event", "server_ts")


@query("flatten_leaf", w(EV) + """SELECT eid, CAST(eid AS VARCHAR) AS name, kind AS id FROM ev""")
def flatten_leaf(spark, sf):
    """Two groups share a leaf name: the later one stays."""
    nested = i.ev(spark, sf).select("eid", F.struct(F.col("uid").alias("id"), F.lit("first").alias("name")).alias("a"),
                                    F.struct(F.col("eid").cast("string").alias("name")).alias("b"), F.col("kind").alias("id"))
    return events.flatten_leaf(nested)

