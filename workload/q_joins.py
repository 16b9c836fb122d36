"""Lookups, cascades, region and refund matching."""

from pyspark.sql import functions as F

from playtrail.operators import geo, guards, lines, resolve, state as st, warehouse as wh
from playtrail.operators.lookup import Dimension, lookup
from playtrail.operators.once import once

from . import inputs as i
from .q_decode import COIN_SQL, coin_json_input
from .registry import query
from .sql import DIMS, EV, OD, REGIONS, daykey, loc, w

EV_GID = "CAST(100000000 + uid % 80 AS VARCHAR)"


@query("lookup_game_channel", w(EV, DIMS) + """SELECT eid, coalesce(c.channel_id, 'error') AS channel_id, c.channel_id IS NOT NULL AS hit FROM ev
  LEFT JOIN channel_of c ON c.game_id = game AND c.game_channel_id = gc""")
def lookup_game_channel(spark, sf):
    return lookup(i.ev(spark, sf).select("eid", "game", "gc"), i.dims(spark, sf).channel_of, [F.col("game"), F.col("gc")],
                  {"channel_id": "channel_id"}, found="hit").select("eid", "channel_id", "hit")


@query("lookup_channel_reverse", w(EV, DIMS) + """SELECT eid, coalesce(c.game_channel_id, 'error') AS game_channel_id FROM ev
  LEFT JOIN game_channel_of c ON c.game_id = game AND c.channel_id = ch""")
def lookup_channel_reverse(spark, sf):
    return lookup(i.ev(spark, sf).select("eid", "game", "ch"), i.dims(spark, sf).game_channel_of, [F.col("game"), F.col("ch")],
                  {"game_channel_id": "game_channel_id"}).select("eid", "game_channel_id")


@query("lookup_by_game_channel", w(EV, DIMS) + """SELECT eid, coalesce(c.channel_id, 'error') AS channel_id, coalesce(c.game_id, 'error') AS game_id FROM ev
  LEFT JOIN by_game_channel c ON c.game_channel_id = gc""")
def lookup_by_game_channel(spark, sf):
    return lookup(i.ev(spark, sf).select("eid", "gc"), i.dims(spark, sf).by_game_channel, [F.col("gc")],
                  {"channel_id": "channel_id", "game_id": "game_id"}).drop("gc")


@query("lookup_os", w(EV, DIMS) + "SELECT eid, coalesce(pf, 'error') AS os_type FROM ev LEFT JOIN os ON os.channel_id = CAST(k AS VARCHAR)")
def lookup_os(spark, sf):
    return lookup(i.ev(spark, sf).select("eid", "k"), i.dims(spark, sf).os, [F.col("k")], {"os_type": "pf"}).drop("k")


@query("lookup_sub_channel", w(EV, DIMS) + """SELECT eid, coalesce(s.channel_id, 'error') AS channel_id, coalesce(o.game_channel_id, 'error') AS game_channel_id FROM ev
  LEFT JOIN sub_channel s ON s.sub_channel_id = sub LEFT JOIN old_channel o ON o.channel_id = sub""")
def lookup_sub_channel(spark, sf):
    d = i.dims(spark, sf).measured("sub_channel", "old_channel")
    one = lookup(i.ev(spark, sf).select("eid", "sub"), d.sub_channel, [F.col("sub")], {"channel_id": "channel_id"})
    return lookup(one, d.old_channel, [F.col("sub")], {"game_channel_id": "game_channel_id"}).drop("sub")


@query("lookup_company", w(EV, DIMS) + "SELECT eid, coalesce(company_id, 'error') AS company_id FROM ev LEFT JOIN company ON game_id = game")
def lookup_company(spark, sf):
    return lookup(i.ev(spark, sf).select("eid", "game"), i.dims(spark, sf).company, [F.col("game")], {"company_id": "company_id"}).drop("game")


@query("lookup_belong_game", w(EV, DIMS) + f"""SELECT eid, coalesce(b.game_channel_id, 'error') AS game_channel_id, coalesce(b.channel_id, 'error') AS channel_id,
  coalesce(b.game_id, 'error') AS game_id FROM ev LEFT JOIN belong_overseas b ON b.belong_game_id = {EV_GID}""")
def lookup_belong_game(spark, sf):
    d = i.dims(spark, sf, platforms=("4", "5"))
    return lookup(i.ev(spark, sf).select("eid", "uid"), d.belong, [100000000 + F.col("uid") % 80],
                  {c: c for c in ("game_channel_id", "channel_id", "game_id")}).drop("uid")


@query("lookup_package", w(EV) + """SELECT eid, CAST(1 + p_partkey % 97 AS VARCHAR) AS game_id FROM ev LEFT JOIN part ON p_partkey = k * 30""")
def lookup_package(spark, sf):
    return lookup(i.ev(spark, sf).select("eid", "k"), i.dims(spark, sf).package_game, [F.concat(F.lit("com.game.p"), F.col("k") * 30)],
                  {"game_id": "game_id"}, default=None).drop("k")


@query("dim_last_wins", w(DIMS) + "SELECT game_id, channel_id, game_channel_id FROM game_channel_of")
def dim_last_wins(spark, sf):
    return i.dims(spark, sf).game_channel_of.df


@query("lookup_large_dimension", """SELECT l_orderkey, l_linenumber, o_custkey, coalesce(o_orderstatus, 'error') AS status FROM lineitem
  LEFT JOIN orders ON o_orderkey = CASE WHEN l_suppkey % 3 = 0 THEN 7 ELSE l_orderkey END""")
def lookup_large_dimension(spark, sf):
    """A third of the rows share one key and the dimension is above its bound: no broadcast of it."""
    o = i.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    dim = Dimension(o, ["o_orderkey"], ["o_custkey", "o_orderstatus"], broadcast_rows=1000, hot_rows=5000)
    li = i.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    key = F.when(F.col("l_suppkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey"))
    out = lookup(li, dim, [key], {"o_custkey": "o_custkey", "status": "o_orderstatus"}, default=None)
    return out.withColumn("status", F.coalesce("status", F.lit("error"))).drop("l_suppkey")


LOGIN_SQL = """lg AS (SELECT *, CASE et WHEN 'view' THEN '' WHEN 'signup' THEN sub ELSE ch END AS c0, CASE et WHEN 'signup' THEN '' WHEN 'click' THEN '0' ELSE gc END AS g0 FROM ev),
lj AS (SELECT lg.*, coalesce(a.channel_id, 'error') AS by_gc, s.channel_id AS sub_ch, coalesce(s.channel_id, lg.c0) AS eff, coalesce(o.game_channel_id, 'error') AS old_gc
  FROM lg LEFT JOIN channel_of a ON a.game_id = game AND a.game_channel_id = g0 LEFT JOIN sub_channel s ON s.sub_channel_id = c0
  LEFT JOIN old_channel o ON o.channel_id = c0),
lk AS (SELECT lj.*, coalesce(r.game_channel_id, 'error') AS rev, coalesce(os.pf, 'error') AS os, coalesce(company_id, 'error') AS company FROM lj
  LEFT JOIN game_channel_of r ON r.game_id = game AND r.channel_id = eff LEFT JOIN os ON os.channel_id = eff LEFT JOIN company ON company.game_id = game),
lr AS (SELECT *, CASE WHEN c0 = '' THEN by_gc WHEN g0 IN ('', '0') THEN eff ELSE c0 END AS channel_id,
  CASE WHEN c0 <> '' AND g0 IN ('', '0') THEN CASE WHEN sub_ch IS NULL THEN rev WHEN old_gc = 'error' THEN rev ELSE old_gc END ELSE g0 END AS game_channel_id,
  CASE WHEN c0 <> '' AND g0 IN ('', '0') THEN os ELSE '' END AS os_type FROM lk)"""


@query("resolve_channel_login", w(EV, DIMS, LOGIN_SQL) + """SELECT eid, channel_id, game_channel_id, os_type, company AS company_id, channel_id NOT IN ('6001', '10081') AS resolved FROM lr""")
def resolve_channel_login(spark, sf):
    e = i.ev(spark, sf)
    c0 = F.when(F.col("et") == "view", F.lit("")).when(F.col("et") == "signup", F.col("sub")).otherwise(F.col("ch"))
    g0 = F.when(F.col("et") == "signup", F.lit("")).when(F.col("et") == "click", F.lit("0")).otherwise(F.col("gc"))
    out = resolve.resolve_login(e.select("eid", "game", c0.alias("c0"), g0.alias("g0")), i.dims(spark, sf), agent=F.lit(1), game_id=F.col("game"),
                                channel_id=F.col("c0"), game_channel_id=F.col("g0"))
    return out.drop("game", "c0", "g0")


ORDER_SQL = """oa AS (SELECT od.*, CAST(game AS VARCHAR) AS g, CAST(col AS VARCHAR) AS c, coalesce(a.channel_id, 'error') AS by_gc, s.channel_id AS sub_ch,
  coalesce(s.channel_id, CAST(col AS VARCHAR)) AS eff, coalesce(o.game_channel_id, 'error') AS old_gc FROM od
  LEFT JOIN channel_of a ON a.game_id = CAST(game AS VARCHAR) AND a.game_channel_id = CAST(col AS VARCHAR)
  LEFT JOIN sub_channel s ON s.sub_channel_id = CAST(col AS VARCHAR) LEFT JOIN old_channel o ON o.channel_id = CAST(col AS VARCHAR)),
ob AS (SELECT oa.*, coalesce(r.game_channel_id, 'error') AS rev, CASE WHEN game >= 63 THEN by_gc ELSE eff END AS channel_id FROM oa
  LEFT JOIN game_channel_of r ON r.game_id = g AND r.channel_id = eff),
oc AS (SELECT ob.*, CASE WHEN game >= 63 THEN c WHEN sub_ch IS NULL THEN rev WHEN old_gc = 'error' THEN rev ELSE old_gc END AS game_channel_id,
  coalesce(os.pf, 'error') AS os_type, coalesce(company.company_id, 'error') AS company_id FROM ob LEFT JOIN os ON os.channel_id = ob.channel_id
  LEFT JOIN company ON company.game_id = g)"""


@query("resolve_channel_order", w(OD, DIMS, ORDER_SQL) + "SELECT oid, channel_id, game_channel_id, os_type, company_id, TRUE AS resolved FROM oc")
def resolve_channel_order(spark, sf):
    o = i.od(spark, sf).select("oid", F.col("game").cast("string").alias("g"), F.col("col").cast("string").alias("c"))
    return resolve.resolve_order(o, i.dims(spark, sf), game_id=F.col("g"), column=F.col("c")).drop("g", "c")


@query("resolve_channel_order_shuffled", w(OD, DIMS, ORDER_SQL) + "SELECT oid, channel_id, game_channel_id, os_type, company_id FROM oc")
def resolve_channel_order_shuffled(spark, sf):
    """The same cascade with every dimension above its bound and hot keys split off."""
    o = i.od(spark, sf).select("oid", F.col("game").cast("string").alias("g"), F.col("col").cast("string").alias("c"))
    d = i.dims(spark, sf, broadcast_rows=1, hot_rows=200)
    return resolve.resolve_order(o, d, game_id=F.col("g"), column=F.col("c")).drop("g", "c", "resolved")


@query("resolve_channel_active", w(EV, DIMS) + """SELECT eid, channel_id, game_channel_id, game_id, coalesce(company.company_id, 'error') AS company_id, resolved FROM (
  SELECT eid, CASE WHEN small THEN eff ELSE coalesce(b.channel_id, 'error') END AS channel_id, CASE WHEN small THEN coalesce(r.game_channel_id, 'error') ELSE given END AS game_channel_id,
   CASE WHEN small THEN game ELSE coalesce(b.game_id, 'error') END AS gid, CASE WHEN small THEN game ELSE coalesce(b.game_id, 'error') END AS game_id, given <> '0' AS resolved FROM (
   SELECT a.*, coalesce(s.channel_id, given) AS eff FROM (SELECT *, CASE et WHEN 'view' THEN ch WHEN 'signup' THEN sub ELSE gc END AS given, uid % 97 + 1 < 63 AS small FROM ev) a
   LEFT JOIN sub_channel s ON s.sub_channel_id = given) x LEFT JOIN game_channel_of r ON r.game_id = game AND r.channel_id = eff
  LEFT JOIN by_game_channel b ON b.game_channel_id = given) y LEFT JOIN company ON company.game_id = y.gid""".replace("SELECT eid, channel_id, game_channel_id, game_id, coalesce", "SELECT eid, channel_id, game_channel_id, y.game_id AS game_id, coalesce"))
def resolve_channel_active(spark, sf):
    given = F.when(F.col("et") == "view", F.col("ch")).when(F.col("et") == "signup", F.col("sub")).otherwise(F.col("gc"))
    e = i.ev(spark, sf).select("eid", F.col("game").alias("g0"), given.alias("given"))
    return resolve.resolve_active(e, i.dims(spark, sf), game_id=F.col("g0"), game_channel_id=F.col("given")).drop("g0", "given")


COIN_RESOLVED = """cj AS (SELECT coin.*, TRY_CAST(gid AS INTEGER) AS num, b.belong_game_id IS NOT NULL OR gid LIKE '%SA%' AS own, coalesce(b.game_id, 'error') AS og, coalesce(b.channel_id, 'error') AS och,
  coalesce(b.game_channel_id, 'error') AS ogc, coalesce(a.channel_id, 'error') AS by_gc, s.channel_id AS sub_ch, coalesce(s.channel_id, chn) AS eff, coalesce(o.game_channel_id, 'error') AS old_gc FROM coin
  LEFT JOIN belong b ON b.belong_game_id = gid LEFT JOIN channel_of a ON a.game_id = gid AND a.game_channel_id = gch LEFT JOIN sub_channel s ON s.sub_channel_id = chn
  LEFT JOIN old_channel o ON o.channel_id = chn),
ck AS (SELECT cj.*, coalesce(r.game_channel_id, 'error') AS rev FROM cj LEFT JOIN game_channel_of r ON r.game_id = gid AND r.channel_id = eff),
cr AS (SELECT *, CASE WHEN own THEN og ELSE gid END AS game_id, CASE WHEN own THEN och WHEN gch = '2050' THEN chn WHEN num < 63 THEN eff WHEN num >= 63 THEN by_gc ELSE chn END AS channel_id,
  CASE WHEN own THEN ogc WHEN gch = '2050' THEN gch WHEN num < 63 THEN CASE WHEN sub_ch IS NULL THEN rev WHEN old_gc = 'error' THEN rev ELSE old_gc END ELSE gch END AS game_channel_id FROM ck)"""


@query("resolve_channel_coin", w(EV, COIN_SQL, DIMS, COIN_RESOLVED) + """SELECT eid, game_id, channel_id, game_channel_id, own OR gch = '2050' OR num IS NOT NULL AS resolved FROM cr WHERE k <> 8
  UNION ALL SELECT eid, game_id, channel_id, game_channel_id, own OR gch = '2050' OR num IS NOT NULL FROM cr WHERE et = 'click' AND k NOT IN (8, 20)""")
def resolve_channel_coin(spark, sf):
    trades = lines.coin_json_lines(coin_json_input(spark, sf)).where("ok").select("eid", "game_id", "channel_id", "game_channel_id")
    return resolve.resolve_coin(trades, i.dims(spark, sf))


@query("resolve_own_channel", w(EV, DIMS) + f"""SELECT eid, coalesce(b.game_id, 'error') AS app_id, coalesce(b.channel_id, 'error') AS channel_id, coalesce(b.game_channel_id, 'error') AS game_channel_id,
  coalesce(company_id, 'error') AS company_id, kind <> 'login' OR b.game_channel_id IN (SELECT game_channel_id FROM special) AS kept,
  kind = 'login' AND coalesce(b.game_channel_id IN (SELECT game_channel_id FROM special), FALSE) AS kept_logins_only
  FROM ev LEFT JOIN belong b ON b.belong_game_id = CASE WHEN k = 1 THEN '100000000' ELSE {EV_GID} END LEFT JOIN company c ON c.game_id = b.game_id""".replace(
    "kind <> 'login' OR b.game_channel_id IN (SELECT game_channel_id FROM special) AS kept,",
    "kind <> 'login' OR coalesce(b.game_channel_id IN (SELECT game_channel_id FROM special), FALSE) AS kept,"))
def resolve_own_channel(spark, sf):
    game = F.when(F.col("k") == 1, F.lit("hw_csgj")).otherwise((100000000 + F.col("uid") % 80).cast("string"))
    d = i.dims(spark, sf)
    out = resolve.resolve_own(i.ev(spark, sf).select("eid", "kind", game.alias("g")), d, game_id=F.col("g"))
    flagged = guards.member(out, F.col("game_channel_id"), d.special, "_in")
    return flagged.select("eid", "app_id", "channel_id", "game_channel_id", "company_id",
                          resolve.own_login_kept(F.col("kind"), F.col("_in")).alias("kept"),
                          resolve.own_login_kept(F.col("kind"), F.col("_in"), "drop").alias("kept_logins_only"))




@query("ip_region", w(EV, REGIONS) + """SELECT eid, coalesce(country, '') AS country, coalesce(province, '') AS province, coalesce(city, '') AS city FROM ev
  ASOF LEFT JOIN bounds b ON ev.ipn <= b.ip_hi""")
def ip_region(spark, sf):
    return geo.add_region(i.ev(spark, sf).select("eid", "ip"), i.regions(spark, sf), F.col("ip")).drop("ip")


@query("ip_region_orders", w(OD, REGIONS) + """SELECT oid, coalesce(country, '') AS country, coalesce(province, '') AS province, coalesce(city, '') AS city FROM od
  ASOF LEFT JOIN bounds b ON od.ipn <= b.ip_hi""")
def ip_region_orders(spark, sf):
    """Blank client address falls back to the other one; the region table is above its bound."""
    o = i.od(spark, sf).select("oid", F.lit("").alias("client_ip"), "ip")
    return geo.add_region(o, i.regions(spark, sf, broadcast_rows=10, hot_rows=300), F.col("client_ip"), F.col("ip")).drop("ip", "client_ip")


def refund_lines(spark, sf):
    """One refund list per order with two entries; only tokens of lineitem-known orders match."""
    o = i.od(spark, sf)
    entry = lambda off: F.struct(F.concat(F.lit("tok-"), F.col("oid") + off).alias("purchaseToken"), (F.col("t") * 1000).alias("purchaseTimeMillis"),
                                 (F.col("t") * 1000 + (F.col("oid") % 50) * 1800000 + off).alias("voidedTimeMillis"))
    doc = i.obj(google_lf="google_lf", package_name=F.concat(F.lit("com.game.p"), F.col("uid") % 40),
                google_data=F.struct(F.array(entry(0), entry(1)).alias("voidedPurchases")))
    line = once(o, {"value": F.concat(F.lit("DATA["), doc, F.lit("]"))}, ["oid"])
    return lines.framed_lines(line, wh.REFUND_SHAPE, "DATA[", frame=False)


def stored_purchases(spark, sf):
    return i.ev(spark, sf).selectExpr("concat('com.game.p', uid % 40) AS pack_name", "concat('tok-', eid) AS purchase_token", "eid", "val AS amount")


REFUND_SQL = f"""rf AS (SELECT 'com.game.p' || (uid % 40) AS pack_name, 'tok-' || (oid + n) AS purchase_token, t * 1000 + (oid % 50) * 1800000 + n AS voided_ms, t * 1000 AS bought FROM od, (VALUES (0), (1)) AS r(n)),
rr AS (SELECT pack_name, purchase_token, {loc('voided_ms // 1000')} AS voided_time, {daykey('voided_ms // 1000')} AS voided_date, (voided_ms - bought) // 3600000 AS time_interval, voided_ms FROM rf),
bought AS (SELECT 'com.game.p' || (uid % 40) AS pack_name, 'tok-' || eid AS purchase_token, eid, val AS amount FROM ev)"""


@query("refund_match", w(EV, OD, REFUND_SQL) + "SELECT rr.* FROM rr SEMI JOIN bought USING (pack_name, purchase_token)")
def refund_match(spark, sf):
    return wh.refund_match(wh.refund_rows(refund_lines(spark, sf)), stored_purchases(spark, sf))


@query("refund_update", w(EV, OD, REFUND_SQL) + """SELECT b.pack_name, b.purchase_token, eid, amount, last.voided_time, last.voided_date, last.time_interval, CASE WHEN last.purchase_token IS NULL THEN 0 ELSE 1 END AS mark
  FROM bought b LEFT JOIN (SELECT pack_name, purchase_token, arg_max(voided_time, voided_ms) AS voided_time, arg_max(voided_date, voided_ms) AS voided_date, arg_max(time_interval, voided_ms) AS time_interval
  FROM rr GROUP BY 1, 2) last USING (pack_name, purchase_token)""")
def refund_update(spark, sf):
    return wh.refund_update(stored_purchases(spark, sf), wh.refund_rows(refund_lines(spark, sf)))


@query("new_device_backfill", w(EV) + """SELECT eid, game, device, t, CASE WHEN coalesce(f.first_ts, 999999999) < t THEN 0 ELSE 1 END AS new_device FROM ev LEFT JOIN
  (SELECT game, device, min(t) + 86400 AS first_ts FROM ev WHERE et = 'view' GROUP BY 1, 2) f USING (game, device)""")
def new_device_backfill(spark, sf):
    e = i.ev(spark, sf)
    state = e.where("et = 'view'").groupBy("game", "device").agg((F.min("t") + 86400).alias("first_ts"))
    return st.backfill_new_device(e.select("eid", "game", "device", "t"), state, ["game", "device"], "t")
