"""Reads: text, snapshots, offsets, warehouse and state."""

from pyspark.sql import Window, functions as F

from playtrail.operators import dims as dm, geo, state as st
from playtrail.session import fresh_path
from playtrail.sinks import files
from playtrail.sources import tables

from . import inputs as i
from .registry import query
from .sql import EV, REGIONS, w

@query("text_scan", w(EV) + """SELECT eid, et, k FROM ev""")
def text_scan(spark, sf):
    """Lines written as text files, read back by glob."""
    path = fresh_path(spark, "text_scan")
    files.write_text(i.ev(spark, sf).select(F.concat_ws("\t", "eid", "et", "k").alias("l")), "l", path)
    cells = F.split("value", "\t")
    return tables.text_scan(spark, f"{path}/part-*").select(cells[0].cast("bigint").alias("eid"), cells[1].alias("et"), cells[2].cast("int").alias("k"))


@query("dim_snapshot_latest_good", """SELECT 'brand' || (p_partkey // 50) AS name, p_brand AS brand, p_size AS size,
  CAST(CASE WHEN p_partkey // 50 % 3 = 0 THEN 1 ELSE 2 END AS INTEGER) AS version FROM part""")
def dim_snapshot_latest_good(spark, sf):
    """Two copies per snapshot of 50 rows; the newer copy of every third one is broken."""
    item = F.struct(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    packed = i.table(spark, sf, "part").groupBy(F.expr("p_partkey div 50").alias("g")).agg(F.collect_list(item).alias("content"))
    good = packed.select("g", F.concat(F.lit("brand"), "g").alias("name"), F.to_json(F.struct("content")).alias("text"))
    both = good.select("name", "g", "text", F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    broken = (F.col("version") == 2) & (F.col("g") % 3 == 0)
    copies = both.select("name", "version", F.when(broken, F.substring("text", 1, 30)).otherwise(F.col("text")).alias("value"))
    return dm.snapshot_rows(copies, "struct<id:bigint,brand:string,size:int>").select("name", "brand", "size", "version")


@query("ip_ranges_from_upper_bounds", w(REGIONS) + """SELECT coalesce(lag(ip_hi) OVER (ORDER BY ip_hi), -1) + 1 AS ip_lo, ip_hi,
  'N"' || substr(country, 2) AS country, city FROM bounds""")
def ip_ranges_from_upper_bounds(spark, sf):
    return geo.ranges_from_upper_bounds(i.ip_bounds(spark, sf)).select("ip_lo", "ip_hi", "country", "city")


@query("ip_database_scan", w(REGIONS) + """SELECT ip_hi, country, province, 'c' || substr(country, 2) AS city FROM bounds""")
def ip_database_scan(spark, sf):
    """A binary database written from the bounds: index length, jump table, entries of 8 bytes, closing block, texts."""
    path, table = fresh_path(spark, "ip-database"), 1024
    byte = lambda c: F.lpad(F.hex(c.cast("bigint")), 2, "0")
    nation = F.replace("country", F.lit('"'))
    bounds = i.ip_bounds(spark, sf).select("ip_hi", F.concat_ws("\t", nation, "province", F.concat(F.lit("c"), F.substring(nation, 2, 9))).alias("text"))
    before = Window.orderBy("text").rowsBetween(Window.unboundedPreceding, -1)  # a hundred texts
    texts = bounds.select("text").distinct().withColumn("at", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)) + table)
    at = F.col("at")
    rest = F.concat(byte(at % 256), byte(F.floor(at / 256) % 256), byte(F.floor(at / 65536)), byte(F.octet_length("text")))
    entries = bounds.join(texts, "text").select(F.concat(F.lpad(F.hex("ip_hi"), 8, "0"), rest).alias("e"))
    index = entries.agg(F.array_join(F.sort_array(F.collect_list("e")), "").alias("index"))
    body = texts.agg(F.array_join(F.transform(F.sort_array(F.collect_list("text")), lambda t: F.hex(t.cast("binary"))), "").alias("body"))
    blank = F.lit("00" * table)
    head = F.lpad(F.hex(F.length("index") / 2 + 4 + 2 * table), 8, "0")
    whole = F.unhex(F.concat(head, blank, "index", blank, "body"))
    one = index.withColumn("n", F.lit(1)).join(body.withColumn("n", F.lit(1)), "n")
    files.write_text(one.select(whole.cast("string").alias("value")), "value", path)
    return tables.read_ip_database(spark, f"{path}/part-*")


@query("rule_file_scan", """SELECT 'e' || p_partkey % 7 AS event, 'g' || p_size AS grp, 'f' || p_partkey AS field, CAST(p_size % 5 AS VARCHAR) AS rule,
  CAST(row_number() OVER (PARTITION BY p_partkey % 7 ORDER BY 'g' || p_size, p_partkey) - 1 AS INTEGER) AS pos FROM part""")
def rule_file_scan(spark, sf):
    """XML rule files, one an event, written and read back in file order."""
    path = fresh_path(spark, "rules")
    part = i.table(spark, sf, "part").selectExpr("concat('e', p_partkey % 7) AS event", "concat('g', p_size) AS grp", "p_partkey AS no",
                                                 "concat('<f', p_partkey, '> ', p_size % 5, '\n</f', p_partkey, '>') AS xml")
    joined = lambda order, text: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda e: e[text]), "")
    groups = part.groupBy("event", "grp").agg(joined("no", "xml").alias("xml")).withColumn("xml", F.format_string("<%s>%s</%s>", "grp", "xml", "grp"))
    events = groups.groupBy("event").agg(joined("grp", "xml").alias("xml"))
    text = F.format_string("<rules><%s>%s</%s></rules>", "event", "xml", "event").alias("value")
    events.select(text, F.col("event").alias("file")).write.partitionBy("file").text(path)
    return tables.rule_scan(spark, f"{path}/file=*").select("event", "grp", "field", "rule", "pos")


@query("warehouse_exists", """SELECT l_partkey, l_suppkey, count(o_orderkey) AS asked, coalesce(any_value(n), 0) AS stored FROM
  (SELECT l_partkey, l_suppkey, l_orderkey AS o_orderkey FROM lineitem WHERE l_returnflag = 'R') r
  LEFT JOIN (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL) USING (l_partkey, l_suppkey)
  GROUP BY ALL""")
def warehouse_exists(spark, sf):
    li = i.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    keys = ["l_partkey", "l_suppkey"]
    asked = li.where("l_returnflag = 'R'").groupBy(*keys).agg(F.count(F.lit(1)).alias("asked"))
    return tables.warehouse_exists(asked, li.where("l_returnflag = 'A'").select(*keys), keys)


@query("state_read_through", """SELECT CAST(c_custkey AS VARCHAR) AS key,
  CASE WHEN c_nationkey < 10 THEN c_custkey + 100 WHEN c_acctbal > 0 THEN c_custkey + 900 END AS login_ts,
  CASE WHEN c_nationkey < 10 THEN CASE WHEN c_nationkey < 5 THEN c_custkey + 200 END WHEN c_acctbal > 4000 THEN c_custkey + 950 END AS order_ts FROM customer""")
def state_read_through(spark, sf):
    """A hot order value alone is ignored: both values then come from the durable store."""
    c = i.table(spark, sf, "customer").selectExpr("cast(c_custkey AS string) AS key", "c_custkey AS id", "c_nationkey AS n", "c_acctbal AS b")
    hot = c.where("n < 15").selectExpr("key", "CASE WHEN n < 10 THEN id + 100 END AS login_ts",
                                       "CASE WHEN n < 5 OR n >= 10 THEN id + 200 END AS order_ts")
    cold = c.where("b > 0").selectExpr("key", "id + 900 AS login_ts", "CASE WHEN b > 4000 THEN id + 950 END AS order_ts")
    return st.read_through(c.select("key"), hot, cold)
