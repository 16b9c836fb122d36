"""Lines with very many rows: bounded in the query, one very wide line here."""

import os

import pytest
from pyspark.sql import functions as F

from playtrail.operators.guards import packed_test_rules
from playtrail.plans import orders
from workload import inputs as i, q_jobs

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


def test_lines_follow_the_rows(spark):
    top = spark.read.parquet(f"{SF}/lineitem.parquet").agg(F.max("l_orderkey")).first()[0]
    rows = [r.n for r in q_jobs.wide_lines(spark, SF).select((F.size(F.split("value", '"order_sn"')) - 1).alias("n")).collect()]
    assert len(rows) >= 3 * (top // q_jobs.LINE_KEYS) > 3 and max(rows) <= 7 * q_jobs.LINE_KEYS
    before = {r.line_no: (r.group, r.before) for r in q_jobs.rows_before(spark, SF).collect()}
    items = q_jobs.wide_items(spark, SF).groupBy("line_no").count().collect()
    for line, (group, n) in before.items():
        assert n == sum(r["count"] for r in items if r.line_no < line and before[r.line_no][0] == group)


def test_one_very_wide_line_keeps_its_order(spark):
    d, n = i.dims(spark, SMALL), 70_000
    data = F.struct(F.col("id").alias("order_sn"), F.lit(70).alias("game_id"), F.lit(5000).alias("channel_id"), (F.col("id") % 50).alias("user_id"), F.lit("x").alias("server"),
                    F.lit(1).alias("pay_status"), F.lit(2).alias("status"), F.lit("").alias("create_ip"), ((F.col("id") + 800000000) * 1000).alias("update_time"))
    row = F.struct(F.lit("agent_order").alias("table"), data.alias("data"))
    line = spark.range(n).agg(F.to_json(F.struct(F.sort_array(F.collect_list(row)).alias("rows"))).alias("value")).withColumn("line_no", F.lit(q_jobs.FAR))
    out = orders.agency_orders(line, d, i.regions(spark, SMALL), d.special, packed_test_rules(i.test_rules(spark, SMALL)), "line_no", wrapped=False)
    got = out.select("row_no", F.col("order_sn").cast("long").alias("sn")).agg(F.count("*"), F.countDistinct("row_no"), F.count_if(F.col("row_no") != F.col("sn")), F.max("row_no")).first()
    assert tuple(got) == (n, n, 0, n - 1)
