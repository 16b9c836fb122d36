"""All lookup paths give the same rows."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from playtrail.operators import geo, guards
from playtrail.operators.lookup import Dimension, dimension, lookup, measure


def facts(spark, n=500):
    rnd = random.Random(2)
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rnd.randrange(60)}")) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, k string"), rows


def test_broadcast_and_spread_paths_agree(spark):
    df, rows = facts(spark)
    source = spark.createDataFrame([(f"k{i}", i, i) for i in range(40)] + [("hot", 1, 100), ("hot", 2, 101)], "k string, v int, pos int")
    small = dimension(source, ["k"], ["v"], "pos")
    large = dimension(source, ["k"], ["v"], "pos", broadcast_rows=3, hot_rows=20)
    measure([small, large])
    assert small.small and not large.small
    want = {i: (2 if k == "hot" else int(k[1:]) if k and int(k[1:]) < 40 else None) for i, k in rows}
    for dim in (small, large):
        out = lookup(df, dim, [F.col("k")], {"v": "v"}, default=None, found="hit").collect()
        assert len(out) == len(rows)
        assert {r["id"]: r["v"] for r in out} == want
        assert all(r["hit"] == (want[r["id"]] is not None) for r in out)


def test_large_dimension_is_not_broadcast_whole(spark):
    df, _ = facts(spark)
    source = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    dim = Dimension(source, ["k"], ["id"], broadcast_rows=10, hot_rows=50)
    plan = lookup(df, dim, [F.col("k")], {"v": "id"}, default=None)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1  # the hot keys alone
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        physical = lookup(df, dim, [F.col("k")], {"v": "id"}, default=None)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in physical and "NestedLoop" not in physical and "Cartesian" not in physical
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_of_a_hot_key_are_spread(spark):
    df, rows = facts(spark)
    source = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"), "id").union(spark.createDataFrame([("hot", 7)], "k string, id bigint"))
    dim = Dimension(source, ["k"], ["id"], broadcast_rows=10, hot_rows=50)
    for name, value in (("autoBroadcastJoinThreshold", "-1"), ("adaptive.enabled", "false")):
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        out = lookup(df, dim, [F.col("k")], {"v": "id"}, default=None).select("*", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {r["id"]: r["v"] for r in out} == {i: 7 if k == "hot" else int(k[1:]) if k else None for i, k in rows}
    for some in ("hot", None):
        assert len({r["p"] for r in out if r["k"] == some}) > 1


def test_duplicate_dimension_keys_never_multiply_rows(spark):
    df, rows = facts(spark)
    source = spark.createDataFrame([("hot", i, i) for i in range(5)], "k string, v int, pos int")
    assert lookup(df, dimension(source, ["k"], ["v"], "pos"), [F.col("k")], {"v": "v"}).count() == len(rows)


def region_case(spark, seed):
    rnd = random.Random(seed)
    bounds = sorted({rnd.randrange(2 ** 32) for _ in range(300)} | {2 ** 24 - 1, 2 ** 31})
    df = spark.createDataFrame([(b, f"c{b}", "p", f'"t{b}"') for b in bounds], "ip_hi bigint, country string, province string, city string")
    ips = [rnd.randrange(2 ** 32) for _ in range(400)] + bounds[:20] + [b + 1 for b in bounds[:20]] + [0, 2 ** 32 - 1]
    text = lambda n: ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    return bounds, df, [(i, text(n), n) for i, n in enumerate(ips)]


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 1, "hot_rows": 3}])
def test_regions_equal_bisect(spark, limits):
    bounds, df, ips = region_case(spark, 4)
    regions = geo.region_dimension(geo.ranges_from_upper_bounds(df), **limits)
    assert regions.small == (not limits)
    asked = spark.createDataFrame(ips, "id bigint, ip string, n bigint")
    got = {r["id"]: (r["country"], r["city"]) for r in geo.add_region(asked, regions, F.col("ip")).collect()}
    for i, _, n in ips:
        at = bisect.bisect_left(bounds, n)
        assert got[i] == ((f"c{bounds[at]}", f"t{bounds[at]}") if at < len(bounds) else ("", ""))


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 1, "hot_rows": 3}])
def test_an_address_meets_few_ranges_however_many_there_are(spark, limits):
    """600,000 ranges inside ten /16 blocks and some outside: smaller blocks, the same regions."""
    number = F.when(F.col("id") % 100 == 0, F.col("id") * 7000).otherwise(F.lit(2 ** 24) + F.col("id"))
    bounds = spark.range(600_000).select(number.alias("ip_hi"), F.concat(F.lit("c"), "id").alias("country"), F.lit("p").alias("province"), F.lit("t").alias("city"))
    regions = geo.region_dimension(geo.ranges_from_upper_bounds(bounds), **limits)
    assert regions.bits < geo.BLOCK_BITS and geo.block_bits(15_000) == geo.BLOCK_BITS
    assert geo.blocked_ranges(geo.ranges_from_upper_bounds(bounds), regions.bits).groupBy("block").count().agg(F.max("count")).first()[0] <= 2 ** regions.bits + 2
    rows = sorted((r["ip_hi"], r["country"]) for r in bounds.select("ip_hi", "country").collect())
    known, asked = [r[0] for r in rows], [0, 1, 2 ** 24 - 1, 2 ** 24 + 1, 2 ** 24 + 65536, 2 ** 24 + 599_999, 2 ** 24 + 600_000, 7000 * 599_900, 2 ** 32 - 1]
    text = lambda n: ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    df = spark.createDataFrame([(n, text(n)) for n in asked], "n bigint, ip string")
    got = {r["n"]: r["country"] for r in geo.add_region(df, regions, F.col("ip"), counted=df).collect()}
    for n in asked:
        at = bisect.bisect_left(known, n)
        assert got[n] == (rows[at][1] if at < len(known) else "")


def test_odd_addresses_get_blanks(spark):
    _, df, _ = region_case(spark, 6)
    regions = geo.region_dimension(geo.ranges_from_upper_bounds(df))
    odd = spark.createDataFrame([(None,), ("",), ("1.2.3",), ("1.2.3.4.5",), ("300.1.1.1",), ("a.b.c.d",)], "ip string")
    assert all(r["country"] == "" for r in geo.add_region(odd, regions, F.col("ip")).collect())


def test_region_join_is_an_equi_join(spark):
    _, df, ips = region_case(spark, 4)
    asked = spark.createDataFrame(ips, "id bigint, ip string, n bigint")
    plan = geo.add_region(asked, geo.region_dimension(geo.ranges_from_upper_bounds(df)), F.col("ip"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_test_orders(spark):
    rules = guards.test_server_rules(spark.createDataFrame(
        [("1", '["5","x7",{"start":10,"end":12}]'), ("2", '[{"start":1,"end":1},{"start":3,"end":"4"}]')], "game_id string, test_server string"))
    rows = [(i, g, s) for i, (g, s) in enumerate([("1", "5"), ("1", "x7"), ("1", "11"), ("1", "13"), ("1", "y"), ("2", "4"), ("2", "2"), ("3", "5")])]
    out = guards.flag_test_orders(spark.createDataFrame(rows, "id int, game_id string, server string"), guards.packed_test_rules(rules))
    assert {r["id"] for r in out.where("is_test_order").collect()} == {0, 1, 2, 5}
