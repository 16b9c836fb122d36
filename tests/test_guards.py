"""Rules of test orders for games with few and with very many of them."""

import random

from pyspark.sql import functions as F

from playtrail.operators import guards

RULES = "game_id string, server string, lo int, hi int, ranged boolean"


def flagged(spark, orders, rules, most):
    df = spark.createDataFrame(orders, "no int, game_id string, server string")
    made = guards.packed_test_rules(spark.createDataFrame(rules, RULES), most)
    out = guards.flag_test_orders(df, made)
    assert out.columns == ["no", "game_id", "server", "is_test_order"]
    return {r["no"]: r["is_test_order"] for r in out.collect()}


def test_many_rules_mean_the_same_as_few(spark):
    rnd = random.Random(4)
    edge = [-2 ** 31, -2 ** 31 + 1, -1, 0, 1, 2 ** 31 - 2, 2 ** 31 - 1]
    rules = [("1", None, *sorted(rnd.choice([rnd.randrange(-300, 300), rnd.choice(edge)]) for _ in range(2)), True) for _ in range(6)]
    rules += [("1", f"s{n}", None, None, False) for n in range(5)] + [("2", None, 5, 9, True), ("2", "x", None, None, False), ("1", None, 9, 5, True)]
    orders = [(n, rnd.choice(["1", "2", "3", None]), rnd.choice(["x", "s1", "s9", "", None, "7.5", *map(str, edge), *[str(rnd.randrange(-320, 320)) for _ in range(20)]])) for n in range(400)]
    few, many = (flagged(spark, orders, rules, most) for most in (1000, 5))
    assert few == many and 0 < sum(few.values()) < len(few)


def test_blocks_cover_a_range_exactly(spark):
    rnd = random.Random(2)
    pairs = [tuple(sorted(rnd.randrange(-70, 70) for _ in range(2))) for _ in range(60)] + [(-2 ** 31, 2 ** 31 - 1), (5, 5)]
    df = spark.createDataFrame([(n, *p) for n, p in enumerate(pairs)], "n int, lo int, hi int")
    got = {}
    for r in df.select("n", F.inline(guards.range_blocks(F.col("lo"), F.col("hi")))).collect():
        got.setdefault(r["n"], []).append((r["level"], r["block"]))
    for n, (lo, hi) in enumerate(pairs):
        spans = sorted(((b << v) - 2 ** 31, ((b + 1) << v) - 2 ** 31) for v, b in got[n])
        assert spans[0][0] == lo and spans[-1][1] == hi + 1 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and len(spans) <= 64


def test_a_game_with_very_many_rules(spark):
    n = 200_000
    rules = spark.range(n).select(F.lit("g").alias("game_id"), F.lit(None).cast("string").alias("server"), (F.col("id") * 10).cast("int").alias("lo"),
                                  (F.col("id") * 10 + 3).cast("int").alias("hi"), F.lit(True).alias("ranged"))
    orders = spark.range(0, 10 * n, 37).select(F.col("id").alias("no"), F.lit("g").alias("game_id"), F.col("id").cast("string").alias("server"))
    out = guards.flag_test_orders(orders, guards.packed_test_rules(rules))
    assert out.where(F.col("is_test_order") != (F.col("no") % 10 <= 3)).count() == 0 and out.count() == orders.count()
