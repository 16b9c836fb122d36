import math

import numpy as np
from pyspark.sql import functions as F

from playtrail.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k=5):
    ok = {(i, tuple(np.float32(x) for x in v)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q, a in ok:
        if q % every:
            continue
        a = np.array(a, dtype=float)
        found = {(c, float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))))
                 for c, b in ((c, np.array(b, dtype=float)) for c, b in ok if c != q and len(b) == len(a))}
        out += [(q, r + 1, c, round(s, 12)) for r, (c, s) in enumerate(sorted(found, key=lambda x: (-x[1], x[0]))[:k])]
    return sorted(out)


def rows_of(df):
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in df.collect())


def test_same_as_brute_force(spark, frame):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=24).astype("float32").tolist(), 0) for i in range(600)]
    same = rows[7][1]
    rows += [(i, same, 1) for i in range(600, 700)]  # a large group of equal vectors, queries among them
    rows += [(i, [2 * x for x in same], 1) for i in range(700, 710)]
    df = frame(rows, SCHEMA)
    assert rows_of(nearest(df.where(F.col("vec_id") % 50 == 0), df)) == brute(rows, 50)


def test_edges(spark, frame):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [0.0, 0.0], 0), (2, None, 0), (3, [], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0),
            (6, [inf, 1.0], 0), (7, [1.0, 1.0], 0), (8, [1.0, 1.0], 0), (8, [1.0, 1.0], 0), (50, [1.0, 2.0, 3.0], 0), (None, [1.0, 0.0], 0), (100, [-1.0, 0.0], 0)]
    df = frame(rows, SCHEMA)
    got = rows_of(nearest(df.where(F.col("vec_id") % 50 == 0), df))
    assert got == brute(rows, 50) and [g[:3] for g in got if g[0] == 0] == [(0, 1, 7), (0, 2, 8), (0, 3, 100)]
    assert nearest(df.limit(0), df.limit(0)).count() == 0
    wide = df.selectExpr("*", "1 as id", "2 as dim", "3 as qb")
    assert rows_of(nearest(wide.where("vec_id % 50 = 0"), wide)) == got
