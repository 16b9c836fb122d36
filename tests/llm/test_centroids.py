import hashlib
import math

import numpy as np
from hypothesis import given, settings, strategies as st

from playtrail.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=8, rounds=10):
    """Plain Python integers: no planes, no arrays."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()))
    cents = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        members = [[] for _ in cents]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        cents = [[sum(col) // len(m) for col in zip(*m)] if m else c for m, c in zip(members, cents)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    sums = {n: sum(d for _, m, d in found if m == n) for n in range(len(cents))}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    held = lambda x: x if x < 1 << 63 else None
    total = sum(sums.values())
    return sorted(((i, n, held(d), held(sums[n]), held(total), names[n]) for i, n, d in found), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_same_as_brute_force(spark, frame):
    rng = np.random.default_rng(5)
    mids = rng.normal(size=(5, 64)) * 0.3
    rows = [(i, (mids[i % 5] + rng.normal(size=64) * 0.05).tolist(), 0) for i in range(300)]
    rows += [(i, rows[3][1], 0) for i in range(300, 420)]  # a large group of equal vectors
    assert rows_of(C.cluster(frame(rows, SCHEMA))) == brute(rows)


def test_edges(spark, frame):
    nan, one = float("nan"), [0.5] * 64
    rows = [(0, one, 0), (0, one, 0), (1, None, 0), (2, [], 0), (3, [1.0] * 63, 0), (4, [None] * 64, 0), (5, [nan] + one[1:], 0), (6, [float("inf")] + one[1:], 0),
            (7, [0.0] * 64, 0), (8, [-0.00001] * 64, 0), (None, [-7.25] * 64, 0), (9, [1e6, -1e6] * 32, 0), (10, [3e5] + [0.0] * 63, 0)]
    df = frame(rows, SCHEMA)
    got = rows_of(C.cluster(df))
    assert got == brute(rows) and len(got) == 7
    assert C.cluster(df.limit(0)).count() == 0
    wide = df.selectExpr("*", "1 as id", "2 as planes", "3 as cluster", "4 as distance", "5 as v")
    assert rows_of(C.cluster(wide)) == got
    few = frame(rows[:1] * 3, SCHEMA)  # equal vectors and one key: every start is the same, the first wins
    assert rows_of(C.cluster(few)) == brute(rows[:1] * 3)


def test_sums_beyond_a_long_are_null(spark, frame):
    rows = [(1, [1e30] * 64, 0), (2, [-1e30] * 64, 0), (3, [0.0] * 64, 0)]
    got = rows_of(C.cluster(frame(rows, SCHEMA), k=2, rounds=1))
    assert got == brute(rows, 2, 1) and any(r[2] is None for r in got)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 70).flatmap(lambda b: st.lists(st.lists(st.integers(-2 ** b, 2 ** b), min_size=64, max_size=64), min_size=2, max_size=4)))
def test_popcounts_are_products(vectors):
    planes = [C.planes_of(v) for v in vectors]
    assert [C.components_of(p) for p in planes] == vectors
    row, other = (np.array(p, dtype=np.uint64) for p in planes[:2])
    assert C.product(row[None], other)[0] == sum(a * b for a, b in zip(*vectors[:2]))
    assert C.squares(row[None])[0] == sum(a * a for a in vectors[0])
