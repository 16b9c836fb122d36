import random

import numpy as np
import pytest

from playtrail.llm import jaccard
from playtrail.llm.components import components
from playtrail.llm.jaccard import classes, one_of_each

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sets_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(doc_id, n, component) by comparing all pairs."""
    sets = [sets_of(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holds = {}
    for i, s in enumerate(sets):
        for g in s if rows[i][0] is not None else ():
            holds.setdefault(g, []).append(i)
    pairs = {(i, j) for h in holds.values() for a, i in enumerate(h) for j in h[a + 1:]}
    for i, j in pairs:
        common = len(sets[i] & sets[j])
        if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def copies(seed, groups=40, size=6):
    """Groups of texts with few to many changed words, so that many pairs lie close to the bound."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 6, 9, 20, 60, 150]))] + passage * (g % 3 == 0)
        for c in range(size):
            text = list(base)
            for _ in range(rng.randint(0, 1 + len(text) // 20)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = text[:max(1, int(len(text) * rng.uniform(0.7, 1)))]
            rows.append((g * 100 + c * 7 % 100, " ".join(text), "en", "s", 1))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_pairs(spark, frame, seed):
    rows = copies(seed)
    assert got(classes(frame(rows, SCHEMA).repartition(3))) == brute(rows)


def test_prefix_join_alone_loses_no_link(spark, frame, monkeypatch):
    rows = copies(3, groups=25)
    monkeypatch.setattr(jaccard, "star_pairs", lambda nodes: nodes.select(nodes.node.alias("a"), nodes.node.alias("b")).where("false"))
    assert got(classes(frame(rows, SCHEMA))) == brute(rows)


def test_edges(spark, frame):
    rows = [(1, "a b c", "en", "s", 1), (2, "A  B\tC", "en", "s", 1), (3, None, "en", "s", 1), (4, "", "en", None, 1), (5, " \n ", "en", "s", 1),
            (6, "a b c", "en", "s", 1), (6, "a b c", "en", "s", 1), (7, "one two three four five six", None, "s", 1), (7, "other words in this row now", "en", "s", None),
            (None, "a b c", "en", "s", 1), (8, "x y", "en", "s", 1), (9, "É a", "en", "s", 1), (10, "é a", "en", "s", 1), (11, "long " + "word " * 60_000, "en", "s", 1)]
    df = frame(rows, SCHEMA)
    assert got(classes(df)) == brute(rows)
    stays = one_of_each(df)
    assert stays.columns == df.columns
    assert sorted(str(r.doc_id) for r in stays.collect()) == sorted(["1", "3", "4", "5", "7", "7", "8", "9", "10", "11", "None"])
    assert classes(df.limit(0)).count() == 0 and one_of_each(df.limit(0)).count() == 0
    wide = df.selectExpr("*", "1 as content", "2 as n", "3 as root", "5 as component_id")
    assert got(classes(wide)) == brute(rows) and one_of_each(wide).count() == 11


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(classes(docs)) == brute([tuple(r) for r in docs.collect()])


def test_overlap_bound_never_below_the_overlap():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2 ** 63, rng.integers(1, 900), dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[:rng.integers(0, len(a) + 1)], rng.integers(0, 2 ** 63, rng.integers(1, 400), dtype=np.uint64)]))
        assert jaccard.overlap_bound(jaccard.histogram(a), jaccard.histogram(b)) >= len(np.intersect1d(a, b))


def test_components_of_chains_and_stars(spark, frame):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (7, 300), (300, 7), (400, 399)]
    got = {r.node: r.root for r in components(frame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in [*range(1, 61), 300]) and all(got[i] == 100 for i in range(101, 140)) and got[400] == 399 and 200 not in got
