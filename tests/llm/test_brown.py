import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from playtrail.llm import brown

SF = "/root/testdata/sf0.001"


def base_scores(rows):
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not out(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return sorted((str(i), out(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows)


def got(df):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect())


def slow_score(model, text):
    """The model's formula token by token, from its counts."""
    own, sizes = model.symbols.own, dict(zip(model.head, model.head_counts))
    total, previous = 0.0, model.symbols.of(b"")
    for w in brown.tokens(text):
        s = model.symbols.of(w)
        total += model.transitions[model.classes[previous], model.classes[s]] + model.emissions[s]
        total += 0.0 if w in own else math.log10(sizes.get(w, 0) + 1)
        previous = s
    return total


@pytest.mark.parametrize("head", [brown.HEAD, 50])
def test_scores_of_given_documents(spark, monkeypatch, head):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    whole = brown.fit(docs)[0]
    monkeypatch.setattr(brown, "HEAD", head)
    monkeypatch.setattr(brown, "OWN", min(head, brown.OWN))
    monkeypatch.setattr(brown, "FLUSH", 1000)
    model, counts = brown.fit(docs)
    result = brown.score(docs, model, counts)
    assert got(result) == base_scores(rows)
    held = [r for r in result.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    if head > 50:
        texts = dict(rows)
        assert all(abs(r.score - slow_score(whole, texts[r.doc_id])) < 1e-6 * r.n_tokens for r in result.collect())


def test_probabilities_sum_to_one(spark):
    model, counts = brown.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    assert np.allclose((10 ** model.transitions).sum(axis=1), 1)
    known = {bytes(r.word): r.c for r in counts.collect()}
    of_class = np.zeros(brown.CLASSES)
    unseen = np.zeros(len(model.symbols.counts))
    for word, c in known.items():
        s = model.symbols.of(word)
        of_class[model.classes[s]] += 10 ** model.emissions[s] * (1 if word in model.symbols.own else c + 1)
    for s in range(len(model.symbols.own), len(unseen)):  # one more place per spelling for words never seen
        of_class[model.classes[s]] += 10 ** model.emissions[s]
    assert (of_class < 1 + 1e-9).all() and (of_class[np.unique(model.classes)] > 0.95).all()


def test_exchange_never_lowers_the_likelihood():
    rng = np.random.default_rng(0)
    groups = rng.integers(0, 4, 60)
    table = rng.poisson(0.2 + 5.0 * (groups[:, None] == groups[None]) * rng.random((60, 60))).astype(float)
    likelihood = lambda g: brown.xlogx(g).sum() - brown.xlogx(g.sum(0)).sum() - brown.xlogx(g.sum(1)).sum()
    whole = lambda c: np.array([[table[np.ix_(c == i, c == j)].sum() for j in range(brown.CLASSES)] for i in range(brown.CLASSES)])
    classes, bigram = brown.exchanged(table)
    assert np.allclose(bigram, whole(classes))
    right = np.bincount(classes, weights=table[5], minlength=brown.CLASSES)
    left = np.bincount(classes, weights=table[:, 5], minlength=brown.CLASSES)
    right[classes[5]] -= table[5, 5]
    left[classes[5]] -= table[5, 5]
    change = brown.gains(right, left, table[5, 5], classes[5], bigram)
    for k in range(0, brown.CLASSES, 7):
        other = classes.copy()
        other[5] = k
        assert abs(likelihood(whole(other)) - likelihood(whole(classes)) - change[k]) < 1e-6


def test_edges(spark, frame):
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "A B"), (7, "x " * 30_000), (9, "held é"), (8, " \n\t")]
    docs = frame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, word int, c string")
    model, counts = brown.fit(docs)
    result = brown.score(docs, model, counts)
    assert got(result) == base_scores(rows) and all(math.isfinite(r.score) and r.perplexity >= 1 for r in result.collect())
    empty = docs.limit(0)
    model, counts = brown.fit(empty)
    assert brown.score(empty, model, counts).count() == 0
    assert all(r.base_score == 0 and r.n_known == 0 and math.isfinite(r.score) for r in brown.score(docs, model, counts).collect())


def counted_bigrams(docs, classes):
    """Class bigrams of the texts outside the held-out fold, token by token."""
    out = np.zeros((brown.CLASSES, brown.CLASSES), dtype=np.int64)
    for i, text in docs:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            previous = b""
            for w in brown.tokens(text):
                out[classes[previous], classes[w]] += 1
                previous = w
    return out


@pytest.mark.parametrize("head, own, bucket", [(brown.HEAD, brown.OWN, brown.BUCKET), (300, 40, 3000), (40, 40, 10**9)])
def test_every_word_is_clustered(spark, monkeypatch, head, own, bucket):
    """Each training word has its own class; the counts of all classes and every score are those of these classes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for name, value in (("HEAD", head), ("OWN", own), ("BUCKET", bucket), ("FLUSH", 50_000)):
        monkeypatch.setattr(brown, name, value)
    model, counts = brown.fit(docs)
    words = {bytes(r.word): (r.c, r["class"]) for r in counts.collect()}
    trained = Counter(w for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for w in brown.tokens(t))
    assert {w: c for w, (c, _) in words.items()} == trained and counts.count() == len(trained)
    classes = {w: k for w, (_, k) in words.items()}
    bigram = counted_bigrams(rows, classes)
    prior = (bigram.sum(axis=0) + 0.5) / (bigram.sum() + 0.5 * brown.CLASSES)
    assert np.allclose(10 ** model.transitions, (bigram + brown.SHRINK * prior) / (bigram.sum(axis=1, keepdims=True) + brown.SHRINK))
    steps = [likelihood for _, likelihood in model.log]
    assert abs(steps[-1] - brown.likelihood(bigram)) < 1e-6 * abs(steps[-1]) and steps[-1] > steps[0] + 0.01 * model.n_tokens
    # words of one spelling beyond OWN no longer share a class
    kinds = Counter((brown.spelling(w), k) for w, k in classes.items() if w not in set(model.head[:own]))
    assert len(kinds) > 2 * len({s for s, _ in kinds})
    in_class = np.bincount([k for _, k in words.values()], weights=[c + 0.5 for c, _ in words.values()], minlength=brown.CLASSES)
    unseen = model.classes[len(model.head):]
    in_class += np.bincount(unseen, minlength=brown.CLASSES) * 0.5
    texts, result = dict(rows), brown.score(docs, model, counts).collect()
    for r in result:
        total, previous = 0.0, classes[b""]
        for w in brown.tokens(texts[r.doc_id]):
            c, k = words.get(w) or (0, model.classes[model.symbols.spelt.get(brown.spelling(w), -1)])
            total += model.transitions[previous, k] + math.log10((c + 0.5) / in_class[k])
            previous = k
        assert abs(r.score - total) < 1e-6 * r.n_tokens
    assert len(result) == len(rows)


def test_words_are_parsed_alike(spark, frame):
    import random

    import pyarrow as pa
    random.seed(3)
    texts = ["".join(random.choice(" \t\n\x0b\x0c\r\x1c\x85\xa0\x00aBCÉß漢é.,!?)'\"") for _ in range(random.randrange(25))) for _ in range(2000)] + [None, ""]
    found, sizes = brown.parsed(pa.chunked_array([texts]))
    assert found.to_pylist() == [w for t in texts for w in brown.words(t)] and sizes.tolist() == [len(brown.words(t)) for t in texts]
    every = sorted(set(found.to_pylist()))
    spelt = frame([(bytearray(w),) for w in every], "word binary").select("word", brown.spelt("word").alias("s")).collect()
    assert all(bytes(r.s) == brown.spelling(bytes(r.word)) for r in spelt)
    keys = brown.keys_of(found[5:]).tolist()
    assert keys == [1 << 62 | xxhash.xxh3_64_intdigest(w) >> 2 for w in found.to_pylist()[5:]]
    assert brown.spellings(found).to_pylist() == [brown.spelling(w) for w in found.to_pylist()]


def test_best_class_is_that_of_the_whole_likelihood():
    """A word moves where the likelihood, counted anew over all bigrams, is largest."""
    rng = np.random.default_rng(1)
    size, words = 40, 12  # words beside 28 others that stay
    table = rng.poisson(0.6, (size, size)) * rng.integers(1, 40, (size, size))
    table[:words, :words] = 0
    classes = rng.integers(0, brown.CLASSES, size)

    def likelihood(c):
        out = np.zeros((brown.CLASSES, brown.CLASSES))
        np.add.at(out, (c[:, None].repeat(size, 1), c[None].repeat(size, 0)), table)
        return brown.likelihood(out), out

    a, b = np.nonzero(table[:words])
    c, d = np.nonzero(table[:, :words])
    times = np.concatenate([table[a, b], table[c, d]])
    around = (np.concatenate([a, d]), np.repeat([0, 1], [len(a), len(c)]), classes[np.concatenate([b, c])], times)
    base, counts = likelihood(classes)
    new = brown.moved(classes[:words], around, counts)
    assert (new != classes[:words]).sum() > 6
    for w in range(words):
        every = []
        for k in range(brown.CLASSES):
            other = classes.copy()
            other[w] = k
            every.append(likelihood(other)[0])
        apart = {k for k in range(brown.CLASSES) if not {k} & set(classes[(table[w] + table[:, w]) > 0])}  # a class before and after the word is taken for two
        best = max(every[k] for k in apart)
        assert every[new[w]] >= best - 1e-6 and every[new[w]] >= base - 1e-6


def test_sums_of_segments():
    rng = np.random.default_rng(2)
    lengths = np.concatenate([rng.integers(1, 6, 50), [15, 16, 17, 40], rng.integers(1, 30, 20)])
    rows, begins = rng.random((lengths.sum(), 5)), np.cumsum(lengths) - lengths
    assert np.allclose(brown.segments(rows, begins, lengths), np.add.reduceat(rows, begins, axis=0))
