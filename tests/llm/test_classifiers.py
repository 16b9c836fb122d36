import math
import random
import zlib

import pytest
import zstandard

from playtrail.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def tables(spark):
    return (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))


@pytest.mark.parametrize("module,column,folds,which,least", [(quality, "quality", 4, 2, 0.88), (toxicity, "toxic", 3, 1, 0.93)])
def test_held_out_accuracy(spark, module, column, folds, which, least):
    docs, labels = tables(spark)
    rows = module.score(docs, module.fit(docs, labels)).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == which) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r[column] for r in labels.collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and sum(p == y for p, y in held) / len(held) >= least


@pytest.mark.parametrize("module,column", [(quality, "quality"), (toxicity, "toxic")])
def test_edges(spark, frame, module, column):
    docs = frame([(1, "some words", "a"), (1, "some words", "a"), (2, None, "b"), (3, "", "c"), (None, "no key", "d"), (4, "x" * 200_000, "e")], "doc_id long, text string, score string")
    labels = frame([(1, 1), (1, 0), (None, 1), (2, None), (9, 1), (3, 5)], f"doc_id long, {column} int")
    for learn in (labels, labels.limit(0), frame([(1, 1), (4, 1)], f"doc_id long, {column} int")):
        rows = module.score(docs, module.fit(docs, learn)).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
        assert len({r.score for r in rows if r.doc_id == 1}) == 1 and len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    model = module.fit(docs, labels.limit(0))
    assert {r.score for r in module.score(docs, model).collect()} == {0.5}
    assert module.score(docs.limit(0), model).count() == 0 and module.fit(docs.limit(0), labels) is not None


def test_scores_use_whole_texts(spark, frame):
    docs, labels = tables(spark)
    model = toxicity.fit(docs, labels)
    plain = "the of and in to " * 300
    rows = frame([(1, plain), (2, plain + "idiot scum moron trash loser idiot scum moron trash loser")], "doc_id long, text string")
    assert [r.predicted for r in toxicity.score(rows, model).orderBy("doc_id").collect()] == [0, 1]
    assert [r.doc_id for r in toxicity.keep_clean(rows, model).collect()] == [1]


def test_index_finds_the_nearest(spark):
    rng = random.Random(2)
    vectors = []
    for _ in range(500):
        terms = rng.sample(range(40), rng.randint(0, 6))
        weights = {t: rng.choice([1.0, 2.0, 3.0]) for t in sorted(terms)}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        vectors.append({t: w / norm for t, w in weights.items()})
    model = toxicity.Model({}, list(range(500)), [0] * 500, toxicity.index(vectors, 40), ())
    for place, query in enumerate(vectors[:120]):
        if not query:
            continue
        want = sorted(((sum(w * v.get(t, 0) for t, w in query.items()), i) for i, v in enumerate(vectors) if i != place), key=lambda x: (-round(x[0], 9), x[1]))
        want = [round(c, 9) for c, _ in want if c > 1e-12][:31]
        assert [round(c, 9) for c, _ in model.nearest(query, but=place)] == want


def test_quality_same_as_by_hand(spark):
    """Every piece compressed anew with both dictionaries, the logistic by its formula."""
    docs, labels = tables(spark)
    model = quality.fit(docs, labels)
    rows = {r.doc_id: r for r in quality.score(docs, model).collect()}
    mean, scale, weights = model.logistic
    for doc in docs.limit(300).collect():
        raw = (doc.text or "").encode()
        sizes = [0, 0]
        for at in range(0, len(raw), 2048):
            for side, blob in enumerate((model.good, model.bad)):
                one = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(blob), write_content_size=False, write_checksum=False, write_dict_id=False)
                sizes[side] += len(one.compress(raw[at:at + 2048]))
        x = mean if not raw else [(sizes[1] - sizes[0]) / sum(sizes), math.log(min(sizes) / len(raw))]
        z = weights[2] + sum(w * (v - m) / s for w, v, m, s in zip(weights, x, mean, scale))
        assert rows[doc.doc_id].score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-12)
