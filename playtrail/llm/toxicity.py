"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words (letters and digits inside punctuation, lower case) and their leading letters; those that go with the
toxic label (chi-square with Yates' correction) make the vocabulary. Examples are bounded labelled rows. Their postings
are cut into blocks of BLOCK examples, each with its largest weight: a block is opened only while the sum of its bounds
can still reach the k-th best cosine, so the neighbours are exact. Votes weigh by squared cosine. A logistic function,
fitted on the examples with each left out of its own neighbours, turns vote, weight and density of the terms into the
score. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import in_fold, pieces, small_batches, words, written
from .learning import fit_logistic, labelled, probability

EXAMPLES = 8000  # labelled rows, at most
TERMS = 4096  # terms of the vocabulary, at most
LEADING = (5, 7)  # letters that make a term of a longer word
CHI_SQUARE, LEAST_DF = 24.0, 3
BLOCK, NEIGHBOURS = 64, 31
CACHE = 200_000  # words a worker remembers
THRESHOLD = 0.7
HELD = (3, 1)  # folds of the key and the one never learnt from
STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def terms_of(word: bytes) -> list[str]:
    plain = word.decode("utf-8", "replace").strip(STRIP).lower()
    return [f"={plain}", *(plain[:n] for n in LEADING if len(plain) > n)] if plain else []


@dataclass(frozen=True)
class Model:
    """vocabulary: term to (number, idf). keys, toxic: the examples. postings: term to blocks of (block, bound, places, weights)."""

    vocabulary: dict
    keys: list
    toxic: list
    postings: list
    logistic: tuple

    def hits(self, text: str | None, cache: dict) -> tuple[dict[int, int], int, int]:
        """Counts of the vocabulary's terms, words that held one, and all words."""
        counts, held, every = Counter(), 0, words(text)
        for word in every:
            found = cache.get(word)
            if found is None:
                if len(cache) >= CACHE:
                    cache.clear()
                found = cache[word] = tuple(self.vocabulary[t][0] for t in terms_of(word) if t in self.vocabulary)
            if found:
                held += 1
                for term in found:
                    counts[term] += 1
        return counts, held, len(every)

    def vector(self, counts: dict[int, int], idf: list[float]) -> tuple[dict[int, float], float]:
        weights = {t: (1 + math.log(n)) * idf[t] for t, n in sorted(counts.items())}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        return {t: w / norm for t, w in weights.items()}, norm

    def nearest(self, query: dict[int, float], k: int = NEIGHBOURS, but: int = -1) -> list[tuple[float, int]]:
        """(cosine, place) of the k examples of largest cosine above 0 other than `but`, ties to the smaller place."""
        bounds: dict[int, float] = {}
        lists: dict[int, list] = {}
        for term, weight in query.items():
            for block, bound, places, weights in self.postings[term]:
                bounds[block] = bounds.get(block, 0.0) + weight * bound
                lists.setdefault(block, []).append((weight, places, weights))
        best: list[tuple[float, int]] = []
        for block in sorted(bounds, key=lambda b: (-bounds[b], b)):
            if len(best) >= k and bounds[block] < best[-1][0] - 1e-9:
                break
            cosine = np.zeros(BLOCK)
            for weight, places, weights in lists[block]:
                cosine[places] += weight * weights
            near = np.flatnonzero(cosine > 0)
            best += [(float(cosine[i]), int(block * BLOCK + i)) for i in near if block * BLOCK + i != but]
            best = sorted(best, key=lambda b: (-b[0], b[1]))[:k]
        return best

    def features(self, near, norm: float, held: int, every: int) -> tuple[float, float, float, float]:
        weight = sum(c * c for c, _ in near)
        vote = sum(c * c * self.toxic[i] for c, i in near) / weight if weight else 0.0
        return vote, math.log1p(norm), math.log1p(100 * held / max(1, every)), math.log1p(held)


def index(vectors: list[dict[int, float]], terms: int) -> list:
    """Per term, in order of blocks: the block, its largest weight, the places inside it and their weights."""
    lists: list[dict[int, tuple[list, list]]] = [{} for _ in range(terms)]
    for place, vector in enumerate(vectors):
        for term, weight in vector.items():
            places, weights = lists[term].setdefault(place // BLOCK, ([], []))
            places.append(place % BLOCK)
            weights.append(weight)
    return [[(b, max(w), np.array(p), np.array(w)) for b, (p, w) in sorted(blocks.items())] for blocks in lists]


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", key: str = "doc_id", text: str = "text",
        held: tuple[int, int] = HELD) -> Model:
    """Vocabulary, index and calibration from a bounded labelled sample without the held-out fold."""
    def spread(batches):
        for batch in batches:
            rows = [(y, sorted({t for w in set(words(v)) for t in terms_of(w)})) for y, v in zip(pieces(batch.column(0)), pieces(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.string()))],
                                             names=["y", "terms"])

    sample = written(labelled(docs, labels, column, ~in_fold(key, *held), EXAMPLES, key, text), "toxic-examples")
    n, n_toxic = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    listed = sample.select("y", "text").mapInArrow(spread, "y int, terms array<string>")
    counts = (listed.select("y", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.count("*").cast("double").alias("df"), F.sum("y").cast("double").alias("a")).where(F.col("df") >= LEAST_DF))
    a, b = F.col("a"), F.col("df") - F.col("a")
    c, d = F.lit(float(n_toxic)) - a, F.lit(float(n - n_toxic)) - b
    excess = F.greatest(F.lit(0.0), a * d - b * c - F.lit(n / 2))
    below = F.col("df") * (c + d) * (a + c) * (b + d)
    chosen = (counts.withColumn("chi", F.when(below > 0, n * excess * excess / below)).where(F.col("chi") >= CHI_SQUARE)
              .orderBy(F.desc("chi"), "term").limit(TERMS).collect())
    vocabulary = {r.term: (i, math.log((1 + n) / (1 + r.df)) + 1) for i, r in enumerate(chosen)}
    idf = [r[1] for r in vocabulary.values()]
    bare = Model(vocabulary, [], [], [], ())

    def gather(batches):
        cache: dict = {}
        for batch in batches:
            rows = [bare.hits(v, cache) for v in pieces(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([list(r[0]) for r in rows], pa.list_(pa.int32())), pa.array([list(r[0].values()) for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32())], names=["key", "y", "terms", "counts", "held", "n"])

    shape = f"key {sample.schema['key'].dataType.simpleString()}, y int, terms array<int>, counts array<int>, held int, n int"
    rows = sorted(sample.select("key", "y", "text").mapInArrow(gather, shape).collect())
    keys, toxic = [r.key for r in rows], [r.y for r in rows]
    vectors = [bare.vector(dict(zip(r.terms, r.counts)), idf) for r in rows]
    model = Model(vocabulary, keys, toxic, index([v for v, _ in vectors], len(vocabulary)), ())
    x = [model.features(model.nearest(v, but=i) if v else [], norm, r.held, r.n) for i, ((v, norm), r) in enumerate(zip(vectors, rows))]
    logistic = fit_logistic(np.array(x, dtype=float).reshape(-1, 4), np.array(toxic, dtype=float))
    return Model(vocabulary, keys, toxic, model.postings, logistic)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", held: tuple[int, int] = HELD,
          threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from `threshold` on), neighbours and terms as evidence; a row per input row.

    neighbours: the three nearest examples with cosine and label; terms: the vocabulary found in the text, by weight.
    Null and empty texts have no evidence and the score of texts without terms; a null key is in no held-out fold.
    Without any labels every score is 0.5. Repeated rows are scored alike; other columns are not read.
    """
    def run(batches):
        model, cache = shared.value, {}
        names, idf = list(model.vocabulary), [r[1] for r in model.vocabulary.values()]
        for batch in batches:
            scores, evidence, found = [], [], []
            for value in pieces(batch.column(1)):
                counts, hits, every = model.hits(value, cache)
                vector, norm = model.vector(counts, idf)
                near = model.nearest(vector) if vector else []
                scores.append(probability(model.logistic, model.features(near, norm, hits, every)))
                evidence.append([{"example": model.keys[i], "cosine": c, "toxic": model.toxic[i]} for c, i in near[:3]])
                found.append([names[t] for t in sorted(vector, key=lambda t: (-vector[t], t))[:5]])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, near_type), pa.array(found, pa.list_(pa.string()))],
                                             names=["doc_id", "score", "neighbours", "terms"])

    kind = docs.schema[key].dataType.simpleString()
    near_type = pa.list_(pa.struct([("example", {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())), ("cosine", pa.float64()), ("toxic", pa.int32())]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = small_batches(docs).select(key, text).mapInArrow(
        run, f"doc_id {kind}, score double, neighbours array<struct<example:{kind},cosine:double,toxic:int>>, terms array<string>")
    return out.select("doc_id", in_fold("doc_id", *held).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "neighbours", "terms")


def keep_clean(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the model does not call toxic, with all their columns."""
    def run(batches):
        model, cache = shared.value, {}
        idf = [r[1] for r in model.vocabulary.values()]
        for batch in batches:
            clean = []
            for value in pieces(batch.column(batch.schema.get_field_index(text))):
                counts, hits, every = model.hits(value, cache)
                vector, norm = model.vector(counts, idf)
                near = model.nearest(vector) if vector else []
                clean.append(probability(model.logistic, model.features(near, norm, hits, every)) < threshold)
            yield batch.filter(pa.array(clean, pa.bool_()))

    shared = docs.sparkSession.sparkContext.broadcast(model)
    return small_batches(docs).mapInArrow(run, docs.schema)
