"""Quality by compression: a text of a class compresses better with a dictionary built from that class.

Two zstandard dictionaries are built from pieces of good and of bad labelled texts. A text is cut into pieces of PIECE
bytes, each compressed on its own with either dictionary, so that a long text cannot become its own dictionary. The
score is a logistic function of the normalised size difference (bad - good) / (bad + good) and of the log of the better
ratio to the plain size (text that repeats itself shrinks to nothing). It is fitted on labelled rows that built no
dictionary. Texts are compressed whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import in_fold, pieces, small_batches
from .learning import fit_logistic, labelled, probability

PIECE = 2048  # bytes compressed at a time
DICTIONARY = 112_640  # bytes of a dictionary
BUILD_ROWS = 3000  # labelled rows per class whose pieces may build a dictionary
BUILD_PIECES = 6000  # pieces per class, at most 12 MB
FIT_ROWS = 4000  # labelled rows that fit the calibration
THRESHOLD = 0.7
HELD = (4, 2)  # folds of the key and the one never learnt from


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    logistic: tuple

    def compressors(self):
        def with_dictionary(blob):
            extra = {"dict_data": zstandard.ZstdCompressionDict(blob)} if blob else {}
            return zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, write_dict_id=False, **extra)
        return with_dictionary(self.good), with_dictionary(self.bad)


def parts(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]


def features(text: str | None, good, bad) -> tuple[float, float] | None:
    """Normalised size difference and log ratio; none for texts without bytes."""
    cut = parts(text)
    if not cut:
        return None
    a, b = (sum(len(c.compress(p)) for p in cut) for c in (good, bad))
    return (b - a) / (b + a), math.log(min(a, b) / sum(map(len, cut)))


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or, of samples too few to train on, their last bytes as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", key: str = "doc_id", text: str = "text",
        held: tuple[int, int] = HELD) -> Model:
    """Dictionaries and calibration from bounded labelled samples, none of them from the held-out fold."""
    def cut(batches):
        for batch in batches:
            found = [(k, n, p) for k, t in zip(pieces(batch.column(0)), pieces(batch.column(1))) for n, p in enumerate(parts(t))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32()),
                                              pa.array([f[2] for f in found], pa.binary())], names=["key", "n", "piece"])

    learnt = ~in_fold(key, *held)
    builds = F.crc32(F.concat(F.lit("build"), F.col(key).cast("string"))) % 2 == 0
    blobs = []
    for label in (1, 0):
        rows = labelled(docs, labels, column, learnt & builds & (F.col(column) == label), BUILD_ROWS, key, text)
        cuts = rows.select(F.col("key").cast("string"), "text").mapInArrow(cut, "key string, n int, piece binary")
        chosen = cuts.orderBy(F.md5(F.concat_ws(":", "key", "n")), "key", "n", "piece").limit(BUILD_PIECES).collect()
        blobs.append(dictionary([bytes(r.piece) for r in chosen]))
    bare = Model(blobs[0], blobs[1], ())

    def measure(batches):
        good, bad = bare.compressors()
        for batch in batches:
            rows = [(y, f) for y, t in zip(pieces(batch.column(0)), pieces(batch.column(1))) if (f := features(t, good, bad))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[1][i] for r in rows], pa.float64()) for i in (0, 1))],
                                             names=["y", "difference", "ratio"])

    rows = labelled(docs, labels, column, learnt & ~builds, FIT_ROWS, key, text)
    seen = sorted(map(tuple, rows.select("y", "text").mapInArrow(measure, "y int, difference double, ratio double").collect()))
    x = np.array([r[1:] for r in seen], dtype=float).reshape(-1, 2)
    return Model(blobs[0], blobs[1], fit_logistic(x, np.array([r[0] for r in seen], dtype=float)))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", held: tuple[int, int] = HELD,
          threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from `threshold` on), difference and ratio, one row per input row.

    Null and empty texts get the score of an average text and null features; a null key is in no held-out fold. Without
    any labels every score is 0.5. Repeated rows are scored alike; other columns are not read.
    """
    def run(batches):
        good, bad = shared.value.compressors()
        logistic = shared.value.logistic
        for batch in batches:
            found = [features(t, good, bad) for t in pieces(batch.column(1))]
            scores = [probability(logistic, f or logistic[0]) for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), *(pa.array([f and f[i] for f in found], pa.float64()) for i in (0, 1))],
                names=["doc_id", "score", "difference", "ratio"])

    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()
    out = small_batches(docs).select(key, text).mapInArrow(run, f"doc_id {kind}, score double, difference double, ratio double")
    return out.select("doc_id", in_fold("doc_id", *held).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "difference", "ratio")
