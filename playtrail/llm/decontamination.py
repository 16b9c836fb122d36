"""Benchmark decontamination by spaced-seed hashing.

A mask is laid over every position of a text and only the tokens under its ones are hashed, so a changed word under a
zero leaves the hash as it is. Training positions whose hash passes a fixed-size filter of the benchmark's hashes leave
the scan as segments (token codes around neighbouring hits); the hits are joined with the benchmark on the hash. The
passage and the benchmark item are compared token by token along the diagonal of a hit, the best ungapped stretch through
every agreeing token is tried, and one that is too unlike is tried again in two parts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import bit_filter, own_names, passes, pieces, renamed, small_batches, words, written

# The single token is not hashed: it is laid over the diagonals that the others hit. A stretch of five or more agreeing
# tokens, three quarters of it, that avoids all three others does not exist (tested up to 18 tokens).
MASKS = ("1", "1111", "11011", "11101")
HASHED = MASKS[1:]
SPAN = max(map(len, MASKS))
SHORTEST = 5  # tokens of the shortest item that is looked for, and agreeing tokens of the shortest stretch
BITS = 23  # of either filter
AROUND = 64  # tokens kept beyond the outermost hit of a segment
LEAST_TOKENS, LEAST_IDENTITY = 12, 0.75
PENALTY = 2.0  # of a token that differs, against 1 for one that agrees
CACHE = 400_000
AT_ONCE = 1 << 17  # tokens whose hashes are taken together
STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
MIX = np.uint64(0x9E3779B97F4A7C15)


class Codes(dict):
    """Word to the 64-bit hash of its letters inside punctuation, in lower case; 0 when nothing is left."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        plain = word.decode("utf-8", "replace").strip(STRIP).lower()
        code = self[word] = xxhash.xxh3_64_intdigest(plain) | 1 if plain else 0
        return code


def tokens(text: str | None, codes: Codes) -> np.ndarray:
    code = np.array([codes[w] for w in words(text)], dtype=np.uint64)
    return code[code != 0]


def seeds(code: np.ndarray, mask: str, number: int) -> np.ndarray:
    """One hash per position at which the whole mask fits."""
    count = len(code) - len(mask) + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(count, number + 1, dtype=np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            total = total * MIX + code[i:i + count]
            total ^= total >> np.uint64(31)
    return total * MIX


def stretch(same: np.ndarray, at: int) -> tuple[int, int]:
    """(start, end) of the best stretch of a diagonal through position `at`, where `same` says which tokens agree.

    Agreeing tokens count 1, others -PENALTY; on either side the stretch ends where the sum is largest.
    """
    gain = np.where(same, 1.0, -PENALTY)
    after, before = np.cumsum(gain[at:]), np.cumsum(gain[:at][::-1])
    end = at + 1 + int(np.argmax(after))
    start = at - (int(np.argmax(before)) + 1 if len(before) and before.max() > 0 else 0)
    return start, end


def stretches(same: np.ndarray, least: int):
    """(start, tokens, agreeing tokens) of the stretches of a diagonal with `least` tokens, enough of them agreeing.

    All tokens of an agreeing run lead to the same stretch, so its first one is tried; runs inside a stretch that passed
    or is too short lead to parts of it. A stretch that is too unlike may hide a good part: its runs are tried too, and
    both sides of its lowest running sum.
    """
    todo = [(0, len(same))]
    seen = set(todo)
    while todo:
        low, high = todo.pop()
        part, reach = same[low:high], 0
        if int(part.sum()) < SHORTEST or high - low < least:
            continue
        for at in np.flatnonzero(part & ~np.concatenate(([False], part[:-1]))).tolist():
            if at < reach:
                continue
            start, end = stretch(part, at)
            size, equal = end - start, int(part[start:end].sum())
            if size < least or equal < SHORTEST:
                reach = end
            elif equal >= LEAST_IDENTITY * size:
                reach = end
                yield low + start, size, equal
            else:
                cut = start + 1 + int(np.argmin(np.cumsum(np.where(part[start:end], 1.0, -PENALTY))))
                sides = [(low + start, low + cut), (low + cut, low + end)]
                todo += [side for side in sides if side not in seen]
                seen.update(sides)


def overlaps(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
             item_text: str = "text") -> DataFrame:
    """One row per document row and benchmark item that overlap: doc_id, item_id, content (md5 of the text), start (token
    of the document), n_tokens, n_same, identity, n_item. The longest stretch of a pair is shown.

    A stretch counts from LEAST_TOKENS tokens on (or the whole of a shorter item) with LEAST_IDENTITY of them, and at
    least SHORTEST, equal. It begins and ends where its sum is largest, so a shorter item whose outer words are changed
    is not whole. Null, empty and shorter texts and items of fewer than SHORTEST tokens match nothing. Repeated document rows give
    one row each text; equal items each match, items without id each for themselves. Null keys are kept; keys are whole numbers. An empty table gives no rows.
    """
    def read_items(batches):
        codes = Codes()
        for batch in batches:
            rows = [(k, c) for k, t in zip(pieces(batch.column(0)), pieces(batch.column(1))) if len(c := tokens(t, codes)) >= SHORTEST]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].view(np.int64) for r in rows], pa.list_(pa.int64()))], names=["item_id", "item"])

    def mask_items(batches):
        for batch in batches:
            for k, c in zip(pieces(batch.column(0)), pieces(batch.column(1))):
                code, rows = np.array(c, dtype=np.int64).view(np.uint64), []
                for number, mask in enumerate(HASHED):
                    hashes = seeds(code, mask, number)
                    rows += [(k, h, p) for p, h in enumerate(hashes.view(np.int64).tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32()))], names=["number", "hash", "item_at"])

    def hits_of(codes, first, second):
        """Of the texts laid end to end: the position among all and the hash of every hit, and where the texts begin."""
        gap = np.zeros(SPAN, dtype=np.uint64)
        starts = np.cumsum([0, *(len(c) + SPAN for c in codes[:-1])])
        code = np.concatenate([part for c in codes for part in (c, gap)])
        places, found = [], []
        for number, mask in enumerate(HASHED):
            hashes = seeds(code, mask, number)
            at = np.flatnonzero(passes(first, BITS, hashes) & (code[:len(hashes)] != 0) & (code[len(mask) - 1:] != 0))
            at = at[passes(second, BITS, hashes[at] << np.uint64(32))]
            places.append(at)
            found.append(hashes[at])
        at, hashes = np.concatenate(places), np.concatenate(found)
        order = np.argsort(at, kind="stable")
        return at[order], hashes[order].view(np.int64), starts

    def segments_of(keys, texts, codes, first, second):
        at, hashes, starts = hits_of(codes, first, second)
        for n, start in enumerate(starts.tolist()):
            code = codes[n]
            a, b = np.searchsorted(at, (start, start + len(code)))
            if a == b:
                continue
            digest = hashlib.md5(texts[n].encode("utf-8", "surrogatepass")).hexdigest()
            own = at[a:b] - start
            for group in np.split(np.arange(b - a), np.flatnonzero(np.diff(own) > AROUND) + 1):
                begin = max(0, int(own[group[0]]) - AROUND)
                part = code[begin:int(own[group[-1]]) + SPAN + AROUND]
                yield keys[n], digest, begin, part.view(np.int64), own[group] - begin, hashes[a:b][group]

    def find(batches):
        codes, (first, second) = Codes(), shared.value
        kinds = pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())
        for batch in batches:
            rows, given, size = [], [], 0
            for k, t in zip(pieces(batch.column(0)), pieces(batch.column(1))):
                given.append((k, t, tokens(t, codes)))
                size += len(given[-1][2])
                if size >= AT_ONCE:
                    rows += segments_of(*zip(*given), first, second)
                    given, size = [], 0
            if given:
                rows += segments_of(*zip(*given), first, second)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             names=["doc_id", "content", "start", "passage", "at", "hashes"])

    def verify(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                passage, code, shift = np.array(r["passage"], dtype=np.int64), np.array(r["item"], dtype=np.int64), r["shift"]
                low, high = max(0, -shift), min(len(code), len(passage) - shift)
                good = list(stretches(passage[low + shift:high + shift] == code[low:high], min(LEAST_TOKENS, len(code))))
                if good:
                    start, size, same = max(good, key=lambda t: (t[2], t[1]))
                    out.append({"doc_id": r["doc_id"], "item_id": r["item_id"], "number": r["number"], "content": r["content"], "start": r["start"] + shift + low + start,
                                "n_tokens": size, "n_same": same, "identity": same / size, "n_item": len(code)})
            yield pa.RecordBatch.from_pylist(out, schema=result)

    result = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("number", pa.int64()), ("content", pa.string()), ("start", pa.int32()), ("n_tokens", pa.int32()),
                        ("n_same", pa.int32()), ("identity", pa.float64()), ("n_item", pa.int32())])
    items = written(bench.select(F.col(item).cast("long"), item_text).mapInArrow(read_items, "item_id long, item array<bigint>")
                    .withColumn("number", F.monotonically_increasing_id()), "bench-items")
    hashed = written(items.select("number", "item").mapInArrow(mask_items, "number long, hash long, item_at int"), "bench-hashes")
    low = hashed.select(F.call_function("shiftleft", F.col("hash"), F.lit(32)).alias("hash"))
    shared = docs.sparkSession.sparkContext.broadcast((bit_filter(hashed, BITS), bit_filter(low, BITS)))
    segments = written(small_batches(docs).select(F.col(key).cast("long"), text).mapInArrow(
        find, "doc_id long, content string, start int, passage array<bigint>, at array<int>, hashes array<bigint>")
        .withColumn("segment", F.monotonically_increasing_id()), "leak-segments")
    hits = segments.select("segment", F.explode(F.arrays_zip("at", "hashes")).alias("hit")).select("segment", "hit.at", F.col("hit.hashes").alias("hash"))
    tried = (hits.join(hashed, "hash").select("segment", "number", (F.col("at") - F.col("item_at")).alias("shift")).distinct())
    rows = tried.join(segments.drop("at", "hashes"), "segment").join(items, "number")
    checked = rows.select("doc_id", "item_id", "content", "start", "passage", "item", "shift", F.when(F.col("item_id").isNull(), F.col("number")).alias("number")).mapInArrow(
        verify, "doc_id long, item_id long, number long, content string, start int, n_tokens int, n_same int, identity double, n_item int")
    best = F.max_by(F.struct("start", "n_tokens", "n_same", "identity", "n_item"), F.struct("n_same", "n_tokens", -F.col("start")))
    return (checked.groupBy("doc_id", "item_id", "number", "content").agg(best.alias("best"))
            .select("doc_id", "item_id", "content", "best.*"))


def without_leaks(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The rows of docs whose text overlaps no benchmark item, with all their columns, whatever these are called.

    Rows go by their text: equal texts go or stay together, null and empty texts and null keys stay or go like others.
    An empty table of documents stays empty; with an empty benchmark every row stays.
    """
    found = written(overlaps(docs, bench, key, text, **names).select(F.col("content").alias("leak")).distinct(), "leaks")
    rows, called = renamed(docs)
    digest = F.md5(F.coalesce(F.col(called[text.lower()]), F.lit("")).cast("binary"))
    return rows.withColumn("content", digest).join(found, F.col("content") == F.col("leak"), "left_anti").select(*own_names(docs))
