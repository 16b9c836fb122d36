"""Language-model scoring with a class-based bigram model.

Every training word has a class of its own, found by exchange clustering of the bigrams of all training texts, and

    P(word | previous) = P(class | previous class) * P(word | class),

with class transitions shrunk towards class frequencies and P(word | class) smoothed by half a token a word. A word
never seen takes the class of its spelling (last letters and closing punctuation) and that half a token.

1. The driver clusters the OWN most frequent words and the SPELLINGS most frequent spellings of all others, symbol by
   symbol, from a table of their bigrams whose size is fixed. That gives the classes of the frequent words and spellings.
2. Every other word starts in the class of its spelling and is dealt to a bucket with all its neighbours. Tasks try it in
   every class and move it to the one that raises the likelihood most, one part of the buckets after the other, so that
   words that follow each other seldom move at once. Rounds go on until the words that move hold at most STILL of the
   tokens, or more than SETTLED of those of the round before.
3. The classes at the end are counted over all bigrams.

What the driver and each task hold is bounded by parameters: the HEAD most frequent words with counts and classes, the
table of symbols, and a bucket. Words beyond HEAD are known by 62 bits of a hash while they are clustered; their classes
are told to the buckets of their neighbours as messages, and reach the texts, with their counts, through a join on the word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from playtrail.session import fresh_path

from .common import in_fold, small_batches, words, written

HEAD = 131_072  # words whose counts and classes every task holds
OWN, SPELLINGS = 2048, 1024  # words and spellings that the driver clusters
CLASSES = 64
PARTS = 4  # words of one part of the buckets move at once
STILL, SETTLED = 0.01, 0.9  # words that hold this share of the tokens, or of those that moved the round before, may still move in the last round
SHRINK = 4.0  # tokens of prior for a class's transitions
HELD = (7, 2)  # folds of the key and the one never learnt from
FLUSH = 2_000_000  # bytes of text a task takes apart at once
BUCKET = 1_000_000  # training tokens for which there is a bucket of words
END = b""  # the token that closes a text, and precedes its first word
CLOSING = "".join(sorted(".,!?;:)\"'"))
TAIL = 1 << 62  # keys of words beyond HEAD begin here; smaller ones are places in the head
PLACE = 18  # bits of a place in the head
FAR = (1 << PLACE) - 1  # stands for any word beyond the head
MOST = (1 << 32 - PLACE) - 1  # how often a neighbour comes, in the bits a place leaves


def spelling(word: bytes) -> bytes:
    """Last three letters and the punctuation that closes the word."""
    text = word.decode("utf-8", "replace")
    bare = text.rstrip(CLOSING)
    return (bare[-3:] + text[len(bare):][:1]).encode()


def spellings(found: pa.Array) -> pa.Array:
    """`spelling` of an array of words."""
    if not len(found):
        return found
    text = pa.concat_arrays([found]).cast(pa.large_string())
    bare = pc.utf8_rtrim(text, CLOSING)
    ends, letters = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1], np.frombuffer(text.buffers()[2] or b"", np.uint8)
    closed = ends[:-1] + pc.binary_length(bare).to_numpy()
    mark = np.full(len(text), len(CLOSING))
    inside = closed < ends[1:]
    mark[inside] = np.searchsorted(np.frombuffer(CLOSING.encode(), np.uint8), letters[closed[inside]])
    marks = pa.array([*CLOSING, ""], pa.large_string()).take(pa.array(mark))
    return pc.binary_join_element_wise(pc.utf8_slice_codeunits(bare, -3), marks, pa.scalar("", pa.large_string())).cast(pa.large_binary())


def spelt(word: str) -> Column:
    """`spelling` of a column of words."""
    text = F.col(word).cast("string")
    bare = F.rtrim(text, F.lit(CLOSING))
    return F.concat(F.right(bare, F.lit(3)), F.substr(text, F.length(bare) + 1, F.lit(1))).cast("binary")


def tokens(text: str | None) -> list[bytes]:
    every = words(text)
    every.append(END)
    return every


def portions(batches):
    """The rows in portions of about FLUSH bytes of their last column; no row is cut."""
    held, size = [], 0
    for batch in batches:
        ends, start = np.cumsum(pc.fill_null(pc.binary_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + FLUSH - size, "right")))
            held.append(batch.slice(start, stop - start))
            size, start = size + ends[stop - 1] - before, stop
            if size >= FLUSH or start < len(ends):
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def parsed(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, as `words` finds them, and how many each text has."""
    texts = pc.ascii_lower(pc.fill_null(pa.concat_arrays(texts.chunks).cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(texts)
    found, sizes = lists.flatten().cast(pa.large_binary()), np.diff(lists.offsets.to_numpy()).astype(np.int64)
    full = pc.binary_length(found).to_numpy(zero_copy_only=False) > 0  # white space at the ends leaves empty words
    if not full.all():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[full], minlength=len(sizes))
        found = found.filter(pa.array(full))
    return found, sizes


def places(found: pa.Array, head: pa.Array) -> np.ndarray:
    """Places of words in the head, -1 beyond it."""
    return pc.fill_null(pc.index_in(found, value_set=head), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def between_ends(values: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """One after the other the words of all texts, with an end before the first text and after each."""
    out, inner = np.full(len(values) + len(sizes) + 1, end, dtype=np.int64), np.ones(len(values) + len(sizes) + 1, dtype=bool)
    inner[0] = False
    inner[np.cumsum(sizes + 1)] = False
    out[inner] = values
    return out


def keys_of(found: pa.Array) -> np.ndarray:
    """Keys of words (large binary) beyond the head."""
    if not len(found):
        return np.empty(0, np.int64)
    ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset:found.offset + len(found) + 1].tolist()
    letters = (found.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    hashes = np.array([xxhash.xxh3_64_intdigest(letters[a:b]) for a, b in zip(ends, ends[1:])], dtype=np.uint64)
    return (hashes >> np.uint64(2)).astype(np.int64) | TAIL


def packed(array) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def unpacked(column, kind=np.int64) -> np.ndarray:
    """The numbers of all rows of a binary column."""
    return np.concatenate([np.empty(0, kind), *(np.frombuffer(b, kind) for b in column.to_pylist() if b)])


def summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and the sums of their n."""
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1)) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, c) over all texts; tasks count what they read before anything is shuffled."""
    def run(batches):
        for rows in portions(batches):
            found, sizes = parsed(rows.column(0))
            counts = found.value_counts()
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([counts.field(0), pa.array([END], pa.large_binary())]).cast(pa.binary()),
                                              pa.concat_arrays([counts.field(1), pa.array([len(sizes)], pa.int64())])], names=["word", "c"])

    counted = small_batches(docs).select(text).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    return written(counted, "word-counts")


@dataclass
class Symbols:
    """Numbers of the symbols: own words first, then spellings, last the symbol of all other words."""

    own: dict
    spelt: dict
    counts: list  # training tokens per symbol

    def of(self, word: bytes) -> int:
        found = self.own.get(word)
        return found if found is not None else self.spelt.get(spelling(word), len(self.own) + len(self.spelt))

    def of_others(self, found: pa.Array) -> np.ndarray:
        """`of` for words that are no own ones."""
        place = places(spellings(found), pa.array(list(self.spelt), pa.large_binary()))
        return np.where(place < 0, len(self.spelt), place) + len(self.own)


def find_symbols(counts: DataFrame, top: list[bytes], top_counts: list[int], tokens_all: int) -> Symbols:
    """What the driver clusters: the most frequent words and the most frequent spellings of all others."""
    own = {w: i for i, w in enumerate(top)}
    rest = counts.join(F.broadcast(counts.sparkSession.createDataFrame([(w,) for w in top], "word binary")), "word", "left_anti")
    found = rest.groupBy(spelt("word").alias("spelling")).agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "spelling").limit(SPELLINGS).collect()
    each = [*top_counts, *(r.c for r in found)]
    return Symbols(own, {bytes(r.spelling): len(top) + i for i, r in enumerate(found)}, [*each, tokens_all - sum(each)])


def xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def gains(right: np.ndarray, left: np.ndarray, own: float, old: int, table: np.ndarray) -> np.ndarray:
    """Change of the class bigram likelihood when a symbol moves from class `old` to each class.

    right, left: its neighbours' counts by class (without itself); own: how often it follows itself.
    """
    base = table.copy()
    base[old] -= right
    base[:, old] -= left
    base[old, old] -= own
    base = np.maximum(base, 0)
    rows, columns = base.sum(axis=1) + left, base.sum(axis=0) + right  # neighbours follow and precede it in any class
    n_right, n_left = right.sum() + own, left.sum() + own
    cells = xlogx(base)
    to_row = (xlogx(base + right[None]) - cells).sum(axis=1)  # its right neighbours in row k
    to_column = (xlogx(base + left[:, None]) - cells).sum(axis=0)
    corner = np.diag(base)
    both = xlogx(corner + right + left + own) + xlogx(corner) - xlogx(corner + right) - xlogx(corner + left)
    sums = xlogx(rows + n_right) - xlogx(rows) + xlogx(columns + n_left) - xlogx(columns)
    total = to_row + to_column + both - sums
    return total - total[old]

def exchanged(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the symbols and the class bigram counts, from a symbol by symbol table of bigram counts.

    Symbols start in turn in the classes, the most frequent first. Round by round each is taken out of its class and put
    where the likelihood is largest, until a round moves none.
    """
    size = len(table)
    order = np.argsort(-table.sum(axis=1), kind="stable")
    classes = np.empty(size, dtype=np.int64)
    classes[order] = np.arange(size) % CLASSES
    after, before = table, table.T

    def by_class(row):
        return np.bincount(classes, weights=row, minlength=CLASSES)

    bigram = np.zeros((CLASSES, CLASSES))
    for s in range(size):
        bigram[classes[s]] += by_class(after[s])
    least, n_moved = max(1e-6, 1e-12 * float(xlogx(table.sum()))), size  # less is within the errors of the sums
    while n_moved:
        n_moved = 0
        for s in order:
            old, own = classes[s], table[s, s]
            right, left = by_class(after[s]), by_class(before[s])
            right[old] -= own
            left[old] -= own
            change = gains(right, left, own, old, bigram)
            new = int(np.argmax(change))
            if change[new] > least:
                for k, sign in ((old, -1), (new, 1)):
                    bigram[k] += sign * right
                    bigram[:, k] += sign * left
                    bigram[k, k] += sign * own
                classes[s] = new
                n_moved += 1
    return classes, bigram

RAW = "bucket int, near binary, words array<binary>, keys binary, far binary, links binary, pairs binary"
WORDS = "bucket int, words array<binary>, keys binary, counts binary, starts binary, nbrs binary, link_owner binary, link_key binary, pairs binary"
STATE = "bucket int, source int, classes binary, near binary, far binary, told binary, tables binary, places binary"


def slices(bucket: np.ndarray, buckets: int, *arrays):
    """The arrays' values by bucket, as a function of the bucket."""
    order = np.argsort(bucket.astype(np.uint16 if buckets < 1 << 16 else np.uint32), kind="stable")
    cuts, arrays = np.searchsorted(bucket[order], np.arange(buckets + 1)), [a[order] for a in arrays]
    return lambda b: [a[cuts[b]:cuts[b + 1]] for a in arrays]


def surroundings(docs: DataFrame, text: str, symbols: Symbols, head: list[bytes], buckets: int) -> DataFrame:
    """One row per bucket and portion of texts: every occurrence of a word beyond OWN with the places before and after.
    A text begins after the end of another.

    near: occurrences of words of the head (place, place before, place after in one number). words, keys: words beyond
    it; far: their occurrences, numbered by these; links: pairs of (its number and side, key of a neighbour beyond the head).
    pairs, in rows of their own: which symbol follows which, and how often.
    """
    own, size = len(symbols.own), len(symbols.counts)

    def run(batches):
        symbols, head, of_head = shared.value
        head, pairs = pa.array(head, pa.large_binary()), np.zeros(size * size, dtype=np.int32)
        for rows in portions(batches):
            found, sizes = parsed(rows.column(0))
            place = places(found, head)
            rare = place < 0
            others = found.filter(pa.array(rare)).dictionary_encode()
            each = of_head[place]
            each[rare] = symbols.of_others(others.dictionary)[others.indices.to_numpy()]
            each = between_ends(each, sizes, 0)
            np.add.at(pairs, each[:-1] * size + each[1:], np.int32(1))
            keys = keys_of(others.dictionary)
            at = np.argsort((keys % buckets).astype(np.uint32), kind="stable")  # words of a bucket side by side
            keys, names = keys[at], others.dictionary.take(pa.array(at)).cast(pa.binary())
            where = np.empty_like(at)
            where[at] = np.arange(len(at))
            place[rare] = TAIL + where[others.indices.to_numpy()]
            stream = between_ends(place, sizes, 0)
            firsts = np.searchsorted(keys % buckets, np.arange(buckets + 1))
            short = np.where(stream < TAIL, stream, FAR)

            def occurrences(i):
                return short[i - 1] << PLACE | short[i + 1]

            i = np.flatnonzero((stream >= own) & (stream < TAIL))
            near = slices(stream[i] % buckets, buckets, stream[i] << 2 * PLACE | occurrences(i))
            i = np.flatnonzero(stream >= TAIL)
            number = stream[i] - TAIL
            home = keys[number] % buckets
            far = slices(home, buckets, (number - firsts[home]) << 2 * PLACE | occurrences(i))
            i = np.flatnonzero((stream[:-1] >= TAIL) & (stream[1:] >= TAIL))
            number, side = np.concatenate([stream[i], stream[i + 1]]) - TAIL, np.repeat([0, 1], len(i))
            other, home = keys[np.concatenate([stream[i + 1], stream[i]]) - TAIL], keys[number] % buckets
            links = slices(home, buckets, np.stack([(number - firsts[home]) * 2 + side, other], axis=1))
            yield dealt([(b, near(b)[0], names.slice(firsts[b], firsts[b + 1] - firsts[b]), keys[firsts[b]:firsts[b + 1]], far(b)[0], links(b)[0], none) for b in range(buckets)])
        cells = np.flatnonzero(pairs)
        found = slices(cells // size % buckets, buckets, cells << 32 | pairs[cells])
        yield dealt([(b, none, pa.array([], pa.binary()), none, none, none, found(b)[0]) for b in range(buckets)])

    def dealt(out):
        out = [o for o in out if len(o[1]) or len(o[2]) or len(o[6])]
        offsets = pa.array(np.cumsum([0, *(len(o[2]) for o in out)]).astype(np.int32))
        names = pa.ListArray.from_arrays(offsets, pa.concat_arrays([o[2] for o in out]) if out else pa.array([], pa.binary()))
        near, keys, far, links, pairs = (pa.array([packed(o[k]) for o in out], pa.binary()) for k in (1, 3, 4, 5, 6))
        return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), near, names, keys, far, links, pairs],
                                          names=["bucket", "near", "words", "keys", "far", "links", "pairs"])

    none = np.empty(0, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((symbols, head, np.array([*map(symbols.of, head), 0], dtype=np.int64)))
    return small_batches(docs).select(text).mapInArrow(run, RAW)


def merged(raw: DataFrame) -> DataFrame:
    """One row per bucket.

    words: those beyond the head. keys, counts: places in the head and keys beyond it, ascending, and their tokens.
    starts, nbrs: for each word the distinct places after it, then before it, with how often (MOST at most, then again). link_owner (number of
    the word and side) and link_key: neighbours beyond the head of words beyond it. pairs: as above.
    """
    def run(rows):
        near = unpacked(rows.column("near"))
        keys = [np.frombuffer(b, np.int64) for b in rows.column("keys").to_pylist()]
        names = pa.concat_arrays([c.flatten() for c in rows.column("words").chunks])
        tail, first, number = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        mids, owner = np.unique(near >> 2 * PLACE, return_inverse=True)
        owner, around, link_owner, link_key, base = [owner], [near & (1 << 2 * PLACE) - 1], [], [], 0
        for k, far, links in zip(keys, rows.column("far").to_pylist(), rows.column("links").to_pylist()):
            of = number[base:base + len(k)] + len(mids)
            far, links, base = np.frombuffer(far, np.int64), np.frombuffer(links, np.int64).reshape(-1, 2), base + len(k)
            owner.append(of[far >> 2 * PLACE])
            around.append(far & (1 << 2 * PLACE) - 1)
            link_owner.append(of[links[:, 0] >> 1] * 2 + (links[:, 0] & 1))
            link_key.append(links[:, 1])
        owner, around = np.concatenate(owner), np.concatenate(around)
        every = np.concatenate([owner << PLACE + 1 | around & FAR, owner << PLACE + 1 | 1 << PLACE | around >> PLACE])
        codes, times = np.unique(every[every & FAR != FAR], return_counts=True)
        again = (times - 1) // MOST
        codes, times = np.concatenate([codes, np.repeat(codes, again)]), np.concatenate([times - again * MOST, np.full(again.sum(), MOST)])
        order = np.argsort(codes, kind="stable")
        codes, times = codes[order], times[order]
        size, pairs = len(mids) + len(tail), unpacked(rows.column("pairs"))
        cells, n = summed(pairs >> 32, pairs & (1 << 32) - 1)
        return pa.Table.from_arrays([
            pa.array([rows.column("bucket")[0].as_py()], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(first)], pa.int32()), names.take(pa.array(first))),
            *(pa.array([packed(a)], pa.binary()) for a in (
                np.concatenate([mids, tail]), np.bincount(owner, minlength=size), np.searchsorted(codes >> PLACE, np.arange(2 * size + 1)).astype(np.int32),
                (codes & FAR | times << PLACE).astype(np.uint32), np.concatenate(link_owner).astype(np.int32), np.concatenate(link_key), np.stack([cells, n], axis=1)))],
            names=["bucket", "words", "keys", "counts", "starts", "nbrs", "link_owner", "link_key", "pairs"])

    path = fresh_path(raw.sparkSession, "word-neighbours")
    raw.groupBy("bucket").applyInArrow(run, WORDS).withColumn("part", F.col("bucket") % PARTS).write.partitionBy("part").parquet(path)
    return raw.sparkSession.read.schema(f"{WORDS}, part int").parquet(path)


def symbol_table(parts: DataFrame, size: int) -> np.ndarray:
    """How often symbol b follows symbol a: (OWN + SPELLINGS + 1) ** 2 cells whatever the input (75 MB)."""
    table = np.zeros(size * size)
    for chunk in parts.select("pairs").toArrow().column(0).chunks:
        for b in chunk:
            pairs = np.frombuffer(b.as_buffer(), np.int64).reshape(-1, 2)
            table[pairs[:, 0]] = pairs[:, 1]
    return table.reshape(size, size)


@dataclass
class Bucket:
    keys: np.ndarray
    counts: np.ndarray
    owner: np.ndarray  # number of the word, for each of its neighbours of the head
    side: np.ndarray  # 0: the neighbour follows, 1: it precedes
    nbrs: np.ndarray
    times: np.ndarray
    link_owner: np.ndarray
    link_key: np.ndarray

    @staticmethod
    def of(rows: pa.Table) -> "Bucket":
        starts, nbrs = unpacked(rows.column("starts"), np.int32), unpacked(rows.column("nbrs"), np.uint32).astype(np.int64)
        seg = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        return Bucket(unpacked(rows.column("keys")), unpacked(rows.column("counts")), seg >> 1, seg & 1, nbrs & FAR, nbrs >> PLACE,
                      unpacked(rows.column("link_owner"), np.int32).astype(np.int64), unpacked(rows.column("link_key")))

    def messages(self, classes: np.ndarray, own: int, buckets: int):
        """Classes of the words beyond the head, for the buckets of their neighbours.

        near: place, class, side and times for words of the head; far, told: key, and class and side, for others.
        """
        i = np.flatnonzero((self.keys[self.owner] >= TAIL) & (self.nbrs >= own))
        what = classes[self.owner[i]] << 1 | 1 - self.side[i]
        near = slices(self.nbrs[i] % buckets, buckets, self.times[i] << 32 | self.nbrs[i] << 8 | what)
        what = (classes[self.link_owner >> 1] << 1 | 1 - (self.link_owner & 1)).astype(np.uint8)
        far = slices(self.link_key % buckets, buckets, self.link_key, what)
        return lambda b: (near(b)[0], *far(b))

    def neighbours(self, state: pa.Table, head_classes: np.ndarray, own: int):
        """(word's number, side, class of the neighbour, times, whether among OWN, part of the neighbour) of all neighbours."""
        out = [(self.owner, self.side, head_classes[self.nbrs], self.times, self.nbrs < own, self.nbrs % PARTS)]
        for part in range(PARTS):
            rows = state.filter(pa.array(state.column("source").to_numpy() % PARTS == part))
            near = unpacked(rows.column("near"))
            key, what = np.concatenate([near >> 8 & FAR, unpacked(rows.column("far"))]), np.concatenate([near & 255, unpacked(rows.column("told"), np.uint8).astype(np.int64)])
            times = np.concatenate([near >> 32, np.ones(len(key) - len(near), np.int64)])
            out.append((np.searchsorted(self.keys, key), what & 1, what >> 1, times, np.zeros(len(key), bool), np.full(len(key), part)))
        return [np.concatenate(c) for c in zip(*out)]


def tables(classes: np.ndarray, around, part: int) -> np.ndarray:
    """Class bigrams of a bucket's words: with OWN words and words of other parts, and with words after and words before them in their own part."""
    owner, side, other, times, top, at = around
    kind = np.where(top | (at != part), 0, 1 + side)
    return np.bincount(kind * CLASSES ** 2 + pairs_of(classes, around), weights=times, minlength=3 * CLASSES ** 2).reshape(3, -1)


def pairs_of(classes: np.ndarray, around) -> np.ndarray:
    owner, side, other = around[:3]
    return np.where(side == 0, classes[owner] * CLASSES + other, other * CLASSES + classes[owner])


def segments(rows: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of `lengths` (one at least) rows from `begins` on; many short segments are added up together, a row of each at a time."""
    order = np.argsort(-lengths, kind="stable")
    first, sizes = begins[order], lengths[order]
    total = rows[first]
    for j in range(1, min(16, int(sizes.max(initial=1)))):
        n = int(np.searchsorted(-sizes, -j, "left"))
        total[:n] += rows[first[:n] + j]
    for i in np.flatnonzero(sizes > 16):
        total[i] += rows[first[i] + 16:first[i] + sizes[i]].sum(axis=0)
    out = np.empty_like(total)
    out[order] = total
    return out


def moved(classes: np.ndarray, around, table: np.ndarray) -> np.ndarray:
    """Each word's best class, when all others stay: those of `classes` unless another one raises the likelihood.

    As in `gains`, but from the distinct classes beside a word; words beside themselves count as beside their old class.
    """
    owner, side, other, times = around[:4]
    codes, n = summed((owner * 2 + side) * CLASSES + other, times)
    side, j = codes // CLASSES & 1, codes % CLASSES
    first = np.flatnonzero(np.diff(codes // (2 * CLASSES), prepend=-1))
    who = codes[first] // (2 * CLASSES)
    mass = np.zeros((2, len(classes)))
    for s in (0, 1):
        mass[s] = np.bincount(codes[side == s] // (2 * CLASSES), weights=n[side == s], minlength=len(classes))
    both = np.concatenate([table.T, table])  # by side and class beside it: the counts of the classes it may be in
    logs, sums = xlogx(both), (table.sum(axis=1), table.sum(axis=0))
    steps = np.concatenate([xlogx(both + k) - logs for k in range(1, 9)])
    sum_steps = [np.stack([xlogx(x + k) - xlogx(x) for k in range(9)]) for x in sums]
    new, row = classes.copy(), side * CLASSES + j
    ends, stop = np.append(first, len(codes)), 0
    while stop < len(who):
        start, stop = stop, max(stop + 1, int(np.searchsorted(ends, ends[stop] + 20_000, "right")) - 1)
        at = slice(ends[start], ends[stop])
        k, r, w = n[at], row[at], who[start:stop]
        gain = steps.take((np.minimum(k, 8) - 1) * 2 * CLASSES + r, axis=0)
        big = np.flatnonzero(k > 8)
        gain[big] = xlogx(both[r[big]] + k[big, None]) - logs[r[big]]
        lengths, begins = np.diff(ends[start:stop + 1]), ends[start:stop] - ends[start]
        mine = np.repeat(classes[w], lengths)
        left = both[r, mine]
        gain[np.arange(len(k)), mine] = xlogx(left) - xlogx(np.maximum(left - k, 0))
        total, every, old = segments(gain, begins, lengths), np.arange(len(w)), classes[w]
        for s in (0, 1):
            m, here = mass[s, w], sums[s][old]
            grown = sum_steps[s].take(np.minimum(m, 8).astype(np.int64), axis=0)
            big = np.flatnonzero(m > 8)
            grown[big] = xlogx(sums[s] + m[big, None]) - xlogx(sums[s])
            grown[every, old] = xlogx(here) - xlogx(np.maximum(here - m, 0))
            total -= grown
        best = total.argmax(axis=1)
        go = total[every, best] - total[every, old] > 1e-6
        new[w[go]] = best[go]
    return new


def state_rows(bucket: int, buckets: int, keys: np.ndarray, classes: np.ndarray, messages, counted: np.ndarray | None = None) -> pa.Table:
    """The bucket's own row (classes, its tables, places and classes of words of the head) and its messages, by the bucket they go to."""
    mids = keys[keys < TAIL]
    out = [(bucket, bucket, packed(classes.astype(np.uint8)), None, None, None, counted is not None and packed(counted) or None, packed(mids << 8 | classes[:len(mids)]))]
    for b in range(buckets):
        near, far, told = messages(b)
        if len(near) or len(far):
            out.append((b, bucket, None, packed(near), packed(far), packed(told), None, None))
    return pa.Table.from_arrays([pa.array([o[i] for o in out], pa.int32() if i < 2 else pa.binary()) for i in range(8)],
                                names=["bucket", "source", "classes", "near", "far", "told", "tables", "places"])


def first_state(parts: DataFrame, symbols: Symbols, head: list[bytes], symbol_classes: np.ndarray, buckets: int) -> DataFrame:
    """Every word in the class of its spelling; messages tell it to its neighbours."""
    own = len(symbols.own)

    def run(batches):
        symbols, of_head, of_symbol = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                rows = pa.Table.from_batches([batch.slice(i, 1)])
                bucket = Bucket.of(rows)
                classes = np.concatenate([of_head[bucket.keys[bucket.keys < TAIL]], of_symbol[symbols.of_others(rows.column("words").combine_chunks().flatten().cast(pa.large_binary()))]])
                yield from state_rows(rows.column("bucket")[0].as_py(), buckets, bucket.keys, classes, bucket.messages(classes, own, buckets)).to_batches()

    shared = parts.sparkSession.sparkContext.broadcast((symbols, symbol_classes[[symbols.of(w) for w in head]] if head else symbol_classes, symbol_classes))
    return written(parts.drop("pairs", "part").mapInArrow(run, STATE), "word-classes")


def part_moved(parts: DataFrame, states: list[DataFrame], part: int, head_classes: np.ndarray, own: int, table: np.ndarray, buckets: int) -> DataFrame:
    """The words of one part of the buckets, each in its best class."""
    def run(words, state):
        if not words.num_rows:
            return state.slice(0, 0)
        head_classes, table = shared.value
        number, bucket = words.column("bucket")[0].as_py(), Bucket.of(words)
        classes = unpacked(state.column("classes"), np.uint8).astype(np.int64)
        around = bucket.neighbours(state, head_classes, own)
        new = moved(classes, around, table)
        (others, after, _), now = tables(classes, around, part), tables(new, around, part)
        # a pair inside the part is counted by both its words, each with the other's class from before: right unless both move
        held = np.concatenate([others, after, now[0], now[1] + now[2] - after, [bucket.counts[new != classes].sum()]]).astype(np.int64)
        return state_rows(number, buckets, bucket.keys, new, bucket.messages(new, own, buckets), held)

    shared = parts.sparkSession.sparkContext.broadcast((head_classes, table))
    state = reduce(DataFrame.union, states).where(F.col("bucket") % PARTS == part)
    return written(parts.where(F.col("part") == part).drop("words", "pairs", "part").groupBy("bucket").cogroup(state.groupBy("bucket")).applyInArrow(run, STATE), "word-classes")


def counted(parts: DataFrame, states: list[DataFrame], head_classes: np.ndarray, own: int) -> DataFrame:
    """(word, c, class) of the words beyond the head; and, without word, a row per bucket with its table and the tokens and words of its classes."""
    def run(words, state):
        if not words.num_rows:
            return pa.table({"word": pa.array([], pa.binary()), "c": pa.array([], pa.int64()), "class": pa.array([], pa.int32()), "tables": pa.array([], pa.binary())})
        bucket, classes = Bucket.of(words), unpacked(state.column("classes"), np.uint8).astype(np.int64)
        around = bucket.neighbours(state, shared.value, own)
        once = around[4] | (around[1] == 0)  # a pair of two words of buckets is counted where its first word is
        table = np.bincount(pairs_of(classes, around)[once], weights=around[3][once], minlength=CLASSES ** 2)
        names, far = words.column("words").combine_chunks().flatten(), bucket.keys >= TAIL
        sums = [np.bincount(classes[far], weights=w, minlength=CLASSES) for w in (bucket.counts[far], np.ones(far.sum()))]
        held = packed(np.concatenate([table, *sums]).astype(np.int64))
        rest = len(names)
        return pa.table({"word": pa.concat_arrays([names, pa.array([None], pa.binary())]), "c": pa.array([*bucket.counts[far].tolist(), None], pa.int64()),
                         "class": pa.array([*classes[far].tolist(), None], pa.int32()), "tables": pa.array([None] * rest + [held], pa.binary())})

    shared = parts.sparkSession.sparkContext.broadcast(head_classes)
    found = parts.drop("pairs", "part").groupBy("bucket").cogroup(reduce(DataFrame.union, states).groupBy("bucket")).applyInArrow(run, "word binary, c long, class int, tables binary")
    return written(found, "words-beyond-head")


def summed_up(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Over all buckets the sums of `tables`, and all of `places` (place and class of words of the head)."""
    def run(batches):
        held, places = np.zeros(size, np.int64), []
        for batch in batches:
            for b in batch.column(0).to_pylist():
                held += np.frombuffer(b, np.int64)
            places.append(unpacked(batch.column(1)))
        yield pa.RecordBatch.from_arrays([pa.array([packed(a)], pa.binary()) for a in (held, np.concatenate([np.empty(0, np.int64), *places]))], names=["tables", "places"])

    found = rows.coalesce(8).mapInArrow(run, "tables binary, places binary").toArrow()
    return unpacked(found.column(0)).reshape(-1, size).sum(axis=0), unpacked(found.column(1))


def spread(parts: DataFrame, buckets: int, symbols: Symbols, head: list[bytes], table: np.ndarray, symbol_classes: np.ndarray,
           bigram: np.ndarray, n_tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, DataFrame, list[tuple[int, float]]]:
    """Classes of all words, from those of the symbols.

    Classes of the words of the head, class bigrams, tokens and words by class beyond the head, (word, c, class) of these,
    and of every round the tokens that moved and the likelihood before it (nearly: words that moved at once and follow each other
    are counted anew in the next round only; the last likelihood and the class bigrams are exact).
    """
    own, cells = len(symbols.own), CLASSES ** 2
    head_classes = symbol_classes[[symbols.of(w) for w in head]].astype(np.int64)
    first = first_state(parts, symbols, head, symbol_classes, buckets)
    states = [first.where(F.col("source") % PARTS == part) for part in range(PARTS)]
    guessed, log = [None] * PARTS, []
    while not log or log[-1][0] > STILL * n_tokens and (len(log) < 2 or log[-1][0] <= SETTLED * log[-2][0]):
        log.append([0, likelihood(np.maximum(bigram, 0))])
        for part in range(PARTS):
            states[part] = part_moved(parts, states, part, head_classes, own, np.maximum(bigram, 0), buckets)
            rows = states[part].where(F.col("tables").isNotNull())
            found, places = summed_up(rows.select("tables", "places"), 4 * cells + 1)
            others, inside, now_others, now_inside = found[:-1].reshape(4, CLASSES, CLASSES)
            bigram = bigram - others - (inside if guessed[part] is None else guessed[part]) + now_others + now_inside
            guessed[part] = now_inside
            head_classes[places >> 8] = places & 255
            log[-1][0] += int(found[-1])
    rare = counted(parts, states, head_classes, own)
    found, _ = summed_up(rare.where(F.col("word").isNull()).select("tables", F.lit(b"").alias("places")), cells + 2 * CLASSES)
    top = np.bincount((symbol_classes[:own, None] * CLASSES + symbol_classes[None, :own]).ravel(), weights=table[:own, :own].ravel(), minlength=cells)
    bigram = (top + found[:cells]).reshape(CLASSES, CLASSES)
    log.append([0, likelihood(bigram)])
    return head_classes, bigram, found[cells:].reshape(2, CLASSES), rare.where(F.col("word").isNotNull()).drop("tables"), log


def likelihood(bigram: np.ndarray) -> float:
    """Log likelihood of the classes, less what does not depend on them."""
    return float(xlogx(bigram).sum() - xlogx(bigram.sum(axis=0)).sum() - xlogx(bigram.sum(axis=1)).sum())


@dataclass
class Model:
    symbols: Symbols  # the words of the head, and the spellings of words never seen
    head: list  # the most frequent words
    head_counts: list
    classes: np.ndarray
    transitions: np.ndarray  # log10 P(class | previous class)
    emissions: np.ndarray  # log10 P(symbol | class)
    in_class: np.ndarray  # smoothed tokens of each class
    n_tokens: int
    n_types: int
    log: list  # of every round the tokens that moved and the likelihood before it, nearly; last the likelihood at the end


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", held: tuple[int, int] = HELD) -> tuple[Model, DataFrame]:
    """The model and the table of all words (word, c, class), from all texts outside the held-out fold."""
    train = docs.where(~in_fold(key, *held))
    counts = word_counts(train, text)
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.length("word") > 0, F.desc("c"), "word").limit(HEAD).toArrow()
    head, head_counts = top.column("word").to_pylist(), top.column("c").to_pylist()
    coarse = find_symbols(counts, head[:OWN], head_counts[:OWN], n)
    buckets = PARTS * max(1, math.ceil(n / (PARTS * BUCKET)))
    parts = merged(surroundings(train, text, coarse, head, buckets))
    table = symbol_table(parts, len(coarse.counts))
    symbol_classes, bigram = exchanged(table)
    own, head_classes, beyond, rare, log = len(coarse.own), symbol_classes[:len(head)], np.zeros((2, CLASSES)), None, []
    if v > own:
        head_classes, bigram, beyond, rare, log = spread(parts, buckets, coarse, head, table, symbol_classes, bigram, n)
    symbols = Symbols({w: i for i, w in enumerate(head)}, {s: i - own + len(head) for s, i in coarse.spelt.items()}, head_counts + [0] * (len(coarse.counts) - own))
    classes = np.concatenate([head_classes, symbol_classes[own:]])
    size = np.asarray(symbols.counts, dtype=float) + 0.5
    in_class = np.bincount(classes, weights=size, minlength=CLASSES) + beyond[0] + 0.5 * beyond[1]
    prior = (bigram.sum(axis=0) + 0.5) / (bigram.sum() + 0.5 * CLASSES)
    moves = (bigram + SHRINK * prior[None]) / (bigram.sum(axis=1, keepdims=True) + SHRINK)
    found = docs.sparkSession.createDataFrame(pa.table({"word": pa.array(head, pa.binary()), "c": pa.array(head_counts, pa.int64()), "class": pa.array(head_classes, pa.int32())}))
    return (Model(symbols, head, head_counts, classes, np.log10(moves), np.log10(size / in_class[classes]), in_class, n, v, log),
            found.union(rare) if rare is not None else found)


def score(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id", text: str = "text",
          held: tuple[int, int] = HELD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity (of the score); a row per row.

    Null and empty texts consist of the end alone. Without training texts every token is unknown and base_score is 0;
    a null key is in no held-out fold. Repeated rows are scored alike; other columns are not read.
    """
    def run(batches):
        head, end, plus, classes, moves, emissions = shared.value
        head, row = pa.array(head, pa.large_binary()), TaskContext.get().partitionId() << 33
        for rows in portions(batches):
            found, sizes = parsed(rows.column(1))
            place = places(found, head)
            known = between_ends(place, sizes, end if len(head) else -1)
            cls = np.append(classes, -1)[known]
            text_of = np.repeat(np.arange(len(sizes)), sizes + 1)

            def sums(values):
                return np.bincount(text_of, weights=values, minlength=len(sizes))

            seen = known[1:] >= 0
            before = cls[:-1].copy()
            firsts = np.cumsum(sizes + 1) - sizes - 1
            before[firsts] = classes[end]
            pair = (before >= 0) & (cls[1:] >= 0)
            part = np.where(pair, moves[before, cls[1:]], 0.0) + np.where(seen, np.append(emissions[:len(plus)], 0.0)[known[1:]], 0.0)
            after = np.append(cls[2:], -2)
            after[firsts[1:] - 1] = -2  # a text ends here
            at = np.flatnonzero(~seen)
            inner = between_ends(np.arange(len(found)), sizes, len(found))[1:][at]
            rare = pa.concat_arrays([found, pa.array([END], pa.large_binary())]).take(pa.array(inner)).cast(pa.binary())
            # where the word stands, and the classes before and after it: 0 none, 1 another rare word's, else known
            codes = (at - firsts[text_of[at]]) << 24 | (before[at] + 2) << 16 | (after[at] + 2) << 8
            offsets = pa.array(np.cumsum([0, *np.bincount(text_of[at], minlength=len(sizes))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(len(sizes))), pa.concat_arrays(rows.column(0).chunks), pa.array(sizes + 1), pa.array(sums(seen).astype(np.int64)),
                pa.array(sums(np.where(seen, np.append(plus, 0.0)[known[1:]], 0.0))), pa.array(sums(part)), pa.ListArray.from_arrays(offsets, rare),
                pa.ListArray.from_arrays(offsets, pa.array(codes, pa.int64()))], names=names)
            row += len(sizes)

    def whole(batches):
        """Class bigrams and emissions of the rare words, by the classes the join has found."""
        moves = shared.value[4]
        for batch in batches:
            codes = batch.column("codes")
            sizes = np.diff(codes.offsets.to_numpy())
            flat, of = codes.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(batch.num_rows), sizes)
            order = np.lexsort((flat, of))
            flat, of = flat[order], of[order]
            at, before, after, cls = flat >> 24, (flat >> 16 & 255) - 2, (flat >> 8 & 255) - 2, flat & 255
            total = np.where(before >= 0, moves[before, cls], 0.0) + np.where(after >= 0, moves[cls, after], 0.0)
            pair = np.flatnonzero((np.diff(of) == 0) & (np.diff(at) == 1))
            total[pair] += moves[cls[pair], cls[pair + 1]]
            part = batch.column("part").to_numpy() + np.bincount(of, weights=total, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(part)], names=[*kept, "score"])

    kind = docs.schema[key].dataType.simpleString()
    names = ["row", "doc_id", "n_tokens", "known", "plus", "part", "rare", "codes"]
    kept = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.head, model.symbols.of(END), np.log10(np.asarray(model.head_counts, dtype=float) + 1), model.classes, model.transitions, model.emissions))
    rows = written(small_batches(docs).select(key, text).mapInArrow(run, f"row long, doc_id {kind}, n_tokens long, known long, plus double, part double, "
                                                                         "rare array<binary>, codes array<long>"), "scored")
    ends = spark.createDataFrame([(s, int(model.classes[i])) for s, i in model.symbols.spelt.items()], "spelling binary, like int")
    found = (rows.select("row", F.explode(F.arrays_zip("rare", "codes")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.codes").alias("code"))
             .join(counts, "word", "left").withColumn("spelling", F.when(F.col("c").isNull(), spelt("word"))).join(F.broadcast(ends), "spelling", "left")
             .withColumn("class", F.coalesce("class", "like", F.lit(int(model.classes[-1])))))
    sizes = F.lit([math.log10(s) if s else 0.0 for s in model.in_class.tolist()])
    rare = found.groupBy("row").agg(F.collect_list(F.col("code") + F.col("class")).alias("codes"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("more"), F.count("c").alias("found"),
                                    F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5) - F.element_at(sizes, F.col("class") + 1)).alias("emitted"))
    more = F.coalesce("more", F.lit(0.0))
    size = math.log10(model.n_tokens + model.n_types + 1)
    every = rows.drop("rare", "codes").join(rare, "row", "left").select(
        "doc_id", in_fold("doc_id", *held).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), (F.col("plus") + more - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        (F.col("part") + F.coalesce("emitted", F.lit(0.0))).alias("part"), F.coalesce("codes", F.array().cast("array<long>")).alias("codes"))
    return every.mapInArrow(whole, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
