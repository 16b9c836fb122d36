"""Token-id shards with keyed access: raw id payloads, found through a minimal perfect hash index.

Store (all below one folder of the shared storage):

* `shards/kind=ids/shard=S/`: one file of unsigned little-endian 16-bit ids (32-bit for vocabularies beyond 65,536), document
  after document in ascending key order, each closed by the end id 0. A footer follows: per document one line of JSON
  text [key, number of ids], then its length in bytes as 8 bytes and a mark. Shard numbers ascend with the keys; a new
  shard begins after SHARD_IDS ids, so a file is bounded but for one very long document.
* `shards/kind=keys/shard=S/`: one file of each writing task, S its first shard: the entries of all its documents as JSON
  objects, each closed by a zero byte. The manifest and the index are made from them, so that no shard is read for it; a
  shard that is read is held against its own footer.
* `manifest/`: shard, number of ids, ids of all shards before it, and how many copies of its first key lie before it.
* `index/`: one row per bucket of keys: a minimal perfect hash function and, at a key's slot, its fingerprint, shard,
  offset and number of ids.

The hash function: keys of a bucket go to bit arrays level by level. At a level every key that is left hashes to a cell;
a key alone in its cell is placed there, the others go on. The number of set bits before a key's cell is its slot, so n
keys use the slots 0 to n - 1 and a lookup looks at two levels on average, however many keys there are. A stored 32-bit
fingerprint of another hash tells unknown keys (all but one in 4 billion).

Copies of a key are the keys (key, 0), (key, 1), ..., so that a key with many rows is spread over all buckets.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from playtrail.session import fresh_path

from .common import small_batches

END_ID = 0
SHARD_IDS = 1 << 22  # ids after which a shard is closed
TEXT_BYTES = 1 << 25  # bytes of text that a writing task is meant to get
BUCKET_KEYS = 1 << 15  # keys of an index bucket, about
SHARDS_A_TASK = 4  # shards that a reading task gets, about
CACHED = 1 << 19  # encoded pieces a process remembers, of 32 bytes on average at most
MARK = b"ids\n"
AT_ONCE = 512  # new pieces encoded as one text: the library's work on a text grows faster than the text
ROWS, BYTES = 2048, 1 << 23  # rows, and bytes of their texts, whose pieces are looked up together: each look-up hashes all remembered ones
# Fixed value: how a byte-level vocabulary writes a blank.
BLANK = "\u0120"
EDGE = r"[!-~\pL\pN]"  # characters that are white space in no library
STOPS = ".,;:!?"
LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"  # letters in every version of Unicode
_TOKENIZERS: dict = {}


class Encoder:
    """Ids of whole texts as packed bytes, from pieces that are encoded once and remembered.

    A byte-level tokenizer cuts a text before a single blank between two characters that are no white space, and between
    a letter and a full stop, whatever stands further left or right. Texts are cut there, each new piece is encoded by
    the library and the ids are joined: the same ids as for the whole text. New pieces are encoded as one text; the ids
    that begin with a blank tell them apart. Texts that hold an added token or another blank, and all texts of
    tokenizers that work otherwise, are encoded whole.
    """

    def __init__(self, definition: bytes):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_buffer(definition)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        form = json.loads(definition)
        before = form.get("pre_tokenizer") or {}
        self.cuts = (not form.get("normalizer") and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
                     and before.get("use_regex", True) and form["model"]["type"] == "BPE" and not form["model"].get("dropout"))
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.begins[number] = token.startswith(BLANK)
        self.stops = np.array([self.tokenizer.encode(c, add_special_tokens=False).ids[0] for c in STOPS], dtype=self.kind) if self.cuts else None
        self.forget()

    def forget(self) -> None:
        """ids[start:start + size] are those of a piece behind a blank; opens and closes tell whether it may be cut there."""
        self.pieces = pa.array([], pa.string())
        self.ids, self.start, self.size = np.empty(0, dtype=self.kind), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.opens, self.closes = np.empty(0, dtype=bool), np.empty(0, dtype=bool)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def together(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and how many each has, of pieces that follow a blank, hold none and do not end in white space."""
        bounds = pa.array([*range(0, len(pieces), AT_ONCE), len(pieces)], pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(bounds, pieces), " ").to_pylist()
        ids = np.concatenate([self.whole([" " + text])[0] for text in texts])
        at = np.flatnonzero(self.begins[ids])
        if len(at) != len(pieces):
            raise ValueError("pieces were not cut at their blanks")
        return ids, np.diff(np.append(at, len(ids)))

    def enter(self, pieces: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.start = np.append(self.start, len(self.ids) + np.cumsum(size) - size)
        self.size, self.ids = np.append(self.size, size), np.append(self.ids, ids)
        self.opens, self.closes = np.append(self.opens, matches(pieces, f"^{EDGE}")), np.append(self.closes, matches(pieces, f"{EDGE}$"))

    def numbers(self, pieces: pa.Array) -> np.ndarray:
        """A number for each of these distinct pieces; new ones are encoded. A word and a stop take the ids of the word."""
        closed = matches(pieces, f"^{LETTER}+[{STOPS}]$")
        words = pc.utf8_slice_codeunits(pieces.filter(pa.array(closed)), 0, -1)
        found = places(pa.concat_arrays([pieces, words]), self.pieces)
        own, word = found[:len(pieces)], found[len(pieces):]
        new = own < 0
        word = word[new[closed]]
        words = words.filter(pa.array(new[closed]))
        todo = pc.unique(pa.concat_arrays([pieces.filter(pa.array(new & ~closed)), words.filter(pa.array(word < 0))]))
        first, plain = len(self.pieces), matches(todo, f"^[^ ]*{EDGE}$")
        some, odd = todo.filter(pa.array(plain)), todo.filter(pa.array(~plain))
        if len(some):
            self.enter(some, *self.together(some))
        if len(odd):
            ids = self.whole([" " + p for p in odd.to_pylist()])
            self.enter(odd, np.concatenate(ids), np.array([len(x) for x in ids], dtype=np.int64))
        entered = pa.concat_arrays([some, odd])
        if len(words):
            ends = pieces.filter(pa.array(new & closed))
            number = np.where(word < 0, first + places(words, entered), word)
            size = self.size[number] + 1
            ids, last = np.empty(size.sum(), dtype=self.kind), np.cumsum(size) - 1
            ids[last] = self.stops[places(pc.utf8_slice_codeunits(ends, -1), pa.array(list(STOPS)))]
            ids[np.delete(np.arange(len(ids)), last)] = self.ids[spans(self.start[number], size - 1)]
            self.enter(ends, ids, size)
            entered = pa.concat_arrays([entered, ends])
        own[new] = first + places(pieces.filter(pa.array(new)), entered)
        return own

    def packed(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text and the end id."""
        end = np.array([END_ID], dtype=self.kind)
        odd = np.full(len(texts), not self.cuts)
        for mark in self.marks:
            odd |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        out = [b""] * len(texts)
        if not odd.all():
            if len(self.pieces) > CACHED or self.pieces.nbytes > 32 * CACHED:
                self.forget()
            parts = pc.split_pattern(texts, " ")
            offsets, cut = parts.offsets.to_numpy().astype(np.int64), parts.flatten().dictionary_encode()
            offsets = offsets - offsets[0]
            number = self.numbers(cut.dictionary)[cut.indices.to_numpy()]
            inner = np.ones(len(number), dtype=bool)
            inner[offsets[:-1]] = False  # the first piece of a text follows no blank
            bad = np.flatnonzero(inner[1:] & ~(self.closes[number[:-1]] & self.opens[number[1:]])) + 1
            odd[np.searchsorted(offsets, bad, side="right") - 1] = True  # a blank that may not be cut
            size = np.where(inner & ~np.repeat(odd, np.diff(offsets)), self.size[number], 0)
            stop = np.cumsum(size)
            ids = self.ids[spans(self.start[number], size)]
            bounds = np.concatenate([[0], stop])[offsets]
            plain = np.flatnonzero(~odd)
            heads = self.whole(pc.list_element(pc.split_pattern(texts.take(pa.array(plain)), " ", max_splits=1), 0).to_pylist())
            for i, head in zip(plain.tolist(), heads):
                out[i] = np.concatenate([head, ids[bounds[i]:bounds[i + 1]], end]).tobytes()
        rest = np.flatnonzero(odd)
        for i, ids in zip(rest.tolist(), self.whole(texts.take(pa.array(rest)).to_pylist())):
            out[i] = np.append(ids, end).tobytes()
        return out


def matches(texts: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)


def places(values: pa.Array, among: pa.Array) -> np.ndarray:
    """Position of each value in the other array, -1 for those that are not in it."""
    return pc.fill_null(pc.index_in(values, value_set=among), -1).to_numpy().astype(np.int64)


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each span, one span after the other."""
    stop = np.cumsum(size)
    return np.repeat(start - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)


def handfuls(batches):
    """The rows of all batches in order, at most ROWS rows and BYTES of text (or one longer text) at a time."""
    held, rows, size = [], 0, 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = min(start + ROWS - rows, int(np.searchsorted(ends, before + BYTES - size, side="right")))
            stop = max(stop, start if held else start + 1)
            if stop > start:
                held.append(batch.slice(start, stop - start))
                rows, size, start = rows + stop - start, size + int(ends[stop - 1] - before), stop
            if start < batch.num_rows:  # full
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def encoder(definition) -> Encoder:
    """The encoder of a broadcast tokenizer file, made once in each process."""
    if definition.value not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[definition.value] = Encoder(definition.value)
    return _TOKENIZERS[definition.value]


def write_shards(docs: DataFrame, root: str, tokenizer: str, key: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Encodes every whole text in one pass over the rows in key order and writes the shards."""
    spark = docs.sparkSession
    with open(tokenizer, "rb") as file:
        definition = spark.sparkContext.broadcast(file.read())  # one file of fixed size
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    tasks = max(1, -(-size // TEXT_BYTES))
    rows = small_batches(docs).select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    tie = F.xxhash64("t")  # rows with one key are ordered by their texts, and may be dealt to several tasks
    ordered = rows.repartitionByRange(tasks, "k", tie).sortWithinPartitions("k", tie, "t").select(F.col("k").cast("string").alias("k"), "t")

    def run(batches):
        from pyspark import TaskContext
        encode = encoder(definition)
        wide, base, number, at, ids, listed = encode.kind.itemsize, TaskContext.get().partitionId() << 24, 0, 0, 0, []
        copy, told = 0, 0

        def footer():
            lines = "".join(json.dumps(x, separators=(",", ":")) + "\n" for x in listed).encode()
            return lines + bytes([wide]) + len(lines).to_bytes(8, "little") + MARK

        def table(out):  # the writer closes every row by one zero byte: the last of an end id, or one behind the footer
            return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.binary()))],
                                              names=["kind", "shard", "no", "value"])

        for few in handfuls(batches):
            out, entry = [], []
            for k, payload in zip(few.column(0).to_pylist(), encode.packed(few.column(1))):
                n = len(payload) // wide
                out.append(("ids", base + number, at, payload[:-1]))
                copy = copy + 1 if listed and k == listed[-1][0] else 0
                listed.append((k, n))
                entry.append(json.dumps({"doc_shard": base + number, "first": k == listed[0][0], "k": k, "copy": copy, "at": ids, "n": n}, separators=(",", ":")))
                at, ids = at + 1, ids + n
                if ids >= shard_ids:
                    out.append(("ids", base + number, at, footer()))
                    number, at, ids, listed = number + 1, 0, 0, []
            told += 1
            yield table([*out, ("keys", base, told, "\0".join(entry).encode())])
        if listed:
            yield table([("ids", base + number, at, footer())])

    shards = ordered.mapInArrow(run, "kind string, shard long, no long, value binary").sortWithinPartitions("kind", "shard", "no")
    (shards.select("kind", "shard", F.col("value").cast("string").alias("value")).write.partitionBy("kind", "shard")
     .option("lineSep", "\0").option("compression", "none").text(f"{root}/shards"))


def of_kind(found: DataFrame, kind: str) -> DataFrame:
    """The files of one kind; none if nothing was written."""
    return found.where(F.col("kind") == kind) if "kind" in found.columns else found.where(F.lit(False)).withColumn("shard", F.lit(0))


def files(spark: SparkSession, root: str) -> DataFrame:
    """(shard, content): the files as they are."""
    found = of_kind(spark.read.format("binaryFile").load(f"{root}/shards"), "ids")
    return found.select(F.col("shard").cast("long").alias("shard"), "content")


def footer_of(content: bytes | memoryview) -> tuple[int, list]:
    """(bytes of an id, [[key, number of ids]]) of a shard file."""
    if content[-5:-1] != MARK:
        raise ValueError("a shard file lacks its footer")
    length = int.from_bytes(content[-13:-5], "little")
    return content[-14], [json.loads(line) for line in bytes(content[-14 - length:-14]).splitlines()]


def entries(spark: SparkSession, root: str) -> DataFrame:
    """(shard, first, k, copy, at, n) of every document, as its writing task noted them; shards are not read.

    first: whether its key begins the shard; copy: rows of its key before it in the shard; at: ids before it in the shard.
    """
    names = "shard", "first", "k", "copy", "at", "n"
    own = "doc_shard long, first boolean, k string, copy long, at long, n long"
    found = spark.read.schema(own).option("lineSep", "\0").option("mode", "FAILFAST").json(f"{root}/shards")
    return of_kind(found, "keys").withColumn("shard", F.col("doc_shard")).select(*names)


def write_manifest(found: DataFrame, root: str) -> DataFrame:
    """shard, n_docs, n_ids, start (ids of all shards before), before (copies of the shard's first key in shards before).

    The windows run over one or two rows a shard, not over documents.
    """
    shards = found.groupBy("shard").agg(
        F.count("*").alias("n_docs"), F.sum("n").alias("n_ids"), F.count_if("first").alias("n_first"), F.min_by("k", "at").alias("k"),
        F.max_by("k", "at").alias("last"), (F.max_by("copy", "at") + 1).alias("n_last"))
    ends = shards.select("k", "shard", F.lit(True).alias("begins"), F.col("n_first").alias("rows")).union(
        shards.where(~F.col("k").eqNullSafe(F.col("last"))).select("last", "shard", F.lit(False), "n_last"))
    earlier = Window.partitionBy("k").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).where("begins").select("shard", "before")
    start = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards.withColumn("start", start).join(before, "shard").select("shard", "n_docs", "n_ids", "start", "before").write.parquet(f"{root}/manifest")
    return found.sparkSession.read.parquet(f"{root}/manifest")


def key_hashes(buckets: int) -> list[Column]:
    """bucket, two hashes that place a key, and its fingerprint."""
    def h(n):
        return F.xxhash64(F.lit(n), F.col("k").isNull(), F.coalesce("k", F.lit("")), F.col("copy"))
    return [F.pmod(h(1), F.lit(buckets)).alias("bucket"), h(2).alias("h1"), h(3).alias("h2"), h(4).bitwiseAND(0xFFFFFFFF).alias("print")]


def cells(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    """Cell of each key at a level of `size` cells: both hashes and the level, mixed."""
    with np.errstate(over="ignore"):
        x = h1 + np.uint64(2 * level + 1) * (h2 | np.uint64(1))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (x ^ (x >> np.uint64(29))) % np.uint64(size)


def hash_function(h1: np.ndarray, h2: np.ndarray):
    """(cells of each level, words, ranks): the bits of all levels in 64-bit words, and the set bits before each word."""
    if len(np.unique(np.stack([h1, h2]), axis=1).T) < len(h1):
        raise ValueError("two keys share both hashes")
    sizes, words = [], []
    left = np.arange(len(h1))
    while len(left):
        size = -(-2 * len(left) // 64) * 64
        cell = cells(h1[left], h2[left], len(sizes), size)
        taken = np.bincount(cell.astype(np.int64), minlength=size)
        words.append(np.packbits(taken == 1, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[taken[cell.astype(np.int64)] > 1]
    words = np.concatenate(words) if words else np.empty(0, dtype="<u8")
    ranks = np.bitwise_count(words).astype(np.int64)
    return sizes, words, np.cumsum(ranks) - ranks


def slots(h1: np.ndarray, h2: np.ndarray, sizes: list[int], words: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Slot of each key; -1 for a key that is in no level and so was never entered."""
    out, left, base = np.full(len(h1), -1, dtype=np.int64), np.arange(len(h1)), 0
    for level, size in enumerate(sizes):
        cell = cells(h1[left], h2[left], level, size) + np.uint64(base)
        word, bit = (cell >> np.uint64(6)).astype(np.int64), cell & np.uint64(63)
        found = (words[word] >> bit) & np.uint64(1) == 1
        below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        out[left[found]] = (ranks[word] + np.bitwise_count(below))[found]
        left, base = left[~found], base + size
    return out


PLACES = ("shard", "at", "start", "n")
INDEX = ("bucket long, buckets long, n_keys long, sizes array<bigint>, words binary, ranks binary, prints binary, "
         + ", ".join(f"{p} binary" for p in PLACES))


def write_index(found: DataFrame, manifest: DataFrame, root: str) -> None:
    """A hash function and the places of its keys for each bucket; a bucket holds BUCKET_KEYS keys, give or take."""
    buckets = max(1, -(-(manifest.agg(F.sum("n_docs")).first()[0] or 0) // BUCKET_KEYS))
    placed = found.join(manifest.select("shard", F.col("start").alias("base"), "before"), "shard").select(
        "k", (F.col("copy") + F.when(F.col("first"), F.col("before")).otherwise(0)).alias("copy"), "shard", "at", (F.col("base") + F.col("at")).alias("start"), "n")

    def build(rows: pa.Table) -> pa.Table:
        h1, h2 = (rows.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        sizes, words, ranks = hash_function(h1, h2)
        order = np.argsort(slots(h1, h2, sizes, words, ranks))
        held = {p: [rows.column(p).to_numpy()[order].astype("<i8").tobytes()] for p in PLACES}
        prints = rows.column("print").to_numpy()[order].astype("<u4").tobytes()
        return pa.table({"bucket": [rows.column("bucket")[0].as_py()], "buckets": [buckets], "n_keys": [rows.num_rows], "sizes": pa.array([sizes], pa.list_(pa.int64())),
                         "words": [words.tobytes()], "ranks": [ranks.astype("<i8").tobytes()], "prints": [prints], **held})

    (placed.select(*key_hashes(buckets), *PLACES).groupBy("bucket").applyInArrow(lambda rows: build(rows), INDEX).write.parquet(f"{root}/index"))


def build(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", root: str | None = None, shard_ids: int = SHARD_IDS) -> str:
    """Writes the store of a table and returns its folder, a new one in the shared folder unless given.

    Null texts are empty and have the end id alone. Null keys come first and are a key like any other; rows with one key
    are its copies, ordered by text. Keys of any type are held as text. Other columns are not read. An empty table gives
    a store in which nothing is found. One document may be longer than a shard; it is never cut.
    """
    root = root or fresh_path(docs.sparkSession, "token-store")
    write_shards(docs, root, tokenizer, key, text, shard_ids)
    found = entries(docs.sparkSession, root)
    write_index(found, write_manifest(found, root), root)
    return root


def keys_of(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(k, copy): every key of a table as often as it has rows. A key with many rows is counted out by many tasks."""
    counted = docs.groupBy(F.col(key).cast("string").alias("k")).agg(F.count("*").alias("rows"))
    blocks = counted.select("k", "rows", F.explode(F.expr("sequence(0, (rows - 1) div 4096)")).alias("block")).repartition("k", "block")
    return blocks.select("k", F.explode(F.expr("sequence(block * 4096, least(rows, block * 4096 + 4096) - 1)")).alias("copy"))


def lookup(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """(k, copy, shard, at, start, n) of the keys (k, copy) that the index holds; each key is looked up once."""
    index = spark.read.schema(INDEX).parquet(f"{root}/index")
    some = index.select("buckets").first()

    def find(wanted: pa.Table, row: pa.Table) -> pa.Table:
        if not wanted.num_rows or not row.num_rows:
            return schema.empty_table()
        h1, h2 = (wanted.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        held = {c: np.frombuffer(row.column(c)[0].as_py(), kind) for c, kind in (("words", "<u8"), ("ranks", "<i8"), ("prints", "<u4"), *((p, "<i8") for p in PLACES))}
        slot = slots(h1, h2, row.column("sizes")[0].as_py(), held["words"], held["ranks"])
        good = np.flatnonzero((slot >= 0) & (held["prints"][slot] == wanted.column("print").to_numpy()))
        return pa.table([wanted.column("k").take(pa.array(good)), wanted.column("copy").take(pa.array(good)), *(pa.array(held[p][slot[good]]) for p in PLACES)], schema=schema)

    schema = pa.schema([("k", pa.string()), ("copy", pa.int64()), *((p, pa.int64()) for p in PLACES)])
    hashed = keys.select("k", F.col("copy").cast("long").alias("copy")).distinct().select("*", *key_hashes(some.buckets if some else 1))
    return (hashed.groupBy("bucket").cogroup(index.groupBy("bucket"))
            .applyInArrow(lambda a, b: find(a, b), "k string, copy long, shard long, at long, start long, n long"))


def read(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """(k, copy, start, ids) of the keys (k, copy) in the store: ids of all documents before, and the document's ids with
    its end id as unsigned little-endian 32-bit integers. Only shards that hold a wanted key are read."""
    tasks = max(1, -(-spark.read.parquet(f"{root}/manifest").count() // SHARDS_A_TASK))  # a task's share does not grow with the store
    places = lookup(spark, root, keys).select("k", "copy", "shard", "at", "start", "n").repartition(tasks, "shard")

    def cut(wanted: pa.Table, file: pa.Table) -> pa.Table:
        if not wanted.num_rows:
            return schema.empty_table()
        content = memoryview(file.column("content")[0].as_buffer()).cast("B")
        wide, listed = footer_of(content)
        at, n = wanted.column("at").to_numpy(), wanted.column("n").to_numpy()
        size = np.array([x for _, x in listed], dtype=np.int64)
        start = np.cumsum(size) - size
        place = np.minimum(np.searchsorted(start, at), len(listed) - 1)
        if (start[place] != at).any() or (size[place] != n).any() or [listed[i][0] for i in place.tolist()] != wanted.column("k").to_pylist():
            raise ValueError("a shard file is not the one that the index was made of")
        ids = [np.frombuffer(content, f"<u{wide}", int(b), int(a) * wide).astype("<u4").tobytes() for a, b in zip(at, n)]
        return pa.table([wanted.column("k"), wanted.column("copy"), wanted.column("start"), pa.array(ids, pa.binary())], schema=schema)

    schema = pa.schema([("k", pa.string()), ("copy", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
    return (places.groupBy("shard").cogroup(files(spark, root).repartition(tasks, "shard").groupBy("shard"))
            .applyInArrow(lambda a, b: cut(a, b), "k string, copy long, start long, ids binary"))


def digests(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every row, read back by key from the store of the table."""
    spark = docs.sparkSession
    root = build(docs, tokenizer, key, text)
    kind = docs.schema[key].dataType.simpleString()
    return read(spark, root, keys_of(docs, key)).select(
        F.col("k").cast(kind).alias("doc_id"), "start", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
