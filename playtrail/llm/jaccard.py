"""Near-duplicate documents: all links of word-shingle sets at a Jaccard similarity of 3/4 or more, as components.

1. Every text becomes its set of 64-bit shingle hashes. Texts alike are one node. A fixed-size table counts how many
   nodes hold the shingles of a cell: the global order of shingles is rare first (count, then hash).
2. Stars: nodes that share one of their SMALLEST smallest hashes are compared with one leader of that value and with a
   few nodes next to them. Links found here join large groups of copies with a few comparisons per node.
3. Prefix join between different components. A pair that links shares a shingle of the larger text's first
   n - ceil(3n/4) + 1 and of the smaller one's first n - ceil(6n/7) + 1 shingles in the order. Shingles whose prefix
   rows all lie in one component cannot bring a new pair and are set aside; rows of the others are joined on the
   shingle, with length and positional filter. Of a shingle's largest component only pairs with others are formed.
4. Every new pair passes the suffix filter (an upper bound of the overlap from counts per hash range, finer for larger
   sets) and is verified once on the whole sets. Stars and pairs together give the components: a link lies either
   inside a component of step 2 or is one of the pairs of step 3, so none is lost and no group is expanded.

Tables between steps are in the shared folder. What is broadcast (counts, bit sets) has a fixed size.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD, bit_filter, own_names, passes, pieces, renamed, small_batches, words, written
from .components import components

SHINGLE = 5
CELL_BITS, CHUNK = 22, 16384  # cells of the counting table, and how many travel together
SMALLEST = 8  # smallest hashes that find a leader
NEXT, SALTS = 6, 16  # nodes of a hash that are compared with their next ones, and into how many parts a hash is dealt
KEY_BITS, GRAM_BITS = 23, 26  # bits of the fixed-size filters
BUCKET_ROWS = 500_000  # prefix rows of a bucket
SENT_ROWS = 1_000_000  # prefix rows, or shingles to count, that a task gathers before it works on them
CACHE = 200_000  # words a worker remembers
ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class Codes(dict):
    """Word to 64-bit hash; forgets everything when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def shingles(text: str | None, codes: Codes) -> np.ndarray:
    """Sorted distinct hashes (uint64) of the runs of SHINGLE words; fewer words are one run; no words, no hashes."""
    every = words(text)
    if not every:
        return np.empty(0, dtype=np.uint64)
    code = np.array([codes[w] for w in every], dtype=np.uint64)
    if len(code) < SHINGLE:
        runs = np.array([np.uint64(len(code))], dtype=np.uint64)
        for c, odd in zip(code, ODD):
            runs = runs * odd + c
    else:
        last = len(code) - SHINGLE + 1
        runs = code[:last] * ODD[0]
        for i in range(1, SHINGLE):
            runs = runs + code[i:last + i] * ODD[i]
    runs ^= runs >> np.uint64(32)
    runs *= ODD[3]
    runs ^= runs >> np.uint64(29)
    return np.unique(runs)


def content(text: str | None) -> bytes:
    """What makes two texts one node."""
    return hashlib.md5((text or "").encode("utf-8", "surrogatepass")).digest()


def histogram(grams: np.ndarray) -> bytes:
    """Counts of a set's hashes per range of leading bits, about four hashes to a range."""
    bits = max(4, int(len(grams)).bit_length() - 3)
    return np.bincount((grams >> np.uint64(64 - bits)).astype(np.int64), minlength=2 ** bits).astype(np.uint16).tobytes()


def overlap_bound(left: bytes, right: bytes) -> int:
    """No two sets with these histograms share more."""
    a, b = np.frombuffer(left, np.uint16).astype(np.int64), np.frombuffer(right, np.uint16).astype(np.int64)
    if len(a) > len(b):
        a, b = b, a
    return int(np.minimum(a, b.reshape(len(a), -1).sum(axis=1)).sum())


def least_overlap(n: int, m: int) -> int:
    """Fewest common shingles of sets of n and m with 100 * common >= 75 * union."""
    return -(-3 * (n + m) // 7)


def prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def index_length(n):
    return n - F.ceil(6 * n / F.lit(7)) + 1


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (doc_id, content, n) of every document, and counts of cells (chunk, counts) of every task."""
    def run(batches):
        codes, table, seen = Codes(), np.zeros(2 ** CELL_BITS, dtype=np.uint32), set()
        for batch in batches:
            keys, sizes, pending, held = [], [], [], 0
            for value in pieces(batch.column(1)):
                grams = shingles(value, codes)
                keys.append(content(value))
                sizes.append(len(grams))
                if keys[-1] not in seen:
                    seen.add(keys[-1])
                    pending.append(grams)
                    held += len(grams)
                if held >= SENT_ROWS:
                    count(table, pending)
                    pending, held = [], 0
            count(table, pending)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()),
                                              pa.nulls(len(keys), pa.int32()), pa.nulls(len(keys), pa.binary())], names=names)
        yield from chunks(table)

    names = ["doc_id", "content", "n", "chunk", "counts"]

    def count(table, sets):
        if sets:
            table += np.bincount((np.concatenate(sets) >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(table)).astype(np.uint32)

    def chunks(table):
        used = [(i, table[i * CHUNK:(i + 1) * CHUNK]) for i in range(len(table) // CHUNK)]
        used = [(i, zlib.compress(part.tobytes(), 1)) for i, part in used if part.any()]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.binary()), pa.nulls(len(used), pa.int32()),
                                          pa.array([u[0] for u in used], pa.int32()), pa.array([u[1] for u in used], pa.binary())], names=names)

    return written(small_batches(docs).select(key, text).mapInArrow(run, "doc_id long, content binary, n int, chunk int, counts binary"), "shingle-scan")


def cell_counts(parts: DataFrame) -> np.ndarray:
    """The sum of all tasks' tables; each task first sums what it reads, and every chunk is summed on its own."""
    def unpack(blob):
        return np.frombuffer(zlib.decompress(blob), np.uint32).astype(np.uint64)

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, blob in zip(pieces(batch.column(0)), pieces(batch.column(1))):
                sums[chunk] = sums[chunk] + unpack(blob) if chunk in sums else unpack(blob)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([pack(s) for s in sums.values()], pa.binary())], names=["chunk", "counts"])

    def pack(total):
        return zlib.compress(np.minimum(total, 2 ** 32 - 1).astype(np.uint32).tobytes(), 1)

    def whole(group: pa.Table) -> pa.Table:
        total = sum(unpack(b) for b in group.column("counts").to_pylist())
        return pa.table({"chunk": group.column("chunk")[:1], "counts": pa.array([pack(total)], pa.binary())})

    shape = "chunk int, counts binary"
    table = np.zeros(2 ** CELL_BITS, dtype=np.uint32)
    for row in parts.select("chunk", "counts").mapInArrow(merge, shape).groupBy("chunk").applyInArrow(whole, shape).collect():
        table[row.chunk * CHUNK:(row.chunk + 1) * CHUNK] = unpack(row.counts)
    return table


def nodes_of(docs: DataFrame, text: str, counts: np.ndarray) -> DataFrame:
    """(node, content, n, grams, smallest, hist) per distinct text with words; grams: the prefix, rare first."""
    def run(batches):
        codes, seen, table = Codes(), set(), shared.value
        for batch in batches:
            rows = []
            for value in pieces(batch.column(0)):
                grams = shingles(value, codes)
                key = content(value)
                if len(grams) and key not in seen:
                    seen.add(key)
                    order = np.lexsort((grams, table[(grams >> np.uint64(64 - CELL_BITS)).astype(np.int64)]))
                    rows.append((key, len(grams), grams[order[:prefix_length(len(grams))]].view(np.int64), grams[:SMALLEST].view(np.int64), histogram(grams)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[3] for r in rows], pa.list_(pa.int64())), pa.array([r[4] for r in rows], pa.binary())], names=["content", "n", "grams", "smallest", "hist"])

    shared = docs.sparkSession.sparkContext.broadcast(counts)
    found = small_batches(docs).select(text).mapInArrow(run, "content binary, n int, grams array<bigint>, smallest array<bigint>, hist binary")
    return written(found.dropDuplicates(["content"]).select(F.monotonically_increasing_id().alias("node"), "*"), "shingle-nodes")


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) that pass the length and the suffix filter, with n, m and the contents of both."""
    def run(batches):
        for batch in batches:
            n, m = (batch.column(i).to_pylist() for i in (2, 3))
            keep = [overlap_bound(x, y) >= least_overlap(p, q) for p, q, x, y in zip(n, m, batch.column(6).to_pylist(), batch.column(7).to_pylist())]
            yield pa.RecordBatch.from_arrays(batch.columns[:6], names=batch.schema.names[:6]).filter(pa.array(keep, pa.bool_()))

    left = nodes.select(F.col("node").alias("a"), "n", F.col("content").alias("ca"), F.col("hist").alias("ha"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("content").alias("cb"), F.col("hist").alias("hb"))
    both = pairs.join(left, "a").join(right, "b").where((4 * F.col("n") >= 3 * F.col("m")) & (4 * F.col("m") >= 3 * F.col("n")))
    kept = both.select("a", "b", "n", "m", "ca", "cb", "ha", "hb").mapInArrow(run, "a long, b long, n int, m int, ca binary, cb binary")
    return written(kept, "shingle-pairs")


def verified(pairs: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The pairs whose whole sets overlap enough. Sets are made only for texts whose bit in a fixed-size filter is set."""
    def run(batches):
        codes, seen, bits = Codes(), set(), shared.value
        for batch in batches:
            keys, sets = [], []
            for value in pieces(batch.column(0)):
                key = content(value)
                if key not in seen and passes(bits, KEY_BITS, np.array([int.from_bytes(key[:8], "big")], dtype=np.uint64))[0]:
                    seen.add(key)
                    keys.append(key)
                    sets.append(shingles(value, codes).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["content", "grams"])

    lead = F.conv(F.hex(F.substring("content", 1, 8)), 16, -10).cast("long")
    wanted = pairs.select(F.col("ca").alias("content")).union(pairs.select("cb")).distinct().select(lead.alias("hash"))
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted, KEY_BITS))
    sets = small_batches(docs).select(text).mapInArrow(run, "content binary, grams array<bigint>").dropDuplicates(["content"])
    sets = written(sets, "shingle-sets")
    common = F.size(F.array_intersect("ga", "gb"))
    return (pairs.join(sets.select(F.col("content").alias("ca"), F.col("grams").alias("ga")), "ca")
            .join(sets.select(F.col("content").alias("cb"), F.col("grams").alias("gb")), "cb")
            .where(7 * common >= 3 * (F.col("n") + F.col("m"))).select("a", "b"))


def star_pairs(nodes: DataFrame) -> DataFrame:
    """Each node with the leader (smallest node) of each of its smallest hashes, and with the next NEXT nodes of the same
    hash and salt; of these, pairs of like length that share most of their smallest hashes. In a large group of copies
    every node so meets a few dozen others, whatever the size of the group."""
    def alike(x, y):
        shared = F.size(F.array_intersect(x["smallest"], y["smallest"]))
        return ((x["node"] != y["node"]) & (4 * F.least(x["n"], y["n"]) >= 3 * F.greatest(x["n"], y["n"]))
                & (shared * 8 >= 5 * F.least(F.size(x["smallest"]), F.size(y["smallest"]))))

    rows = nodes.select(F.struct("node", "n", "smallest").alias("x"), F.explode("smallest").alias("value"))
    leaders = rows.groupBy("value").agg(F.min("x").alias("y"), F.count("*").alias("c")).where("c > 1").drop("c")
    inside = Window.partitionBy("value", F.pmod(F.hash("value", "x.node"), F.lit(SALTS))).orderBy("x.node")
    later = F.array(*[F.lead("x", i).over(inside) for i in range(1, NEXT + 1)])
    near = F.filter("later", lambda y: y.isNotNull() & alike(F.col("x"), y))
    chains = rows.select("x", later.alias("later")).select("x", F.explode(near).alias("y"))
    both = rows.join(leaders, "value").where(alike(F.col("x"), F.col("y"))).select("x", "y").union(chains)
    return both.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()


def contested(nodes: DataFrame) -> DataFrame:
    """Prefix shingles (hash) that rows of different roots hold. nodes: root, grams.

    A task sends each shingle once, with the smallest and largest root it saw, packed by bucket; the number of buckets
    follows the number of prefix rows.
    """
    total = nodes.agg(F.coalesce(F.sum(F.size("grams")), F.lit(0))).first()[0]
    buckets = max(16, -(-total // BUCKET_ROWS))
    step = np.uint64(2 ** 64 // buckets + 1)

    def pack(batches):
        grams, roots, held = [], [], 0
        for batch in batches:
            lists = batch.column(1)
            grams.append(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            roots.append(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)))
            held += len(grams[-1])
            if held > SENT_ROWS:
                yield from send(np.concatenate(grams), np.concatenate(roots))
                grams, roots, held = [], [], 0
        if held:
            yield from send(np.concatenate(grams), np.concatenate(roots))

    def ranges(grams, low, high):
        order = np.argsort(grams, kind="stable")
        grams, low, high = grams[order], low[order], high[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        return grams[first], np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)

    def send(grams, roots):
        grams, low, high = ranges(grams, roots, roots)
        cut = np.searchsorted(grams // step, np.arange(buckets + 1, dtype=np.uint64))
        rows = [(i, slice(cut[i], cut[i + 1])) for i in range(buckets) if cut[i] < cut[i + 1]]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), *(pa.array([part[s].tobytes() for _, s in rows], pa.binary()) for part in (grams, low, high))],
                                         names=["bucket", "grams", "low", "high"])

    def find(group: pa.Table) -> pa.Table:
        grams, low, high = (np.concatenate([np.frombuffer(b, t) for b in group.column(c).to_pylist()]) for c, t in (("grams", np.uint64), ("low", np.int64), ("high", np.int64)))
        grams, low, high = ranges(grams, low, high)
        return pa.table({"hash": pa.array(grams[low != high].view(np.int64), pa.int64())})

    packed = nodes.select("root", "grams").mapInArrow(pack, "bucket int, grams binary, low binary, high binary")
    return packed.groupBy("bucket").applyInArrow(find, "hash long")


def prefix_pairs(nodes: DataFrame, hashes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different roots that share a prefix shingle and pass length and positional filter."""
    def run(batches):
        bits = shared.value
        for batch in batches:
            lists = batch.column(3)
            grams = lists.flatten().to_numpy(zero_copy_only=False)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            place = np.arange(len(grams)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            row = np.repeat(np.arange(len(lengths)), lengths)
            keep = np.flatnonzero(passes(bits, GRAM_BITS, grams.view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(grams[keep]), *(batch.column(i).take(pa.array(row[keep])) for i in range(3)), pa.array(place[keep].astype(np.int32))],
                                             names=["gram", "node", "root", "n", "place"])

    shared = nodes.sparkSession.sparkContext.broadcast(bit_filter(hashes, GRAM_BITS))
    rows = written(nodes.select("node", "root", "n", "grams").mapInArrow(run, "gram long, node long, root long, n int, place int"), "shingle-rows")
    major = (rows.groupBy("gram", "root").agg(F.count("*").alias("c")).groupBy("gram")
             .agg(F.max_by("root", F.struct("c", "root")).alias("major"), F.count("*").alias("roots")).where("roots > 1").drop("roots"))
    rows = written(rows.join(major, "gram"), "shingle-rows")
    few = rows.where("root <> major").select("gram", *[F.col(c).alias(f"{c}_1") for c in ("node", "root", "n", "place")])
    n, m = F.least("n", "n_1"), F.greatest("n", "n_1")
    first = F.struct("n", "node") < F.struct("n_1", "node_1")
    small_place = F.when(first, F.col("place")).otherwise(F.col("place_1"))
    rest = F.least(F.col("n") - F.col("place"), F.col("n_1") - F.col("place_1"))
    pairs = few.join(rows, "gram").where(
        (F.col("root") != F.col("root_1")) & ((F.col("root") == F.col("major")) | (F.col("node_1") < F.col("node")))
        & (4 * n >= 3 * m) & (small_place < index_length(n)) & (7 * rest >= 3 * (n + m)))
    return pairs.select(F.greatest("node", "node_1").alias("a"), F.least("node", "node_1").alias("b")).distinct()


def with_root(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row, its content digest and root (null for rows that take no part).

    component_id is the smallest doc_id that links reach. Null and empty texts and texts of white space have no shingles
    and link with nothing; texts of fewer words than a shingle are one shingle. Rows with a null doc_id take no part and
    have a null component. Rows that repeat a doc_id with another text are nodes of their own. Other columns are not
    read. An empty table gives no rows.
    """
    read = scan(docs.withColumn(key, F.col(key).cast("long")), key, text)
    rows = read.where("chunk is null").select("doc_id", "content", "n")
    used = docs.where(F.col(key).isNotNull())
    nodes = nodes_of(used, text, cell_counts(read.where("chunk is not null")))
    tried = likely(star_pairs(nodes), nodes)
    links = written(verified(tried, used, text), "shingle-links")
    roots = components(links)
    rooted = with_root(nodes, roots)
    found = prefix_pairs(rooted, written(contested(rooted), "shingle-contested"))
    fresh = likely(found.join(tried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), ["a", "b"], "left_anti"), nodes)
    more = written(verified(fresh, used, text), "shingle-links")
    roots = written(components(links.union(more)), "shingle-roots")
    placed = with_root(nodes.select("node", "content"), roots).select("content", "root")
    known = written(rows.where("doc_id is not null and n > 0").join(placed, "content"), "shingle-placed")
    least = known.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = known.join(least, "root").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "content", "root")
    alone = rows.where("doc_id is null or n = 0").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), "content",
        F.lit(None).cast("long").alias("root"))
    return linked.union(alone)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs with the smallest doc_id of their component, one for each component, with all their columns.

    Rows with a null doc_id and texts without words stay. Of rows that repeat doc_id and text one stays. Columns may have
    any names; an empty table stays empty.
    """
    kept = (classes(docs, key, text).where("root is not null").groupBy("root")
            .agg(F.min(F.struct("doc_id", "content")).alias("first")))
    kept = kept.select(F.col("first.doc_id").alias("kept_id"), F.lower(F.hex("first.content")).alias("kept_content"))
    rows, called = renamed(docs)
    own_key, own_text = F.col(called[key.lower()]), F.coalesce(F.col(called[text.lower()]), F.lit(""))
    marked = rows.withColumn("content", F.md5(own_text.cast("binary")))
    stay = (marked.join(kept, (own_key == F.col("kept_id")) & (F.col("content") == F.col("kept_content")))
            .dropDuplicates(["kept_id", "kept_content"]))
    alone = own_key.isNull() | ~own_text.rlike(WORD)
    return stay.select(*own_names(docs)).union(rows.where(alone).select(*own_names(docs)))


ORACLE_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
side AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT x, y FROM side UNION SELECT reach.x, side.y FROM reach JOIN side ON side.x = reach.y)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS low FROM reach GROUP BY 1) USING (doc_id)"""
