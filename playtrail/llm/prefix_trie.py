"""Prefix trie of conversations: union-find over the LCP edges of sorted neighbours.

A turn becomes an entry of fixed width, 16 bytes of a digest of role and text and 8 bytes for the length of the text; a
conversation becomes the path of its entries. Equal paths become one row with their ids in bounded blocks, so that a
conversation with a third of all copies is a few rows. Paths are range-partitioned and sorted; neighbours are joined by
edges as deep as their common prefix. In a partition the edges are taken in descending depth: union-find joins the two
components, every join at a new depth is a branching node, and the turns between two branching nodes are a chain.

Nodes that reach into a neighbouring partition lie on two spines only: the prefixes that the first path shares with the
path before it, and those that the last path shares with the path behind. A partition's forest is contracted to these:
everything below is already summed into them. A node counts what happens once (its text, its place among its parent's
children) only in the partition where it starts, so that equal spine nodes of different partitions merge by adding up.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import written

ENTRY = 24  # bytes of a turn in a path
TEXT_DIGITS = 16  # hex digits of the length of its text, at the end
PART_ROWS, PART_BYTES = 1 << 16, 1 << 23  # of paths that a partition is meant to get
BLOCK_BITS = 16  # ids that agree above these bits share a block
NO_ENDS = hashlib.sha256(b"").hexdigest()


def sequences(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, turns): the entries of each conversation, in hex, by turn (null first), equal turns by digest.

    Null roles and texts are empty; rows without conversation have no place. A conversation is one row of 48 characters
    a turn, which bounds it at some 40 million turns.
    """
    role, text = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    entry = F.concat(F.substring(digest, 1, 2 * ENTRY - TEXT_DIGITS), F.lpad(F.lower(F.hex(F.char_length(text))), TEXT_DIGITS, "0"))
    rows = chats.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("c"), F.struct(F.col(turn).alias("turn"), entry.alias("entry")).alias("e"))
    return rows.groupBy("c").agg(F.sort_array(F.collect_list("e")).alias("e")).select("c", F.col("e.entry").alias("turns"))


def regrouped(chats: DataFrame, shared: int = 6, span: int = 100) -> DataFrame:
    """(c, turns) of sequences() in which c begins with the first h turns of c - c % span, h = crc32(c) % shared, and goes
    on with its own turns after its first h."""
    h = F.crc32(F.col("c").cast("string").cast("binary")) % shared
    heads = chats.where(F.col("c") % span == 0).select(F.col("c").alias("top"), F.slice("turns", 1, shared - 1).alias("head"))
    rows = chats.withColumn("h", h.cast("int")).withColumn("top", F.col("c") - F.col("c") % span).join(heads, "top", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return rows.select("c", F.concat(head, own).alias("turns"))


def common(a: bytes, b: bytes) -> int:
    """Entries that both paths begin with."""
    low, high = 0, min(len(a), len(b)) // ENTRY
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[ENTRY * low:ENTRY * mid] == b[ENTRY * low:ENTRY * mid] else (low, mid - 1)
    return low


def spine(path: bytes, depth: int) -> list[bytes]:
    """Digests of the path's prefixes of 0 to `depth` entries."""
    made, out = hashlib.sha256(), []
    for d in range(depth + 1):
        out.append(made.digest())
        made.update(path[ENTRY * d:ENTRY * (d + 1)])
    return out


class Component:
    """Neighbouring paths joined so far, with the node that covers them all, of which more may become known."""

    __slots__ = ("left", "right", "depth", "n", "least", "ends", "children", "leaves", "saved", "waiting")

    def __init__(self, i: int, depth: int, n: int, least: int, ends: str):
        self.left = self.right = i
        self.depth, self.n, self.least, self.ends = depth, n, least, ends
        self.children = self.leaves = self.saved = 0  # children that start here; sums below the node
        self.waiting: list[int] = []  # nodes whose parent it is


class Forest:
    """The nodes of one partition's sorted distinct paths."""

    def __init__(self, paths: list[bytes], counts: list[tuple[int, int, str]], before: bytes | None, after: bytes | None):
        self.paths = paths
        self.shared_left = common(before, paths[0]) if before is not None else -1
        self.shared_right = common(paths[-1], after) if after is not None else -1
        self.keys_left, self.keys_right = spine(paths[0], self.shared_left), spine(paths[-1], self.shared_right)
        self.nodes: list[tuple] = []
        self.parents: list[int] = []
        self.counts = counts

    def closed(self, x: Component, depth: int) -> None:
        """Writes the node of x and the chain above it, down to `depth`, which x then stands below."""
        path = self.paths[x.left]
        while x.depth > depth:
            d = x.depth
            chars = int.from_bytes(path[ENTRY * d - TEXT_DIGITS // 2:ENTRY * d]) if d else 0
            starts = not (x.left == 0 and d <= self.shared_left)
            goes_on = x.right == len(self.paths) - 1 and d <= self.shared_right
            x.leaves += x.children == 0 and not goes_on and d * ENTRY == len(path)
            x.saved += chars * (x.n - starts)
            key = self.keys_left[d] if not starts else self.keys_right[d] if goes_on else None
            for child in x.waiting:
                self.parents[child] = len(self.nodes)
            x.waiting = [len(self.nodes)]
            self.nodes.append((d, x.least, x.n, x.children, x.leaves, x.saved, x.ends, key))
            self.parents.append(-1)
            x.depth, x.children, x.ends = d - 1, int(starts), None

    def joined(self, a: Component, b: Component, depth: int) -> Component:
        """One component of two neighbours; its node is at `depth`."""
        self.closed(a, depth)
        self.closed(b, depth)
        big, small = (a, b) if len(a.waiting) >= len(b.waiting) else (b, a)
        big.left, big.right, big.least = min(a.left, b.left), max(a.right, b.right), min(a.least, b.least)
        big.n, big.children, big.leaves, big.saved = a.n + b.n, a.children + b.children, a.leaves + b.leaves, a.saved + b.saved
        big.ends = a.ends or b.ends
        big.waiting += small.waiting
        return big

    def grown(self):
        """(nodes, parents): depth, least, n, children, leaves, saved, ends and key of each; the key marks spine nodes."""
        paths = self.paths
        held = [Component(i, len(p) // ENTRY, *c) for i, (p, c) in enumerate(zip(paths, self.counts))]
        roots = list(range(len(paths)))

        def find(i):
            while roots[i] != i:
                roots[i] = i = roots[roots[i]]
            return i

        edges = [common(a, b) for a, b in zip(paths, paths[1:])]
        size = [1] * len(paths)
        for i in sorted(range(len(edges)), key=edges.__getitem__, reverse=True):
            a, b = find(i), find(i + 1)
            whole = self.joined(held[a], held[b], edges[i])
            a, b = (a, b) if size[a] >= size[b] else (b, a)
            roots[b], size[a] = a, size[a] + size[b]
            held[a], held[b] = whole, None
        self.closed(held[find(0)], -1)
        return self.nodes, self.parents


NODES = pa.schema([("part", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                   ("saved_tokens", pa.int64()), ("ends", pa.string()), ("spine", pa.binary()), ("parent_conv_id", pa.int64()), ("parent_spine", pa.binary())])
NODE_TYPES = "part long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, spine binary, parent_conv_id long, parent_spine binary"


def node_rows(part: int, forest: Forest):
    nodes, parents = forest.grown()
    for start in range(0, len(nodes), 50_000):
        some = nodes[start:start + 50_000]
        above = [nodes[p] if p >= 0 else None for p in parents[start:start + 50_000]]
        columns = [[part] * len(some), *zip(*some), [a and (a[1] if a[7] is None else None) for a in above], [a and a[7] for a in above]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, NODES.types)], schema=NODES)


def grow(batches):
    """Rows sorted by part, kind, path and block to the nodes of each part; a block at a time is held beside the paths."""
    part = before = after = made = None
    paths, counts = [], []

    def close():
        if made is not None:
            counts[-1] = (*counts[-1][:2], made.hexdigest())

    def finished():
        close()
        if paths:
            yield from node_rows(part, Forest(paths, counts, before, after))

    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                yield from finished()
                part, before, after, made, paths, counts = row["part"], None, None, None, [], []
            if row["kind"] == 0:
                before, after = row["before"], row["after"]
                continue
            if not paths or paths[-1] != row["path"]:
                close()
                paths.append(row["path"])
                counts.append((0, row["least"], ""))
                made = hashlib.sha256()
            else:
                made.update(b",")
            made.update(row["ids"].encode())
            counts[-1] = (counts[-1][0] + row["n"], min(counts[-1][1], row["least"]), "")
    yield from finished()


def trie(chats: DataFrame) -> DataFrame:
    """The nodes of (c, turns): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Every distinct sequence of first d turns is a node, the root (depth 0) among them. conv_id is the smallest c below,
    saved_tokens sums (n_convs - 1) * length of the last text over the subtree, ends_sha256 is of the c that end at the
    node, ascending, joined by commas. c is distinct. Conversations without turns end at the root; an empty table has no
    nodes. The ids that end at one node are hashed in order by one task, in blocks: a hash of a list has no other way.
    """
    path = F.unhex(F.array_join("turns", ""))
    blocks = written(chats.select(path.alias("path"), "c", F.shiftright("c", BLOCK_BITS).alias("block")).groupBy("path", "block").agg(
        F.count("*").alias("n"), F.min("c").alias("least"), F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",").alias("ids")), "trie-blocks")
    rows, size = blocks.agg(F.count("*"), F.sum(F.octet_length("path"))).first()
    parts = 1 + max(rows // PART_ROWS, (size or 0) // PART_BYTES)
    ranged = written(blocks.repartitionByRange(parts, "path").withColumn("part", F.spark_partition_id().cast("long")), "trie-ranges")
    edge = Window.orderBy("part")  # over one row a partition
    ends = ranged.groupBy("part").agg(F.min("path").alias("low"), F.max("path").alias("high")).select(
        "part", F.lag("high").over(edge).alias("before"), F.lead("low").over(edge).alias("after"))
    marked = ranged.withColumn("kind", F.lit(1)).unionByName(ends.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    made = written(marked.repartition(parts, "part").sortWithinPartitions("part", "kind", "path", "block")
                   .select("part", "kind", "path", "n", "least", "ids", "before", "after").mapInArrow(grow, NODE_TYPES), "trie-nodes")
    on_spine = F.col("spine").isNotNull()
    merged = written(made.where(on_spine).groupBy("spine").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends").alias("ends"), F.max("parent_spine").alias("parent_spine")), "trie-spines")
    named = merged.select(F.col("spine").alias("parent_spine"), F.col("conv_id").alias("parent_conv_id"))
    local = made.where(on_spine).select("part", F.col("spine").alias("parent_spine")).distinct().join(named, "parent_spine")
    inner = made.where(~on_spine)
    out = [merged.join(named, "parent_spine", "left"), inner.where(F.col("parent_spine").isNull()),
           inner.where(F.col("parent_spine").isNotNull()).drop("parent_conv_id").join(local, ["part", "parent_spine"])]
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")]
    return out[0].select(*columns).union(out[1].select(*columns)).union(out[2].select(*columns))


ORACLE_SQL = """WITH t AS (SELECT conv_id, length(coalesce(text, '')) AS chars, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS p FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id AS c, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 6 AS h FROM t),
r AS (SELECT c, 0 AS half, p, k, chars FROM ids JOIN t ON t.conv_id = c - c % 100 AND p <= h UNION ALL SELECT c, 1, p, k, chars FROM ids JOIN t ON t.conv_id = c AND p > h),
s AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY half, p) AS d FROM r),
pre AS (SELECT c, d, string_agg(k, '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS path, chars FROM s UNION ALL SELECT c, 0, '', 0 FROM ids),
node AS (SELECT path, d, any_value(chars) AS chars, min(c) AS conv_id, count(*) AS n FROM pre GROUP BY path, d),
kids AS (SELECT substr(path, 1, 64 * (d - 1)) AS path, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
ends AS (SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS h FROM (SELECT * FROM pre QUALIFY d = max(d) OVER (PARTITION BY c)) GROUP BY path),
below AS (SELECT substr(path, 1, 64 * up) AS path, sum(leaf) AS n_leaves, sum(saved) AS saved FROM (
  SELECT node.path, unnest(range(node.d + 1)) AS up, CASE WHEN kids.path IS NULL THEN 1 ELSE 0 END AS leaf, (n - 1) * chars AS saved FROM node LEFT JOIN kids ON node.path = kids.path) GROUP BY 1)
SELECT node.conv_id, node.d AS depth, above.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, coalesce(ends.h, sha256('')) AS ends_sha256 FROM node JOIN below ON node.path = below.path LEFT JOIN kids ON node.path = kids.path
  LEFT JOIN ends ON node.path = ends.path LEFT JOIN node above ON above.d = node.d - 1 AND above.path = substr(node.path, 1, 64 * (node.d - 1))"""
