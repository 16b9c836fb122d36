"""Centroid clustering with exact integers: bit planes of 64 components and weighted AND-popcounts.

A vector of 64 integers is held as the bit planes of its two's complement: plane i packs bit i of all components into
one uint64, the last plane is the sign. Plane i weighs 2 ** i, the sign plane -2 ** i, so that
x.c = sum over planes (i, j) of w_i * w_j * popcount(x_i AND c_j), and |x - c|^2 = x.x - 2 x.c + c.c exactly. A vector has
as many planes as its largest component needs. Vectors are packed once into a table in the shared folder; a round
reads it, assigns every vector in its task and counts, per centroid and plane, the members that have each bit set:
centroids * planes rows of 64 numbers reach the driver, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import written
from .neighbours import matrix

WIDTH = 64  # components of a vector, bits of a word
EXACT = 52  # two vectors of fewer planes together give products and distances that int64 holds


def planes_of(values) -> list[int]:
    """Bit planes of 64 integers, lowest first, the sign last; as unsigned 64-bit words."""
    n = max(1, max(int(v if v >= 0 else ~v).bit_length() for v in values) + 1)
    return [sum((int(v) >> i & 1) << d for d, v in enumerate(values)) for i in range(n)]


def packed(values: np.ndarray) -> np.ndarray:
    """Rows of 64 int64 values to rows of words, one a plane, for values that need at most as many planes as given."""
    n = 1 + int(np.where(values >= 0, values, ~values).max(initial=0)).bit_length()
    bits = (values[:, None, :] >> np.arange(n)[None, :, None] & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")[:, :, 0]


def weights(n: int) -> list[int]:
    return [1 << i for i in range(n - 1)] + [-(1 << (n - 1))]


def product(planes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Dot products of rows of planes with one vector's planes: weighted popcounts of their ANDs."""
    kind = np.int64 if planes.shape[1] + len(other) <= EXACT else object
    total = np.zeros(len(planes), dtype=kind)
    for j, b in zip(weights(len(other)), other):
        counts = np.bitwise_count(planes & b).astype(kind)
        total += counts @ np.array(weights(planes.shape[1]), dtype=kind) * j
    return total


def squares(planes: np.ndarray) -> np.ndarray:
    """Each row's product with itself."""
    kind = np.int64 if 2 * planes.shape[1] <= EXACT else object
    total = np.zeros(len(planes), dtype=kind)
    for j, w in enumerate(weights(planes.shape[1])):
        counts = np.bitwise_count(planes & planes[:, j:j + 1]).astype(kind)
        total += counts @ np.array(weights(planes.shape[1]), dtype=kind) * w
    return total


def nearest_centroid(planes: np.ndarray, centroids: list[list[int]]):
    """Number of the nearest centroid of each row, the smaller of equals, and the squared distance."""
    own, best, number = squares(planes), None, np.zeros(len(planes), dtype=np.int64)
    for k, c in enumerate(centroids):
        c = np.array(planes_of(c), dtype=np.uint64)
        kind = np.int64 if 2 * max(planes.shape[1], len(c)) <= EXACT else object
        far = own.astype(kind) - 2 * product(planes, c).astype(kind) + squares(c[None]).astype(kind)[0]
        closer = (far < best).astype(bool) if best is not None else np.ones(len(planes), dtype=bool)
        best = np.where(closer, far, best) if best is not None else far
        number = np.where(closer, k, number)
    return number, best


def by_planes(column):
    """(positions, rows of words) of an Arrow list column, one entry for each number of planes."""
    offsets = column.offsets.to_numpy()
    words = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    sizes = np.diff(offsets)
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        yield rows, words[(offsets[rows] - offsets[0])[:, None] + np.arange(n)]


def pack(vectors: DataFrame, vec: str, scale: int) -> DataFrame:
    """The rows that can be clustered, with `planes` (array<long>) in place of the vector."""
    def run(batches):
        for batch in batches:
            values = matrix(batch.column(1), WIDTH)
            scaled = np.floor(values * scale)
            small = np.abs(scaled).max(axis=1, initial=0) < 2 ** 52
            words = [None] * len(values)
            for i, row in zip(np.flatnonzero(small), narrow(scaled[small].astype(np.int64))):
                words[i] = row
            for i in np.flatnonzero(~small):  # beyond the integers that a double counts one by one: int() is exact
                words[i] = np.array(planes_of([int(x) * scale if abs(x) >= 2 ** 52 else int(np.floor(x * scale)) for x in values[i]]), np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.int64()))], names=["id", "planes"])

    def narrow(values):
        """Each row with no more planes than it needs: what follows the sign is the sign again."""
        words = packed(values) if len(values) else np.empty((0, 1), np.uint64)
        needed = np.frexp(np.where(values >= 0, values, ~values).max(axis=1, initial=0).astype(float))[1] + 1
        return [row[:n].view(np.int64) for row, n in zip(words, needed)]

    v = F.col(vec).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(F.coalesce((F.size(v) == WIDTH) & finite, F.lit(False)))
    return kept.select("id", v.alias("v")).mapInArrow(run, f"id {vectors.schema['id'].dataType.simpleString()}, planes array<bigint>")


def components_of(planes: list[int]) -> list[int]:
    words = [p % (1 << 64) for p in planes]
    return [sum(w * (p >> d & 1) for w, p in zip(weights(len(words)), words)) for d in range(WIDTH)]


def new_centroids(table: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Floor of the mean of each centroid's vectors, from counts of set bits; empty ones stay."""
    def count(batches):
        for batch in batches:
            out = []
            for rows, words in by_planes(batch.column(0)):
                number, _ = nearest_centroid(words, centroids)
                for k in np.unique(number).tolist():
                    members = words[number == k]
                    bits = np.unpackbits(members.astype("<u8").view(np.uint8).reshape(*members.shape, 8), axis=2, bitorder="little").sum(axis=0, dtype=np.int64)
                    out += [(k, i if i < len(bits) - 1 else -1 - i, len(members), *row) for i, row in enumerate(bits.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * (WIDTH + 3), names=names)

    names = ["cluster", "plane", "n", *[f"c{d}" for d in range(WIDTH)]]
    counts = (table.select("planes").mapInArrow(count, ", ".join(f"{n} long" for n in names))
              .groupBy("cluster", "plane").agg(*[F.sum(n).alias(n) for n in names[2:]]))
    sums, sizes = [[0] * WIDTH for _ in centroids], [0] * len(centroids)
    for k, plane, n, *bits in counts.collect():  # at most centroids * planes rows
        if plane < 0:  # every vector has one sign plane
            sizes[k] += n
        weight = 1 << plane if plane >= 0 else -(1 << (-1 - plane))
        sums[k] = [s + weight * b for s, b in zip(sums[k], bits)]
    return [[s // n for s in row] if n else old for row, n, old in zip(sums, sizes, centroids)]


def cluster(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", k: int = 8, rounds: int = 10,
            scale: int = 1024, seed: str = "3") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector of 64 finite components.

    Components become floor(scale * x). The first centroids are the k vectors with the smallest sha256 of `seed:key`; of
    equal keys the smaller planes come first, null keys come last. A round assigns every vector to its nearest centroid
    (ties: the smaller number) and replaces every centroid that has vectors by the floor of their mean.

    Vectors that are null, of another length or hold null or non-finite components give no row. Repeated rows and null
    keys count as rows; with fewer than k rows there are fewer centroids; an empty table gives no rows. Other columns are
    not read. All numbers are exact; a distance or sum too large for a long is null.
    """
    def assign(batches):
        for batch in batches:
            number, far = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=object)
            for rows, words in by_planes(batch.column(1)):
                number[rows], far[rows] = nearest_centroid(words, centroids)
            far = pa.array([x if x < 1 << 63 else None for x in far.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int32()), far], names=["vec_id", "cluster", "distance"])

    ready = vectors.select(F.col(key).alias("id"), F.col(vec).alias("v"))
    table = written(pack(ready, "v", scale), "planes")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    start = table.orderBy(digest.asc_nulls_last(), "planes").limit(k).select("planes").collect()
    centroids = [components_of(r.planes) for r in start]
    for _ in range(rounds if centroids else 0):
        centroids = new_centroids(table, centroids)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    kind = ready.schema["id"].dataType.simpleString()
    found = written(table.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "assigned")
    whole = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(whole.alias("inertia")).collect()}  # k rows
    total = None if None in sums.values() else sum(sums.values())

    def held(value):
        return F.lit(int(value) if value is not None and value < 1 << 63 else None).cast("long")

    def of_cluster(values):
        out = F.lit(None)
        for n, value in values.items():
            out = F.when(F.col("cluster") == n, value).otherwise(out)
        return out

    return found.select("vec_id", "cluster", "distance", of_cluster({n: held(v) for n, v in sums.items()}).cast("long").alias("cluster_inertia"),
                        held(total).alias("inertia"), of_cluster({n: F.lit(names[n]) for n in sums}).cast("string").alias("centroid_sha256"))


def oracle_sql(k: int = 8, rounds: int = 10) -> str:
    """The same in SQL: one assignment and one update for each round."""
    near = """a{r} AS MATERIALIZED (SELECT vec_id, v, n, d FROM (SELECT x.rid, x.vec_id, x.v, c.n, list_sum(list_transform(range(1, 65), lambda i: (x.v[i] - c.c[i]) * (x.v[i] - c.c[i]))) AS d
  FROM x, c{r} c) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, n) = 1)"""
    move = """c{s} AS MATERIALIZED (SELECT c.n, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN (SELECT n, list(f ORDER BY i) AS c FROM (
  SELECT n, i, CAST(floor(sum(e) / count(*)) AS BIGINT) AS f FROM (SELECT n, unnest(v) AS e, unnest(range(64)) AS i FROM a{r}) GROUP BY n, i) GROUP BY n) m USING (n))"""
    steps = ["""x AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
             f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS n, v AS c FROM x ORDER BY n LIMIT {k})"]
    for r in range(rounds):
        steps += [near.format(r=r), move.format(r=r, s=r + 1)]
    return f"""WITH {', '.join([*steps, near.format(r=rounds)])}
SELECT a.vec_id, CAST(a.n AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.n) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c USING (n)"""


ORACLE_SQL = oracle_sql()
