"""Left lookups into dimensions of any size.

A dimension is broadcast only after its row count and bytes were measured and
found below the bound. Beyond the bound the lookup shuffles on the key, with
the keys that hold more than ``hot_rows`` rows taken out of the shuffle: there
are at most ``rows / hot_rows`` of them, so their dimension rows are few enough
to broadcast, and the rows themselves stay spread over all tasks.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field as dc_field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 4_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
# what all broadcast dimensions of a job may take together, once hashed
BROADCAST_TOTAL = 512 * 1024 * 1024
ROW_BYTES = 64
HOT_ROWS = 2_000_000
MAX_AGE = 600.0


@dataclass
class Dimension:
    """A deduplicated lookup table: unique ``keys`` -> ``values``."""

    df: DataFrame
    keys: list[str]
    values: list[str]
    name: str = "dim"
    broadcast_rows: int = BROADCAST_ROWS
    broadcast_bytes: int = BROADCAST_BYTES
    hot_rows: int = HOT_ROWS
    _small: bool | None = dc_field(default=None, repr=False)
    _measured: float = dc_field(default=0.0, repr=False)

    @property
    def small(self) -> bool:
        if self._small is None:
            measure([self])
        return self._small


def measure(dims: list[Dimension]) -> None:
    """One job that counts the rows and bytes of the dimensions of a job.

    Each has its own bound; of those below it the smallest ones are broadcast as long as all together stay below
    BROADCAST_TOTAL. A measure older than MAX_AGE seconds is taken again, so a stream notices a dimension that grows.
    """
    now = time.monotonic()
    if all(d._small is not None and now - d._measured < MAX_AGE for d in dims):
        return
    open_dims = list({id(d): d for d in dims}.values())
    parts = []
    for i, d in enumerate(open_dims):
        width = reduce(lambda a, b: a + b,
                       [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
                        for c in d.keys + d.values])
        parts.append(d.df.agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("n"),
                              F.coalesce(F.sum(width), F.lit(0)).cast("bigint").alias("b")))
    taken = 0
    for row in sorted(reduce(DataFrame.unionAll, parts).collect(), key=lambda r: (r["b"], r["i"])):
        d = open_dims[row["i"]]
        held = row["b"] + row["n"] * ROW_BYTES
        d._small = row["n"] <= d.broadcast_rows and row["b"] <= d.broadcast_bytes and taken + held <= BROADCAST_TOTAL
        d._measured = now
        taken += held if d._small else 0


def last_wins(df: DataFrame, keys: list[str], values: list[str], position: str) -> DataFrame:
    """One row per key: the values found at the highest position."""
    packed = F.max_by(F.struct(*values), F.col(position)).alias("_v")
    return (df.groupBy(*keys).agg(packed)
            .select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values]))


def dimension(df: DataFrame, keys: list[str], values: list[str], position: str,
              name: str = "dim", **bounds: int) -> Dimension:
    return Dimension(last_wins(df, keys, values, position), keys, values, name, **bounds)


def lookup(df: DataFrame, dim: Dimension, on: list[Column], out: dict[str, str],
           default: str | None = "error", found: str | None = None,
           counted: DataFrame | None = None) -> DataFrame:
    """Add ``out`` (new column -> dimension value) for the key expressions ``on``.

    Rows without a match get ``default``; ``found`` names an optional match flag.
    Row count never changes because the dimension keys are unique. ``counted`` is an
    earlier frame with the same rows and keys: hot keys are counted on it, so that a
    chain of large lookups does not run its first part again for each of them.
    """
    keyed = df.select("*", *[c.cast("string").alias(f"_k{i}") for i, c in enumerate(on)])
    names = [f"_k{i}" for i in range(len(on))]
    side = dim.df.select(*[F.col(k).cast("string").alias(n) for k, n in zip(dim.keys, names)],
                         F.struct(*[F.col(v) for v in dict.fromkeys(out.values())],
                                  F.lit(True).alias("_hit")).alias("_v"))
    if dim.small:
        joined = keyed.join(F.broadcast(side), names, "left")
    else:
        source = keyed if counted is None else counted.select(
            *[c.cast("string").alias(n) for n, c in zip(names, on)])
        joined = _spread_join(keyed, side, names, hot_keys(source.na.drop(subset=names), names, dim.hot_rows))
    new = [(F.col(f"_v.{v}") if default is None
            else F.coalesce(F.col(f"_v.{v}"), F.lit(default))).alias(c) for c, v in out.items()]
    if found:
        new.append(F.coalesce(F.col("_v._hit"), F.lit(False)).alias(found))
    replaced = set(out) | ({found} if found else set())
    kept = [c for c in df.columns if c not in replaced]
    return joined.select(*[F.col(f"`{c}`") for c in kept], *new)


def hot_keys(keyed: DataFrame, names: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and into how many parts each is to be cut; map-side combine."""
    return (keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
            .select(*names, F.ceil(F.col("_n") / hot_rows).cast("bigint").alias("_parts")))


def _spread_join(keyed: DataFrame, side: DataFrame, names: list[str], hot: DataFrame) -> DataFrame:
    hot_side = (hot.select(*names).join(side, names, "left")
                .select(*names, F.struct(F.col("_v")).alias("_h")))
    first = keyed.join(F.broadcast(hot_side), names, "left")
    # NULL keys never match and hot keys are already served: both only need a place to go
    served = F.col("_h").isNotNull() | reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
    place = F.xxhash64(*[F.col(f"`{c}`") for c in keyed.columns if not _is_map(keyed, c)])
    # the other rows go by their keys: a constant here would leave the join, and served rows would go by their keys again
    first = first.select("*", F.when(served, place).otherwise(F.xxhash64(*names)).alias("_p"))
    cold = side.select(*[F.col(n).alias("_c" + n) for n in names], F.col("_v").alias("_w"), F.xxhash64(*names).alias("_q"))
    match = reduce(lambda a, b: a & b, [F.col(n) == F.col("_c" + n) for n in names])
    # _p takes part in the shuffle key, so served rows spread over all partitions
    joined = first.join(cold, match & (F.col("_p") == F.col("_q")), "left")
    value = F.when(F.col("_h").isNotNull(), F.col("_h._v")).otherwise(F.col("_w"))
    return joined.select(*[F.col(f"`{c}`") for c in keyed.columns], value.alias("_v"))


def _is_map(df: DataFrame, name: str) -> bool:
    text = df.schema[name].dataType.simpleString()
    return "map<" in text or "variant" in text
