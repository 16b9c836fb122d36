"""IP address -> region.

Each range is listed once per block it touches, so the range search becomes an
equi-join on the block plus a bound check: no nested loop, no Python. Blocks are
/16, and smaller for more ranges, so that an address is held against a few ranges
however many there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import blank, unquoted
from .lookup import Dimension, hot_keys

BLOCK_BITS = 16
REGION = ["country", "province", "city"]


def ip_number(ip: Column) -> Column:
    """Dotted text as BIGINT; NULL unless it is four parts of 0-255."""
    parts = F.split(ip, r"\.")
    nums = [F.try_element_at(parts, F.lit(i)).try_cast("int") for i in (1, 2, 3, 4)]
    ok = reduce(lambda a, b: a & b, [n.between(0, 255) for n in nums]) & (F.size(parts) == 4)
    value = reduce(lambda a, b: a * 256 + b, [n.cast("bigint") for n in nums])
    return F.when(ok, value)


def ranges_from_upper_bounds(df: DataFrame, upper: str = "ip_hi") -> DataFrame:
    """Sorted upper bounds -> closed ranges, each starting after the bound before it.

    The neighbour comes from a window inside each /8 plus the last bound of the
    /8 blocks before it, so no task sorts the whole table.
    """
    first = F.shiftright(F.col(upper), 24)
    tops = df.groupBy(first.alias("_o")).agg(F.max(upper).alias("_top"))
    # at most 256 rows: one per first octet
    before = tops.select("_o", F.max("_top").over(
        Window.orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    inside = F.lag(upper).over(Window.partitionBy("_o").orderBy(upper))
    marked = df.withColumn("_o", first).withColumn("_prev", inside)
    joined = marked.join(F.broadcast(before), "_o", "left")
    low = F.coalesce(F.col("_prev"), F.col("_before"), F.lit(-1)) + 1
    return joined.withColumn("ip_lo", low.cast("bigint")).drop("_o", "_prev", "_before")


def block_bits(ranges: int) -> int:
    """Bits of an address inside a block: fewer than eight ranges for each block there is, and never larger than /16 blocks."""
    return min(BLOCK_BITS, max(4, 35 - max(ranges, 1).bit_length()))


def blocked_ranges(ranges: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """One row per (block, range). Full IPv4 coverage adds at most as many rows as there are blocks: 65,536 of /16."""
    blocks = F.sequence(F.shiftright("ip_lo", bits), F.shiftright("ip_hi", bits))
    return ranges.select(F.explode(blocks).alias("block"), "ip_lo", "ip_hi", *REGION)


@dataclass
class Regions(Dimension):
    """Ranges by blocks of ``bits`` bits."""

    bits: int = BLOCK_BITS


def region_dimension(ranges: DataFrame, **bounds: int) -> Dimension:
    """One job counts the ranges, which set the size of the blocks."""
    bits = block_bits(ranges.count())
    return Regions(blocked_ranges(ranges, bits), ["block", "ip_lo", "ip_hi"], REGION, "regions", bits=bits, **bounds)


def add_region(df: DataFrame, regions: Regions, ip: Column, fallback: Column | None = None,
               counted: DataFrame | None = None) -> DataFrame:
    """Add country, province and city; a blank ip uses ``fallback``, no match gives blanks.

    ``counted`` is an earlier frame with the same addresses: blocks with many rows are found on it, so that beyond the
    broadcast bound what was computed since does not run twice.
    """
    source = ip if fallback is None else F.when(blank(ip), fallback).otherwise(ip)
    kept = [c for c in df.columns if c not in REGION]
    block = F.shiftright("_ip", regions.bits).alias("_b")
    keyed = df.select(*[F.col(f"`{c}`") for c in kept], ip_number(source).alias("_ip")).select("*", block)
    side = regions.df.select(F.col("block").alias("_rb"), F.col("ip_lo").alias("_lo"),
                             F.col("ip_hi").alias("_hi"), *[F.col(c).alias("_r_" + c) for c in REGION])
    inside = F.col("_ip").between(F.col("_lo"), F.col("_hi"))
    if regions.small:
        joined = keyed.join(F.broadcast(side), (F.col("_b") == F.col("_rb")) & inside, "left")
    else:
        seen = keyed if counted is None else counted.select(ip_number(source).alias("_ip")).select(block)
        joined = _salted(keyed, side, inside, hot_keys(seen.where(F.col("_b").isNotNull()), ["_b"], regions.hot_rows))
    clean = [F.coalesce(unquoted(F.col("_r_" + c)), F.lit("")).alias(c) for c in REGION]
    return joined.select(*[F.col(f"`{c}`") for c in kept], *clean)


def _salted(keyed: DataFrame, side: DataFrame, inside: Column, hot: DataFrame) -> DataFrame:
    """Shuffle on (block, salt): only hot blocks, by their rows, and missing addresses are spread."""
    place = F.xxhash64(*[F.col(f"`{c}`") for c in keyed.columns])
    left = keyed.join(F.broadcast(hot), "_b", "left").select(
        "*", F.when(F.col("_b").isNull(), place).when(F.col("_parts").isNotNull(), F.pmod(place, F.col("_parts")))
        .otherwise(F.lit(0)).cast("bigint").alias("_s"))
    right = (side.join(F.broadcast(hot.withColumnRenamed("_b", "_rb")), "_rb", "left")
             .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1)).alias("_t")))
    return left.join(right.drop("_parts"), (F.col("_b") == F.col("_rb")) & (F.col("_s") == F.col("_t")) & inside,
                     "left")
