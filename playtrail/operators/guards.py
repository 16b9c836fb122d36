"""Row predicates of the cleaning jobs. All are Columns, so callers may filter or route."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import blank, int_of, is_number
from .lookup import Dimension, lookup

# Channel ids kept out of the agency flow, the game id from which a
# record carries a game channel, and the web-pay game that is always rejected.
OVERSEAS_CHANNELS = ("6001", "10081", "10082", "10085", "10086", "10087", "10088", "10089",
                     "10099", "10100", "10107")
OWN_CHANNELS = ("199", "8084", "10033", "10081", "10082", "10085", "10086", "10087", "10088",
                "10089", "10099", "10100", "10107", "10133", "10150", "10151", "10157", "10162",
                "6001")
GAME_CHANNEL_FROM = 63
WEB_PAY_GAME = "100000011"


def threshold_guard(game_id: Column, game_channel_id: Column, threshold: int = GAME_CHANNEL_FROM) -> Column:
    """False for games from ``threshold`` on that come without a game channel."""
    big = F.coalesce(game_id.try_cast("int"), F.lit(0)) >= threshold
    return ~(big & blank(game_channel_id))


def agent_guard(agent: Column, game_id: Column, channel_id: Column, game_channel_id: Column,
                digits: bool = False) -> Column:
    named = is_number(game_id) & ~blank(game_id) if digits else ~blank(game_id)
    return F.coalesce(agent.isNotNull() & named & ~(blank(channel_id) & blank(game_channel_id)), F.lit(False))


def channel_guard(platform: Column, ad_id: Column, game_id: Column) -> Column:
    return platform.isNotNull() & ~blank(ad_id) & ~blank(game_id)


def sdk_guard(sdk: Column, app_id: Column) -> Column:
    return sdk.isNotNull() & ~blank(app_id)


def old_login_guard(parsed: Column, game_id: Column, channel_id: Column, server_ts: Column) -> Column:
    return parsed & game_id.isNotNull() & channel_id.isNotNull() & (F.coalesce(server_ts, F.lit(0)) > 0)


def not_in(channel_id: Column, ids: tuple[str, ...] = OVERSEAS_CHANNELS) -> Column:
    return ~F.coalesce(channel_id, F.lit("")).isin(*ids)


def exclude_ids(df: DataFrame, column: str, excluded: Dimension) -> DataFrame:
    """Rows whose id is not in a table of ids."""
    flagged = lookup(df, excluded, [F.col(column)], {}, found="_excluded")
    return flagged.where(~F.col("_excluded")).drop("_excluded")


def member(df: DataFrame, column: Column, members: Dimension, out: str) -> DataFrame:
    """Add a flag: does the id occur in the table of ids."""
    return lookup(df, members, [column], {}, found=out)


LOWEST = 1 << 31  # what makes every INT a number from 0 on


def test_server_rules(df: DataFrame, game: str = "game_id", servers: str = "test_server") -> DataFrame:
    """Rule rows (game, exact server | lo..hi) from arrays mixing texts and {start,end} objects."""
    each = df.select(F.col(game).alias("game_id"), F.explode(
        F.from_json(F.col(servers), "array<string>")).alias("_item"))
    span = F.from_json(F.when(F.col("_item").startswith("{"), F.col("_item")), "start string, end string")
    out = each.select("game_id", F.when(~F.col("_item").startswith("{"), F.col("_item")).alias("server"),
                      span.alias("_s"))
    return out.select("game_id", "server", int_of(F.col("_s.start")).alias("lo"), int_of(F.col("_s.end")).alias("hi"),
                      F.col("_s").isNotNull().alias("ranged"))


@dataclass
class ServerRules:
    """Rules of test orders: those of most games packed, one row a game; those of games with very many as blocks."""

    packed: Dimension
    blocks: DataFrame | None

    def dimensions(self) -> list[Dimension]:
        return [self.packed]


def range_blocks(lo: Column, hi: Column) -> Column:
    """The aligned blocks that together cover lo to hi: array of (level, block), block ``b`` of level ``n`` being the
    numbers from ``b << n`` on, ``1 << n`` of them. A range has at most two blocks a level."""
    none = F.array().cast("array<struct<level:int,block:bigint>>")

    def step(acc: Column, level: Column) -> Column:
        left, right = acc["left"], acc["right"]
        odd, even = left % 2 == 1, right % 2 == 0
        one = lambda at, found: F.when(found & (left <= right), F.array(F.struct(level.alias("level"), at.alias("block"))))
        more = F.concat(F.coalesce(one(left, odd), none), F.coalesce(one(right, even), none))
        return F.struct(F.floor((left + F.when(odd, 1).otherwise(0)) / 2).cast("bigint").alias("left"),
                        F.floor((right - F.when(even, 1).otherwise(0)) / 2).cast("bigint").alias("right"),
                        F.concat(acc["out"], more).alias("out"))

    # numbers are shifted to begin at 0, so that halves of odd and even are the same for all
    start = F.struct((lo.cast("bigint") + LOWEST).alias("left"), (hi.cast("bigint") + LOWEST).alias("right"), none.alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(32)), start, step, lambda acc: acc["out"])


def packed_test_rules(rules: DataFrame, most: int = 1000) -> ServerRules:
    """Rules (game, exact server | lo..hi) as a dimension with one row per game.

    Games with more than ``most`` rules do not become a row: their ranges are cut into aligned blocks and their rules go
    by equal keys, so that a game may have any number of them.
    """
    counts = rules.groupBy("game_id").agg(F.count("*").alias("_n"))
    many = counts.where(F.col("_n") > most).select("game_id")
    big = None if many.isEmpty() else rules.join(many, "game_id", "left_semi")
    few = rules if big is None else rules.join(many, "game_id", "left_anti")
    packed = few.groupBy("game_id").agg(
        F.collect_set("server").alias("servers"),
        F.collect_set(F.when(F.col("ranged"), F.struct("lo", "hi"))).alias("spans"))
    if big is not None:
        exact = big.where(F.col("server").isNotNull()).select("game_id", F.lit(-1).alias("level"), F.col("server").alias("place"))
        cut = big.where(F.col("ranged") & (F.col("lo") <= F.col("hi"))).select("game_id", F.inline(range_blocks(F.col("lo"), F.col("hi"))))
        big = exact.union(cut.select("game_id", "level", F.col("block").cast("string"))).distinct()
    return ServerRules(Dimension(packed, ["game_id"], ["servers", "spans"], "test_rules"), big)


def flag_test_orders(df: DataFrame, rules: ServerRules, game: str = "game_id", server: str = "server",
                     out: str = "is_test_order") -> DataFrame:
    """Exact server or inside a range of the game; a server that is no number is no range match."""
    found = lookup(df, rules.packed, [F.col(game)], {"_servers": "servers", "_spans": "spans"}, default=None)
    number = F.col(server).try_cast("int")
    hit = F.array_contains("_servers", F.col(server)) | F.exists(
        "_spans", lambda s: number.between(s["lo"], s["hi"]))
    flagged = found.withColumn(out, F.coalesce(hit, F.lit(False))).drop("_servers", "_spans")
    if rules.blocks is None:
        return flagged
    # every server of a game is looked up once, under its text and under the block of each level that holds its number
    asked = df.select(F.col(game).cast("string").alias("game_id"), F.col(server).alias("server")).where("server IS NOT NULL").distinct()
    at = F.col("server").try_cast("int").cast("bigint") + LOWEST
    levels = F.transform(F.sequence(F.lit(0), F.lit(32)), lambda n: F.struct(
        n.alias("level"), F.floor(at / F.pow(F.lit(2.0), n)).cast("bigint").cast("string").alias("place")))
    places = F.concat(F.array(F.struct(F.lit(-1).alias("level"), F.col("server").alias("place"))), F.when(at.isNotNull(), levels).otherwise(F.array()))
    hits = (asked.select("game_id", "server", F.inline(places)).join(rules.blocks, ["game_id", "level", "place"], "left_semi")
            .select("game_id", "server").distinct())
    many = Dimension(hits, ["game_id", "server"], ["server"], "test_servers")
    again = lookup(flagged, many, [F.col(game), F.col(server)], {}, found="_many")
    return again.withColumn(out, F.col(out) | F.col("_many")).drop("_many")


def test_order_rows(df: DataFrame, rules: DataFrame, game: str = "game_id", server: str = "server") -> DataFrame:
    """Only the test orders."""
    return flag_test_orders(df, packed_test_rules(rules), game, server, "_test").where("_test").drop("_test")


def order_states(table: Column, pay_status: Column, status: Column) -> Column:
    """Placed (0, 1) or paid (1, 2) rows of the order table."""
    placed = (pay_status == 0) & (status == 1)
    done = (pay_status == 1) & (status == 2)
    return (table == "order") & (placed | done)


def user_inserts(table: Column, kind: Column) -> Column:
    return (table == "user") & (kind == "INSERT")


def new_user_cohort(df: DataFrame, game_channel_id: str, dates: list[str]) -> DataFrame:
    """Device ids of users registered on the day of the row, for chosen days and one channel."""
    keep = ((F.col("reg_date") == F.col("server_date_day")) & (F.col("game_channel_id") == game_channel_id)
            & F.col("reg_date").isin(*dates))
    return df.where(keep).select("reg_date", "android_imei")


def has_error(columns: list[str]) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, [F.col(c) == "error" for c in columns]), F.lit(False))


