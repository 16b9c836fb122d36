"""Channel, game, company, os and currency resolution.

Every cascade joins its few dimensions once and decides with one ``when``
chain, so a whole cascade is one stage while the dimensions are broadcast.
Keys are separate columns, never glued text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import blank, is_number
from .dims import Dims
from .guards import GAME_CHANNEL_FROM, OVERSEAS_CHANNELS, WEB_PAY_GAME, agent_guard, not_in
from .lookup import Dimension, lookup

ERROR = "error"

# Text names of overseas games and their ids.
GAME_ALIASES = {
    "hw_csgj": "100000000", "hw_hwdzz": "100000001", "hw_djcz": "100000002",
    "hw_csgjhwb": "100000003", "hw_lzdl": "100000004", "hw_csgjhwbfoyo": "100000005",
    "hw_lzdlhwb": "100000006", "hw_tw_lzdl": "100000007", "hw_tw_lzdl3": "100000008",
    "hw_tw_lzdl4": "100000009", "hw_jt_wyfx": "100000010", "hw_web_pay": "100000011",
    "hw_tw_lzdl5": "100000012", "hw_tw_android_yjqy": "100000013", "hw_tw_ios_yjqy": "100000014",
    "hw_sgqj": "100000015", "hw_tw_ios_sgqj": "100000016", "hw_wzsy": "100000017",
    "hw_hw_android_HWwzsy": "100000018", "hw_hw_tw_android_HW_jyqy": "100000019",
    "hw_csssj": "100000020", "hw_XJZZ": "100000021", "hw_xjzz_standalone": "100000022",
    "hw_hw_tw_google_xjzz": "100000023", "hw_hw_tw_standalone_xjzz": "100000024",
    "hw_hw_tw_standalone_sgqj_test": "100000025", "hw_hw_tw_google": "100000026",
    "hw_hw_tw_google_sgqj": "100000027", "hw_hw_tw_standalone_sgqj": "100000028",
    "hw_hw_tw_ios_xjzz": "100000029",
}


def game_alias(game: Column, aliases: dict[str, str] | None = None) -> Column:
    """Game id of a text name; an unknown name passes through."""
    table = GAME_ALIASES if aliases is None else aliases
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, game), game)


def alias_lookup(df: DataFrame, game: str, aliases: Dimension) -> DataFrame:
    """The same from a caller's table (alias, game_id)."""
    found = lookup(df, aliases, [F.col(game)], {"_game": "game_id"}, default=None)
    return found.withColumn(game, F.coalesce("_game", game)).drop("_game")


def _agency_parts(df: DataFrame, dims: Dims, game: Column, channel: Column, game_channel: Column) -> DataFrame:
    """All lookups the agency cascades need, under ``_``-names."""
    given = df.select("*", game.alias("_g"), channel.alias("_c"), game_channel.alias("_gc"))
    effective = F.when(F.col("_is_sub"), F.col("_sub")).otherwise(F.col("_c"))

    def by_sub(frame: DataFrame) -> DataFrame:
        found = lookup(frame, dims.sub_channel, [F.col("_c")], {"_sub": "channel_id"}, found="_is_sub", counted=given)
        return found.withColumn("_eff", effective)

    work = lookup(given, dims.channel_of, [F.col("_g"), F.col("_gc")], {"_ch_of_gc": "channel_id"}, counted=given)
    work = by_sub(work)
    work = lookup(work, dims.old_channel, [F.col("_c")], {"_old_gc": "game_channel_id"}, counted=given)
    return lookup(work, dims.game_channel_of, [F.col("_g"), F.col("_eff")], {"_gc_of_ch": "game_channel_id"},
                  counted=None if dims.game_channel_of.small else by_sub(given.select("_g", "_c")))


# the lookups of the agency cascades, to be measured together
AGENCY_DIMS = ("channel_of", "sub_channel", "old_channel", "game_channel_of", "os", "company")

_PARTS = ["_g", "_c", "_gc", "_ch_of_gc", "_sub", "_is_sub", "_old_gc", "_eff", "_gc_of_ch"]


def _sub_game_channel() -> Column:
    """Game channel of a sub-channel: its own old one, else by the resolved channel."""
    return F.when(F.col("_old_gc") == ERROR, F.col("_gc_of_ch")).otherwise(F.col("_old_gc"))


def resolve_login(df: DataFrame, dims: Dims, *, agent: Column, game_id: Column, channel_id: Column,
                  game_channel_id: Column, strict: bool = True) -> DataFrame:
    """Agency logins: fills channel_id, game_channel_id, os_type, company_id, ``resolved``.

    A blank channel comes from the game channel; a blank (or ``0``) game channel
    from the channel, by way of the sub-channel tables. ``strict`` keeps the
    record check in force together with the exclusion of overseas channels.
    """
    dims.measured(*AGENCY_DIMS)
    guard = agent_guard(agent, game_id, channel_id, game_channel_id)
    work = _agency_parts(df.select("*", guard.alias("_guard")), dims, game_id,
                         F.coalesce(channel_id, F.lit("")), F.coalesce(game_channel_id, F.lit("")))
    no_channel, no_game_channel = F.col("_c") == "", F.col("_gc").isin("", "0")
    by_channel = ~no_channel & no_game_channel
    work = lookup(work, dims.os, [F.when(by_channel, F.col("_eff"))], {"_os": "pf"})
    work = lookup(work, dims.company, [F.col("_g")], {"_company": "company_id"})
    channel = (F.when(no_channel, F.col("_ch_of_gc")).when(by_channel, F.col("_eff")).otherwise(F.col("_c")))
    gc = F.when(by_channel, F.when(F.col("_is_sub"), _sub_game_channel()).otherwise(F.col("_gc_of_ch"))) \
        .otherwise(F.col("_gc"))
    use = lambda c, raw: F.when(F.col("_guard"), c).otherwise(raw)
    out = {"channel_id": use(channel, F.col("_c")), "game_channel_id": use(gc, F.col("_gc")),
           "os_type": F.when(F.col("_guard") & by_channel, F.col("_os")).otherwise(F.lit("")),
           "company_id": use(F.col("_company"), F.lit(""))}
    done = _emit(work, out, _PARTS + ["_os", "_company"])
    outside = not_in(F.col("channel_id"), OVERSEAS_CHANNELS)
    return (done.withColumn("resolved", F.col("_guard") & outside if strict else outside).drop("_guard"))


def resolve_order(df: DataFrame, dims: Dims, *, game_id: Column, column: Column) -> DataFrame:
    """Agency orders: ``column`` is a game channel for games from 63 on, else a (sub-)channel."""
    dims.measured(*AGENCY_DIMS)
    number = game_id.try_cast("int")
    valid = F.coalesce(number, F.lit(-1)) != -1
    work = _agency_parts(df.select("*", valid.alias("resolved"), (number >= GAME_CHANNEL_FROM).alias("_big")),
                         dims, number.cast("string"), column, column)
    channel = F.when(F.col("_big"), F.col("_ch_of_gc")).otherwise(F.col("_eff"))
    gc = F.when(F.col("_big"), F.col("_gc")).otherwise(
        F.when(F.col("_is_sub"), _sub_game_channel()).otherwise(F.col("_gc_of_ch")))
    work = work.withColumn("_channel", channel)
    work = lookup(work, dims.os, [F.col("_channel")], {"_os": "pf"})
    work = lookup(work, dims.company, [F.col("_g")], {"_company": "company_id"})
    out = {"channel_id": F.col("_channel"), "game_channel_id": gc, "os_type": F.col("_os"),
           "company_id": F.col("_company")}
    return _emit(work, out, _PARTS + ["_big", "_channel", "_os", "_company"])


def resolve_old_login(df: DataFrame, dims: Dims, *, game_id: Column, channel_id: Column,
                      game_channel_id: Column) -> DataFrame:
    """Old login files: rows without a game channel run through the order cascade.

    A game id that is no number is treated like the games from 63 on; no fallback
    from the old sub-channel table to the channel.
    """
    dims.measured("channel_of", "sub_channel", "old_channel", "game_channel_of", "os")
    digits = is_number(game_id) & ~blank(game_id)
    big = ~digits | (game_id.try_cast("int") >= GAME_CHANNEL_FROM)
    work = df.select("*", big.alias("_big"), (F.coalesce(game_channel_id, F.lit("")) == "").alias("_open"),
                     game_channel_id.alias("_own_gc"))
    work = _agency_parts(work, dims, game_id, channel_id, channel_id)
    channel = F.when(F.col("_big"), F.col("_ch_of_gc")).otherwise(F.col("_eff"))
    gc = F.when(F.col("_big"), F.col("_gc")).otherwise(
        F.when(F.col("_is_sub"), F.col("_old_gc")).otherwise(F.col("_gc_of_ch")))
    work = work.withColumn("_channel", F.when(F.col("_open"), channel).otherwise(F.col("_c")))
    work = lookup(work, dims.os, [F.when(F.col("_open"), F.col("_channel"))], {"_os": "pf"})
    out = {"channel_id": F.col("_channel"),
           "game_channel_id": F.when(F.col("_open"), gc).otherwise(F.col("_own_gc")),
           "sub_pf": F.when(F.col("_open"), F.col("_os")).otherwise(F.lit(""))}
    return _emit(work, out, _PARTS + ["_big", "_open", "_own_gc", "_channel", "_os"])


def resolve_active(df: DataFrame, dims: Dims, *, game_id: Column, game_channel_id: Column) -> DataFrame:
    """Activations: small games carry a (sub-)channel, others a game channel that gives channel and game."""
    dims.measured("sub_channel", "game_channel_of", "by_game_channel", "company")
    number = F.coalesce(game_id.try_cast("int"), F.lit(-1))
    given = game_channel_id.try_cast("int").cast("string")
    small = number < GAME_CHANNEL_FROM
    work = df.select("*", small.alias("_small"), number.cast("string").alias("_g"), given.alias("_gc"),
                     (F.coalesce(given, F.lit("0")) != "0").alias("resolved"))
    work = lookup(work, dims.sub_channel, [F.col("_gc")], {"_sub": "channel_id"}, found="_is_sub")
    work = work.withColumn("_ch", F.when(F.col("_is_sub"), F.col("_sub")).otherwise(F.col("_gc")))
    work = lookup(work, dims.game_channel_of, [F.col("_g"), F.col("_ch")], {"_gc_of": "game_channel_id"})
    work = lookup(work, dims.by_game_channel, [F.col("_gc")], {"_bch": "channel_id", "_bg": "game_id"})
    work = work.withColumn("_game", F.when(F.col("_small"), F.col("_g")).otherwise(F.col("_bg")))
    work = lookup(work, dims.company, [F.col("_game")], {"_company": "company_id"})
    out = {"channel_id": F.when(F.col("_small"), F.col("_ch")).otherwise(F.col("_bch")),
           "game_channel_id": F.when(F.col("_small"), F.col("_gc_of")).otherwise(F.col("_gc")),
           "game_id": F.col("_game"), "company_id": F.col("_company")}
    return _emit(work, out, ["_small", "_g", "_gc", "_sub", "_is_sub", "_ch", "_gc_of", "_bch", "_bg",
                             "_game", "_company"])


# Mark of an own game in coin logs, and the game channel left untouched.
OWN_GAME_MARK, UNTOUCHED_GAME_CHANNEL = "SA", "2050"


def resolve_coin(df: DataFrame, dims: Dims) -> DataFrame:
    """Coin trades: own games replace the whole triple; ``2050`` stays; else by game id."""
    dims.measured("channel_of", "sub_channel", "old_channel", "game_channel_of", "belong")
    work = _agency_parts(df, dims, F.col("game_id"), F.col("channel_id"), F.col("game_channel_id"))
    work = lookup(work, dims.belong, [F.col("_g")],
                  {"_ogc": "game_channel_id", "_och": "channel_id", "_og": "game_id"}, found="_owned")
    own = F.col("_g").contains(OWN_GAME_MARK) | F.col("_owned")
    kept = F.col("_gc") == UNTOUCHED_GAME_CHANNEL
    number = F.col("_g").try_cast("int")
    small, big = number < GAME_CHANNEL_FROM, number >= GAME_CHANNEL_FROM
    small_gc = F.when(F.col("_is_sub"), _sub_game_channel()).otherwise(F.col("_gc_of_ch"))
    out = {
        "game_id": F.when(own, F.col("_og")).otherwise(F.col("_g")),
        "channel_id": F.when(own, F.col("_och")).when(kept, F.col("_c")).when(small, F.col("_eff"))
        .when(big, F.col("_ch_of_gc")).otherwise(F.col("_c")),
        "game_channel_id": F.when(own, F.col("_ogc")).when(kept, F.col("_gc")).when(small, small_gc)
        .otherwise(F.col("_gc")),
        "resolved": (F.col("_g") != "") & (own | kept | number.isNotNull())}
    return _emit(work, out, _PARTS + ["_ogc", "_och", "_og", "_owned"])


def resolve_own(df: DataFrame, dims: Dims, *, game_id: Column, aliases: dict[str, str] | None = None) -> DataFrame:
    """Own-channel records: belong game -> app_id, channel_id, game_channel_id, company_id."""
    dims.measured("belong", "company")
    work = df.select("*", game_alias(game_id, aliases).alias("_own"))
    work = lookup(work, dims.belong, [F.col("_own")],
                  {"_ogc": "game_channel_id", "_och": "channel_id", "_og": "game_id"})
    work = lookup(work, dims.company, [F.col("_og")], {"_company": "company_id"})
    out = {"app_id": F.col("_og"), "channel_id": F.col("_och"), "game_channel_id": F.col("_ogc"),
           "company_id": F.col("_company")}
    return _emit(work, out, ["_own", "_ogc", "_och", "_og", "_company"])


def own_login_kept(event: Column, in_set: Column, non_login: str = "keep") -> Column:
    """Own-channel logins count only inside the special set; other events by choice."""
    if non_login not in ("keep", "drop"):
        raise ValueError("non_login is 'keep' or 'drop'")
    return F.when(event == "login", in_set).otherwise(F.lit(non_login == "keep"))


def game_app_swap(game: Column, rejected: str = WEB_PAY_GAME) -> tuple[Column, Column]:
    """(rebuilt game struct, ok): game_id and app_id change places, other fields stay."""
    swapped = F.struct(game["app_id"].alias("game_id"), game["game_id"].alias("app_id"),
                       *[F.coalesce(game[c], F.lit("")).alias(c) for c in ("game_ver", "game_name", "company_id")])
    return swapped, F.coalesce(game["game_id"], F.lit("")) != rejected


def fx_convert(df: DataFrame, dims: Dims, currency: Column, amount: Column) -> DataFrame:
    """Add cny_amount and usd_amount; a currency without a rate counts one to one."""
    work = df.select("*", amount.alias("_amount"))
    work = lookup(work, dims.rate, [currency], {"_cny": "cny_rate", "_usd": "usd_rate"}, default=None)
    out = {"cny_amount": F.coalesce("_cny", F.lit(1.0)) * F.col("_amount"),
           "usd_amount": F.coalesce("_usd", F.lit(1.0)) * F.col("_amount")}
    return _emit(work, out, ["_amount", "_cny", "_usd"])


def _emit(work: DataFrame, out: dict[str, Column], drop: list[str]) -> DataFrame:
    kept = [F.col(f"`{c}`") for c in work.columns if c not in out and c not in drop]
    return work.select(*kept, *[c.alias(n) for n, c in out.items()])


