"""The dimension tables of the enrichment jobs, deduplicated with the last row winning."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field as dc_field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookup import Dimension, dimension, measure

OVERSEAS_PLATFORMS = ("4", "5")


Source = DataFrame | Callable[[], DataFrame] | None


def belong_game_rows(df: DataFrame, platforms: tuple[str, ...] | None) -> DataFrame:
    """An own game may map to several channels; overseas only given platforms count."""
    return df if platforms is None else df.where(F.col("sub_pf").isin(*platforms))


def rate_rows(df: DataFrame) -> DataFrame:
    """(from, to, rate) rows -> one row per currency with its CNY and USD rate."""
    cny, usd = F.col("to_currency") == "CNY", F.col("to_currency") == "USD"
    return (df.where(cny | usd).groupBy(F.col("from_currency").alias("currency"))
            .agg(F.max_by(F.when(cny, F.col("exchange_rate")), F.when(cny, F.col("pos"))).alias("cny_rate"),
                 F.max_by(F.when(usd, F.col("exchange_rate")), F.when(usd, F.col("pos"))).alias("usd_rate")))


@dataclass
class Dims:
    """All lookups of one run. Every source frame has a ``pos`` column giving its order.

    A source is a frame or a function giving one, called when its lookup is first used.
    """

    game_channel_rows: Source = None    # game_id, channel_id, game_channel_id, pos
    agent_game: Source = None           # game_id, company_id, pos
    agent_channel: Source = None        # channel_id, pf, pos
    sub_channel_rows: Source = None     # sub_channel_id, channel_id, pos
    old_game_channel: Source = None     # channel_id, game_channel_id, pos
    belong_game: Source = None          # belong_game_id, ..., sub_pf, pos
    special_set: Source = None          # game_channel_id
    rates: Source = None                # from_currency, to_currency, exchange_rate, pos
    packages: Source = None             # game_id, package_name, pos
    platforms: tuple[str, ...] | None = None
    bounds: dict = dc_field(default_factory=dict)
    _made: dict = dc_field(default_factory=dict, repr=False)

    def _rows(self, name: str) -> DataFrame:
        source = getattr(self, name)
        if source is None:
            raise ValueError(f"no source given for {name}")
        return source() if callable(source) else source

    def _get(self, name: str, make) -> Dimension:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    @property
    def channel_of(self) -> Dimension:
        """(game, game channel) -> channel."""
        return self._get("channel_of", lambda: dimension(
            self._rows("game_channel_rows"), ["game_id", "game_channel_id"], ["channel_id"], "pos",
            "channel_of", **self.bounds))

    @property
    def game_channel_of(self) -> Dimension:
        """(game, channel) -> game channel."""
        return self._get("game_channel_of", lambda: dimension(
            self._rows("game_channel_rows"), ["game_id", "channel_id"], ["game_channel_id"], "pos",
            "game_channel_of", **self.bounds))

    @property
    def by_game_channel(self) -> Dimension:
        """game channel -> (channel, game)."""
        return self._get("by_game_channel", lambda: dimension(
            self._rows("game_channel_rows"), ["game_channel_id"], ["channel_id", "game_id"], "pos",
            "by_game_channel", **self.bounds))

    @property
    def company(self) -> Dimension:
        return self._get("company", lambda: dimension(
            self._rows("agent_game"), ["game_id"], ["company_id"], "pos", "company", **self.bounds))

    @property
    def os(self) -> Dimension:
        return self._get("os", lambda: dimension(
            self._rows("agent_channel"), ["channel_id"], ["pf"], "pos", "os", **self.bounds))

    @property
    def sub_channel(self) -> Dimension:
        return self._get("sub_channel", lambda: dimension(
            self._rows("sub_channel_rows"), ["sub_channel_id"], ["channel_id"], "pos", "sub_channel",
            **self.bounds))

    @property
    def old_channel(self) -> Dimension:
        return self._get("old_channel", lambda: dimension(
            self._rows("old_game_channel"), ["channel_id"], ["game_channel_id"], "pos", "old_channel",
            **self.bounds))

    @property
    def belong(self) -> Dimension:
        return self._get("belong", lambda: dimension(
            belong_game_rows(self._rows("belong_game"), self.platforms), ["belong_game_id"],
            ["game_channel_id", "channel_id", "game_id"], "pos", "belong", **self.bounds))

    @property
    def special(self) -> Dimension:
        return self._get("special", lambda: Dimension(
            self._rows("special_set").select("game_channel_id").distinct(), ["game_channel_id"],
            ["game_channel_id"], "special", **self.bounds))

    @property
    def rate(self) -> Dimension:
        return self._get("rate", lambda: Dimension(
            rate_rows(self._rows("rates")), ["currency"], ["cny_rate", "usd_rate"], "rate", **self.bounds))

    @property
    def package_game(self) -> Dimension:
        return self._get("package_game", lambda: dimension(
            self._rows("packages"), ["package_name"], ["game_id"], "pos", "package_game", **self.bounds))

    def measured(self, *names: str, also: tuple[Dimension | None, ...] = ()) -> "Dims":
        """Measure the named and the given dimensions in one job before a plan uses them."""
        measure([getattr(self, n) for n in names] + [d for d in also if d is not None])
        return self


def snapshot_rows(df: DataFrame, schema: str) -> DataFrame:
    """Rows of the newest snapshot whose ``{"content":[...]}`` text parses.

    ``df`` has ``name, version, value``; a broken newest copy falls back to an older one.
    """
    parsed = df.select("name", "version", F.from_json("value", f"content array<{schema}>").alias("doc"))
    good = parsed.where(F.col("doc.content").isNotNull())
    newest = good.groupBy("name").agg(F.max_by("doc", "version").alias("doc"),
                                      F.max("version").alias("version"))
    return (newest.select("name", "version", F.posexplode("doc.content").alias("pos", "row"))
            .select("name", "version", "pos", "row.*"))
