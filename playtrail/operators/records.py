"""Whole JSON records: every field that came is kept, changed fields are laid over it.

A record is held as its entries, an array of (key, VARIANT): numbers, arrays and nested objects stay as they came. Of
equal keys the last one counts, as in the text. Each step is evaluated once per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.extended_json import plain_values
from .once import once  # noqa: F401

MEMBERS = "map<string,variant>"


def entries(text: Column) -> Column:
    """Members of a JSON object, wrapped numbers and times as plain ones; NULL when the text is none."""
    return F.map_entries(F.from_json(F.when(F.ltrim(text).startswith("{"), plain_values(text)), MEMBERS))


def _opened(items: Column, joined: bool) -> Column:
    def one(e: Column) -> Column:
        inner = F.map_entries(F.try_variant_get(e["value"], "$", MEMBERS))
        named = F.transform(inner, lambda f: F.struct(
            (F.concat(e["key"], F.lit("-"), f["key"]) if joined else f["key"]).alias("key"), f["value"].alias("value")))
        return F.coalesce(named, F.array(e))
    return F.flatten(F.transform(items, one))


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", MEMBERS).isNotNull()


def flat(items: Column, joined: bool = True) -> Column:
    """Nested objects as ``group-field`` entries, or under the leaf's name alone, at any depth. Arrays stay whole.

    Most records have groups of plain fields: opened once, nothing is left to open. Otherwise objects are opened again,
    as often as one of those left has opening braces, which is never less than its depth.
    """
    def deeper(found: Column) -> Column:
        braces = F.aggregate(found, F.lit(0), lambda n, e: F.when(_is_object(e["value"]), F.greatest(
            n, F.regexp_count(F.to_json(e["value"]), F.lit(r"\{")))).otherwise(n))
        again = F.aggregate(F.sequence(F.lit(1), braces), found, lambda left, _: _opened(left, joined))
        return F.when(F.exists(found, lambda e: _is_object(e["value"])), again).otherwise(found)
    return let(_opened(items, joined), deeper)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def with_record(df: DataFrame, out: str, items: Column, changed: dict[str, Column], otherwise: Column | None = None) -> DataFrame:
    """Add ``out``: the record as JSON text with the changed fields in place of those of the same name.

    A NULL leaves the field as it came. Rows without entries get ``otherwise``. What is evaluated per entry reads finished
    columns only: expressions inside a lambda are not compiled and would be evaluated again for each entry. Of equal
    names the last entry counts; only a record that repeats a name is searched for them.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    new = F.to_json(F.struct(*[c.alias(n) for n, c in changed.items()]), {"ignoreNullFields": "true"})
    unset = F.array(*[F.when(c.isNull(), F.lit(n)) for n, c in changed.items()])
    staged = df.select(*kept, items.alias("_came"), new.alias("_new"), unset.alias("_unset"))

    def stays(e: Column) -> Column:
        return ~e["key"].isin(*changed) | F.coalesce(F.array_contains("_unset", e["key"]), F.lit(False))

    names, count = F.col("_came.key"), F.size("_came")
    last = F.filter("_came", lambda e, i: stays(e) & ~F.array_contains(F.slice(names, i + 2, count), e["key"]))
    left = F.when(F.size(F.array_distinct(names)) == count, F.filter("_came", stays)).otherwise(last)
    staged = staged.select(*kept, "_new", F.to_json(F.map_from_entries(left)).alias("_left"))
    both = F.concat(F.substr("_left", F.lit(1), F.length("_left") - 1), F.lit(","), F.substr("_new", F.lit(2)))
    text = F.when(F.col("_left") == "{}", F.col("_new")).when(F.col("_new") == "{}", F.col("_left")).otherwise(both)
    text = text if otherwise is None else F.coalesce(text, otherwise)
    return staged.select(*[F.col(f"`{c}`") for c in df.columns if c != out], text.alias(out))
