"""Scalar coercions for records whose fields change type from row to row.

``field`` reads one path of a VARIANT document together with its type; the
``as_*`` functions give the fixed type with the documented stand-in for a
missing value. Text that should be a number but is not becomes NULL, which the
callers turn into a reject.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import times

INT_MAX = 2147483647


class Field:
    """One path of a VARIANT document."""

    def __init__(self, doc: Column, path: str):
        self.doc, self.path = doc, path
        self.kind = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))

    def get(self, kind: str) -> Column:
        return F.try_variant_get(self.doc, self.path, kind)

    @property
    def is_text(self) -> Column:
        return F.coalesce(self.kind == "STRING", F.lit(False))

    @property
    def is_whole(self) -> Column:
        return F.coalesce(self.kind == "BIGINT", F.lit(False))

    @property
    def is_fraction(self) -> Column:
        return F.coalesce((self.kind == "DOUBLE") | self.kind.startswith("DECIMAL"), F.lit(False))

    @property
    def is_flag(self) -> Column:
        return F.coalesce(self.kind == "BOOLEAN", F.lit(False))


def field(doc: Column, *names: str) -> Field:
    """``field(doc, 'user', 'user_id')`` reads a second-level field."""
    return Field(doc, "$." + ".".join(names))


def as_string(f: Field) -> Column:
    return (F.when(f.is_text | f.is_whole, f.get("string"))
            .when(f.is_fraction, f.get("double").cast("string"))
            .otherwise(F.lit("")))


def as_int(f: Field) -> Column:
    return (F.when(f.is_text, f.get("string").try_cast("int"))
            .when(f.is_whole | f.is_fraction, f.get("double").try_cast("int"))
            .otherwise(F.lit(-1)))


def as_long(f: Field) -> Column:
    return (F.when(f.is_text, f.get("string").try_cast("bigint"))
            .when(f.is_whole, f.get("bigint"))
            .when(f.is_fraction, f.get("double").try_cast("bigint"))
            .otherwise(F.lit(0).cast("bigint")))


def as_double(f: Field) -> Column:
    return (F.when(f.is_text, f.get("string").try_cast("double"))
            .when(f.is_whole | f.is_fraction, f.get("double"))
            .otherwise(F.lit(0.0)))


def as_int_string(f: Field) -> Column:
    """Whole-number text: the fraction of a double is dropped."""
    return (F.when(f.is_text | f.is_whole, f.get("string"))
            .when(f.is_fraction, F.split_part(f.get("double").cast("string"), F.lit("."), F.lit(1)))
            .otherwise(F.lit("0")))


as_long_string = as_int_string


def as_double_string(f: Field) -> Column:
    text = f.get("string")
    return (F.when(f.is_text, F.when(text.contains("."), text).otherwise(F.concat(text, F.lit(".0"))))
            .when(f.is_whole, F.concat(text, F.lit(".0")))
            .when(f.is_fraction, f.get("double").cast("string"))
            .otherwise(F.lit("0.0")))


def as_boolean(f: Field) -> Column:
    return F.when(f.is_flag, f.get("boolean")).otherwise(F.lit(False))


def as_epoch(f: Field, pattern: str = times.FULL, tz: str = times.DEFAULT_TZ) -> Column:
    return (F.when(f.is_text, epoch_of_text(f.get("string"), pattern, tz))
            .when(f.is_whole, epoch_of_number(f.get("bigint")))
            .otherwise(F.lit(0).cast("bigint")))


def epoch_of_number(value: Column) -> Column:
    """Values above the INT range are milliseconds."""
    return F.when(value > INT_MAX, F.floor(value / 1000).cast("bigint")).otherwise(value.cast("bigint"))


def epoch_of_text(text: Column, pattern: str = times.FULL, tz: str = times.DEFAULT_TZ) -> Column:
    """Ten digits are seconds, other digits milliseconds, the rest is formatted text; blank is 0."""
    return (F.when(F.coalesce(text, F.lit("")) == "", F.lit(0).cast("bigint"))
            .when(text.rlike("^[0-9]{10}$"), text.try_cast("bigint"))
            .when(text.rlike("^[0-9]+$"), F.floor(text.try_cast("bigint") / 1000).cast("bigint"))
            .otherwise(times.parse(text, pattern, tz)))


def epoch_of_leaf(leaf: Column, pattern: str = times.FULL, tz: str = times.DEFAULT_TZ) -> Column:
    """Leaf written as a JSON number: seconds or, above the INT range, milliseconds; else text."""
    return (F.when(leaf.rlike("^[0-9]+$"), epoch_of_number(leaf.try_cast("bigint")))
            .otherwise(epoch_of_text(leaf, pattern, tz)))


# ---- the same stand-ins for leaves already read as STRING (NULL when missing) ----

def text_of(leaf: Column) -> Column:
    return F.coalesce(leaf, F.lit(""))


def int_of(leaf: Column) -> Column:
    return F.when(leaf.isNull(), F.lit(-1)).otherwise(leaf.try_cast("double").try_cast("int"))


def long_of(leaf: Column) -> Column:
    whole = leaf.try_cast("bigint")
    return (F.when(leaf.isNull(), F.lit(0).cast("bigint"))
            .otherwise(F.coalesce(whole, leaf.try_cast("double").try_cast("bigint"))))


def double_of(leaf: Column) -> Column:
    return F.when(leaf.isNull(), F.lit(0.0)).otherwise(leaf.try_cast("double"))


def int_string_of(leaf: Column) -> Column:
    return F.when(leaf.isNull(), F.lit("0")).otherwise(leaf)


def is_number(text: Column) -> Column:
    """All digits; the empty text passes."""
    return text.rlike("^[0-9]*$")


def blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def unquoted(text: Column) -> Column:
    return F.translate(text, '"', "")
