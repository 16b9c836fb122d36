"""Digest forms and row identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_upper(text: Column) -> Column:
    return F.upper(F.md5(text))


def md5_lower(text: Column) -> Column:
    return F.md5(text)


def md5_base64(text: Column) -> Column:
    return F.base64(F.unhex(F.md5(text)))


def glued(*parts: Column) -> Column:
    """Texts one after the other, missing parts as empty text."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def row_identity(columns: list[str]) -> Column:
    """Stable id of a whole record: field order does not matter."""
    return md5_upper(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)])))
