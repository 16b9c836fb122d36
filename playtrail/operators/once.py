"""Evaluate expensive columns exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, columns: dict[str, Column], kept: list[str] | None = None) -> DataFrame:
    """Add columns that later filters and projections read but never repeat.

    A filter on a parsed field is otherwise pushed below the projection that
    parses it, so the text would be parsed twice. A one-element generator keeps
    the order: parse, then filter. It is given finished columns: expressions in
    a generator would not be compiled.
    """
    names = df.columns if kept is None else kept
    made = {f"_once_{n}": c for n, c in columns.items()}
    done = df.select(*[F.col(f"`{n}`") for n in names], *[c.alias(n) for n, c in made.items()])
    one = F.array(F.struct(*[F.col(f"`_once_{n}`").alias(n) for n in columns]))
    return done.select(*[F.col(f"`{n}`") for n in names], F.inline(one))
