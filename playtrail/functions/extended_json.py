"""JSON texts in which numbers and times are written as objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The members that wrap a number or a time.
NUMBER = r'\{\s*"\$number(?:Long|Int|Double|Decimal)"\s*:\s*"\s*\+?(-?)0*([0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)\s*"\s*\}'
NO_NUMBER = r'\{\s*"\$number(?:Double|Decimal)"\s*:\s*("(?:[+-]?Infinity|NaN)")\s*\}'
DATE = r'\{\s*"\$date"\s*:\s*(-?[0-9]+|"[^"\\]*")\s*\}'


def plain_values(text: Column) -> Column:
    """The text with ``{"$numberLong": "5"}`` and its like as ``5``, ``{"$date": ..}`` as its milliseconds or its text.

    What is no finite number becomes text. In a JSON text these marks cannot stand inside a string, whose quotes are
    escaped, so the rewriting needs no parser; texts without such marks are only searched for one. The first search is for
    a character that is rare, unlike the quote that the marks begin with: each quote of a text would be compared with them.
    """
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, NUMBER, "$1$2"), NO_NUMBER, "$1"), DATE, "$1")
    marked = F.contains(text, F.lit("$")) & (F.contains(text, F.lit('"$number')) | F.contains(text, F.lit('"$date"')))
    return F.when(marked, plain).otherwise(text)
