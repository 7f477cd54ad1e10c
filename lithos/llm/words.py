"""Word splitting as Spark columns."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands between words made of ASCII letters, digits and any non-ASCII characters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, nothing else changed.

    ``lower`` does the same, faster, where no other character has a lower case.
    """
    others = text.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^A-Z]]")
    return F.when(others, F.translate(text, ascii_uppercase, ascii_lowercase)).otherwise(F.lower(text))


def words(text: Column) -> Column:
    """The words of a text in lower case; null has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP)
    return F.array_remove(parts, "")
