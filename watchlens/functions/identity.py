"""Identifiers, experiment groups and pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefixed_id(prefix: str, number: Column, width: int = 5) -> Column:
    """`prefix-00042`; numbers wider than `width` keep all their digits."""
    digits = number.cast("string")
    return F.concat(F.lit(f"{prefix}-"), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def code_point_sum(text: Column) -> Column:
    """Sum of the Unicode code points of a text."""
    characters = F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1))
    return F.aggregate(characters, F.lit(0), lambda total, character: total + F.ascii(character))


def ab_group(user_id: Column) -> Column:
    """Stable A/B label of a user: even code-point sum is A, odd is B."""
    return F.when(code_point_sum(user_id) % 2 == 0, "A").otherwise("B")


def pseudonym(user_id: Column, salt: str) -> Column:
    """Salted SHA-256 of a user id, as hex."""
    return F.sha2(F.concat(F.lit(salt), user_id), 256)
