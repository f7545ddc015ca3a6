"""JSON text in columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_json_text(value: Column) -> Column:
    """Array, map or struct as JSON; NULL stays NULL."""
    return F.to_json(value)


def metadata_json(metadata: Column) -> Column:
    """Metadata map as JSON; a missing map is `{}`."""
    empty = F.create_map().cast("map<string,string>")
    return F.to_json(F.coalesce(metadata, empty))


def metadata_value(metadata: Column, key: str) -> Column:
    """Value of one metadata key; NULL when the key or the map is absent."""
    return F.try_element_at(metadata, F.lit(key))


def parse_text_list(text: Column) -> Column:
    """List from JSON text, also when it was encoded twice.

    Blank, unreadable and missing text give an empty list; blank items go.
    """
    once = F.from_json(text, "array<string>")
    inner = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string")["v"]
    twice = F.from_json(inner, "array<string>")
    items = F.coalesce(once, twice, F.array().cast("array<string>"))
    return F.filter(items, lambda item: F.trim(item) != "")


def sorted_text(items: Column) -> Column:
    """A set as one comparable string."""
    return F.array_join(F.array_sort(items), ",")
