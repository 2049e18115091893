"""JSON held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_json(text: Column) -> Column:
    """True for text that parses as JSON."""
    return F.try_parse_json(text).isNotNull()


def json_text(value: Column) -> Column:
    """Nested value to JSON text."""
    return F.to_json(value)


def json_rows(text: Column, element: str | T.DataType) -> Column:
    """JSON array text to an array of ``element``."""
    kind = element.simpleString() if isinstance(element, T.DataType) else element
    return F.from_json(text, f"array<{kind}>")


def property_map(text: Column) -> Column:
    """JSON object text to a map of its top-level properties; nested values stay JSON text."""
    return F.from_json(text, "map<string,string>")
