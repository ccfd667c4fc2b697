"""Small column functions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def preview(text: Column, width: int = 1000) -> Column:
    """The first ``width`` characters, for looking at long model text."""
    return F.substring(text, 1, width)


def to_double(text: Column) -> Column:
    """Text to number; NULL where the text is no number."""
    return text.try_cast("double")


def hex_to_bytes(text: Column) -> Column:
    return F.unhex(text)


def bytes_to_hex(data: Column) -> Column:
    return F.hex(data)
