"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_utf8(text: Column) -> Column:
    """Drop the bytes that are no UTF-8; well-formed text passes untouched."""
    repaired = F.regexp_replace(F.make_valid_utf8(text), "�", "")
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)


def strip(text: Column) -> Column:
    """Trim every kind of ASCII white space on both ends."""
    return F.btrim(text, F.lit(" \t\r\n\x0b\x0c"))
