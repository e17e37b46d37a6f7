"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(field: Column) -> Column:
    """MD5 hex of the field's text; null stays null."""
    return F.md5(field.cast("string"))
