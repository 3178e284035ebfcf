"""Columns whose names may hold dots and blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + name.replace("`", "``") + "`")
