"""Length-limited text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut_blank_tail(value: Column, limit: int) -> Column:
    """Drop characters beyond ``limit`` when all of them are blanks, as VARCHAR(n) does."""
    cut = F.regexp_replace(value, rf"(?s)\A(.{{{limit}}}) +\z", "$1")
    return F.when(F.length(value) > limit, cut).otherwise(value)
