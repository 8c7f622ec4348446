"""The checks a table must pass before it is published.

``not_null``, ``key_unique``, ``length``, ``json_array`` and ``value_type`` are
predicates here; integer range and decimal precision are enforced where values
are narrowed (:mod:`martloom.functions.exact`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.schemas import MartTable, RawTable


class ConstraintViolation(Exception):
    """A table breaks its declared constraints; nothing was published."""


@dataclass(frozen=True)
class RowCheck:
    """``violated`` is true on a bad row and never NULL."""

    check: str
    column: str
    violated: Column


def row_checks(df: DataFrame, table: RawTable | MartTable) -> list[RowCheck]:
    checks = [RowCheck("not_null", c, F.col(c).isNull()) for c in table.not_null]
    for column, limit in table.max_lengths.items():
        # Characters beyond the limit are allowed when all of them are blanks.
        too_long = F.coalesce(F.length(F.rtrim(column)) > limit, F.lit(False))
        checks.append(RowCheck("length", column, too_long))
    for column in table.json_arrays:
        not_array = F.col(column).isNotNull() & F.json_array_length(column).isNull()
        checks.append(RowCheck("json_array", column, not_array))
    if "type_error" in df.columns:
        for column in (c.name for c in table.columns):
            wrong = F.coalesce(F.col("type_error") == column, F.lit(False))
            checks.append(RowCheck("value_type", column, wrong))
    return checks


def _key_text(table: RawTable | MartTable) -> Column:
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in table.keys]
    return F.concat_ws("|", *parts)


def row_violations(df: DataFrame, table: RawTable | MartTable) -> DataFrame:
    """``(table, check, key, detail)``, one row per bad value. No shuffle."""
    found = [
        F.when(
            c.violated,
            F.struct(F.lit(c.check).alias("check"), F.lit(c.column).alias("detail")),
        )
        for c in row_checks(df, table)
    ]
    any_bad = F.lit(False)
    for c in row_checks(df, table):
        any_bad = any_bad | c.violated
    return (
        df.filter(any_bad)
        .select(_key_text(table).alias("key"), F.explode(F.array_compact(F.array(*found))).alias("v"))
        .select(F.lit(table.name).alias("table"), "v.check", "key", "v.detail")
    )


def duplicate_keys(df: DataFrame, table: RawTable | MartTable) -> DataFrame:
    """``(table, check, key, detail)`` for each key that occurs more than once.

    Counts are combined before the shuffle, so a key with many copies sends one
    row per map task. Rows with a NULL in the key are the NOT NULL check's.
    """
    return (
        df.dropna(subset=list(table.keys))
        .groupBy(*table.keys)
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
        .select(
            F.lit(table.name).alias("table"),
            F.lit("key_unique").alias("check"),
            _key_text(table).alias("key"),
            F.concat(F.col("copies").cast("string"), F.lit(" rows")).alias("detail"),
        )
    )


def check(df: DataFrame, table: RawTable | MartTable, mode: str = "report") -> DataFrame:
    """All violations of ``table``'s constraints in ``df``.

    ``report`` returns them; ``fail`` raises :class:`ConstraintViolation` when
    there are any. One narrow pass for the row checks, one key count.
    """
    violations = row_violations(df, table).unionByName(duplicate_keys(df, table))
    if mode == "report":
        return violations
    if mode != "fail":
        raise ValueError(f"mode must be 'report' or 'fail', not {mode!r}")
    raise_on(violations)
    return violations


def raise_on(violations: DataFrame) -> None:
    """Raise with the number of violations per check; a few rows reach the driver."""
    by_check = violations.groupBy("table", "check").agg(
        F.count("*").alias("n"), F.min("key").alias("example")
    )
    found = by_check.orderBy("table", "check").collect()
    if found:
        text = "; ".join(f"{r['table']}: {r['check']} x{r['n']}, e.g. {r['example']}" for r in found)
        raise ConstraintViolation(text)


def enforce(df: DataFrame, table: RawTable | MartTable) -> DataFrame:
    """``df``, failing the job that computes it at the first bad row.

    For writes: the checks ride on the pass that produces the rows, so a clean
    table costs no extra scan. Key uniqueness needs :func:`duplicate_keys`.
    """
    reasons = [
        F.when(c.violated, F.lit(f"{c.check} {c.column}")) for c in row_checks(df, table)
    ]
    broken = F.col("_broken")
    message = F.concat(
        F.lit(f"constraint violation: {table.name}: "), broken, F.lit(", key "), _key_text(table)
    )
    guarded = table.keys[-1]
    return (
        df.withColumn("_broken", F.coalesce(*reasons))
        .withColumn(
            guarded,
            F.when(broken.isNull(), F.col(guarded)).otherwise(
                F.raise_error(message).cast("string")
            ),
        )
        .drop("_broken")
    )
