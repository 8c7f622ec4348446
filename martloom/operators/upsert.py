"""Keyed upsert with columns that keep their first value."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.exact import instant


def last_per_key(
    batch: DataFrame,
    key: str,
    order_by: Sequence[Column | str],
    sticky: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: values of the last row, sticky values of the first.

    An aggregation, not a window: each map task first reduces its own rows to one
    per key, so a key with a third of the batch sends one row per task.
    ``order_by`` must be unique inside a key. A NULL in the last row is kept.
    """
    names = [c for c in (columns or batch.columns) if c != key]
    moving = [c for c in names if c not in sticky]
    order = F.struct(*order_by)
    winners = batch.groupBy(key).agg(
        F.max_by(F.struct(*moving), order).alias("_last"),
        *[F.min_by(c, order).alias(c) for c in sticky],
    )
    values = [F.col(c) if c in sticky else F.col(f"_last.{c}").alias(c) for c in names]
    return winners.select(key, *values)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    order_by: Sequence[Column | str],
    sticky: Sequence[str] = (),
    as_of: datetime | None = None,
) -> DataFrame:
    """Insert the batch's new keys into ``target`` and replace the rows of known keys.

    Result columns are those of ``target``, whose key is unique. ``sticky``
    columns of a known key keep the target's value, ``loaded_at`` (if the target
    has it) becomes ``as_of`` for every key of the batch, and no key is deleted.

    The batch is reduced to one row per key first, so that the join has unique keys on
    both sides and cannot skew. The reduced batch already has the join's partitioning; a
    target bucketed by ``key`` needs no exchange at all, so only the batch moves.
    """
    values = [c for c in target.columns if c not in (key, "loaded_at")]
    incoming = last_per_key(batch, key, order_by, sticky, values)
    if "loaded_at" in target.columns:
        incoming = incoming.withColumn("loaded_at", instant(as_of))
    return merge_newer(target, incoming, key, sticky)


def merge_newer(target: DataFrame, newer: DataFrame, key: str, sticky: Sequence[str] = ()) -> DataFrame:
    """``target`` with the rows of ``newer`` in place of its own, but for its sticky values.

    Both have the columns of ``target`` and unique keys.
    """
    old, new = target.alias("old"), newer.alias("new")
    known = F.col(f"old.{key}").isNotNull()
    arrived = F.col(f"new.{key}").isNotNull()

    def merged(name: str) -> Column:
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name == key:
            return F.coalesce(before, after)
        if name in sticky:
            return F.when(known, before).otherwise(after)
        return F.when(arrived, after).otherwise(before)

    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    return joined.select(*[merged(c).alias(c) for c in target.columns])
