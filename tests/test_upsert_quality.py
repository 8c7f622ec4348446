"""Upsert semantics and the table checks."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from martloom.operators import quality
from martloom.operators.upsert import last_per_key, upsert
from martloom.schemas import (
    EVENT_LOGS,
    MODERATION_QUEUE,
    MODERATION_STATS,
    RAW_TABLES,
    SUPPORT_TICKETS,
    USER_SESSIONS,
)

COLUMNS = "k string, first int, last string, loaded_at timestamp_ntz"
OLD, NOW = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 2)


def target(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "n int, k string, first int, last string")


def run(spark, old, new):
    merged = upsert(old, new, "k", ["n"], sticky=["first"], as_of=NOW)
    return sorted(tuple(r) for r in merged.collect())


def test_insert_replace_keep(spark):
    old = target(spark, ("a", 1, "x", OLD), ("b", None, "y", OLD), ("c", 3, "z", OLD))
    new = batch(spark, (1, "a", 9, None), (2, "b", 9, "w"), (3, "d", 4, "v"))
    assert run(spark, old, new) == [
        ("a", 1, None, NOW),  # NULL replaces; the sticky value stays
        ("b", None, "w", NOW),  # a sticky NULL stays too
        ("c", 3, "z", OLD),  # not in the batch
        ("d", 4, "v", NOW),
    ]


def test_one_key_three_times(spark):
    new = batch(spark, (2, "a", 20, "second"), (3, "a", 30, None), (1, "a", 10, "first"))
    assert run(spark, target(spark), new) == [("a", 10, None, NOW)]
    assert run(spark, target(spark, ("a", 1, "x", OLD)), new) == [("a", 1, None, NOW)]


def test_empty_batch(spark):
    assert run(spark, target(spark, ("a", 1, "x", OLD)), batch(spark)) == [("a", 1, "x", OLD)]


def test_random_against_a_dictionary_idempotence_and_halves(spark):
    pick = random.Random(5)
    rows = [
        (n, "hot" if n % 3 == 0 else f"k{pick.randint(0, 40)}", pick.choice([None, n]), f"v{n}")
        for n in range(400)
    ]
    pick.shuffle(rows)
    expected = {f"k{n}": (n, f"old{n}", OLD) for n in range(0, 60, 2)}
    old = target(spark, *[(k, *v) for k, v in expected.items()])
    for _, key, first, last in sorted(rows):
        sticky = expected[key][0] if key in expected else first
        expected[key] = (sticky, last, NOW)
    once = run(spark, old, batch(spark, *rows).repartition(7))
    assert once == sorted((k, *v) for k, v in expected.items())
    new = batch(spark, *rows)
    merged = upsert(old, new, "k", ["n"], ["first"], NOW)
    assert run(spark, merged, new) == once
    half = upsert(old, new.filter("n < 200"), "k", ["n"], ["first"], NOW)
    assert run(spark, half, new.filter("n >= 200")) == once


def test_hot_key_is_reduced_before_the_shuffle(spark):
    plan = last_per_key(batch(spark), "k", ["n"], ["first"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == 1 and "partial_max_by" in text and "Window" not in text


def test_upsert_needs_one_exchange_per_side(spark):
    merged = upsert(target(spark, ("a", 1, "x", OLD)).repartition(4), batch(spark), "k", ["n"])
    text = merged.hint("merge")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text


# --- checks ------------------------------------------------------------------


def found(df, table):
    return sorted(tuple(r) for r in quality.check(df, table).collect())


def frame(spark, table, *rows):
    return spark.createDataFrame(list(rows), table.schema)


def session(key="s", user="u", start=OLD, device="tv"):
    return (key, user, start, None, [], device, [], OLD)


def test_clean_tables_have_no_violations(spark):
    assert found(frame(spark, USER_SESSIONS, session()), USER_SESSIONS) == []
    for table in RAW_TABLES.values():
        assert found(frame(spark, table), table) == []


def test_each_row_check(spark):
    rows = frame(
        spark,
        USER_SESSIONS,
        session(user=None),
        session("t", start=None),
        session("v", device="x" * 51),
        session("w", device="x" * 50 + "   "),
        session("y" * 51),
    )
    assert found(rows, USER_SESSIONS) == [
        ("user_sessions", "length", "v", "device"),
        ("user_sessions", "length", "y" * 51, "session_id"),
        ("user_sessions", "not_null", "s", "user_id"),
        ("user_sessions", "not_null", "t", "start_time"),
    ]


def test_duplicate_and_null_keys(spark):
    rows = frame(spark, EVENT_LOGS, *[(k, OLD, "e", "{}", OLD) for k in ("a", "a", "a", "b", None)])
    assert found(rows, EVENT_LOGS) == [
        ("event_logs", "key_unique", "a", "3 rows"),
        ("event_logs", "not_null", "NULL", "event_id"),
    ]


def test_json_array_check(spark):
    rows = frame(
        spark,
        SUPPORT_TICKETS,
        *[(k, "u", "open", "pay", m, OLD, None, OLD)
          for k, m in (("a", None), ("b", "[1]"), ("c", "{}"), ("d", "null"))],
    )
    assert [(c, k) for _, c, k, _ in found(rows, SUPPORT_TICKETS)] == [
        ("json_array", "c"),
        ("json_array", "d"),
    ]


def test_mart_keys(spark):
    rows = frame(
        spark,
        MODERATION_STATS,
        (None, "x", 1, None, 0, 0, 0, OLD),
        (OLD.date(), None, 1, None, 0, 0, 0, OLD),
        (OLD.date(), "y" * 21, 1, None, 0, 0, 0, OLD),
        (OLD.date(), "z", 1, None, 0, 0, 0, OLD),
        (OLD.date(), "z", 2, None, 0, 0, 0, OLD),
    )
    assert sorted((c, d) for _, c, _, d in found(rows, MODERATION_STATS)) == [
        ("key_unique", "2 rows"),
        ("length", "moderation_status"),
        ("not_null", "date"),
        ("not_null", "moderation_status"),
    ]
    with pytest.raises(quality.ConstraintViolation, match="length x1.*not_null x2"):
        quality.check(rows, MODERATION_STATS, mode="fail")


def test_modes(spark):
    clean = frame(spark, USER_SESSIONS, session())
    assert quality.check(clean, USER_SESSIONS, mode="fail").count() == 0
    with pytest.raises(ValueError, match="mode"):
        quality.check(clean, USER_SESSIONS, mode="other")


def test_enforce(spark):
    rows = frame(spark, MODERATION_QUEUE, ("r", None, None, "", 1, "x" * 21, [], None, OLD))
    with pytest.raises(Exception, match="moderation_queue: length moderation_status, key r"):
        quality.enforce(rows, MODERATION_QUEUE).collect()
    clean = frame(spark, USER_SESSIONS, session())
    assert quality.enforce(clean, USER_SESSIONS).collect() == clean.collect()
