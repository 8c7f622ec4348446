"""Seed documents through the whole job, and what happens when a run fails."""

from __future__ import annotations

import copy
import datetime as dt
from decimal import Decimal

import pytest
from seed import SEED, write_collections

from martloom.plans.refresh import load_raw, read_collections, refresh
from martloom.schemas import (
    MARTS,
    MODERATION_STATS,
    PRODUCT_POPULARITY,
    RAW_TABLES,
    SUPPORT_EFFICIENCY,
    USER_ACTIVITY,
    USER_SESSIONS,
)
from martloom.sources.documents import documents_from
from martloom.sources.warehouse import Warehouse

FIRST, SECOND = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)


def rows(df, *drop):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=str)


def contents(warehouse):
    stamps = ("loaded_at", "updated_at")
    tables = [*RAW_TABLES.values(), *MARTS.values()]
    # support_tickets has an updated_at of its own, which is data.
    return {
        t.name: rows(warehouse.read(t), *(stamps[:1] if t.name in RAW_TABLES else stamps[1:]))
        for t in tables
    }


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    source = write_collections(tmp_path_factory.mktemp("source"))
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    reports = refresh(spark, read_collections(spark, source), warehouse, FIRST)
    return warehouse, reports, source


def test_reports(loaded):
    _, reports, _ = loaded
    assert [(r.table, r.rows, r.source, r.accepted, r.rejected) for r in reports] == [
        ("user_sessions", 2, 2, 2, 0),
        ("event_logs", 2, 2, 2, 0),
        ("support_tickets", 1, 1, 1, 0),
        ("user_recommendations", 1, 1, 1, 0),
        ("moderation_queue", 1, 1, 1, 0),
        ("user_activity", 2, None, None, None),
        ("support_efficiency", 1, None, None, None),
        ("moderation_stats", 1, None, None, None),
        ("product_popularity", 9, None, None, None),
    ]


def test_golden_marts(loaded):
    warehouse, _, _ = loaded
    day = dt.date(2024, 1, 10)
    half_hour = Decimal("30.00")
    assert rows(warehouse.read(USER_ACTIVITY), "updated_at") == [
        (day, "user_123", 1, half_hour, 64, 4, 64, "add_to_cart", ["mobile"],
         dt.datetime(2024, 1, 10, 9, 30)),
        (day, "user_456", 1, half_hour, 27, 3, 27, "login", ["desktop"],
         dt.datetime(2024, 1, 10, 10, 45)),
    ]
    zero = Decimal("0.00")
    assert rows(warehouse.read(SUPPORT_EFFICIENCY), "updated_at") == [
        (dt.date(2024, 1, 9), "payment", 1, 1, 0, zero, zero, zero, 1, 1)
    ]
    assert rows(warehouse.read(MODERATION_STATS), "updated_at") == [
        (dt.date(2024, 1, 8), "pending", 1, Decimal("5.00"), 1, 1, 1)
    ]
    views = {"/home": 2, "/about": 1, "/cart": 1, "/contact": 1, "/products": 1, "42": 1}
    advised = ("prod_101", "prod_205", "prod_333")
    expected = [(day, p, n, 0, zero, 0) for p, n in views.items()]
    expected += [(day, p, 0, 0, zero, 1) for p in advised]
    assert rows(warehouse.read(PRODUCT_POPULARITY), "updated_at") == sorted(expected, key=str)


def test_declared_schemas(loaded):
    warehouse, _, _ = loaded
    for table in (*RAW_TABLES.values(), *MARTS.values()):
        assert warehouse.read(table).schema.simpleString() == table.schema.simpleString()


def test_stamps(loaded):
    warehouse, _, _ = loaded
    assert {r[0] for r in warehouse.read(USER_SESSIONS).select("loaded_at").collect()} == {FIRST}
    assert {r[0] for r in warehouse.read(USER_ACTIVITY).select("updated_at").collect()} == {FIRST}


def test_large_marts_are_partitioned_by_date(loaded):
    warehouse, _, _ = loaded
    plan = warehouse.read(PRODUCT_POPULARITY).filter("date = date'2024-01-10'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text


def test_second_run_changes_only_stamps(spark, loaded, tmp_path):
    _, _, source = loaded
    warehouse = Warehouse(spark, str(tmp_path))
    refresh(spark, read_collections(spark, source), warehouse, FIRST)
    before = contents(warehouse)
    refresh(spark, read_collections(spark, source), warehouse, SECOND)
    assert contents(warehouse) == before
    assert {r[0] for r in warehouse.read(USER_SESSIONS).select("loaded_at").collect()} == {SECOND}


def test_changes_sticky_columns_and_missing_keys(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    source = write_collections(tmp_path / "a")
    refresh(spark, read_collections(spark, source), warehouse, FIRST)
    changed = copy.deepcopy(SEED)
    session = changed["UserSessions"][0]
    session.update(start_time="2023-05-05T00:00:00Z", end_time=None, device="tv")
    changed["UserSessions"] = [session]
    changed["SupportTickets"][0].update(created_at="2023-05-05T00:00:00Z", status="closed")
    changed["UserRecommendations"] = []
    source = write_collections(tmp_path / "b", changed)
    reports = refresh(spark, read_collections(spark, source), warehouse, SECOND)
    assert reports[3].source == 0 and reports[3].rows == 1  # empty source: target untouched
    kept = {r["session_id"]: r for r in warehouse.read(USER_SESSIONS).collect()}
    assert kept["sess_001"]["start_time"] == dt.datetime(2024, 1, 10, 9)
    assert kept["sess_001"]["end_time"] is None and kept["sess_001"]["device"] == "tv"
    assert kept["sess_001"]["loaded_at"] == SECOND
    assert kept["sess_002"]["loaded_at"] == FIRST
    ticket = warehouse.read(RAW_TABLES["support_tickets"]).first()
    assert ticket["created_at"] == dt.datetime(2024, 1, 9, 11, 55) and ticket["status"] == "closed"
    assert rows(warehouse.read(SUPPORT_EFFICIENCY).select("closed_tickets",
                "avg_resolution_time_hours")) == [(1, Decimal("1.08"))]


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda d: d["UserSessions"][0].update(user_id=None), "not_null user_id"),
        (lambda d: d["UserSessions"][0].update(device="x" * 51), "length device"),
        (lambda d: d["UserSessions"][0].update(pages_visited="/home"), "value_type pages_visited"),
        (lambda d: d["ModerationQueue"][0].update(rating="4.5"), "value_type rating"),
        (lambda d: d["SupportTickets"][0].update(messages=None), "json_array messages"),
    ],
)
def test_bad_batch_publishes_nothing(spark, loaded, tmp_path, change, message):
    documents = copy.deepcopy(SEED)
    change(documents)
    name = next(n for n in SEED if documents[n] != SEED[n])
    table = next(t for t in RAW_TABLES.values() if t.collection == name)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    good = read_collections(spark, write_collections(tmp_path / "good"))
    load_raw(warehouse, table, good[name], FIRST)
    before = rows(warehouse.read(table))
    bad = read_collections(spark, write_collections(tmp_path / "bad", documents))
    with pytest.raises(Exception, match=message):
        load_raw(warehouse, table, bad[name], SECOND)
    assert rows(warehouse.read(table)) == before
    # The next run goes over what the failed one left.
    load_raw(warehouse, table, good[name], SECOND)
    assert rows(warehouse.read(table), "loaded_at") == [r[:-1] for r in before]


def test_key_collision_keeps_the_old_mart(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    refresh(spark, read_collections(spark, write_collections(tmp_path / "a")), warehouse, FIRST)
    before = rows(warehouse.read(PRODUCT_POPULARITY))
    changed = copy.deepcopy(SEED)
    changed["UserSessions"][0]["pages_visited"] = ["/products/42", "42"]
    source = read_collections(spark, write_collections(tmp_path / "b", changed))
    with pytest.raises(Exception, match="product_popularity: key_unique"):
        refresh(spark, source, warehouse, SECOND)
    assert rows(warehouse.read(PRODUCT_POPULARITY)) == before


def test_rejected_documents_are_kept(spark, tmp_path):
    documents = [
        '{"session_id": "a", "start_time": "2024-01-10T09:00:00Z"}',
        '{"session_id": "b", "user_id": "u", "start_time": "soon"}',
        '{"session_id": "c", "user_id": "u", "start_time": "2024-01-10T09:00:00Z"}',
        "{broken",
    ]
    source = write_collections(tmp_path / "s", {**SEED, "UserSessions": documents})
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    docs = read_collections(spark, source)["UserSessions"]
    report = load_raw(warehouse, USER_SESSIONS, docs, FIRST)
    assert (report.source, report.accepted, report.rejected, report.rows) == (4, 1, 3, 1)
    kept = warehouse.quarantine().select("collection", "key", "reason", "document")
    assert rows(kept) == [
        ("UserSessions", "a", "missing key: user_id", documents[0]),
        ("UserSessions", "b", "bad timestamp: start_time", documents[1]),
        ("UserSessions", None, "not a JSON object", documents[3]),
    ]


def test_all_documents_rejected(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    lines = spark.createDataFrame([(1, "{bad"), (2, "[]")], "n int, text string")
    report = load_raw(warehouse, USER_SESSIONS, documents_from(lines, "text", ["n"]), FIRST)
    assert report.rows == 0 and report.rejected == 2


def test_old_runs_are_dropped(spark, loaded, tmp_path):
    _, _, source = loaded
    warehouse = Warehouse(spark, str(tmp_path), keep=2)
    docs = read_collections(spark, source)["UserSessions"]
    for day in range(1, 5):
        load_raw(warehouse, USER_SESSIONS, docs, dt.datetime(2024, 3, day))
    assert warehouse.runs() == [3, 4]
    used = {p.number for run in (3, 4) for p in warehouse.snapshot(run).versions["user_sessions"].parts}
    folders = {int(n[1:]) for n in warehouse.files.names(f"{tmp_path}/raw/user_sessions")}
    assert folders == used and warehouse.read(USER_SESSIONS).count() == 2
    assert not warehouse.files.names(f"{tmp_path}/parsed")


def one_session(spark, n=40):
    rows = spark.range(n).selectExpr(
        "concat('{\"session_id\":\"s', id, '\",\"user_id\":\"u\",\"start_time\":\"2024-01-10\"}') AS text", "id"
    )
    return documents_from(rows, "text", ["id"])


def test_buckets_grow_with_the_table(spark, tmp_path):
    """With a batch that needs more than there are, and with a compaction."""
    warehouse = Warehouse(spark, str(tmp_path), buckets=2, bucket_bytes=4096)

    def buckets():
        return warehouse.snapshot().versions["user_sessions"].buckets

    load_raw(warehouse, USER_SESSIONS, one_session(spark), dt.datetime(2024, 3, 1), 0)
    assert buckets() == 2
    load_raw(warehouse, USER_SESSIONS, one_session(spark), dt.datetime(2024, 3, 2), 12_000)
    assert buckets() == 4 and warehouse.read(USER_SESSIONS).count() == 40
    warehouse.most_buckets = 100  # the platform's ceiling
    load_raw(warehouse, USER_SESSIONS, one_session(spark), dt.datetime(2024, 3, 3), 1 << 50)
    assert buckets() == 64 and warehouse.read(USER_SESSIONS).count() == 40
    small = Warehouse(spark, str(tmp_path / "b"), buckets=1, bucket_bytes=1, compact_share=0)
    small.most_buckets = 8
    load_raw(small, USER_SESSIONS, one_session(spark), dt.datetime(2024, 3, 1), 0)
    load_raw(small, USER_SESSIONS, one_session(spark), dt.datetime(2024, 3, 2), 0)
    version = small.snapshot().versions["user_sessions"]
    assert version.buckets == 8 and len(version.parts) == 1
    assert small.read(USER_SESSIONS).count() == 40


def plans_of_writes(monkeypatch, warehouse, load):
    """The plans that wrote raw parts, without broadcasts."""
    plans = []
    write = Warehouse.write_raw

    def told(self, rows, *args):
        rows.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, rows, *args)

    monkeypatch.setattr(Warehouse, "write_raw", told)
    load()
    monkeypatch.undo()
    return plans


@pytest.mark.parametrize("partitions", ["2", "8", "32"])
def test_a_load_shuffles_the_batch_once_and_reads_no_stored_row(spark, monkeypatch, tmp_path, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    warehouse = Warehouse(spark, str(tmp_path), buckets=8, bucket_bytes=1 << 20, compact_share=1.5)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        load_raw(warehouse, USER_SESSIONS, one_session(spark), FIRST)
        load = lambda: load_raw(warehouse, USER_SESSIONS, one_session(spark), SECOND)
        (appended,) = plans_of_writes(monkeypatch, warehouse, load)
        assert appended.count("Exchange ") == 1 and "Bucketed" not in appended
        # Read: buckets of base and changes come together as they lie.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = warehouse.read(USER_SESSIONS)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SelectedBucketsCount: 8 out of 8") == 2
        appended, compacted = plans_of_writes(monkeypatch, warehouse, load)
        assert "Exchange" not in compacted and compacted.count("SelectedBucketsCount: 8 out of 8") == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert warehouse.read(USER_SESSIONS).count() == 40


def test_the_source_is_read_once(spark, tmp_path):
    """Also with rejects, of which there is one; an accumulator counts what the source gives out."""
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    given = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            given.add(batch.num_rows)
            yield batch

    rows = one_session(spark).selectExpr("document", "read_order.id AS id")
    bad = spark.createDataFrame([("{broken", 99)], "document string, id long")
    source = rows.unionByName(bad).mapInArrow(counted, "document string, id long")
    report = load_raw(warehouse, USER_SESSIONS, documents_from(source, "document", ["id"]), FIRST)
    assert (report.source, report.accepted, report.rejected, report.rows) == (41, 40, 1, 40)
    assert given.value == 41
    assert not any((tmp_path / "w" / "parsed").rglob("*.parquet"))


def test_quarantine_of_loads_side_by_side(spark, tmp_path):
    """Unequal rejects in all collections at once, again and again, and the same run twice."""
    sizes = {t.collection: n for t, n in zip(RAW_TABLES.values(), (3, 100_000, 20, 5_000, 700))}
    sources = {
        name: documents_from(spark.range(n).selectExpr("concat('{bad ', id) AS text", "id"), "text", ["id"])
        for name, n in sizes.items()
    }
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.quarantine().count() == 0
    for n in range(5):
        refresh(spark, sources, warehouse, dt.datetime(2024, 3, 1, 0, 0, 0, n // 2))
        found = warehouse.quarantine().groupBy("collection", "run").count().collect()
        by_run = {(r["collection"], r["run"][-1]): r["count"] for r in found}
        assert by_run == {(name, str(r)): size for name, size in sizes.items() for r in range(n // 2 + 1)}


def test_all_failed_loads_are_told(spark, tmp_path):
    documents = copy.deepcopy(SEED)
    documents["UserSessions"][0].update(user_id=None)
    documents["ModerationQueue"][0].update(rating="4.5")
    source = read_collections(spark, write_collections(tmp_path / "s", documents))
    with pytest.raises(Exception, match="(?s)not_null user_id.*value_type rating"):
        refresh(spark, source, Warehouse(spark, str(tmp_path / "w")), FIRST)
