"""The batches behind the stored queries, and sizes that follow the input."""

from __future__ import annotations

import glob
import gzip
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from martloom.plans import dumps, refresh, stored
from martloom.plans.refresh import load_raw
from martloom.schemas import EVENT_LOGS, RAW_TABLES, USER_SESSIONS
from martloom.sources import dump
from martloom.sources.documents import documents_from
from martloom.sources.warehouse import CLEAN_UP, JOINED_BYTES, READ_BYTES, TASK_ROWS, Warehouse

ROWS = [(str(n), datetime(2024, 1, 1, 0, n % 60), "view", json.dumps({"k": n})) for n in range(400)]


def test_batches_of_one_derivation(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    schema = "event_id string, timestamp timestamp_ntz, event_type string, details string"
    rows = spark.createDataFrame(ROWS, schema).mapInArrow(look, schema)
    before = spark.conf.get(stored.OPEN_FILES, None)
    stored._write_batches(spark, {EVENT_LOGS: rows}, str(tmp_path))
    assert spark.conf.get(stored.OPEN_FILES, None) == before
    assert seen.value == len(ROWS)
    digits = {r[0]: r[1] for r in rows.select("event_id", F.substring(F.md5("event_id"), 1, 1)).collect()}
    wanted = {
        "first": ("view", "456789abcdef"), "second": ("changed", "1234567"), "third": ("again", "02345"),
    }
    for name, (kind, of) in wanted.items():
        files = glob.glob(f"{tmp_path}/EventLogs.jsonl/batch={name}/part-*")
        assert files and all(f.endswith(".gz") for f in files)
        found = [json.loads(line) for f in files for line in gzip.open(f, "rt")]
        kept = [d for d in found if "lost" not in d]
        assert sorted(d["event_id"] for d in kept) == sorted(k for k, digit in digits.items() if digit in of)
        assert all(d["event_type"] == kind and d["details"] == {"k": int(d["event_id"])} for d in kept)
        lost = sorted(d["lost"] for d in found if "lost" in d)
        assert lost == (sorted(k for k, digit in digits.items() if digit == "c") if name == "second" else [])


def test_ranges_of_a_dump_grow_with_it():
    assert dumps.split_bytes(3 << 20) == 1 << 20
    assert dumps.split_bytes(4 << 30) == 32 << 20
    assert dumps.split_bytes(1 << 40) == dump.SPLIT_BYTES


def test_sessions_of_loads(spark, tmp_path):
    run = Warehouse(spark, str(tmp_path), buckets=4).begin()
    assert run.buckets_for(EVENT_LOGS, 100 << 20) == 4
    assert run.buckets_for(EVENT_LOGS, 200 << 20) == 8
    session = run.session_for(EVENT_LOGS, 200 << 20)
    assert session.conf.get("spark.sql.shuffle.partitions") == "8"
    assert session.conf.get(CLEAN_UP) == "true" and session.conf.get(READ_BYTES) == str(16 << 20)


def test_shuffles_follow_the_tables(spark, tmp_path):
    """Else twelve tasks sort what sixty times the rows make of their share."""
    for name, size in {"events": 1 << 20, "orders": 1 << 20, "lineitem": 1 << 30}.items():
        with open(f"{tmp_path}/{name}.parquet", "wb") as f:
            f.truncate(size)
    assert stored._derivation(spark, str(tmp_path))[stored.SHUFFLES] == "65"
    os.truncate(f"{tmp_path}/lineitem.parquet", 1 << 20)
    assert stored._derivation(spark, str(tmp_path))[stored.SHUFFLES] == spark.conf.get(stored.SHUFFLES)


def test_marts_read_by_a_session_of_the_tables_size(spark, tmp_path):
    texts = spark.createDataFrame([(json.dumps({"event_id": r[0], "timestamp": str(r[1]), "event_type": r[2]}), r[0]) for r in ROWS], "text string, n string")
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2, bucket_bytes=1 << 9)
    load_raw(warehouse, EVENT_LOGS, documents_from(texts, "text", ["n"]), datetime(2024, 2, 1))
    stored_files = glob.glob(f"{tmp_path}/w/raw/{EVENT_LOGS.name}/v*/*.parquet")
    assert stored_files and all(f.endswith(".zstd.parquet") for f in stored_files)
    with warehouse.begin() as run:
        run.widen()
        held = sum(map(os.path.getsize, stored_files))
        shuffles = int(run.spark.conf.get("spark.sql.shuffle.partitions"))
        assert shuffles == warehouse.bucket_count(2, held) > 2
        assert run.read(EVENT_LOGS).sparkSession.conf.get("spark.sql.shuffle.partitions") == str(shuffles)
        assert run.read(EVENT_LOGS).count() == len(ROWS)
    warehouse.drop()


def test_buckets_follow_the_rows(spark, tmp_path):
    """Rows much alike are small in files; a task sorts them at their full size all the same."""
    count = 8 << 10
    rows = spark.range(count).selectExpr("to_json(struct(string(id) AS event_id, '2024-01-01T00:00:00' AS timestamp, 'view' AS event_type)) AS text", "id AS n")
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2, bucket_rows=1 << 10, compact_share=0)
    for day in (1, 2, 3):
        load_raw(warehouse, EVENT_LOGS, documents_from(rows, "text", ["n"]), datetime(2024, 2, day))
        version = warehouse.snapshot().versions[EVENT_LOGS.name]
        # The first load needs eight, its merge with as many rows twice that, and no load more.
        assert version.buckets == (8 if day == 1 else 16)
        assert [p.keys for p in version.parts] == [count]
    assert warehouse.read(EVENT_LOGS).count() == count
    with warehouse.begin() as run:
        assert run.buckets_for(EVENT_LOGS, 1, 20 << 10) == 32
        run.widen()
        assert run.spark.conf.get("spark.sql.shuffle.partitions") == "8"
    warehouse.drop()


def test_parsed_documents_are_not_sorted(spark, tmp_path, monkeypatch):
    """Splitting them by folder sorts whatever a task parsed."""
    rows = spark.createDataFrame([('{"event_id": "1", "timestamp": "2024-01-01T00:00:00", "event_type": "view"}', 1), ("x", 2)], "text string, n int")
    warehouse, seen = Warehouse(spark, str(tmp_path / "w"), buckets=2), []
    size = warehouse.files.size
    monkeypatch.setattr(warehouse.files, "size", lambda path: seen.extend(glob.glob(f"{path}/**/*.parquet", recursive=True)) or size(path))
    report = load_raw(warehouse, EVENT_LOGS, documents_from(rows, "text", ["n"]), datetime(2024, 2, 1))
    parsed = [f for f in seen if "/parsed/" in f]
    assert parsed and not any("rejected=" in f for f in parsed)
    assert (report.source, report.accepted, report.rejected) == (2, 1, 1)
    assert [(r.reason, r.document) for r in warehouse.quarantine().collect()] == [("not a JSON object", "x")]
    warehouse.drop()


def test_a_task_sorts_no_more_than_its_rows(spark, tmp_path, monkeypatch):
    """Partitions joined up to 64 MB of packed blocks hold millions of rows much alike, and spill."""
    count = 60_000
    rows = spark.range(count).selectExpr("to_json(struct(string(id) AS event_id, '2024-01-01T00:00:00' AS timestamp, 'view' AS event_type)) AS text", "id AS n")
    assert Warehouse(spark, str(tmp_path / "other"), buckets=1).bucket_count(1, 1, TASK_ROWS + 1) == 2
    monkeypatch.setattr("martloom.plans.refresh.TASK_ROWS", count // 6)
    monkeypatch.setattr("martloom.sources.warehouse.TASK_ROWS", count // 6)
    monkeypatch.setattr("martloom.sources.warehouse.SMALL_JOINED", "1")
    warehouse, staged = Warehouse(spark, str(tmp_path / "w"), buckets=2, bucket_rows=count // 6), []
    size = warehouse.files.size
    monkeypatch.setattr(warehouse.files, "size", lambda path: staged.extend(glob.glob(f"{path}/*.parquet")) or size(path))
    with warehouse.begin() as run:
        load_raw(run, EVENT_LOGS, documents_from(rows.coalesce(1), "text", ["n"]), datetime(2024, 2, 1))
        held = run.read(EVENT_LOGS)
        assert held.count() == count and run.versions[EVENT_LOGS.name].buckets == 8
        run.widen()
        assert run.spark.conf.get(JOINED_BYTES) == "1"
        session = run.session_for(EVENT_LOGS, 1 << 20, count)
        assert session.conf.get(READ_BYTES) == str((1 << 20) // 6)
    assert len([f for f in staged if "/parsed/" in f]) == 6  # files are not split when read
    warehouse.drop()


def test_derivation_follows_the_rows(spark, tmp_path):
    n = int(spark.conf.get(stored.SHUFFLES))
    assert stored._derivation(spark, str(tmp_path), 3 * n * stored.SOURCE_ROWS)[stored.SHUFFLES] == str(3 * n + 1)
    assert int(stored._derivation(spark, str(tmp_path))[JOINED_BYTES]) <= 4 << 20
    for name, count in zip(stored.SOURCES, (3, 1, 2)):
        spark.range(count).write.parquet(f"{tmp_path}/{name}.parquet")
    assert stored._most_rows(spark, str(tmp_path)) == 3


def _loads(spark, days):
    """A frame of documents for each (day, first, end) of keys."""
    text = "to_json(struct(string(id) AS event_id, '2024-01-01T00:00:00' AS timestamp, '{}' AS event_type)) AS text"
    return [documents_from(spark.range(*keys).selectExpr(text.format(day), "id AS n"), "text", ["n"]) for day, keys in days.items()]


def test_stored_parts_are_merged_without_a_sort(spark, tmp_path):
    """Buckets are stored in the order of their keys."""
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2, compact_share=5)
    with warehouse.begin() as run:
        first, second = _loads(spark, {"a": (0, 40), "b": (30, 50)})
        load_raw(run, EVENT_LOGS, first, datetime(2024, 2, 1))
        run.commit()
    with warehouse.begin() as run:
        assert load_raw(run, EVENT_LOGS, second, datetime(2024, 2, 2)).rows == 50
        run.widen()
        rows = run.read(EVENT_LOGS)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Sort [" not in plan and "Exchange" not in plan
        assert rows.where("event_type = 'b'").count() == 20 and rows.count() == run.count(EVENT_LOGS) == 50
        assert run.count(USER_SESSIONS) == 0
    warehouse.drop()


def test_marts_read_tables_that_are_compacted(spark, tmp_path, monkeypatch):
    """What a run rewrites anyway is rewritten before its marts merge it; a run that fails keeps what tells its changes."""
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2, compact_share=0, keep=3)
    nothing = documents_from(spark.createDataFrame([], "n int, text string"), "text", ["n"])
    seen, build = [], refresh.build_mart

    def look(run, mart, *more):
        seen.append(len(run.versions[EVENT_LOGS.name].parts))
        return build(run, mart, *more)

    monkeypatch.setattr(refresh, "build_mart", look)
    for n, documents in enumerate(_loads(spark, {"a": (0, 20), "b": (10, 30)}), 1):
        sources = {t.collection: documents if t is EVENT_LOGS else nothing for t in RAW_TABLES.values()}
        refresh.refresh(spark, sources, warehouse, datetime(2024, 2, n))
    assert seen == [1] * 8

    def fail(*_):
        raise ValueError("no mart")

    monkeypatch.setattr(refresh, "build_mart", fail)
    with pytest.raises(RuntimeError, match="no mart"):
        refresh.refresh(spark, sources, warehouse, datetime(2024, 2, 3))
    with warehouse.begin(resume=True) as run:
        assert len(run.versions[EVENT_LOGS.name].parts) == 2 and run.count(EVENT_LOGS) == 30
    warehouse.drop()


def test_changed_rows_are_merged_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2, compact_share=5)
    first, second = _loads(spark, {"a": (0, 200), "b": (100, 300)})
    load_raw(warehouse, EVENT_LOGS, first, datetime(2024, 2, 1))
    with warehouse.begin() as run:
        load_raw(run, EVENT_LOGS, second, datetime(2024, 2, 2))
        run.widen()
        before, after = refresh.changed_rows(run, EVENT_LOGS)
        for rows, kind, first in ((before, "a", 100), (after, "b", 100)):
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan and "Exchange" not in plan
            assert rows.columns == EVENT_LOGS.schema.names
            keys = sorted(int(r.event_id) for r in rows.where(F.col("event_type") == kind).collect())
            assert keys == list(range(first, 200 if kind == "a" else 300))
        assert (before.count(), after.count()) == (100, 200)
    warehouse.drop()


def test_batches_are_made_by_compiled_code(spark, tmp_path, monkeypatch):
    """``array_compact`` interprets what makes the texts."""
    schema = "event_id string, timestamp timestamp_ntz, event_type string, details string"
    plans, text = [], DataFrameWriter.text

    def look(writer, path, *more, **options):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        text(writer, path, *more, **options)

    monkeypatch.setattr(DataFrameWriter, "text", look)
    stored._write_batches(spark, {EVENT_LOGS: spark.createDataFrame(ROWS, schema)}, str(tmp_path))
    assert len(plans) == 1 and "filter(" not in plans[0] and "lambda" not in plans[0]
