"""Change sets, runs and their lease, and marts kept up from changed rows."""

from __future__ import annotations

import datetime as dt
import random
import threading

import pytest
from seed import SEED, write_collections

from martloom.operators.mart_state import MART_STATES, summed
from martloom.plans import refresh as plans
from martloom.plans.refresh import load_raw, mart_frame, read_collections, refresh
from martloom.schemas import (
    MARTS,
    MODERATION_QUEUE,
    PRODUCT_POPULARITY,
    RAW_TABLES,
    SUPPORT_TICKETS,
    USER_ACTIVITY,
    USER_RECOMMENDATIONS,
    USER_SESSIONS,
)
from martloom.sources.documents import documents_from
from martloom.sources.warehouse import RunRefused, Warehouse


def day(n):
    return dt.datetime(2024, 3, 1) + dt.timedelta(days=n)


def rows(df, *drop):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=str)


def sessions(spark, start, end, device="phone", step=1):
    made = spark.range(start, end, step).selectExpr(
        f"to_json(named_struct('session_id', concat('s', id), 'user_id', concat('u', id % 97), 'start_time', "
        f"date_format(timestampadd(MINUTE, id, timestamp'2024-01-01'), \"yyyy-MM-dd'T'HH:mm:ss\"), "
        f"'device', '{device}', 'pages_visited', array(concat('/products/', id % 50), '/home'))) AS text",
        "id",
    )
    return documents_from(made, "text", ["id"])


# --- change sets --------------------------------------------------------------------------


def test_a_load_writes_its_batch_only(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    load_raw(warehouse, USER_SESSIONS, sessions(spark, 0, 100_000), day(0))
    stored = warehouse.files.size(f"{tmp_path}/w/raw")
    load_raw(warehouse, USER_SESSIONS, sessions(spark, 0, 100_000, "tv", 100), day(1))
    added = warehouse.files.size(f"{tmp_path}/w/raw") - stored
    alone = Warehouse(spark, str(tmp_path / "alone"), buckets=2)
    load_raw(alone, USER_SESSIONS, sessions(spark, 0, 100_000, "tv", 100), day(1))
    assert added <= 1.5 * alone.files.size(f"{tmp_path}/alone/raw") and added < stored / 20
    assert warehouse.read(USER_SESSIONS).count() == 100_000
    assert warehouse.read(USER_SESSIONS).where("device = 'tv'").count() == 1000


def test_many_small_loads_become_one_change_set(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=2, most_parts=3, compact_share=0.5)
    load_raw(warehouse, USER_SESSIONS, sessions(spark, 0, 20_000), day(0))
    base = warehouse.snapshot().versions["user_sessions"].parts[0]
    for n in range(1, 6):
        load_raw(warehouse, USER_SESSIONS, sessions(spark, 10 * n, 10 * n + 20, f"d{n}"), day(n))
        parts = warehouse.snapshot().versions["user_sessions"].parts
        assert parts[0] == base and len(parts) <= 3
    found = {r["session_id"]: r for r in warehouse.read(USER_SESSIONS).where("device <> 'phone'").collect()}
    assert {k: r["device"] for k, r in found.items()} == {
        f"s{i}": f"d{min(5, i // 10)}" for i in range(10, 70)
    }
    assert found["s15"]["loaded_at"] == day(1) and found["s25"]["loaded_at"] == day(2)


def test_change_sets_equal_one_load(spark, tmp_path):
    """Any split of a sequence of documents into loads gives the same rows, sticky ones too."""
    rng = random.Random(4)
    documents = [
        (n, f'{{"session_id": "s{rng.randrange(30)}", "user_id": "u{n}", "start_time": "2024-01-{rng.randint(1, 28):02}"}}')
        for n in range(200)
    ]
    at_once = Warehouse(spark, str(tmp_path / "a"), buckets=2)
    df = spark.createDataFrame(documents, "n int, text string")
    load_raw(at_once, USER_SESSIONS, documents_from(df, "text", ["n"]), day(0))
    split = Warehouse(spark, str(tmp_path / "b"), buckets=2, compact_share=1.0, most_parts=3)
    for n, start in enumerate(range(0, 200, 40)):
        load_raw(split, USER_SESSIONS, documents_from(df.where(f"n >= {start} AND n < {start + 40}"), "text", ["n"]), day(n))
    assert rows(split.read(USER_SESSIONS), "loaded_at") == rows(at_once.read(USER_SESSIONS), "loaded_at")


def test_keys_are_filtered_where_rows_lie(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=2, compact_share=5)
    for n in range(3):
        load_raw(warehouse, USER_SESSIONS, sessions(spark, 100 * n, 100 * n + 200, f"d{n}"), day(n))
    keys = spark.createDataFrame([("s150",), ("s350",), ("none",)], "session_id string")
    found = warehouse.snapshot().read(USER_SESSIONS, keys)
    assert rows(found.select("session_id", "device")) == [("s150", "d1"), ("s350", "d2")]


def test_a_lookup_opens_one_bucket(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=8, compact_share=5)
    for n in range(2):
        load_raw(warehouse, USER_SESSIONS, sessions(spark, 100 * n, 100 * n + 2000, f"d{n}"), day(n))
    found = warehouse.snapshot().read(USER_SESSIONS, ["s150"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SelectedBucketsCount: 1 out of 8") == 2 and "EqualTo(session_id,s150)" in plan
    assert [(r["session_id"], r["device"]) for r in found.collect()] == [("s150", "d1")]
    assert rows(warehouse.snapshot().read(USER_SESSIONS, ["s1", "none", "s2050"]).select("session_id")) == [("s1",), ("s2050",)]


def test_keys_have_bloom_filters(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=1)
    load_raw(warehouse, USER_SESSIONS, sessions(spark, 0, 60_000), day(0))
    (file,) = [p for p in (tmp_path / "raw" / "user_sessions").rglob("*.parquet")]
    jvm = spark._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(str(file)), spark._jsparkSession.sessionState().newHadoopConf()
    )
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    having = {columns.get(i).getPath().toDotString() for i in range(columns.size()) if columns.get(i).getBloomFilterOffset() >= 0}
    reader.close()
    assert having == {"session_id"}


# --- runs ---------------------------------------------------------------------------------


def test_a_second_run_is_refused(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    source = read_collections(spark, write_collections(tmp_path / "s"))
    refresh(spark, source, warehouse, day(0))
    with warehouse.begin() as run:
        other = Warehouse(spark, str(tmp_path / "w"))
        with pytest.raises(RunRefused, match="run 2 holds"):
            refresh(spark, source, other, day(1))
        load_raw(run, USER_SESSIONS, sessions(spark, 0, 10), day(1))
        assert other.read(USER_SESSIONS).count() == 2  # nothing is seen before the commit
        run.commit()
    assert other.read(USER_SESSIONS).count() == 12
    refresh(spark, source, other, day(2))
    assert other.runs() == [2, 3]


def test_one_of_many_begins(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    began, refused = [], []

    def begin():
        try:
            began.append(warehouse.begin())
        except RunRefused:
            refused.append(1)

    threads = [threading.Thread(target=begin) for _ in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(began) == 1 and len(refused) == 7


def test_a_lost_run_is_given_up_and_cannot_publish(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), lease_seconds=0)
    lost = warehouse.begin()
    load_raw(lost, USER_SESSIONS, sessions(spark, 0, 5), day(0))
    load_raw(warehouse, USER_SESSIONS, sessions(spark, 0, 7), day(1))
    with pytest.raises(RunRefused, match="given up"):
        lost.commit()
    assert warehouse.runs() == [2] and warehouse.read(USER_SESSIONS).count() == 7


def broken(documents):
    changed = {**documents, "ModerationQueue": [{**documents["ModerationQueue"][0], "rating": "4.5"}]}
    changed["UserSessions"] = [{**documents["UserSessions"][0], "device": "tv"}]
    return changed


def test_a_failed_run_leaves_the_old_set_and_can_be_resumed(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    good = write_collections(tmp_path / "good")
    refresh(spark, read_collections(spark, good), warehouse, day(0))
    before = {t.name: rows(warehouse.read(t)) for t in (*RAW_TABLES.values(), *MARTS.values())}
    bad = write_collections(tmp_path / "bad", broken(SEED))
    with pytest.raises(Exception, match="value_type rating"):
        refresh(spark, read_collections(spark, bad), warehouse, day(1))
    assert {t.name: rows(warehouse.read(t)) for t in (*RAW_TABLES.values(), *MARTS.values())} == before

    loaded = []
    load = plans.load_raw
    monkeypatch.setattr(plans, "load_raw", lambda run, table, *a: (loaded.append(table.name), load(run, table, *a))[1])
    refresh(spark, read_collections(spark, good), warehouse, day(2), resume=True)
    assert loaded == ["moderation_queue"]
    kept = {r["session_id"]: r for r in warehouse.read(USER_SESSIONS).collect()}
    assert kept["sess_001"]["device"] == "tv" and kept["sess_001"]["loaded_at"] == day(1)
    assert kept["sess_002"]["loaded_at"] == day(0)
    assert rows(warehouse.read(USER_ACTIVITY), "updated_at") == rows(
        mart_frame(warehouse, "user_activity", day(2), "product"), "updated_at"
    )


def test_a_snapshot_stays_as_it_was(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), keep=2)
    load_raw(warehouse, USER_SESSIONS, sessions(spark, 0, 10), day(0))
    pinned = warehouse.snapshot()
    load_raw(warehouse, USER_SESSIONS, sessions(spark, 10, 30), day(1))
    assert pinned.read(USER_SESSIONS).count() == 10 and warehouse.read(USER_SESSIONS).count() == 30
    load_raw(warehouse, USER_SESSIONS, sessions(spark, 30, 31), day(2))
    with pytest.raises(ValueError, match="no longer kept"):
        warehouse.snapshot(1)


def test_loads_have_pools_of_their_own(spark):
    def pool():
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    found = plans._all(spark, {"a": pool, "b": pool})
    assert found == ["a", "b"] and pool() is None


# --- marts from changed rows ----------------------------------------------------------------


def random_documents(rng, n):
    """Documents of all collections with few keys, so that batches change rows in every way."""

    def moment():
        return f"2024-01-{rng.randint(1, 5):02}T{rng.randint(0, 23):02}:00:00"

    def some(values, most):
        return [rng.choice(values) for _ in range(rng.randint(0, most))]

    made = {name: [] for name in SEED}
    for _ in range(n):
        made["UserSessions"].append(
            {
                "session_id": f"s{rng.randrange(20)}", "user_id": f"u{rng.randrange(4)}", "start_time": moment(),
                "end_time": rng.choice([None, moment()]), "device": rng.choice([None, "tv", "phone"]),
                "pages_visited": rng.choice([None, some(["/home", "/products/1", "/products/2", None], 4)]),
                "actions": some(["a", "b", "c", None], 4),
            }
        )
        made["SupportTickets"].append(
            {
                "ticket_id": f"t{rng.randrange(20)}", "user_id": f"u{rng.randrange(4)}", "created_at": moment(),
                "status": rng.choice(["open", "closed", "held"]), "issue_type": rng.choice(["x", "y"]),
                "messages": some([1, 2], 3), "updated_at": rng.choice([None, moment()]),
            }
        )
        made["UserRecommendations"].append(
            {"user_id": f"u{rng.randrange(8)}", "recommended_products": some(["1", "3", None], 3), "last_updated": moment()}
        )
        made["ModerationQueue"].append(
            {
                "review_id": f"r{rng.randrange(20)}", "user_id": rng.choice([None, "u1", "u2"]), "product_id": rng.choice([None, "1", "9"]),
                "rating": rng.choice([None, 1, 4, 5]), "moderation_status": rng.choice(["approved", "pending"]),
                "flags": rng.choice([None, ["f"], ["f", "g"]]), "submitted_at": moment(),
            }
        )
    return made


@pytest.mark.parametrize("counting", ["product", "plain"])
def test_updates_equal_rebuilds(spark, tmp_path, counting):
    """After each of several random batches, with compactions, merged parts and vanished dates."""
    rng = random.Random(len(counting))
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2, compact_share=0.6, most_parts=3)
    for n, size in enumerate((30, 6, 12, 2, 25, 1)):
        documents = random_documents(rng, size)
        if n == 3:
            documents["UserSessions"] = []
        source = write_collections(tmp_path / str(n), documents)
        refresh(spark, read_collections(spark, source), warehouse, day(n), counting, marts="update")
        now = warehouse.snapshot()
        for mart in MARTS.values():
            assert rows(now.read(mart), "updated_at") == rows(mart_frame(now, mart.name, day(n), counting), "updated_at"), (n, mart.name)
            state = MART_STATES[mart.name, counting]
            whole = [p for t in state.sources for p in state.contributions(t, now.read(t))]
            union = whole[0]
            for part in whole[1:]:
                union = union.unionByName(part)
            assert rows(now.read(state.state)) == rows(summed(union, state.state).select(*state.state.schema.names))


def test_only_touched_dates_are_written(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    empty = {name: [] for name in SEED}
    one = lambda k, d: {"session_id": k, "user_id": "u", "start_time": d, "pages_visited": ["/home"]}
    first = {**empty, "UserSessions": [one(f"s{n}", f"2024-01-{n:02}") for n in range(1, 9)]}
    refresh(spark, read_collections(spark, write_collections(tmp_path / "a", first)), warehouse, day(0), marts="update")
    second = {**empty, "UserSessions": [one("s3", "2024-01-09"), one("s9", "2024-01-05")]}
    refresh(spark, read_collections(spark, write_collections(tmp_path / "b", second)), warehouse, day(1), marts="update")
    parts = warehouse.snapshot().versions["product_popularity"].parts
    assert parts[-1].dates == ("2024-01-05",)  # s3 is as it was: its start is sticky
    stamps = {r["date"].day: r["updated_at"] for r in warehouse.read(PRODUCT_POPULARITY).collect()}
    assert stamps == {n: day(1) if n == 5 else day(0) for n in range(1, 9)}


def test_a_date_that_loses_its_rows_disappears(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    empty = {name: [] for name in SEED}
    review = {"review_id": "r", "submitted_at": "2024-01-01", "rating": 5}
    refresh(spark, read_collections(spark, write_collections(tmp_path / "a", {**empty, "ModerationQueue": [review]})), warehouse, day(0), marts="update")
    review = {**review, "submitted_at": "2024-01-07"}
    refresh(spark, read_collections(spark, write_collections(tmp_path / "b", {**empty, "ModerationQueue": [review]})), warehouse, day(1), marts="update")
    assert [r["date"].day for r in warehouse.read(MARTS["moderation_stats"]).collect()] == [7]


def test_a_load_outside_a_refresh_renews_the_sums(spark, tmp_path):
    """Sums that would lack its rows are dropped, and the next update builds them anew."""
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    source = read_collections(spark, write_collections(tmp_path / "s"))
    refresh(spark, source, warehouse, day(0), marts="update")
    load_raw(warehouse, USER_SESSIONS, sessions(spark, 0, 50), day(1))
    refresh(spark, source, warehouse, day(2), marts="update")
    now = warehouse.snapshot()
    for mart in MARTS.values():
        assert rows(now.read(mart), "updated_at") == rows(mart_frame(now, mart.name, day(2), "product"), "updated_at")


def test_changed_rows_read_stored_rows_without_a_shuffle(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=4, compact_share=5)
    load_raw(warehouse, USER_SESSIONS, sessions(spark, 0, 100), day(0))
    with warehouse.begin() as run:
        load_raw(run, USER_SESSIONS, sessions(spark, 50, 150, "tv"), day(1))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            new = run.versions["user_sessions"]
            newer = warehouse.reduced(type(new)(new.table, new.buckets, new.parts[1:]), None, spark)
            plan = run.start.read(USER_SESSIONS, newer.select("session_id"))._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        before, after = plans.changed_rows(run, USER_SESSIONS)
        assert before.count() == 50 and after.count() == 100
        assert plans.changed_rows(run, SUPPORT_TICKETS)[0].count() == 0


# --- order of the marts ---------------------------------------------------------------------


def test_a_hot_date_is_split_into_key_ranges(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=2)
    made = spark.range(60_000).selectExpr("date'2024-01-01' AS date", "concat('p', id) AS product_id", "1 AS total_views", "0 AS total_reviews", "0.00BD AS avg_rating", "0 AS times_recommended", "timestamp_ntz'2024-01-01' AS updated_at")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plans.build_mart(warehouse, PRODUCT_POPULARITY, made)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = warehouse.read(PRODUCT_POPULARITY).selectExpr("input_file_name() AS f", "product_id AS k").groupBy("f").agg({"k": "min", "*": "count"})
    found = sorted((r["min(k)"], r["count(1)"]) for r in files.collect())
    assert len(found) == 4 and max(n for _, n in found) < 25_000
    highs = sorted(r[0] for r in warehouse.read(PRODUCT_POPULARITY).selectExpr("input_file_name() AS f", "product_id AS k").groupBy("f").agg({"k": "max"}).select("max(k)").collect())
    assert all(high < low for high, (low, _) in zip(highs, found[1:]))


def test_unused_tables_are_named(spark):
    assert {MODERATION_QUEUE, USER_RECOMMENDATIONS, USER_SESSIONS, SUPPORT_TICKETS} == {t for s in MART_STATES.values() for t in s.sources}
