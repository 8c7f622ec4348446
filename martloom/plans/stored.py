"""Queries over stored tables: what three loads, an empty one and a failed one leave behind.

The derived documents are written as JSON Lines files, read back by ``read_collections``
and loaded in three batches. By the first hex digit of its key's MD5 a row is

``0``    in the third batch only (new there)
``1``    in the second only
``2-3``  in the second (new there) and the third
``4-5``  in all three
``6-7``  in the first two
``8-f``  in the first only; those of ``c`` come back in the second as a document without its keys

A later batch changes its rows. After the second the changes are more than the warehouse leaves
uncompacted, after the third they are less: the tables are then a new base and a change set.
One run serves all queries of a session over the same tables. ``stored_*`` marts are
rebuilt with every batch; ``updated_*`` are kept up from changed rows, in a warehouse of their own.
"""

from __future__ import annotations

import atexit
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.plans.refresh import LoadReport, _all, load_raw, read_collections, refresh
from martloom.schemas import (
    EVENT_LOGS,
    MARTS,
    MODERATION_QUEUE,
    RAW_TABLES,
    SUPPORT_TICKETS,
    USER_RECOMMENDATIONS,
    USER_SESSIONS,
    MartTable,
    RawTable,
)
from martloom.sources import sample
from martloom.sources.documents import documents_from
from martloom.sources.files import Files
from martloom.sources.warehouse import CLEAN_UP, JOINED_BYTES, READ_BYTES, SMALL_JOINED, Warehouse

FIRST, SECOND, THIRD, FOURTH = (datetime(2024, 2, day) for day in (1, 2, 3, 4))
SHARE = 0.3  # of changes to the base that is left uncompacted
BATCHES = ("first", "second", "third")
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
SMALL_READS = str(8 << 20)  # of the source tables a task: its sorts stay in memory
SOURCE_BYTES = 16 << 20  # of the source tables a shuffled partition, at most
SOURCE_ROWS = 1 << 17  # and rows: the sort of a task that reduces them takes some hundred bytes for each
SHUFFLES = "spark.sql.shuffle.partitions"
_RUNS: dict[tuple, tuple[Warehouse, list[tuple]]] = {}
_LANDED: dict[tuple, str] = {}


def _later(column: str, days: int) -> Column:
    return F.col(column) + F.expr(f"INTERVAL '{days}' DAY")


#: What the second and the third batch change. Start of a session and creation of a ticket are sticky.
CHANGES: dict[RawTable, Callable[[int], dict[str, Column]]] = {
    USER_SESSIONS: lambda n: {"start_time": _later("start_time", n), "device": F.lit(("changed", "again")[n - 1])},
    EVENT_LOGS: lambda n: {"event_type": F.lit(("changed", "again")[n - 1])},
    SUPPORT_TICKETS: lambda n: {"created_at": _later("created_at", n), "status": F.lit(("closed", "open")[n - 1])},
    USER_RECOMMENDATIONS: lambda n: {"last_updated": _later("last_updated", n)},
    MODERATION_QUEUE: lambda n: {"rating": F.lit(n)},
}


def _rows(spark: SparkSession, sf_dir: str) -> dict[RawTable, DataFrame]:
    events, orders, lines = (sample.table(spark, sf_dir, n) for n in ("events", "orders", "lineitem"))
    return {
        USER_SESSIONS: sample.user_sessions(events),
        EVENT_LOGS: sample.event_logs(events),
        SUPPORT_TICKETS: sample.support_tickets(orders, lines),
        USER_RECOMMENDATIONS: sample.user_recommendations(orders, lines),
        MODERATION_QUEUE: sample.moderation_queue(lines),
    }


SOURCES = ("events", "orders", "lineitem")


def _most_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the largest source table, from the footers of its files."""
    return max(sample.table(spark, sf_dir, n).count() for n in SOURCES)


def _derivation(spark: SparkSession, sf_dir: str, rows: int = 0) -> dict[str, str]:
    """Settings of jobs that derive the rows: shuffles match the source tables, so sorts stay in memory.

    Bytes tell little of that where rows are much alike, so ``rows`` count too. The documents'
    files, which cannot be split, follow.
    """
    files = Files(spark)
    size = sum(files.size(f"{sf_dir}/{n}.parquet") for n in SOURCES)
    shuffles = max(int(spark.conf.get(SHUFFLES)), size // SOURCE_BYTES + 1, rows // SOURCE_ROWS + 1)
    return {SHUFFLES: str(shuffles), READ_BYTES: SMALL_READS, JOINED_BYTES: SMALL_JOINED, CLEAN_UP: "true"}


def _write_batches(spark: SparkSession, rows: dict[RawTable, DataFrame], root: str) -> None:
    """Each table's rows are derived once, and each row goes to the batches that it is in.

    The tables are written side by side. A task has the files of all batches open at once, so nothing is sorted by batch. They are
    compressed: the documents are many times the size of the tables that they come from.
    """

    def write(table: RawTable, df: DataFrame) -> None:
        digit = F.substring(F.md5(table.key), 1, 1)

        def to(batch: int, document: Column) -> Column:
            return F.struct(F.lit(BATCHES[batch]).alias("batch"), document.alias("document"))

        def row(changes: dict[str, Column]) -> Column:
            return sample.document_of(table, table is not SUPPORT_TICKETS, changes)

        placed = F.array(
            F.when(digit >= "4", to(0, row({}))),
            F.when(digit.between("1", "7"), to(1, row(CHANGES[table](1)))).when(
                digit == "c", to(1, F.to_json(F.struct(F.col(table.key).alias("lost"))))
            ),
            F.when((digit == "0") | digit.between("2", "5"), to(2, row(CHANGES[table](2)))),
        )
        # Left out after the explode, not by array_compact, which interprets what makes the texts.
        documents = df.select(F.explode(placed).alias("p")).where("p IS NOT NULL").select("p.batch", "p.document")
        writer = documents.write.mode("overwrite").partitionBy("batch").option("compression", "gzip")
        writer.text(f"{root}/{table.collection}.jsonl")

    with settings(spark, {OPEN_FILES: str(len(BATCHES))}):
        _all(spark, {table.name: partial(write, table, df) for table, df in rows.items()})


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with other settings for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the checkpoint folder, else the catalog's."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def state_of(sf_dir: str) -> tuple:
    """Tells apart contents of the source tables, where that is a local folder."""
    if not os.path.isdir(sf_dir):
        return ()
    return tuple(sorted((e.name, e.stat().st_mtime_ns, e.stat().st_size) for e in os.scandir(sf_dir)))


def _drop(spark: SparkSession, warehouse: Warehouse) -> None:
    if spark.sparkContext._jsc is not None:
        warehouse.drop()


def _drop_folder(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        Files(spark).delete(path)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the batches; one for a session and state of the tables, gone when the process ends."""
    key = (spark.sparkContext.applicationId, sf_dir, state_of(sf_dir))
    if key not in _LANDED:
        root = f"{shared_folder(spark).rstrip('/')}/landing-{uuid.uuid4().hex}"
        atexit.register(_drop_folder, spark, root)
        with settings(spark, _derivation(spark, sf_dir, _most_rows(spark, sf_dir))):
            _write_batches(spark, _rows(spark, sf_dir), root)
        _LANDED[key] = root
    return _LANDED[key]


def _loaded(spark: SparkSession, sf_dir: str, marts: str = "rebuild") -> tuple[Warehouse, list[tuple]]:
    """The warehouse after all loads, and what they reported. Gone when the process ends."""
    key = (spark.sparkContext.applicationId, sf_dir, state_of(sf_dir), marts)
    if key in _RUNS:
        return _RUNS[key]
    landing = _landed(spark, sf_dir)
    with settings(spark, {CLEAN_UP: "true"}):
        _RUNS[key] = _load(spark, sf_dir, landing, marts)
    return _RUNS[key]


def _load(spark: SparkSession, sf_dir: str, landing: str, marts: str) -> tuple[Warehouse, list[tuple]]:
    root = f"{shared_folder(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    warehouse = Warehouse(spark, root, keep=3, compact_share=SHARE)
    atexit.register(_drop, spark, warehouse)

    def told(batch: int, reports: list[LoadReport]) -> list[tuple]:
        return [(batch, r.table, r.source, r.accepted, r.rejected, r.rows) for r in reports]

    reports = []
    for batch, (name, as_of) in enumerate(zip(BATCHES, (FIRST, SECOND, THIRD)), 1):
        documents = read_collections(spark, landing, f".jsonl/batch={name}")
        reports += told(batch, refresh(spark, documents, warehouse, as_of, marts="update" if marts == "update" else "rebuild"))
    if marts == "again":  # P3: the last batch twice
        refresh(spark, documents, warehouse, FOURTH)
    if marts == "rebuild":
        nothing = documents_from(spark.createDataFrame([], "n int, text string"), "text", ["n"])
        reports += told(4, [load_raw(warehouse, EVENT_LOGS, nothing, FOURTH)])
        # One value too long for its column: the whole batch must fail and leave the table.
        orders = sample.table(spark, sf_dir, "orders")
        wrong = F.to_json(F.struct(F.concat(F.repeat(F.lit("x"), 60), F.col("o_custkey").cast("string")).alias("user_id")))
        bad = documents_from(orders.select(wrong.alias("text"), "o_orderkey"), "text", ["o_orderkey"])
        try:
            load_raw(warehouse, USER_RECOMMENDATIONS, bad, FOURTH)
        except Exception as error:  # noqa: BLE001 - the job's own message is looked for
            if "length user_id" not in str(error):
                raise
            left = warehouse.read(USER_RECOMMENDATIONS).count()
            reports.append((5, USER_RECOMMENDATIONS.name, None, None, None, left))
    return warehouse, reports


def refresh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table after one refresh from the derived rows; its files are gone afterwards."""
    root = f"{shared_folder(spark).rstrip('/')}/refresh-{uuid.uuid4().hex}"
    warehouse = Warehouse(spark, root, keep=1)
    sources = {
        t.collection: sample.as_documents(df, t, keep_nulls=t is not SUPPORT_TICKETS)
        for t, df in _rows(spark, sf_dir).items()
    }
    try:
        with settings(spark, _derivation(spark, sf_dir, _most_rows(spark, sf_dir))):
            reports = refresh(spark, sources, warehouse)
    finally:
        warehouse.drop()
    return spark.createDataFrame([(r.table, r.rows) for r in reports], "`table` string, rows long")


def _flat(df: DataFrame) -> DataFrame:
    arrays = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    return df.withColumns({n: F.array_join(n, ",", "NULL") for n in arrays})


def _stored(table: RawTable | MartTable, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published contents, with their stamp."""
    return _flat(_loaded(spark, sf_dir)[0].read(table))


def stored_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected documents of all loads, with their text."""
    return _loaded(spark, sf_dir)[0].quarantine()


def stored_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table after the last batch was loaded twice, and how many of them the second
    time changed, stamps aside."""
    warehouse = _loaded(spark, sf_dir, "again")[0]
    once, twice = (warehouse.snapshot(run) for run in (3, 4))
    counts = []
    for table in (*RAW_TABLES.values(), *MARTS.values()):
        stamp = "loaded_at" if isinstance(table, RawTable) else "updated_at"
        before, after = (_flat(tables.read(table).drop(stamp)) for tables in (once, twice))
        sides = before.withColumn("side", F.lit(-1)).unionByName(after.withColumn("side", F.lit(1)))
        same = sides.groupBy(*before.columns).agg(F.sum("side").alias("more"), F.count_if(F.col("side") == 1).alias("n"))
        counts.append(
            same.agg(F.lit(table.name).alias("table"), F.sum("n").alias("rows"), F.sum(F.abs("more")).alias("changed"))
        )
    return reduce(DataFrame.unionByName, counts)


def _updated(mart: MartTable, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as updates from changed rows leave it."""
    return _flat(_loaded(spark, sf_dir, "update")[0].read(mart)).drop("updated_at")


def stored_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table as each kept run left them: the second to the fourth."""
    warehouse = _loaded(spark, sf_dir)[0]
    counts = []
    for run in warehouse.runs():
        tables = warehouse.snapshot(run)
        for table in (*RAW_TABLES.values(), *MARTS.values()):
            name = F.lit(table.name).alias("table")
            counts.append(tables.read(table).agg(F.count("*").alias("rows")).select(F.lit(run).alias("run"), name, "rows"))
    return reduce(DataFrame.unionByName, counts)


def stored_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each mart its dates, rows, and files whose range of (date, key) meets that of another."""
    counts = []
    for mart in MARTS.values():
        rows = _loaded(spark, sf_dir)[0].read(mart)
        key = F.struct(*[F.col(k).alias(f"k{n}") for n, k in enumerate(mart.keys)])
        files = rows.groupBy(F.input_file_name().alias("file"), "date").agg(
            F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n")
        )
        before = F.max("high").over(Window.partitionBy("date").orderBy("low").rowsBetween(Window.unboundedPreceding, -1))
        files = files.withColumn("meets", F.col("low") <= before)
        counts.append(
            files.agg(
                F.lit(mart.name).alias("table"),
                F.count_distinct("date").alias("dates"),
                F.sum("n").alias("rows"),
                F.count_if("meets").alias("overlaps"),
            )
        )
    return reduce(DataFrame.unionByName, counts)


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read, accepted and rejected by each load, and rows stored after it."""
    schema = "batch int, `table` string, source long, accepted long, rejected long, rows long"
    return spark.createDataFrame(_loaded(spark, sf_dir)[1], schema)


QUERIES = {
    **{f"stored_{t.name}": partial(_stored, t) for t in (*RAW_TABLES.values(), *MARTS.values())},
    **{f"updated_{m.name}": partial(_updated, m) for m in MARTS.values()},
    "stored_quarantine": stored_quarantine,
    "stored_snapshot": stored_snapshot,
    "stored_order": stored_order,
    "stored_again": stored_again,
    "load_counts": load_counts,
}
