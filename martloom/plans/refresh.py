"""One run of the whole job: five raw loads, then four marts, published together."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.exact import instant
from martloom.operators.mart_state import MART_STATES, MartState, summed
from martloom.operators.moderation_stats import moderation_stats
from martloom.operators.product_popularity import product_popularity
from martloom.operators.quality import duplicate_keys, enforce, raise_on
from martloom.operators.support_efficiency import support_efficiency
from martloom.operators.upsert import last_per_key
from martloom.operators.user_activity import user_activity
from martloom.schemas import (
    MARTS,
    MODERATION_QUEUE,
    RAW_TABLES,
    SUPPORT_TICKETS,
    USER_RECOMMENDATIONS,
    USER_SESSIONS,
    MartTable,
    RawTable,
)
from martloom.sources.documents import accepted, parse, read_documents, rejected
from martloom.sources.warehouse import PACKED, TASK_ROWS, Part, Run, Snapshot, Version, Warehouse


T = TypeVar("T")

#: Keys of a batch up to which its stored rows are looked up, not joined.
LOOKED_UP = 64
WAS = "_was_"  # before the names of columns as they were


@dataclass(frozen=True)
class LoadReport:
    """What one task did. Counts of documents are those of the rows the parse wrote."""

    table: str
    rows: int
    source: int | None = None
    accepted: int | None = None
    rejected: int | None = None


def read_collections(spark: SparkSession, root: str, suffix: str = ".jsonl") -> dict[str, DataFrame]:
    """Documents of the five collections from ``<root>/<collection><suffix>``, a file or directory."""
    return {
        t.collection: read_documents(spark, f"{root}/{t.collection}{suffix}")
        for t in RAW_TABLES.values()
    }


def load_raw(
    target: Warehouse | Run,
    table: RawTable,
    documents: DataFrame,
    as_of: datetime,
    batch_bytes: int | None = None,
) -> LoadReport:
    """Parse and check one collection, and append it to its table as a change set.

    The source is read once: its documents are parsed into the warehouse's shared folder, with
    whether they were rejected. They are not split by that: a task would sort all it
    parsed, and files that cannot be split make tasks grow with the collection. Emptiness, counts, the quarantine and the change set
    come from there, so they agree even when the source changes meanwhile. A bad value fails
    the write and nothing is published. ``batch_bytes`` is the size the batch will have when
    stored, by default that of the parsed files.

    Given a warehouse, the load is a run of its own, with its compaction.
    """
    if isinstance(target, Warehouse):
        with target.begin() as run:
            report = load_raw(run, table, documents, as_of, batch_bytes)
            for state in MART_STATES.values():  # sums that would lack this load
                if table in state.sources:
                    run.drop(state.state.name)
            if report.accepted:
                run.compact(table)
            run.commit()
            return report
    run, warehouse = target, target.warehouse
    stamp = as_of.strftime("%Y%m%dT%H%M%S%f")
    path = warehouse.parsed_path(table, run.run)
    try:
        rejects = F.col("reject_reason").isNotNull()
        parsed = parse(documents, table).withColumns(
            {"rejected": rejects, "document": F.when(rejects, F.col("document"))}
        )
        # Files of so many rows, as reads are not split inside a row group.
        writer = parsed.write.mode("overwrite").option("compression", PACKED).option("maxRecordsPerFile", TASK_ROWS)
        writer.parquet(path)
        size = warehouse.files.size(path) if batch_bytes is None else batch_bytes
        staged = run.session_for(table, size).read.schema(parsed.schema).parquet(path)
        counts = {r["rejected"]: r["n"] for r in staged.groupBy("rejected").agg(F.count("*").alias("n")).collect()}
        good, bad = counts.get(False, 0), counts.get(True, 0)
        # Now that the rows are known, by a session of as many buckets as they need.
        staged = run.session_for(table, size, good).read.schema(parsed.schema).parquet(path)
        if bad:
            warehouse.keep_rejected(rejected(staged.where("rejected"), table), table.collection, stamp)
        if good:
            batch = enforce(accepted(staged.where("NOT rejected"), table), table)
            latest = last_per_key(batch, table.key, ["read_order"], table.sticky, table.column_names)
            run.append(table, latest.withColumn("loaded_at", instant(as_of)), size, good)
        return LoadReport(table.name, run.count(table), good + bad, good, bad)
    finally:
        warehouse.files.delete(path)


def build_mart(target: Warehouse | Run, mart: MartTable, rows: DataFrame, dates: list[str] | None = None) -> LoadReport:
    """Rebuild one mart from scratch, or only the given dates of it.

    What is gone from the source disappears with the rows that are replaced.
    """
    if isinstance(target, Warehouse):
        with target.begin() as run:
            report = build_mart(run, mart, rows, dates)
            run.commit()
            return report
    run = target
    version = run.stage_mart(enforce(rows, mart), mart, dates)
    added = run.warehouse.read_version(Version(mart, 0, (Part(version.parts[-1].number),)), spark=run.spark)
    raise_on(duplicate_keys(added, mart))
    run.put(version)
    return LoadReport(mart.name, run.read(mart).count())


def changed_rows(run: Run, table: RawTable) -> tuple[DataFrame, DataFrame] | None:
    """Rows of the keys that this run's loads brought, as they were before and as they are.

    None when the run's parts do not tell: the table was rewritten. The stored rows are read
    once, filtered by key where they lie, and merged once; both states of a row are written
    side by side, so that the marts read what they need of them without a join.
    """
    before, now = run.start.versions.get(table.name), run.versions.get(table.name)
    old = before.parts if before else ()
    new = now.parts[len(old) :] if now else ()
    if now and (now.parts[: len(old)] != old or not old):
        return None
    if not new:
        nothing = run.spark.createDataFrame([], table.schema)
        return nothing, nothing
    newer = run.warehouse.reduced(Version(table, now.buckets, new), None, run.spark)
    keys = newer.select(table.key)
    few = [r[0] for r in keys.limit(LOOKED_UP + 1).collect()]
    known = run.start.read(table, keys if len(few) > LOOKED_UP else few, run.spark)
    was = {c: f"{WAS}{c}" for c in table.schema.names}
    known = known.select(*[F.col(c).alias(n) for c, n in was.items()])
    found = F.col(was[table.key]).isNotNull()
    after = [F.when(found, F.col(was[c])).otherwise(F.col(c)).alias(c) if c in table.sticky else c for c in was]
    both = newer.join(known, F.col(table.key) == F.col(was[table.key]), "left").select(*after, *was.values())
    path = f"{run.warehouse.parsed_path(table, run.run)}-changed"
    both.write.mode("overwrite").option("compression", PACKED).parquet(path)
    both = run.spark.read.schema(both.schema).parquet(path)
    return both.where(found).select(*[F.col(n).alias(c) for c, n in was.items()]), both.select(*was)


def update_mart(run: Run, spec: MartState, changes: Mapping[RawTable, tuple | None], as_of: datetime) -> LoadReport:
    """Bring a mart up to date from changed rows alone.

    They are added to the mart's stored sums and taken from them, and the dates that this touches
    are built anew from the sums. Without sums, or where a table was rewritten, the sums are
    built from all rows. Stamps of untouched dates stay.
    """
    state, mart = spec.state, spec.mart
    sources = {table: changes[table] for table in spec.sources}
    known = state.name in run.versions and mart.name in run.versions
    if not known or any(c is None for c in sources.values()):
        rows = [part for table in sources for part in spec.contributions(table, run.read(table))]
        run.add_state(summed(reduce(DataFrame.unionByName, rows), state), state, replace=True)
        return build_mart(run, mart, spec.finish(run.read(state), as_of))
    rows = []
    for table, (before, after) in sources.items():
        rows += spec.contributions(table, before, -1) + spec.contributions(table, after)
    version = run.add_state(summed(reduce(DataFrame.unionByName, rows), state), state)
    added = run.warehouse.read_version(Version(state, 0, version.parts[-1:]), spark=run.spark)
    dates = [r["date"] for r in added.select(F.col("date").cast("string")).distinct().collect()]
    sums = run.read(state)
    if len(run.versions[mart.name].parts) >= run.warehouse.most_parts:
        report = build_mart(run, mart, spec.finish(sums, as_of))
    else:
        touched = F.col("date").isin([F.to_date(F.lit(d)) for d in dates if d is not None])
        # A row without a date breaks the mart's key, which the check has to see.
        report = build_mart(
            run, mart, spec.finish(sums.where(touched | F.col("date").isNull()), as_of), [d for d in dates if d is not None]
        )
    run.compact_state(state)
    return report


def mart_frame(tables: Warehouse | Snapshot, mart: str, as_of: datetime, counting: str) -> DataFrame:
    """A mart from all raw rows."""
    read = tables.read
    if mart == "user_activity":
        return user_activity(read(USER_SESSIONS), counting, as_of)
    if mart == "support_efficiency":
        return support_efficiency(read(SUPPORT_TICKETS), as_of)
    if mart == "moderation_stats":
        return moderation_stats(read(MODERATION_QUEUE), as_of)
    return product_popularity(
        read(USER_SESSIONS), read(MODERATION_QUEUE), read(USER_RECOMMENDATIONS), as_of
    )


def _all(spark: SparkSession, tasks: Mapping[str, Callable[[], T]]) -> list[T]:
    """Run independent tasks side by side; every one ends before errors are raised, all of them.

    Each has a scheduler pool of its own name: where the application schedules fairly
    (``spark.scheduler.mode=FAIR``), a large load leaves the others their share of the cores.
    """

    def pooled(name: str, task: Callable[[], T]) -> Callable[[], T]:
        def run() -> T:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            return task()

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        running = [pool.submit(pooled(name, task)) for name, task in tasks.items()]
    failed = [r.exception() for r in running if r.exception() is not None]
    if len(failed) > 1:
        raise RuntimeError("; ".join(str(e) for e in failed)) from failed[0]
    return [r.result() for r in running]


def refresh(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    warehouse: Warehouse,
    as_of: datetime | None = None,
    counting: str = "product",
    marts: str = "rebuild",
    resume: bool = False,
) -> list[LoadReport]:
    """Load every collection, and when all are loaded bring every mart up to date.

    ``sources`` maps a collection name to its documents (``document``, ``read_order``).
    ``marts="rebuild"`` computes every mart from all raw rows, ``"update"`` from the rows that
    the loads changed; the results are equal but for stamps of rows that did not change.

    The run holds the warehouse's lease and publishes everything at its end. When it fails, all
    tables stay as they were; ``resume`` then takes over the loads that had succeeded.
    Running twice gives the same tables apart from the stamps.
    """
    if marts not in ("rebuild", "update"):
        raise ValueError(f"marts must be 'rebuild' or 'update', not {marts!r}")
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    with warehouse.begin(resume) as run:
        loads = _all(
            spark,
            {
                table.name: lambda t=table: load_raw(run, t, sources[t.collection], as_of)
                for table in RAW_TABLES.values()
                if table.name not in run.done
            },
        )
        changes = {}
        if marts == "rebuild":
            for name in [spec.state.name for spec in MART_STATES.values()]:
                run.drop(name)
        else:
            run.widen()
            read = [t for t in RAW_TABLES.values() if any(t in s.sources for s in MART_STATES.values())]
            changes = dict(zip(read, _all(spark, {t.name: lambda t=t: changed_rows(run, t) for t in read})))
        # Before the marts, which then have fewer parts to merge.
        loaded = {n: run.versions[n] for n in RAW_TABLES if n in run.versions}
        _all(spark, {n: lambda t=RAW_TABLES[n]: run.compact(t) for n in loaded})
        run.widen()
        if marts == "rebuild":
            builds = {
                m.name: lambda m=m: build_mart(run, m, mart_frame(run, m.name, as_of, counting))
                for m in MARTS.values()
            }
        else:
            builds = {
                name: lambda n=name: update_mart(run, MART_STATES[n, counting], changes, as_of) for name in MARTS
            }
        try:
            built = _all(spark, builds)
        except BaseException:
            run.versions.update(loaded)  # by their parts a run that resumes tells what was changed
            raise
        run.commit()
    return loads + built
