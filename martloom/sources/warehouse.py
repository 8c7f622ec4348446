"""Stored tables: Parquet parts, and one manifest per run that says which parts are current.

Layout below the root::

    <layer>/<table>/v<number>/        one part of a table; never changed once written
    runs/<run>.lease                  made when a run begins; only one run can make it
    runs/<run>.outcome                made when it ends: the parts of every table, or why it failed
    parsed/<run>/<table>/             documents of a load, parsed; gone when the run ends
    quarantine/collection=<c>/run=<run>/  rejected documents of a load

Readers follow the last outcome that was published, so they see all tables as one run left
them. A run that fails leaves the older outcome in place; its parts are swept by a later run.

A table is a list of parts, oldest first:

raw     a base and change sets, all bucketed alike by key. A row of a later part replaces that
        of an earlier one, except for its sticky columns. A load appends one change set
        of its batch's size; nothing stored is rewritten until ``compact`` finds the changes
        large or many.
mart    rows by date; a later part replaces the dates that the manifest lists for it.
state   partial sums; the parts are added up.
"""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.mart_state import STATES, StateTable, summed
from martloom.operators.upsert import last_per_key, merge_newer
from martloom.schemas import MARTS, RAW_TABLES, MartTable, RawTable
from martloom.sources.files import Files

Table = RawTable | MartTable | StateTable
_TABLES: dict[str, Table] = RAW_TABLES | MARTS | STATES

#: Keys to be read: a frame of the key column, a few values, or None for all.
Keys = DataFrame | list[str] | None

#: Partition columns come after those in the files.
STORED_QUARANTINE = "key string, reason string, document string, collection string, run string"
PART = "_part"

#: Settings of the sessions that load and compact: files of shuffles that were read go at once, and
#: a task reads this much, so that what it sorts, many times the size in Parquet, stays in memory.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
READ_BYTES = "spark.sql.files.maxPartitionBytes"
LOAD_READS = 16 << 20
TASK_ROWS = 1 << 17  # of a table that a task sorts

#: Small partitions of a shuffle are joined up to this size. It is that of packed blocks, where a row takes
#: a tenth of its place in memory: the default, 64 MB, are 1.6 million reviews that one task then sorts.
JOINED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SMALL_JOINED = str(4 << 20)
#: Each bucket of a part is one file sorted by key, so a merge of two parts has nothing to sort.
SORTED_READS = "spark.sql.legacy.bucketedTableScan.outputOrdering"
PACKED = "zstd"  # of stored and staged files: a third smaller than the default here


class RunRefused(Exception):
    """Another run holds the warehouse, or has taken it over."""


@dataclass(frozen=True)
class Part:
    number: int
    dates: tuple[str, ...] | None = None  # of a mart: dates that it replaces; None for all
    keys: int = 0  # of a raw table: keys that it holds, at most


@dataclass(frozen=True)
class Version:
    table: Table
    buckets: int  # 0 unless raw
    parts: tuple[Part, ...]

    def plus(self, part: Part) -> Version:
        return Version(self.table, self.buckets, (*self.parts, part))


class Snapshot:
    """All tables as one run left them, or as a run that has not ended has them so far."""

    def __init__(self, warehouse: Warehouse, run: int, versions: dict[str, Version]) -> None:
        self.warehouse = warehouse
        self.run = run
        self.versions = versions
        self.spark = warehouse.spark  # reads, unless they name a session

    def read(self, table: Table, keys: Keys = None, spark: SparkSession | None = None) -> DataFrame:
        """Rows in declared column order; none when the table was never written.

        ``keys`` leaves the rows of a raw table whose key is in it: a frame of that column, or
        for a look-up a list. Stored rows are filtered where they lie, and only what is left is
        merged. With a list only the buckets are opened that its keys fall into, and of
        their row groups only those whose Bloom filters do not rule a key out.
        """
        spark = spark or self.spark
        version = self.versions.get(table.name)
        if version is None:
            return spark.createDataFrame([], table.schema)
        rows = self.warehouse.read_version(version, keys, spark)
        return rows.select(*table.schema.names)

    def count(self, table: RawTable) -> int:
        """Rows of a raw table: the keys of its parts, whose rows need not be merged for that."""
        version = self.versions.get(table.name)
        if version is None:
            return 0
        keys = self.warehouse._bucketed(version, self.spark).select(table.key)
        return (keys if len(version.parts) == 1 else keys.distinct()).count()


class Run(Snapshot):
    """A run that holds the lease. Ends by ``commit``; as a context, by an error too."""

    def __init__(self, start: Snapshot, run: int, taken: dict[str, Version]) -> None:
        super().__init__(start.warehouse, run, start.versions | taken)
        self.start = start
        self.done = frozenset(taken)  # tables that a failed run had loaded
        self._ended = False

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if not self._ended:
            self._end("failed", told=str(error)[:2000] if error else "left without a commit")

    def put(self, version: Version) -> None:
        """Make a staged version the run's own; readers see it after the commit."""
        self.versions[version.table.name] = version

    def drop(self, name: str) -> None:
        self.versions.pop(name, None)

    def commit(self) -> None:
        """Publish all that was put, at once, and sweep what no kept run refers to."""
        house = self.warehouse
        if not self._end("published") or house.last_run() > self.run:
            # A later run may have swept the outcome that gave this one up.
            if house.last_run() > self.run:
                house.forget(self.run)
            raise RunRefused(f"run {self.run} was given up after its lease ended; nothing was published")
        house.sweep(self.run)

    def _end(self, ended: str, **more: object) -> bool:
        self._ended = True
        return self.warehouse._end(self.run, ended, self.versions, **more)

    # --- raw tables ------------------------------------------------------------

    def session_for(self, table: RawTable, incoming: int, keys: int = 0) -> SparkSession:
        """A session whose shuffles match the buckets that a batch will be written to.

        The batch is then shuffled once and the stored rows not at all, whatever the caller's
        session is set to. Where its rows are known (``keys``), a task reads about ``TASK_ROWS`` of
        its ``incoming`` bytes, as it sorts what it reads.
        """
        reads = min(LOAD_READS, max(1, incoming * TASK_ROWS // keys)) if keys else LOAD_READS
        return self._session(self.buckets_for(table, incoming, keys), reads)

    def buckets_for(self, table: RawTable, incoming: int, keys: int = 0) -> int:
        """Those of the stored parts, or more for a batch that alone needs more."""
        version = self.versions.get(table.name)
        if version is None:
            return self.warehouse.bucket_count(self.warehouse.buckets, incoming, keys)
        return self.warehouse.bucket_count(version.buckets, incoming, keys)

    def append(self, table: RawTable, changes: DataFrame, incoming: int, keys: int) -> None:
        """Store one row per key as the table's next change set; of at most ``keys`` keys.

        Only a batch that alone needs more buckets than the table has is merged at once: it is
        larger than what is stored, by the way buckets are chosen.
        """
        number, buckets = 2 * self.run, self.buckets_for(table, incoming, keys)
        version = self.versions.get(table.name)
        if version is not None and version.parts[-1].number >= number:
            raise ValueError(f"{table.name}: loaded already by run {self.run}")
        if version is not None and version.buckets < buckets:
            stored = self.read(table, spark=changes.sparkSession)
            changes = merge_newer(stored, changes, table.key, table.sticky)
            keys += sum(p.keys for p in version.parts)
            version = None
        part = Part(number, keys=keys)
        self.warehouse.write_raw(changes, table, part, buckets)
        self.put(version.plus(part) if version else Version(table, buckets, (part,)))

    def compact(self, table: RawTable) -> str | None:
        """Rewrite parts when changes are large (``base``) or many (``changes``); what was done.

        Changes up to ``compact_share`` of the base are left, so that a byte of the base is
        rewritten once for that share of new ones, not with every load.
        """
        house, version = self.warehouse, self.versions[table.name]
        sizes = [house.files.size(house.path(table, p.number)) for p in version.parts]
        if sum(sizes[1:]) > house.compact_share * sizes[0]:
            keys = sum(p.keys for p in version.parts)
            buckets = house.bucket_count(version.buckets, sum(sizes), keys)
            part = Part(2 * self.run + 1, keys=keys)
            house.write_raw(self.read(table, spark=self._session(buckets)), table, part, buckets)
            self.put(Version(table, buckets, (house.counted(table, part),)))
            return "base"
        if len(version.parts) > house.most_parts:
            newer = Version(table, version.buckets, version.parts[1:])
            part = Part(2 * self.run + 1, keys=sum(p.keys for p in newer.parts))
            rows = house.reduced(newer, None, self._session(version.buckets))
            house.write_raw(rows, table, part, version.buckets)
            self.put(Version(table, version.buckets, (version.parts[0], house.counted(table, part))))
            return "changes"
        return None

    def widen(self) -> None:
        """Read from now on by a session whose shuffles match what the raw tables hold.

        A mart's tasks then sort as much of a large table as of a small one, in memory.
        """
        house = self.warehouse
        held = [(house.path(v.table, p.number), p.keys) for n, v in self.versions.items() if n in RAW_TABLES for p in v.parts]
        size, keys = sum(house.files.size(path) for path, _ in held), sum(keys for _, keys in held)
        self.spark = self._session(house.bucket_count(house.buckets, size, keys))

    def _session(self, buckets: int, reads: int = LOAD_READS) -> SparkSession:
        session = self.warehouse.spark.newSession()
        session.conf.set("spark.sql.shuffle.partitions", str(buckets))
        session.conf.set(CLEAN_UP, "true")
        session.conf.set(READ_BYTES, str(reads))
        session.conf.set(JOINED_BYTES, SMALL_JOINED)
        session.conf.set(SORTED_READS, "true")
        return session

    # --- marts and states ------------------------------------------------------

    def stage_mart(self, rows: DataFrame, mart: MartTable, dates: list[str] | None = None) -> Version:
        """Write mart rows; with ``dates`` they replace these dates only. Not put yet."""
        part = Part(2 * self.run, None if dates is None else tuple(sorted(dates)))
        self.warehouse.write_mart(rows, mart, part.number)
        version = self.versions.get(mart.name)
        if dates is None or version is None:
            return Version(mart, 0, (part,))
        return version.plus(part)

    def add_state(self, rows: DataFrame, state: StateTable, replace: bool = False) -> Version:
        """Write partial sums, to be added to those stored or in place of them, and put them."""
        part = Part(2 * self.run)
        self.warehouse.write_state(rows, state, part.number)
        version = self.versions.get(state.name)
        self.put(Version(state, 0, (part,)) if replace or version is None else version.plus(part))
        return self.versions[state.name]

    def compact_state(self, state: StateTable) -> bool:
        """Add the parts of a state up when they are many; whether that was done."""
        if len(self.versions[state.name].parts) <= self.warehouse.most_parts:
            return False
        part = Part(2 * self.run + 1)
        self.warehouse.write_state(self.read(state), state, part.number)
        self.put(Version(state, 0, (part,)))
        return True


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int | None = None,
        keep: int = 2,
        bucket_bytes: int = 1 << 25,
        bucket_rows: int = TASK_ROWS,
        compact_share: float = 0.25,
        most_parts: int = 8,
        lease_seconds: float = 6 * 3600,
    ) -> None:
        """``buckets``: files per raw table at least, by default the session's shuffle partitions.
        A power-of-two multiple keeps a bucket below ``bucket_bytes`` in its files and below
        ``bucket_rows`` keys, which one task sorts in memory: files tell little of that, as
        rows much alike take thirty times their size in memory. At the platform's ceiling
        buckets get larger. The last ``keep`` published runs stay readable. A run without an
        outcome is given up ``lease_seconds`` after it began."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.keep = keep
        self.bucket_bytes = bucket_bytes
        self.bucket_rows = bucket_rows
        self.compact_share = compact_share
        self.most_parts = most_parts
        self.lease_seconds = lease_seconds
        self.most_buckets = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
        # Catalog entries are made for one process: entries of others may describe other files.
        self._id = hashlib.sha256(f"{self.root}{uuid.uuid4()}".encode()).hexdigest()[:16]
        self._lock = threading.Lock()

    # --- runs ------------------------------------------------------------------

    def begin(self, resume: bool = False) -> Run:
        """Take the lease of the next run; :class:`RunRefused` while another run holds it.

        ``resume`` takes over the tables that a failed last run had loaded in full, so that
        only the others are loaded again.
        """
        last = self.last_run()
        if last and not self.files.exists(self._outcome(last)):
            if time.time() - self.files.modified(self._lease(last)) < self.lease_seconds:
                raise RunRefused(f"run {last} holds the warehouse {self.root}")
            self._end(last, "given up", {})
        number = last + 1
        if not self.files.create_new(self._lease(number), {"began": time.time()}):
            raise RunRefused(f"run {number} of the warehouse {self.root} has just been begun elsewhere")
        start, taken = self.snapshot(), {}
        if resume and last:
            outcome = self.files.read(self._outcome(last))
            if outcome["ended"] == "failed":
                taken = {n: v for n, v in self._versions(outcome).items() if n in RAW_TABLES and v != start.versions.get(n)}
        return Run(start, number, taken)

    def last_run(self) -> int:
        """The latest run that was begun, 0 before the first."""
        return max((int(n.split(".")[0]) for n in self.files.names(self._runs()) if n.endswith(".lease")), default=0)

    def forget(self, run: int) -> None:
        """Take back the outcome of a run that a later one has replaced."""
        self.files.delete(self._outcome(run))

    def runs(self) -> list[int]:
        """Published runs, oldest first."""
        return [n for n, outcome in self._outcomes() if outcome["ended"] == "published"]

    def snapshot(self, run: int | None = None) -> Snapshot:
        """All tables as the last published run left them, or a given one that is still kept."""
        found = Snapshot(self, 0, {})
        for number, outcome in reversed(self._outcomes()):
            if outcome["ended"] == "published" and run in (None, number):
                return Snapshot(self, number, self._versions(outcome))
        if run is not None:
            raise ValueError(f"run {run} is not published or no longer kept")
        return found

    def read(self, table: Table) -> DataFrame:
        """The current rows of one table. Read several from one :meth:`snapshot`."""
        return self.snapshot().read(table)

    def _outcomes(self) -> list[tuple[int, dict]]:
        names = [n for n in self.files.names(self._runs()) if n.endswith(".outcome") and not n.startswith(".")]
        return [(int(n.split(".")[0]), self.files.read(f"{self._runs()}/{n}")) for n in names]

    def _end(self, run: int, ended: str, versions: dict[str, Version], **more: object) -> bool:
        tables = {
            name: {"buckets": v.buckets, "parts": [[p.number, p.dates, p.keys] for p in v.parts]}
            for name, v in versions.items()
        }
        return self.files.publish_new(self._outcome(run), {"ended": ended, "tables": tables, **more})

    def _versions(self, outcome: dict) -> dict[str, Version]:
        def part(number: int, dates: list[str] | None, keys: int) -> Part:
            return Part(number, None if dates is None else tuple(dates), keys)

        return {
            name: Version(_TABLES[name], v["buckets"], tuple(part(*p) for p in v["parts"]))
            for name, v in outcome["tables"].items()
        }

    def sweep(self, run: int) -> None:
        """Delete what runs up to ``run`` left and no kept run refers to.

        Parts of later runs are not looked at: one may be under way already.
        """
        outcomes = [(n, o) for n, o in self._outcomes() if n <= run]
        published = [n for n, o in outcomes if o["ended"] == "published"][-self.keep :]
        kept: dict[str, set[int]] = {}
        for number, outcome in outcomes:
            if number in published:
                for name, version in self._versions(outcome).items():
                    kept.setdefault(name, set()).update(p.number for p in version.parts)
        for number, _ in outcomes:
            if number < published[0]:  # outcome first: parts that are gone must not look published
                self.files.delete(self._outcome(number))
                self.files.delete(self._lease(number))
        for name, table in _TABLES.items():
            for folder in self.files.names(self._table_path(table)):
                number = int(folder[1:])
                if number <= 2 * run + 1 and number not in kept.get(name, ()):
                    self.files.delete(self.path(table, number))
                    for row in self.spark.sql(f"SHOW TABLES LIKE 'raw_{name}_{self._id}_*p{number}p*'").collect():
                        self.spark.sql(f"DROP TABLE IF EXISTS `{row['tableName']}`")
        for number in self.files.names(f"{self.root}/parsed"):
            if int(number) <= run:
                self.files.delete(f"{self.root}/parsed/{number}")

    # --- reading ---------------------------------------------------------------

    def read_version(self, version: Version, keys: Keys = None, spark: SparkSession | None = None) -> DataFrame:
        """Rows of one version, published or staged."""
        table, spark = version.table, spark or self.spark
        if isinstance(table, StateTable):
            rows = spark.read.schema(table.schema).parquet(*[self.path(table, p.number) for p in version.parts])
            return summed(rows, table)
        if isinstance(table, MartTable):
            return self._read_mart(version, spark)
        base = _of_keys(self._bucketed(Version(table, version.buckets, version.parts[:1]), spark).drop(PART), table.key, keys)
        if len(version.parts) == 1:
            return base
        newer = self.reduced(Version(table, version.buckets, version.parts[1:]), keys, spark)
        return merge_newer(base, newer, table.key, table.sticky)

    def reduced(self, version: Version, keys: Keys, spark: SparkSession) -> DataFrame:
        """One row per key over the parts of a raw table, the latest but for sticky columns."""
        rows = _of_keys(self._bucketed(version, spark), version.table.key, keys)
        if len(version.parts) == 1:
            return rows.drop(PART)
        return last_per_key(rows, version.table.key, [PART], version.table.sticky, version.table.schema.names)

    def _bucketed(self, version: Version, spark: SparkSession) -> DataFrame:
        """The rows of all parts with the number of their part, as one bucketed scan.

        The parts are the partitions of a catalog entry, so that buckets of equal number
        come together and neither a join nor an aggregation by key has to exchange them.
        """
        table = version.table
        numbers = [p.number for p in version.parts]
        name = f"raw_{table.name}_{self._id}_p{'p'.join(map(str, numbers))}p_b{version.buckets}"
        with self._lock:
            if not spark.catalog.tableExists(name):
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
                spark.sql(
                    f"CREATE TABLE `{name}` ({columns}, `{PART}` INT) USING parquet PARTITIONED BY (`{PART}`) "
                    f"CLUSTERED BY (`{table.key}`) SORTED BY (`{table.key}`) INTO {version.buckets} BUCKETS "
                    f"LOCATION '{self._table_path(table)}'"
                )
                places = " ".join(f"PARTITION (`{PART}`={n}) LOCATION '{self.path(table, n)}'" for n in numbers)
                spark.sql(f"ALTER TABLE `{name}` ADD IF NOT EXISTS {places}")
        return spark.table(name)

    def _read_mart(self, version: Version, spark: SparkSession) -> DataFrame:
        """Every date from the last part that replaces it."""
        table, frames, replaced = version.table, [], set()
        for part in reversed(version.parts):
            rows = spark.read.schema(table.schema).parquet(self.path(table, part.number))
            if replaced:
                rows = rows.where(~F.col("date").isin([F.to_date(F.lit(d)) for d in sorted(replaced)]))
            frames.append(rows.select(*table.schema.names))
            replaced.update(part.dates or ())
        return reduce(DataFrame.unionByName, frames)

    # --- writing ---------------------------------------------------------------

    def write_raw(self, rows: DataFrame, table: RawTable, part: Part, buckets: int) -> None:
        path, spark = self.path(table, part.number), rows.sparkSession
        name = f"staged_{table.name}_{self._id}_{part.number}"
        self.files.delete(path)
        (
            rows.select(*table.schema.names)
            .write.format("parquet")
            .bucketBy(buckets, table.key)
            .sortBy(table.key)
            .option("path", path)
            .option("compression", PACKED)
            .option(f"parquet.bloom.filter.enabled#{table.key}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{table.key}", str(part.keys // buckets + 1))
            .saveAsTable(name)
        )
        spark.sql(f"DROP TABLE `{name}`")  # the files stay

    def write_mart(self, rows: DataFrame, mart: MartTable, number: int) -> None:
        """Rows in disjoint ranges of (date, key) per file, sorted: a hot date is split by key."""
        writer = (
            rows.select(*mart.schema.names)
            .repartitionByRange(*mart.keys)
            .sortWithinPartitions(*mart.keys)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", PACKED)
        )
        (writer.partitionBy("date") if mart.by_date else writer).parquet(self.path(mart, number))

    def write_state(self, rows: DataFrame, state: StateTable, number: int) -> None:
        """Sums in ranges of their keys, the date first: reading a few dates skips the other row groups.

        No folder per date, as there may be many dates with few rows in a change.
        """
        ranged = rows.select(*state.schema.names).repartitionByRange(*state.keys).sortWithinPartitions(*state.keys)
        ranged.write.mode("overwrite").option("compression", PACKED).parquet(self.path(state, number))

    def keep_rejected(self, rows: DataFrame, collection: str, run: str) -> None:
        """Keep the rejected documents of one collection and run; the same run again replaces them.

        Each load writes a folder of its own, so loads side by side do not meet.
        """
        path = f"{self.root}/quarantine/collection={collection}/run={run}"
        rows.drop("collection").write.mode("overwrite").parquet(path)

    def quarantine(self) -> DataFrame:
        """``(key, reason, document, collection, run)`` of all rejected documents."""
        root = f"{self.root}/quarantine"
        if not any(name.startswith("collection=") for name in self.files.names(root)):
            return self.spark.createDataFrame([], STORED_QUARANTINE)
        return self.spark.read.schema(STORED_QUARANTINE).option("basePath", root).parquet(root)

    def counted(self, table: RawTable, part: Part) -> Part:
        """A part just written, with the rows that it has: the sum of what it was merged from grows with every load."""
        return Part(part.number, keys=self.spark.read.schema(table.schema).parquet(self.path(table, part.number)).count())

    def bucket_count(self, at_least: int, size: int, keys: int = 0) -> int:
        count = at_least
        while (size > count * self.bucket_bytes or keys > count * self.bucket_rows) and count * 2 <= self.most_buckets:
            count *= 2
        return min(count, self.most_buckets)

    def drop(self) -> None:
        """Remove every table of this warehouse, files and catalog entries."""
        for row in self.spark.sql(f"SHOW TABLES LIKE '*_{self._id}_*'").collect():
            self.spark.sql(f"DROP TABLE IF EXISTS `{row['tableName']}`")
        self.files.delete(self.root)

    # --- paths -----------------------------------------------------------------

    def parsed_path(self, table: RawTable, run: int) -> str:
        return f"{self.root}/parsed/{run}/{table.name}"

    def path(self, table: Table, number: int) -> str:
        return f"{self._table_path(table)}/{_folder(number)}"

    def _table_path(self, table: Table) -> str:
        layer = {RawTable: "raw", MartTable: "mart", StateTable: "state"}[type(table)]
        return f"{self.root}/{layer}/{table.name}"

    def _runs(self) -> str:
        return f"{self.root}/runs"

    def _lease(self, run: int) -> str:
        return f"{self._runs()}/{run:010d}.lease"

    def _outcome(self, run: int) -> str:
        return f"{self._runs()}/{run:010d}.outcome"


def _folder(number: int) -> str:
    return f"v{number:010d}"


def _of_keys(rows: DataFrame, key: str, keys: Keys) -> DataFrame:
    if keys is None:
        return rows
    if isinstance(keys, list):
        return rows.where(F.col(key).isin(keys))
    return rows.join(keys, key, "left_semi")
