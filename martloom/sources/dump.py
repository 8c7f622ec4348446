"""Dumps of a document collection as a data source: extended JSON, one document per line.

``spark.read.format("collection_dump").load(path)`` gives

``id``        the document's ``_id`` as text; NULL when it has none
``document``  the document as plain JSON, without ``_id``
``file``, ``position``  where its line begins, in bytes; together the read order

Files are split into byte ranges, each read by one task; a line belongs to the range that it begins
in. Filters on ``id`` and ``file`` are pushed down (``spark.sql.python.filterPushdown.enabled``):
other files are not opened and other documents not converted. Comparing ids is how a
collection is read from a point on, as ids grow with time.

Typed values become plain ones: ``$oid`` and ``$symbol`` a text, ``$numberInt``, ``$numberLong``,
``$numberDouble`` and ``$numberDecimal`` a number, ``$undefined`` null. A ``$date`` stays an
object, which no column takes for a time. A line that is no JSON object, or names a key twice, is
passed on as it is, for the parser to reject. Blank lines are no documents.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
)

FORMAT = "collection_dump"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
SPLIT_BYTES = 64 << 20
_CHUNK = 1 << 20
_ROWS = 2048

_SCHEMA = pa.schema([("id", pa.string()), ("document", pa.string()), ("file", pa.string()), ("position", pa.int64())])
# A leading ObjectId, as exports write it; what follows is converted only if it has typed values.
_LEADING_ID = re.compile(r'\{\s*"_id"\s*:\s*\{\s*"\$oid"\s*:\s*"([0-9a-f]{24})"\s*\}\s*,')


class _KeyTwice(ValueError):
    pass


def _number(text: str) -> object:
    try:
        return int(text)
    except ValueError:
        value = float(text)
        return value if abs(value) < float("inf") else text  # also false for NaN


_PLAIN: dict[str, Callable[[object], object]] = {
    "$oid": str,
    "$symbol": str,
    "$numberInt": _number,
    "$numberLong": _number,
    "$numberDouble": _number,
    "$numberDecimal": _number,
    "$undefined": lambda _: None,
}


def _plain(pairs: list[tuple[str, object]]) -> object:
    if len(pairs) == 1 and pairs[0][0] in _PLAIN:
        return _PLAIN[pairs[0][0]](pairs[0][1])
    made = dict(pairs)
    if len(made) < len(pairs):
        raise _KeyTwice
    return made


def convert(line: str) -> tuple[str | None, str]:
    """(id, document) of one line."""
    leading = _LEADING_ID.match(line)
    if leading and '"$' not in line[leading.end() :] and '"_id"' not in line[leading.end() :]:
        return leading.group(1), "{" + line[leading.end() :]
    try:
        document = json.loads(line, object_pairs_hook=_plain)
    except (ValueError, RecursionError):
        return None, line
    if not isinstance(document, dict):
        return None, line
    found = document.pop("_id", None)
    return None if found is None else str(found), json.dumps(document, ensure_ascii=False)


@dataclass
class Split(InputPartition):
    file: str
    start: int
    end: int


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def lines_of(split: Split) -> Iterator[tuple[int, bytes]]:
    """(position, line) of the lines that begin in a range."""
    system, path = _open(split.file)
    with system.open_input_file(path) as file:
        at, rest = split.start, b""
        if at:  # the line that the byte before belongs to is the earlier range's
            file.seek(at - 1)
            at -= 1
            skipping = True
        else:
            skipping = False
        while True:
            chunk = file.read(_CHUNK)
            if not chunk and not rest:
                return
            data = rest + chunk
            if skipping:
                cut = data.find(b"\n")
                if cut < 0:
                    at += len(data)
                    rest = b""
                    if not chunk or at >= split.end:
                        return
                    continue
                at, data, skipping = at + cut + 1, data[cut + 1 :], False
            *whole, rest = data.split(b"\n")
            if not chunk and rest:
                whole, rest = [*whole, rest], b""
            for line in whole:
                if at >= split.end:
                    return
                yield at, line
                at += len(line) + 1
            if not chunk or (at >= split.end):
                return


class DumpReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keep those on ``id`` and ``file``; Spark applies the others."""
        for f in filters:
            if isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual)) and f.attribute in (("id",), ("file",)):
                self.tests.append(f)
            else:
                yield f

    def _passes(self, column: str, value: str | None) -> bool:
        for f in self.tests:
            if f.attribute != (column,):
                continue
            if value is None:
                return False
            if isinstance(f, In):
                if value not in f.value:
                    return False
            elif isinstance(f, EqualTo):
                if value != f.value:
                    return False
            # Spark orders text by its UTF-8 bytes, as Python does by code points.
            elif not (value > f.value if isinstance(f, GreaterThan) else value >= f.value):
                return False
        return True

    def partitions(self) -> list[Split]:
        system, path = _open(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        prefix = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        splits = []
        for f in sorted(found, key=lambda f: f.path):
            hidden = f.base_name.startswith(("_", "."))
            name = prefix + f.path
            if not f.is_file or hidden or not f.size or not self._passes("file", name):
                continue
            splits += [Split(name, at, min(at + self.split_bytes, f.size)) for at in range(0, f.size, self.split_bytes)]
        return splits

    def read(self, partition: Split | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # how Spark reads a source without partitions
            return
        rows: list[tuple] = []
        for at, line in lines_of(partition):
            if not line.strip():
                continue
            found, document = convert(line.decode("utf-8", "replace").rstrip("\r"))
            if self._passes("id", found):
                rows.append((found, document, partition.file, at))
            if len(rows) >= _ROWS:
                yield self._batch(rows)
                rows = []
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


class CollectionDump(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "id string, document string, file string, position long"

    def reader(self, schema) -> DumpReader:  # noqa: ANN001
        return DumpReader({k.lower(): v for k, v in self.options.items()})


def read_dump(spark: SparkSession, path: str, since: str | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(document, read_order)`` of a dump, for ``parse``; with ``since`` of later ids only."""
    spark.dataSource.register(CollectionDump)
    spark.conf.set(PUSHDOWN, "true")
    rows = spark.read.format(FORMAT).option("splitBytes", str(split_bytes)).load(path)
    if since is not None:
        rows = rows.where(F.col("id") > since)
    return rows.select("document", F.struct("file", "position").alias("read_order"))
