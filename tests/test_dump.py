"""The dump source: typed values, byte ranges, filters and bad lines."""

from __future__ import annotations

import json
import random

import pytest

from martloom.schemas import USER_SESSIONS
from martloom.sources.documents import parse
from martloom.sources.dump import DumpReader, Split, convert, lines_of, read_dump

OID = "5f0c1d2e3a4b5c6d7e8f9a0b"


@pytest.mark.parametrize(
    "line, found, document",
    [
        (f'{{"_id":{{"$oid":"{OID}"}},"a":1.50}}', OID, '{"a":1.50}'),
        (f'{{"a":{{"$numberInt":"5"}},"_id":{{"$oid":"{OID}"}}}}', OID, '{"a": 5}'),
        ('{"_id":{"$numberLong":"12"},"a":{"$numberDouble":"NaN"}}', "12", '{"a": "NaN"}'),
        ('{"a":{"$numberDecimal":"2.50"},"b":[{"$symbol":"x"},{"$undefined":true}]}', None, '{"a": 2.5, "b": ["x", null]}'),
        ('{"at":{"$date":{"$numberLong":"1700000000000"}}}', None, '{"at": {"$date": 1700000000000}}'),
        ('{"é":"\\u00e9 ✓"}', None, '{"é": "é ✓"}'),
        ('{"a":1,"a":2}', None, '{"a":1,"a":2}'),
        ("{broken", None, "{broken"),
        ("[1]", None, "[1]"),
    ],
)
def test_typed_values_become_plain(line, found, document):
    assert convert(line) == (found, document)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50, 10_000])
def test_every_line_is_in_one_range(tmp_path, size):
    rng = random.Random(size)
    lines = [b"x" * rng.choice([0, 1, 2, 5, 60]) for _ in range(60)]
    for tail in (b"", b"\n"):
        data = b"\n".join(lines) + tail
        path = tmp_path / "f"
        path.write_bytes(data)
        found = [p for at in range(0, len(data), size) for p in lines_of(Split(str(path), at, min(at + size, len(data))))]
        places, at = [], 0
        for line in data.split(b"\n"):
            places.append((at, line))
            at += len(line) + 1
        assert [p for p in found if p[1]] == [p for p in places if p[1]]
        assert len(set(found)) == len(found)


def test_long_lines_cross_chunks(tmp_path):
    data = b"a" * 3_000_000 + b"\n" + b"b" * 2_500_000 + b"\nlast"
    path = tmp_path / "f"
    path.write_bytes(data)
    found = [p for at in range(0, len(data), 1_000_000) for p in lines_of(Split(str(path), at, min(at + 1_000_000, len(data))))]
    assert [(at, len(line)) for at, line in found] == [(0, 3_000_000), (3_000_001, 2_500_000), (5_500_002, 4)]


def write(path, ids):
    path.parent.mkdir(exist_ok=True)
    documents = [
        {"_id": {"$oid": f"{n:024x}"}, "session_id": f"s{n}", "user_id": "u", "start_time": "2024-01-10T09:00:00Z"} for n in ids
    ]
    path.write_text("".join(json.dumps(d) + "\n\n" for d in documents))


def test_partitions_order_and_hidden_files(spark, tmp_path):
    write(tmp_path / "d" / "a.json", range(50))
    write(tmp_path / "d" / "b.json", range(50, 60))
    (tmp_path / "d" / "_SUCCESS").write_text("")
    rows = read_dump(spark, str(tmp_path / "d"), split_bytes=1000)
    assert rows.rdd.getNumPartitions() > 5
    found = rows.orderBy("read_order").selectExpr("get_json_object(document, '$.session_id') AS s").collect()
    assert [r["s"] for r in found] == [f"s{n}" for n in range(60)]
    assert read_dump(spark, str(tmp_path / "d" / "a.json")).count() == 50


def test_filters_are_pushed(spark, tmp_path):
    write(tmp_path / "d" / "a.json", range(50))
    write(tmp_path / "d" / "b.json", range(50, 60))
    late = read_dump(spark, str(tmp_path / "d"), since=f"{54:024x}")
    assert late.count() == 5
    rows = spark.read.format("collection_dump").load(str(tmp_path / "d"))
    one = rows.where(f"id = '{7:024x}' AND position >= 0")
    assert one.count() == 1
    assert rows.where(f"id IN ('{7:024x}', '{58:024x}', 'x')").count() == 2
    named = [r["file"] for r in rows.select("file").distinct().collect()]
    assert rows.where(f"file = '{sorted(named)[1]}'").count() == 10
    reader = DumpReader({"path": str(tmp_path / "d")})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    kept = list(reader.pushFilters([EqualTo(("file",), sorted(named)[1]), GreaterThan(("position",), 3)]))
    assert len(kept) == 1 and len(reader.partitions()) == 1


def test_a_native_date_is_rejected(spark, tmp_path):
    path = tmp_path / "d.json"
    good = {"_id": {"$oid": OID}, "session_id": "a", "user_id": "u", "start_time": "2024-01-10T09:00:00Z"}
    native = {**good, "session_id": "b", "start_time": {"$date": "2024-01-10T09:00:00Z"}}
    path.write_text("\n".join(json.dumps(d) for d in (good, native)) + "\n{broken\n")
    parsed = parse(read_dump(spark, str(path)), USER_SESSIONS).collect()
    assert {(r.session_id, r.reject_reason) for r in parsed} == {
        (None, "not a JSON object"), ("a", None), ("b", "bad timestamp: start_time"),
    }


def test_missing_and_empty(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert read_dump(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(Exception, match="FileNotFoundError"):
        read_dump(spark, str(tmp_path / "none")).count()
