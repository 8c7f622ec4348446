"""Run a registered query and its SQL on the same tables and compare types and values.

As a script: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Spark type name -> DuckDB type name.
_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted_rows(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, query, sql: str, sf_dir: str) -> list[str]:
    """Differences as text; empty when the two results are equal."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    df = df.select(*names)
    con = duck(sf_dir)
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(described) != names:
        return [f"columns: spark {names}, sql {sorted(described)}"]
    for field in df.schema.fields:
        spark_type = field.dataType.simpleString()
        expected = _TYPES.get(spark_type, spark_type.upper())
        if expected != described[field.name]:
            problems.append(f"type of {field.name}: spark {spark_type}, sql {described[field.name]}")
    columns = ", ".join(f'"{n}"' for n in names)
    ours = _sorted_rows(df.collect())
    theirs = _sorted_rows(con.execute(f"SELECT {columns} FROM ({sql})").fetchall())
    if len(ours) != len(theirs):
        problems.append(f"rows: spark {len(ours)}, sql {len(theirs)}")
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, e.g. spark {different[0][0]}, sql {different[0][1]}")
    return problems


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(contract.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in wanted:
        started = time.time()
        try:
            problems = compare(spark, contract.queries()[name], contract.oracle_sql()[name], sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.1f}s", *problems, sep="\n     ")
    spark.stop()
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
