"""Document collections: read JSON text, parse it to typed rows, split off bad documents.

A parsed frame has the columns of its raw table plus

``document``       the JSON text
``read_order``     position of the document in the read order
``reject_reason``  why the document is left out; NULL when it is accepted
``type_error``     a value its column cannot store; NULL when there is none
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.text import cut_blank_tail
from martloom.functions.timestamps import with_utc_times
from martloom.schemas import NO_DEFAULT, Kind, RawColumn, RawTable

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("collection", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("document", T.StringType()),
    ]
)

_SCALAR_ARRAY = r"^ARRAY<(VOID|STRING|BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE|BOOLEAN)>$"
_END_MARK = 7
_INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
# JSON text of the values that count as "no value" for an optional time.
_EMPTY_VALUE = r'^(null|""|-?0(\.0)?|false|\[\]|\{\})$'


def read_documents(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """JSON Lines files as ``(document, read_order)``, one row per non-blank line.

    ``read_order`` is (file, split start, position): inside one split the row id
    grows with the file position, and a retried task gets the same ids again.
    """
    lines = spark.read.options(**options).text(path)
    return lines.select(
        F.col("value").alias("document"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("position"),
        ).alias("read_order"),
    ).filter(F.trim("document") != "")


def documents_from(df: DataFrame, document: str, order_by: list[Column | str]) -> DataFrame:
    """Any frame with a JSON text column, in the read order the caller names."""
    return df.select(
        F.col(document).alias("document"),
        F.struct(*order_by).alias("read_order"),
    )


def read_connector(
    spark: SparkSession, table: RawTable, source_format: str = "mongodb", **options: str
) -> DataFrame:
    """A collection through a document-database connector on the class path.

    Nothing is inferred from a sample: the columns are those of the table. The connector is
    asked, by a projection, for each key's kind beside its value, which tells an absent key
    from a null and a native date from a text. ``_id`` is not carried. Read order is the
    connector's.
    """
    wanted = {"_id": 0}
    for c in table.columns:
        wanted |= {c.name: 1, f"kind_{c.name}": {"$type": f"${c.name}"}}
    names = [n for c in table.columns for n in (c.name, f"kind_{c.name}")]
    rows = (
        spark.read.format(source_format)
        .schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        .options(collection=table.collection, **{"aggregation.pipeline": json.dumps([{"$project": wanted}])})
        .options(**options)
        .load()
    )
    return rows.select(
        document_of_kinds(table).alias("document"),
        F.struct(F.monotonically_increasing_id().alias("position")).alias("read_order"),
    )


def document_of_kinds(table: RawTable) -> Column:
    """JSON text from a value (text as such, anything else as JSON) and a kind per key.

    A date becomes an object, which no column takes for a time.
    """

    def member(name: str) -> Column:
        value, kind = F.col(name), F.col(f"kind_{name}")
        quoted = F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
        written = (
            F.when(kind == "null", "null")
            .when(kind == "date", F.concat(F.lit('{"$date":'), quoted, F.lit("}")))
            .when(kind.isin("string", "objectId", "symbol"), quoted)
            .otherwise(value)
        )
        return F.when(kind != "missing", F.concat(F.lit(f'"{name}":'), written))

    return F.concat(F.lit("{"), F.concat_ws(",", *[member(c.name) for c in table.columns]), F.lit("}"))


def _raw(column: RawColumn) -> Column:
    return F.col(f"_raw_{column.name}")


def _is_null(column: RawColumn) -> Column:
    """Explicit JSON null; an absent key is SQL NULL instead."""
    return F.is_variant_null(_raw(column))


def _get(column: RawColumn, spark_type: str) -> Column:
    return F.try_variant_get(_raw(column), "$", spark_type)


def _number(column: RawColumn) -> Column:
    """An integer, a number rounded half away from zero, or integer text, within INT range."""
    kind = F.schema_of_variant(_raw(column))
    text = _get(column, "string")
    # Each kind is read in its own type: reading it in another one casts row by row.
    whole = F.when(kind == "BIGINT", _get(column, "bigint")).when(
        kind.rlike("^(DECIMAL|DOUBLE)"), F.round(_get(column, "double"), 0).try_cast("bigint")
    ).when((kind == "STRING") & text.rlike(_INTEGER_TEXT), F.trim(text).try_cast("bigint"))
    return whole.try_cast("int")


def _default(column: RawColumn) -> Column:
    if column.default is NO_DEFAULT:
        return F.lit(None).cast(column.kind.spark_type)
    if column.kind is Kind.TEXT_ARRAY:
        return F.array(*[F.lit(v) for v in column.default]).cast(column.kind.spark_type)
    return F.lit(column.default).cast(column.kind.spark_type)


def _has_time(column: RawColumn) -> Column:
    if column.required:
        return _raw(column).isNotNull()
    return _raw(column).isNotNull() & ~F.to_json(_raw(column)).rlike(_EMPTY_VALUE)


def _value(column: RawColumn) -> Column:
    """The value in its Spark type, times and limited texts still as they were written."""
    if column.kind is Kind.TIME:
        return _get(column, "string")
    if column.kind is Kind.JSON:
        present = F.to_json(_raw(column))
    elif column.kind is Kind.TEXT_ARRAY:
        present = _get(column, "array<string>")
    elif column.kind is Kind.INTEGER:
        present = _number(column)
    else:
        present = _get(column, "string")
    return F.when(_raw(column).isNull(), _default(column)).otherwise(present)


def _reject_reason(column: RawColumn) -> Column | None:
    missing = F.when(_raw(column).isNull(), F.lit(f"missing key: {column.name}"))
    if column.kind is not Kind.TIME:
        return missing if column.required else None
    # Whether there is a value at all matters, and is looked at, only where none was read.
    malformed = F.when(
        F.col(column.name).isNull() & _has_time(column),
        F.lit(f"bad timestamp: {column.name}"),
    )
    return F.coalesce(missing, malformed) if column.required else malformed


def _type_error(column: RawColumn) -> Column | None:
    """A present, non-null value of a type the column cannot take."""
    if column.kind in (Kind.TIME, Kind.JSON):
        return None
    if column.kind is Kind.TEXT:
        text = F.col(column.name)
        looks_nested = text.startswith("[") | text.startswith("{")
        wrong = looks_nested & F.schema_of_variant(_raw(column)).rlike("^(ARRAY|OBJECT)<")
    elif column.kind is Kind.TEXT_ARRAY:
        wrong = ~F.schema_of_variant(_raw(column)).rlike(_SCALAR_ARRAY)
    else:
        wrong = F.col(column.name).isNull()
    present = _raw(column).isNotNull() & ~_is_null(column)
    return F.when(present & wrong, F.lit(column.name))


class ParseCounts:
    """How many documents one :func:`parse` read, accepted and rejected.

    Known once a frame that was built on it has been written or collected.
    """

    def __init__(self) -> None:
        self.source, self.outcome = Observation(), Observation()

    def get(self) -> dict[str, int]:
        return {**self.source.get, **self.outcome.get}


def parse(documents: DataFrame, table: RawTable, counts: ParseCounts | None = None) -> DataFrame:
    """``(document, read_order)`` to the typed columns of ``table``, bad documents included.

    No shuffle and no per-row Python. Only the table's keys are taken from a
    document, so ``_id`` and any other key are dropped here.

    Each step's values are used several times by the next one, so Spark keeps the
    steps apart and computes each value once.

    Counting rides on the pass. The two points of observation do more: a later
    filter on ``reject_reason`` stays above them and does not parse documents again,
    and they split the generated code into methods that the JVM still compiles (it
    interprets methods above 8000 bytes of code).
    """
    counts = counts or ParseCounts()
    times = [c.name for c in table.columns if c.kind is Kind.TIME]
    # The parser stops after one value and ignores what follows. With a mark behind
    # the document, anything but a single value on the line shows, and is rejected.
    line = F.concat(F.lit("["), F.col("document"), F.lit(f",{_END_MARK}]"))
    parsed = documents.select("document", "read_order", F.try_parse_json(line).alias("_line"))
    # One cast gives every key: NULL for an absent one, a variant null for an explicit null.
    keys = ", ".join(f"`{c.name}` variant" for c in table.columns)
    fields = parsed.select(
        "document",
        "read_order",
        F.when(
            F.try_variant_get("_line", "$[1]", "bigint") == _END_MARK,
            F.try_variant_get("_line", "$[0]", f"struct<{keys}>"),
        ).alias("_fields"),
    )
    values = fields.select(
        "document",
        "read_order",
        F.col("_fields").isNotNull().alias("_object"),
        *[F.col(f"_fields.{c.name}").alias(f"_raw_{c.name}") for c in table.columns],
    )
    typed = values.select(
        "*",
        *[
            _value(c).alias(f"_text_{c.name}" if c.name in times else c.name)
            for c in table.columns
        ],
    )
    fitted = typed.withColumns(
        {name: cut_blank_tail(F.col(name), limit) for name, limit in table.max_lengths.items()}
    ).observe(counts.source, F.count(F.lit(1)).alias("source"))
    timed = with_utc_times(fitted, {name: f"_text_{name}" for name in times})
    reasons = [r for r in map(_reject_reason, table.columns) if r is not None]
    errors = [e for e in map(_type_error, table.columns) if e is not None]
    not_object = F.when(~F.col("_object"), F.lit("not a JSON object"))
    is_accepted = F.col("reject_reason").isNull()
    return timed.select(
        *table.column_names,
        "document",
        "read_order",
        F.coalesce(not_object, *reasons).alias("reject_reason"),
        F.coalesce(*errors).alias("type_error"),
    ).observe(
        counts.outcome,
        F.count_if(is_accepted).alias("accepted"),
        F.count_if(~is_accepted).alias("rejected"),
    )


def accepted(parsed: DataFrame, table: RawTable) -> DataFrame:
    """Rows to load, with ``read_order`` and ``type_error`` kept for upsert and checks."""
    return parsed.filter("reject_reason IS NULL").select(
        *table.column_names, "read_order", "type_error"
    )


def rejected(parsed: DataFrame, table: RawTable) -> DataFrame:
    """The quarantine rows of one collection."""
    return parsed.filter("reject_reason IS NOT NULL").select(
        F.lit(table.collection).alias("collection"),
        F.col(table.key).alias("key"),
        F.col("reject_reason").alias("reason"),
        "document",
    )
