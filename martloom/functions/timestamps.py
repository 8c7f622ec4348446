"""ISO-8601 text to UTC wall-clock time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the accepted grammar. A date, then optionally one separator
# character and HH[:MM[:SS[.fff[fff]]]], then optionally Z or +-HH:MM[:SS[.ffffff]].
# A date directly followed by Z is that day's midnight.
ISO_PATTERN = (
    r"\A(?!0000)\d{4}-\d{2}-\d{2}"
    r"(Z|[^Z]\d{2}(:\d{2}(:\d{2}(\.\d{3}(\d{3})?)?)?)?"
    r"(Z|[+-]\d{2}:\d{2}(:\d{2}(\.\d{6})?)?)?)?\z"
)
_OFFSET = r"[+-]\d{2}:\d{2}(:\d{2}(\.\d{6})?)?\z"
_DAY_SECONDS = 86_400


def with_utc_times(df: DataFrame, times: dict[str, str]) -> DataFrame:
    """Add a TIMESTAMP_NTZ column in UTC per entry of ``{new column: text column}``.

    NULL when the text is not valid. Spark's own cast is both wider (``2024``,
    ``+0300``, region names) and narrower (other separators) than the grammar, so
    the text is gated first. The offset is subtracted as an interval: no session
    time zone is involved. Intermediate values are columns of their own, because
    nested in one expression they would be generated once per use.
    """
    zones, clocks, results = {}, {}, {}
    for name, source in times.items():
        text, zone, clock = F.col(source), F.col(f"_zone_{name}"), F.col(f"_clock_{name}")
        # An offset can only start after "YYYY-MM-DD?HH": a '-' before that is the separator.
        zones[f"_zone_{name}"] = F.when(
            text.rlike(ISO_PATTERN),
            F.when(text.endswith("Z"), "Z").otherwise(
                F.regexp_extract(F.substr(text, F.lit(14)), _OFFSET, 0)
            ),
        )
        clocks[f"_clock_{name}"] = F.substring(
            text, F.lit(12), F.length(text) - 11 - F.length(zone)
        )
        clocks[f"_shift_{name}"] = F.when(F.length(zone) > 1, _offset_seconds(zone)).otherwise(0)
        # A malformed text has no zone, hence no clock, hence no time.
        padding = F.substr(F.lit("00:00:00"), F.length(clock) + 1)
        local = F.concat(F.substring(text, 1, 10), F.lit(" "), clock, padding)
        shift, zero = F.col(f"_shift_{name}"), F.lit(0)
        results[name] = F.when(
            F.abs(shift) < _DAY_SECONDS,
            local.try_cast("timestamp_ntz") - F.make_dt_interval(zero, zero, zero, shift),
        )
    return df.withColumns(zones).withColumns(clocks).withColumns(results).drop(*zones, *clocks)


def _offset_seconds(zone: Column) -> Column:
    """Signed length of ``+-HH:MM[:SS[.ffffff]]`` in seconds."""
    sign = F.concat(F.substring(zone, 1, 1), F.lit("1")).try_cast("int")
    seconds = (
        F.substring(zone, 2, 2).try_cast("int") * 3600
        + F.substring(zone, 5, 2).try_cast("int") * 60
        + F.coalesce(F.substr(zone, F.lit(8)).try_cast("decimal(8,6)"), F.lit(0))
    )
    return (sign * seconds).cast("decimal(18,6)")
