"""Column expressions shared by the parsers, validators and the stream.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(c) -> Column:
    """Python truthiness of a feed text: NULL and "" are false."""
    c = _c(c)
    return c.isNotNull() & (c != "")


def typed(v: Column, dt: T.DataType, path: str = "$") -> Column:
    """The value at ``path`` of a VARIANT in type ``dt`` (structs, arrays and
    text), field by field: what is absent, null or of another type is NULL and
    costs only itself.  An object of the schema given as another value is a
    struct of NULLs; an array given as another value is NULL."""
    if isinstance(dt, T.StructType):
        there = F.try_variant_get(v, path, "variant")
        return F.when(there.isNotNull() & ~F.is_variant_null(there), F.struct(*[
            typed(v, f.dataType, f"{path}['{f.name}']").alias(f.name) for f in dt.fields]))
    if isinstance(dt, T.ArrayType):
        return F.transform(F.try_variant_get(v, path, "array<variant>"),
                           lambda e: typed(e, dt.elementType))
    return F.try_variant_get(v, path, "string")


def truthy_epoch(c) -> Column:
    """Truthiness of an epoch read as text: NULL, "", 0 and "0" are false."""
    c = _c(c)
    num = c.try_cast(T.DoubleType())
    return c.isNotNull() & (c != "") & (F.coalesce(num, F.lit(1.0)) != 0)


# Epoch seconds of the first second of year 1 and the last of year 9999.
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799


def epoch_text_to_ts(c) -> Column:
    """Epoch seconds held as text (int, float or numeric string) to a UTC
    timestamp; NULL when the text is not a number, or one outside the years
    1 to 9999 (micro- and nanoseconds sent as seconds are)."""
    c = _c(c)
    as_long = c.try_cast(T.LongType())
    as_double = c.try_cast(T.DoubleType())
    return F.when(as_long.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(as_long)) \
        .when(as_long.isNull() & as_double.between(float(FIRST_SECOND), float(LAST_SECOND)),
              F.timestamp_seconds(as_double))


def whole_number(c) -> Column:
    """Text of a number as a long (``2``, ``2.0``); NULL if it has a fraction
    or is not a number."""
    n = _c(c).try_cast(T.DoubleType())
    return F.coalesce(_c(c).try_cast(T.LongType()), F.when(n == F.floor(n), n.try_cast(T.LongType())))


def epoch_lenient(c) -> Column:
    """Alert timestamps: NULL on NULL or bad text; 0 is a valid time."""
    return epoch_text_to_ts(c)


def iso_to_ts(c) -> Column:
    """ISO-8601 text with offset (``2024-01-01T00:00:01.5+00:00``) to a
    timestamp; NULL when unparsable."""
    return _c(c).try_cast(T.TimestampType())


def parse_trip_id(c) -> tuple[Column, Column]:
    """Direction letter and path id from a trip id like ``060300_A..N55R``.

    Second ``_`` piece, then the second ``..`` piece; its first character is
    the direction (N or S, else U), the rest the path (NULL when empty).  A
    missing piece gives (U, NULL); a bad direction letter keeps its path.
    """
    c = _c(c)
    piece = F.get(F.split(c, "_"), 1)
    dp = F.get(F.split(piece, r"\.\."), 1)
    first = F.substring(dp, 1, 1)
    empty = dp.isNull() | (dp == "")
    direction = F.when(empty, F.lit("U")) \
        .when(first.isin("N", "S"), first).otherwise(F.lit("U"))
    path = F.when(~empty & (F.length(dp) > 1), F.substring(dp, 2, 1 << 30))
    return direction, path


def pick_translation(c) -> Column:
    """Text of the first translation with language exactly "en", else of the
    first translation, else NULL.  An "en" entry with NULL text gives NULL."""
    arr = _c(c).getField("translation")
    en = F.filter(arr, lambda x: x["language"] == "en")
    return F.when(F.size(en) > 0, F.get(en, 0)["text"]) \
        .otherwise(F.get(arr, 0)["text"])


def minutes_between(later, earlier) -> Column:
    """(later - earlier) in minutes as a double, sub-second exact."""
    return (F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))) / 60e6


def seconds_between(later, earlier) -> Column:
    """Whole seconds between two timestamps, truncated toward zero."""
    d = F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))
    return F.when(d >= 0, F.floor(d / 1_000_000)) \
        .otherwise(-F.floor(-d / 1_000_000)).cast("bigint")


def day_of_week(c) -> Column:
    """Day of week with Sunday = 1 ... Saturday = 7 (warehouse convention)."""
    return F.dayofweek(_c(c))
