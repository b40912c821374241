"""Lenient text -> typed coercion.

Spark 4 runs with ANSI casts on, where ``cast('bad' as int)`` raises.  The
warehouse contract is the non-ANSI one: malformed text becomes NULL, and a
decimal string cast to int truncates toward zero ('1.5' -> 1, '-2.9' -> -2).
Everything here is built from JVM-side expressions, so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretrail.schemas import TRIP_COLUMNS, spark_type

# A plain decimal literal (no exponent): sign, whole digits, fraction digits.
# Legacy casts truncate these to their whole part.
_DECIMAL_TEXT = r"^[\x00-\x20\x7f]*([+-]?)(\d*)\.(\d*)[\x00-\x20\x7f]*$"
# A time of day followed by a zone: Z, a name or an offset.
_ZONED_TEXT = r":\d{2}(\.\d+)?\s*([Zz]|UTC|GMT|[+-]\d{1,2}(:?\d{2}){0,2}|[A-Za-z]+/[A-Za-z_]+)\s*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c: str | Column) -> Column:
    """Text -> int; NULL on malformed or out-of-range input, decimals truncated.

    The whole part of a decimal is cut from the text itself (never through a
    double, which would round '1.9999999999999999' up to 2).
    """
    c = _col(c)
    sign = F.regexp_extract(c, _DECIMAL_TEXT, 1)
    whole = F.regexp_extract(c, _DECIMAL_TEXT, 2)
    truncated = F.when(F.length(whole) == 0, F.lit(0)).otherwise(
        F.concat(sign, whole).try_cast("int"))
    return F.coalesce(
        c.try_cast("int"),
        F.when(c.rlike(_DECIMAL_TEXT), truncated),
    )


def lenient_double(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def lenient_timestamp(c: str | Column) -> Column:
    """Text -> timestamp without zone.  Text that names a zone gives the UTC wall time, as a
    zone-aware cast in a UTC session does; a time without a date gives NULL."""
    c = _col(c)
    utc = F.timestamp_micros(F.unix_micros(c.try_cast("timestamp")))
    zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), utc.cast("timestamp_ntz"))
    dated = c.rlike(r"^\s*[+-]?\d{4,}-\d")
    return F.when(c.rlike(_ZONED_TEXT) & dated, zoned).otherwise(c.try_cast("timestamp_ntz"))


_TEXT_COERCERS = {
    "int": lenient_int,
    "double": lenient_double,
    "timestamp": lenient_timestamp,
}


def coerce_column(name: str, source_type: T.DataType, target: str) -> Column:
    """Coerce one column to ``target``: lenient for text, try_cast otherwise."""
    want = spark_type(target)
    if source_type == want:
        return F.col(name)
    if isinstance(source_type, T.StringType):
        return _TEXT_COERCERS[target](name).alias(name)
    return F.col(name).try_cast(want).alias(name)


def is_typed(df: DataFrame, columns: dict[str, str] = TRIP_COLUMNS) -> bool:
    """Whether every contract column of ``df`` has its type, so that :func:`type_trips` coerces nothing."""
    lowered = {k.lower(): spark_type(v) for k, v in columns.items()}
    return all(f.dataType == lowered.get(f.name.lower(), f.dataType) for f in df.schema.fields)


def type_trips(df: DataFrame, columns: dict[str, str] = TRIP_COLUMNS) -> DataFrame:
    """Replace every contract column by its typed form in one projection.

    Columns outside the contract pass through unchanged and in place.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    lowered = {k.lower(): k for k in columns}
    out = []
    for name in df.columns:
        target = lowered.get(name.lower())
        out.append(F.col(name) if target is None
                   else coerce_column(name, types[name], columns[target]).alias(target))
    return df.select(*out)
