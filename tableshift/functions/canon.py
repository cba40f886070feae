"""Canonical text of a row, and the digests built on it.

A row's text lists its columns in order, joined by ``|``. NULL is written ``\\N``, which no value can look like, because
``\\`` and ``|`` inside strings are escaped; so NULL is not the empty string, and shifted text cannot collide.

Doubles are written as the shortest text that identifies them, one form for all magnitudes; -0.0 is 0.0 and every NaN is
``NaN``. ``exact=False`` writes a whole number of units of ``10**-scale`` instead, which other SQL engines reproduce but
which does not see smaller changes; it is for checks against such an engine and has to be asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMPTY_DIGEST = "d41d8cd98f00b204e9800998ecf8427e"  # md5 of the empty string
SEPARATOR = "|"
NULL_MARK = "\\N"


def micros(column: Column, data_type: T.DataType, utc_session: bool) -> Column:
    """Microseconds since 1970 of a timestamp's moment, or of a zone-less timestamp's wall clock."""
    if isinstance(data_type, T.TimestampType) or utc_session:
        return F.unix_micros(column.cast("timestamp"))
    # Outside UTC a cast would shift the wall clock by the session zone; an interval does not.
    since = column - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (since.cast("decimal(20,6)") * 1_000_000).cast("bigint")


def _number_text(column: Column, scale: int, exact: bool) -> Column:
    shortest = (column + F.lit(0.0)).cast("string")  # the sum turns -0.0 into 0.0
    if exact:
        return shortest
    units = 10.0**scale
    small = F.abs(column) < F.lit(1e12)  # also false for NaN and infinities
    return F.when(small, F.floor(column * units + 0.5).cast("string")).otherwise(F.concat(F.lit("d"), shortest))


def _escaped(column: Column, nested: bool) -> Column:
    if nested:  # inside arrays and structs the marks around elements need escaping too
        return F.regexp_replace(column, r"([\\|,\[\]()])", r"\\$1")
    return F.replace(F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def value_text(column: Column, data_type: T.DataType, *, scale: int = 6, exact: bool = True,
               utc_session: bool = False, nested: bool = False) -> Column:
    """Text of a value; NULL stays NULL."""
    options = {"scale": scale, "exact": exact, "utc_session": utc_session, "nested": True}
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return _number_text(column.cast("double"), scale, exact)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return micros(column, data_type, utc_session).cast("string")
    if isinstance(data_type, T.StringType):
        return _escaped(column, nested)
    if isinstance(data_type, T.BinaryType):
        return F.hex(column)
    if isinstance(data_type, T.ArrayType):
        inner = F.transform(column, lambda x: cell_text(x, data_type.elementType, **options))
        return F.concat(F.lit("["), F.array_join(inner, ","), F.lit("]"))
    if isinstance(data_type, T.StructType):
        cells = [cell_text(column.getField(f.name), f.dataType, **options) for f in data_type.fields]
        return F.when(column.isNotNull(), F.concat(F.lit("("), F.concat_ws(",", *cells), F.lit(")")))
    if isinstance(data_type, T.MapType):
        entries = T.ArrayType(T.StructType([T.StructField("key", data_type.keyType),
                                            T.StructField("value", data_type.valueType)]))
        return value_text(F.array_sort(F.map_entries(column)), entries, **options)
    return column.cast("string")


def cell_text(column: Column, data_type: T.DataType, **options) -> Column:
    """Text of a value with NULL marked; never NULL itself."""
    return F.coalesce(value_text(column, data_type, **options), F.lit(NULL_MARK))


def is_utc(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT")


def row_text(df: DataFrame, columns: Sequence[str] | None = None, *, scale: int | dict[str, int] = 6,
             exact: bool = True) -> Column:
    """Canonical text over ``columns`` (all of them by default). ``scale`` may be set per column and needs ``exact=False``."""
    utc = is_utc(df)
    cells = []
    for name in columns or df.columns:
        places = scale.get(name, 6) if isinstance(scale, dict) else scale
        cells.append(cell_text(F.col(f"`{name}`"), df.schema[name].dataType, scale=places, exact=exact,
                               utc_session=utc))
    return F.concat_ws(SEPARATOR, *cells)


def row_md5(df: DataFrame, columns: Sequence[str] | None = None, **options) -> Column:
    return F.md5(row_text(df, columns, **options))


def bag_digest(md5_hex: Column) -> Column:
    """Order-independent digest of a bag of rows: two sums, each of 60 other bits of every row's md5.

    Duplicates count, row order does not, and partial sums combine, so each task sends one small row. Whole-number sums
    of 15 bits stay exact to 2 * 10**14 rows and, past that, raise under ANSI rules instead of wrapping; they avoid a
    wide decimal per row.
    """
    def total(part: int) -> Column:
        bits = F.conv(F.substr(md5_hex, F.lit(1 + 15 * part), F.lit(15)), 16, 10).cast("bigint")
        sums = [F.coalesce(F.sum(F.shiftright(bits, shift).bitwiseAND(F.lit(0x7FFF))), F.lit(0)).cast("decimal(20,0)")
                * F.lit(2**shift).cast("decimal(15,0)") for shift in (0, 15, 30, 45)]
        return sum(sums[1:], sums[0]).cast("decimal(38,0)").cast("string")
    return F.concat_ws(":", total(0), total(1))
