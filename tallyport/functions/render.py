"""A typed cell as the text that is compared, exported and loaded again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def render(value: Column, kind: T.DataType) -> Column:
    """Text of a cell. Nested types, intervals and times are refused, as no target column could take them."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.CalendarIntervalType, T.DayTimeIntervalType, T.YearMonthIntervalType, T.NullType)) or kind.simpleString().startswith("time("):
        raise ValueError(f"columns of type {kind.simpleString()} can't be moved")
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(value))
    if isinstance(kind, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return timestamp_text(value)
    return value.cast("string")


def cell_text(value: Column, kind: T.DataType) -> Column:
    """Text of a cell that goes into a column of another type: floats without an exponent and without `.0`."""
    return plain_float(value, kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else render(value, kind)


def plain_float(value: Column, kind: T.DataType) -> Column:
    """The shortest digits that give the float again, written out: 1.0E7 is 10000000, 1.5E-5 is 0.000015."""
    text = value.cast("string")
    mantissa, exponent = F.split_part(text, F.lit("E"), F.lit(1)), F.coalesce(F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int"), F.lit(0))
    sign = F.when(F.startswith(mantissa, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    bare = F.regexp_replace(mantissa, "^-", "")
    whole, part = F.split_part(bare, F.lit("."), F.lit(1)), F.regexp_replace(F.split_part(bare, F.lit("."), F.lit(2)), "^0$", "")
    digits, point = F.concat(whole, part), F.length(whole) + exponent
    wide = F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)).when(point >= F.length(digits), F.rpad(digits, point, F.lit("0"))).otherwise(F.concat(F.left(digits, point), F.lit("."), F.substr(digits, point + 1)))
    return F.when(F.isnan(value), "NaN").when(F.abs(value) == float("inf"), F.concat(sign, F.lit("inf"))).otherwise(F.concat(sign, wide))


def timestamp_text(value: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` and, if there is a fraction, three or six digits of it."""
    micros = F.date_format(value, "SSSSSS")
    fraction = F.when(micros == "000000", "").when(F.endswith(micros, F.lit("000")), F.concat(F.lit("."), F.left(micros, F.lit(3)))).otherwise(F.concat(F.lit("."), micros))
    return F.concat(F.date_format(value, "yyyy-MM-dd HH:mm:ss"), fraction)


def float_text(value: Column) -> Column:
    """A double without exponent and without a trailing `.0`; for display, never for comparison across engines."""
    text = value.cast("decimal(38,12)").cast("string")
    return F.when(F.isnan(value) | (F.abs(value) >= 1e25), value.cast("string")).otherwise(F.regexp_replace(text, r"\.?0+$", ""))


def render_all(df: DataFrame) -> DataFrame:
    return df.select(*(render(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))
