"""Text to typed columns, with a flag for values that do not fit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyport.functions.patterns import DATE_PATTERNS, TIMESTAMP_PATTERNS
from tallyport.functions.types import TEXTS, SqlType, parse_type, spark_type

_STAMP = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:"
_YEAR_FIRST = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"
_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def shaped(value: Column, patterns: tuple[tuple[str, str], ...], parse: Callable[[Column, str], Column], first: Column | None = None) -> Column:
    """The value parsed by the first pattern whose shape it has; NULL if none or if it is no real date."""
    out = first
    for shape, pattern in patterns:
        condition, parsed = F.regexp_like(value, F.lit(shape)), parse(value, pattern)
        out = F.when(condition, parsed) if out is None else out.when(condition, parsed)
    return out


def recast(text: Column, type_name: str) -> Column:
    """The value of a nullable text in a column of that type; NULL if it has none. Text keeps its form."""
    kind, parameters = parse_type(type_name)
    bare = F.trim(text)
    if kind in TEXTS and kind is not SqlType.CHAR:
        return F.when(F.length(text) <= parameters[0], text) if kind is SqlType.VARCHAR and parameters else text
    if kind is SqlType.CHAR:
        return F.when(F.length(F.rtrim(text)) <= parameters[0], F.rpad(F.rtrim(text), parameters[0], " ")) if parameters else text
    if kind is SqlType.JSON:
        return F.when(F.try_parse_json(text).isNotNull(), text)
    if kind is SqlType.JSONB:
        return F.to_json(F.try_parse_json(text))
    if kind is SqlType.UUID:
        plain = F.lower(F.regexp_replace(bare, "[{}]", ""))
        return F.when(F.regexp_like(plain, F.lit(_UUID)), plain)
    if kind is SqlType.BYTEA:
        return F.when(F.startswith(text, F.lit("\\x")), F.unhex(F.substr(text, F.lit(3)))).otherwise(F.encode(text, "UTF-8"))
    if kind is SqlType.BOOLEAN:
        low = F.lower(bare)
        return F.when(low.isin("t", "true", "y", "yes", "on", "1"), True).when(low.isin("f", "false", "n", "no", "off", "0"), False)
    if kind is SqlType.DATE:
        stamp = F.when(F.regexp_like(bare, F.lit(_STAMP)), F.try_to_timestamp(bare).cast("date"))
        return shaped(bare, DATE_PATTERNS, F.try_to_date, stamp)
    if kind in (SqlType.TIMESTAMP, SqlType.TIMESTAMPTZ):
        target = "timestamp_ntz" if kind is SqlType.TIMESTAMP else "timestamp"
        value = shaped(bare, TIMESTAMP_PATTERNS, lambda v, p: F.try_to_timestamp(v, F.lit(p)).cast(target), F.when(F.regexp_like(bare, F.lit(_YEAR_FIRST)), bare.try_cast(target)))
        return _rounded(value, parameters[0], target) if parameters and parameters[0] < 6 else value
    return bare.try_cast(spark_type(kind, parameters))


def _rounded(value: Column, digits: int, target: str) -> Column:
    """A time stamp with so many digits of its fraction, the half rounded up. The session is in UTC, so a stamp without a zone
    and an instant have the same microseconds."""
    unit = 10 ** (6 - digits)
    micros = F.unix_micros(value.cast("timestamp"))
    up = micros + unit // 2
    return F.timestamp_micros(up - F.pmod(up, F.lit(unit))).cast(target)


def failed(text: Column, value: Column) -> Column:
    return text.isNotNull() & value.isNull()
