"""The dump text codec as column expressions: one field, one line, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the format: what each escaped character stands for. Backslash has to be encoded first.
ESCAPES = (("\\", "\\\\"), ("\b", "\\b"), ("\f", "\\f"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\v", "\\v"))
NULL_MARK = "\\N"
_TOKEN = r"(?s)\\x[0-9A-Fa-f]{1,2}|\\[0-7]{1,3}|\\.|\\$|[^\\]+"
_LETTERS = {"b": "08", "f": "0C", "n": "0A", "r": "0D", "t": "09", "v": "0B"}


def encode(value: Column) -> Column:
    """A nullable text as a dump field: NULL becomes its mark, special characters are escaped."""
    out = value
    for plain, escaped in ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    return F.coalesce(out, F.lit(NULL_MARK))


def encode_line(*values: Column) -> Column:
    return F.concat_ws("\t", *(encode(v) for v in values))


def _token_hex(token: Column) -> Column:
    """The bytes that a token stands for, as hex digits, so that a field's tokens are joined once."""
    kind = F.substring(token, 2, 1)
    octal = F.right(F.concat(F.lit("0"), F.conv(F.substr(token, F.lit(2)), 8, 16)), F.lit(2))
    digits = F.lpad(F.substr(token, F.lit(3)), 2, "0")
    out = F.when(~F.startswith(token, F.lit("\\")) | (F.length(token) == 1), F.hex(F.encode(token, "UTF-8")))
    for letter, code in _LETTERS.items():
        out = out.when(kind == letter, F.lit(code))
    out = out.when((kind == "x") & (F.length(token) > 2), digits)
    out = out.when(F.regexp_like(token, F.lit(r"^\\[0-7]")), octal)
    return out.otherwise(F.hex(F.encode(F.substr(token, F.lit(2)), "UTF-8")))


def decode(field: Column) -> Column:
    """A dump field as nullable text. Unknown escapes lose their backslash, invalid UTF-8 becomes U+FFFD."""
    tokens = F.regexp_extract_all(field, F.lit(_TOKEN), F.lit(0))
    whole = F.unhex(F.array_join(F.transform(tokens, _token_hex), ""))
    text = F.make_valid_utf8(whole.cast("string"))
    return F.when(field == NULL_MARK, F.lit(None).cast("string")).when(F.instr(field, "\\") == 0, field).otherwise(text)


def fields(line: Column) -> Column:
    """The raw fields of a line; a carriage return at its end is not part of it. A blank line has none."""
    bare = F.when(F.endswith(line, F.lit("\r")), F.left(line, F.length(line) - 1)).otherwise(line)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "\t", -1))


def packed(lines: DataFrame, width: int, line: str = "raw") -> DataFrame:
    """`lines` with `good` (whether the width is right) and a struct `row` of the decoded fields f0, f1, ... The fields are
    one array that a generator puts out, so they are split and decoded once, however often later steps use them."""
    once = lines.select("*", F.explode(F.array(F.struct(F.transform(fields(F.col(line)), decode).alias("f")))).alias("_x"))
    row = F.struct(*(F.get("_x.f", F.lit(i)).alias(f"f{i}") for i in range(width))) if width else F.struct(F.lit(None).alias("f0"))
    return once.select(*(F.col(f"`{c}`") for c in lines.columns), (F.size("_x.f") == width).alias("good"), row.alias("row"))


def decoded(lines: DataFrame, line: str, names: tuple[str, ...] | list[str]) -> DataFrame:
    """`lines` with `good` (whether the width is right) and the decoded fields under `names`. The fields are one array that
    a generator puts out, so they are split and decoded once, however often later steps use them."""
    once = lines.select("*", F.explode(F.array(F.struct(F.transform(fields(F.col(line)), decode).alias("f")))).alias("_x"))
    kept = [F.col(f"`{c}`") for c in lines.columns]
    return once.select(*kept, (F.size("_x.f") == len(names)).alias("good"), *(F.get("_x.f", F.lit(i)).alias(c) for i, c in enumerate(names)))
