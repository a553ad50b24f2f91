"""Proof that a load arrived: counts, a null-safe value comparison by key, and one verdict a table."""

from __future__ import annotations

from enum import Enum
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.casts import recast
from tallyport.functions.types import SqlType, parse_type
from tallyport.session import cut

MOST_KEYS = 100
#: Verdicts that let a load pass.
GOOD = ("Match", "SkippedNoExactSourceCount", "ValueCheckSkipped")


class VerifyMode(Enum):
    OFF = "off"
    COUNT = "count"
    FULL = "full"

    @classmethod
    def parse(cls, text: str) -> VerifyMode:
        for mode in cls:
            if mode.value == text.strip().lower():
                return mode
        raise ValueError(f"unknown verify mode {text!r}")


def compares_as_text(type_name: str) -> bool:
    return parse_type(type_name)[0] is SqlType.JSON


def same_value(source: Column, target: Column, type_name: str) -> Column:
    """Null-safe equality of a source text, recast to the column's type, and a target value."""
    if compares_as_text(type_name):
        return source.eqNullSafe(target)
    if parse_type(type_name)[0] is SqlType.JSONB:
        target = recast(target, type_name)
    return (source.isNull() & target.isNull()) | F.coalesce(recast(source, type_name) == target, F.lit(False))


def skip_reason(keys: list[str], source_columns: list[str], target_columns: list[str]) -> str | None:
    """Why values can't be compared, or None."""
    if len(keys) != 1:
        return "no key" if not keys else "composite key"
    if keys[0] not in source_columns:
        return "key not in the source"
    if len(source_columns) != len(target_columns):
        return "column counts differ"
    return None


def compare(source: DataFrame, target: DataFrame, key: str, types: dict[str, str], order: tuple[str, ...] = ()) -> DataFrame:
    """(key text, state, at) of each source row: match, mismatch or missing; `at` is its place by the columns of `order`,
    else its key. The source is text, the target typed; one left join by the recast key, whose strategy Spark picks."""
    s, t = source.alias("s"), target.withColumn("_there", F.lit(True)).alias("t")
    joined = s.join(t, recast(F.col(f"s.`{key}`"), types[key]) == F.col(f"t.`{key}`"), "left")
    same = reduce(Column.__and__, [same_value(F.col(f"s.`{c}`"), F.col(f"t.`{c}`"), types[c]) for c in source.columns if c not in order])
    at = F.struct(*(F.col(f"s.`{c}`") for c in order)) if order else F.struct(F.col(f"s.`{key}`").alias("key"))
    state = F.when(F.col("t._there").isNull(), "missing").when(F.coalesce(same, F.lit(False)), "match").otherwise("mismatch")
    return joined.select(F.col(f"s.`{key}`").alias("key"), state.alias("state"), at.alias("at"))


def check_keys(source: DataFrame, key: str) -> None:
    """A NULL key in the source is an error."""
    if source.where(F.col(f"`{key}`").isNull()).limit(1).count():
        raise ValueError(f"the source has NULL in its key {key}")


def summary(states: DataFrame) -> DataFrame:
    """One row: rows, mismatches, missing, and at most MOST_KEYS keys of each, the first in source order. The comparison
    runs once: its states are written before they are looked at."""
    states = cut(states, "verify-states")
    few = lambda state: states.where(F.col("state") == state).orderBy("at").limit(MOST_KEYS).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "key"))), lambda x: x["key"]).alias(f"{state}_keys"))
    counts = states.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("state") == "mismatch").alias("mismatched"), F.count_if(F.col("state") == "missing").alias("missing"))
    one = F.lit(1).alias("_one")
    return counts.select("*", one).join(few("mismatch").select("*", one), "_one").join(few("missing").select("*", one), "_one").drop("_one")


def verdict(source: Column, loaded: Column, failed: Column, pre: Column, post: Column, on_conflict: Column, skipped: Column, missing: Column, mismatched: Column) -> Column:
    """One verdict by the first rule that holds. NULL counts mean that there was nothing to compare."""
    growth = F.when(pre.isNotNull() & post.isNotNull(), F.greatest(post - pre, F.lit(0)))
    text = lambda name, n: F.concat(F.lit(f"{name}("), n.cast("string"), F.lit(")"))
    return (
        F.when(source.isNull(), "SkippedNoExactSourceCount")
        .when(source > loaded + failed, text("LoaderDropped", source - loaded - failed))
        .when(growth > loaded, text("ExtraTarget", growth - loaded))
        .when((growth < loaded) & (on_conflict == "error"), text("MissingTarget", loaded - growth))
        .when(growth < loaded, text("RowsConflictedAtTarget", loaded - growth))
        .when(F.coalesce(skipped, F.lit(False)), "ValueCheckSkipped")
        .when(missing > 0, text("ValueRowMissingAtTarget", missing))
        .when(mismatched > 0, text("ValueMismatch", mismatched))
        .otherwise("Match")
    )


def passes(value: Column) -> Column:
    return value.isin(*GOOD)


def equal_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that only one of two tables has, with the side."""
    b = b.select(*a.columns)
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))


def verdict_of(spark: SparkSession, table: str, **numbers: object) -> DataFrame:
    """(table, verdict, passed) of one load from its numbers."""
    names = ("source", "loaded", "failed", "pre", "post", "on_conflict", "skipped", "missing", "mismatched")
    kinds = {"on_conflict": "string", "skipped": "boolean"}
    given = [F.lit(numbers.get(n)).cast(kinds.get(n, "bigint")) for n in names]
    value = verdict(*given)
    return spark.range(1).select(F.lit(table).alias("table"), value.alias("verdict"), passes(value).alias("passed"))
