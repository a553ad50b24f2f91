"""Conflict policies over tables that enforce no keys: skip, replace, or fail whole batches."""

from __future__ import annotations

from enum import Enum
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.operators.components import components
from tallyport.session import cut, discard


class OnConflict(Enum):
    DO_NOTHING = "do-nothing"
    DO_UPDATE = "do-update"
    ERROR = "error"

    @classmethod
    def parse(cls, text: str) -> OnConflict:
        for mode in cls:
            if mode.value == text.strip().lower().replace("_", "-"):
                return mode
        raise ValueError(f"unknown conflict mode {text!r}; one of {', '.join(m.value for m in cls)}")


def validate_keys(mode: OnConflict, keys: list[str], excluded: list[str]) -> list[str]:
    """Keys that are excluded, as warnings; an error if a replacing load has no key left."""
    if mode is not OnConflict.DO_UPDATE:
        return []
    if not keys:
        raise ValueError("do-update needs a primary or unique key")
    gone = [k for k in keys if k in excluded]
    if len(gone) == len(keys):
        raise ValueError("all key columns are excluded")
    return [f"key column {k} is excluded" for k in gone]


def batch_id(row_in_chunk: Column, batch_size: int) -> Column:
    """Rows 1..batch_size are batch 0."""
    return F.floor((row_in_chunk - 1) / batch_size).cast("int")


def _first(new: DataFrame, keys: list[str], order: Column, last: bool) -> DataFrame:
    """One row a key; a key with a NULL never conflicts. Only an extreme is kept, so no key's rows meet to be ordered."""
    free = F.lit(False)
    for k in keys:
        free = free | F.col(f"`{k}`").isNull()
    row = F.struct(*(F.col(f"`{c}`") for c in new.columns))
    pick = (F.max_by if last else F.min_by)(row, order)
    return new.where(~free).groupBy(*(F.col(f"`{k}`") for k in keys)).agg(pick.alias("_row")).select("_row.*").unionByName(new.where(free))


def do_nothing(target: DataFrame, new: DataFrame, keys: list[str] | list[list[str]], order: Column) -> DataFrame:
    """The rows to append: of new rows of one key the first, none whose key the target has. With several keys (a list of
    lists) a row stays out if it shares any of them."""
    if not keys:
        return new
    if isinstance(keys[0], str):
        keys = [keys]
    if len(keys) == 1:
        (key,) = keys
        return _first(new, key, order, last=False).join(target.select(*key), key, "left_anti").select(*new.columns)
    placed = new.withColumn("_row", order)
    kept = first_wins(target, placed, keys, "_row")
    return placed.join(kept.withColumnRenamed("row", "_row"), "_row", "left_semi").select(*new.columns)


def do_update(target: DataFrame, new: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The whole table afterwards: of new rows of one key the last, in place of the target's."""
    fresh = _first(new, keys, order, last=True)
    return target.join(fresh.select(*keys), keys, "left_anti").select(*target.columns).unionByName(fresh.select(*target.columns))


def key_rows(df: DataFrame, keys: list[list[str]], *extra: Column) -> DataFrame:
    """(extra columns, key): a text for each key that a row has, which tells the key's values and which key it is. A key with
    a NULL is none."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    value = lambda c: F.lower(F.hex(F.col(f"`{c}`"))) if kinds[c].typeName() == "binary" else F.col(f"`{c}`").cast("string")
    made = []
    for number, key in enumerate(keys):
        known = reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in key])
        # Lengths before values, so that no two lists of values have one text.
        parts = [x for c in key for x in (F.length(value(c)).cast("string"), F.lit(":"), value(c))]
        made.append(F.when(known, F.concat(F.lit(f"{number}|"), *parts)))
    return df.select(*extra, F.explode(F.array_compact(F.array(*made))).alias("key"))


#: Rounds in which rows that are first in all their keys go in, before what is left is settled by components.
ROUNDS = 3
#: Rows of a component that one task settles in order; larger ones are settled in further rounds.
COMPONENT_ROWS = 100_000


def first_wins(target: DataFrame, new: DataFrame, keys: list[list[str]], row: str) -> DataFrame:
    """(row) of the new rows that go in where a row goes in unless the target, or an earlier row that went in, has one of its
    keys. `row` is a column that numbers the new rows in order, with longs.

    Rows that share no key with another one go in at once. The others are a graph. In each of a few rounds a row that is first
    in all its keys goes in, and those that share a key with it leave: that settles any number of copies of a key at once. What
    then is left are chains, in which each row waits for the one before; they are split into connected components, and each
    is settled in order by one task. A component too large for one task stays for further rounds. Only keys and row
    numbers are ever shuffled."""
    keyed = cut(key_rows(new, keys, F.col(row).alias("row")), "keys")
    there = key_rows(target, keys).distinct()
    hit = keyed.join(there, "key", "left_semi").select("row").distinct()
    open_ = cut(keyed.join(hit, "row", "left_anti"), "keys-open")
    without = new.select(F.col(row).alias("row")).join(keyed.select("row").distinct(), "row", "left_anti")
    gone_in = [cut(without, "keys-in")]
    discard(keyed)
    rounds = 0
    while open_.limit(1).count():
        if rounds >= ROUNDS:
            settled, open_ = _by_component(open_)
            gone_in.append(settled)
            if not open_.limit(1).count():
                break
        least = open_.groupBy("key").agg(F.min("row").alias("first"))
        ranked = open_.join(least, "key")
        going_in = cut(ranked.groupBy("row").agg(F.bool_and(F.col("row") == F.col("first")).alias("first")).where("first").select("row"), "keys-in")
        taken = open_.join(going_in, "row", "left_semi").select("key").distinct()
        leaving = open_.join(taken, "key", "left_semi").select("row").distinct()
        before, open_ = open_, cut(open_.join(leaving, "row", "left_anti"), "keys-open")
        discard(before)
        gone_in.append(going_in)
        rounds += 1
    discard(open_)
    return reduce(DataFrame.union, gone_in)


def _by_component(open_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that go in, what is left): components of at most COMPONENT_ROWS rows are settled, larger ones are left."""
    stars = open_.groupBy("key").agg(F.min("row").alias("a"))
    roots = components(open_.join(stars, "key").where("row <> a").select("a", F.col("row").alias("b")))
    of = cut(open_.join(roots.withColumnRenamed("node", "row"), "row", "left").select("row", "key", F.coalesce("root", "row").alias("root")), "keys-components")
    small = of.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= COMPONENT_ROWS).select("root")

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        taken: set[str] = set()
        out = []
        for row, keys in rows.sort_values("row", kind="stable").groupby("row", sort=False)["key"]:
            if taken.isdisjoint(keys):
                taken.update(keys)
                out.append(row)
        return pd.DataFrame({"row": np.array(out, np.int64)})

    settled = cut(of.join(small, "root").groupBy("root").applyInPandas(settle, "row long"), "keys-in")
    left = cut(of.join(small, "root", "left_anti").select("row", "key"), "keys-open")
    discard(of, roots, open_)
    return settled, left


def error_batches(target: DataFrame, new: DataFrame, keys: list[str] | list[list[str]], batch: str = "batch_id") -> DataFrame:
    """(batch, failed) of each batch: it fails if it has a key of the target or a key twice, or a key of an earlier
    batch that went in; `keys` is one key or several. The last is settled in rounds over the keys that several batches share:
    a batch that is first in all its keys goes in, those that share a key with it fail, and both leave. Rounds are as many as
    a chain of batches that each wait for the one before is long, two for most data; rows never come to the driver."""
    several = [keys] if keys and isinstance(keys[0], str) else keys
    keyed = key_rows(new, several, F.col(batch)).groupBy("key", batch).agg(F.count(F.lit(1)).alias("_n"))
    hit = key_rows(target, several).distinct().withColumn("_hit", F.lit(True))
    flagged = keyed.join(hit, "key", "left").groupBy(batch).agg(F.max(F.coalesce("_hit", F.lit(False)) | (F.col("_n") > 1)).alias("own"))
    own = new.select(batch).distinct().join(flagged, batch, "left").select(batch, F.coalesce("own", F.lit(False)).alias("own"))
    sound = keyed.join(own.where(~F.col("own")), batch, "left_semi")
    shared = sound.groupBy("key").agg(F.count(F.lit(1)).alias("_of")).where("_of > 1")
    open_ = cut(sound.join(shared, "key", "left_semi").select("key", batch), "sink-open")
    late = None
    while open_.limit(1).count():
        least = open_.groupBy("key").agg(F.min(batch).alias("_least"))
        ranked = open_.join(least, "key").withColumn("_first", F.col("_least") == F.col(batch))
        going_in = ranked.groupBy(batch).agg(F.min("_first").alias("_in")).where("_in").select(batch)
        taken = open_.join(going_in, batch, "left_semi").select("key").distinct()
        loses = cut(open_.join(taken, "key", "left_semi").select(batch).distinct().join(going_in, batch, "left_anti"), "sink-late")
        late = loses if late is None else late.union(loses)
        gone = going_in.union(loses)
        before, open_ = open_, cut(open_.join(gone, batch, "left_anti"), "sink-open")
        discard(before)
    discard(open_)
    if late is None:
        return own.select(batch, F.col("own").alias("failed"))
    return own.join(late.withColumn("_late", F.lit(True)), batch, "left").select(batch, (F.col("own") | F.coalesce("_late", F.lit(False))).alias("failed"))


def fill_defaults(df: DataFrame, defaults: dict[str, str], columns: list[str]) -> DataFrame:
    """Add columns that were left out, by their default expressions or NULL, in the table's order."""
    return df.select(*(F.col(f"`{c}`") if c in df.columns else F.expr(defaults.get(c, "NULL")).alias(c) for c in columns))
