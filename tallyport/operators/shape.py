"""Columns: exclusion, renaming, alignment by name, positional binding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def validate_excluded(columns: list[str], excluded: list[str]) -> None:
    if unknown := [c for c in excluded if c not in columns]:
        raise ValueError(f"excluded columns are not in the table: {', '.join(unknown)}")
    if columns and set(columns) <= set(excluded):
        raise ValueError("all columns are excluded")


def validate_exclude_rename(excluded: list[str], renamed: dict[str, str]) -> None:
    if both := [c for c in excluded if c in renamed]:
        raise ValueError(f"columns are both excluded and renamed: {', '.join(both)}")


def excluded_positions(columns: list[str], excluded: list[str]) -> list[int]:
    return [i for i, c in enumerate(columns) if c in set(excluded)]


def exclude(df: DataFrame, excluded: list[str]) -> DataFrame:
    validate_excluded(df.columns, excluded)
    return df.drop(*excluded)


def exclude_fields(fields: Column, width: int, positions: list[int]) -> tuple[Column, Column]:
    """(fields without those positions, whether the width is right) of an array of raw fields."""
    kept = [i for i in range(width) if i not in set(positions)]
    return F.array(*(F.get(fields, F.lit(i)) for i in kept)), F.size(fields) == width


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    if unknown := [c for c in mapping if c not in df.columns]:
        raise ValueError(f"renamed columns are not in the source: {', '.join(unknown)}")
    names = [mapping.get(c, c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("renaming makes two columns of one name")
    return df.withColumnsRenamed(mapping)


def align(df: DataFrame, target: list[str]) -> DataFrame:
    """Reorder by name; both must have the same set of columns."""
    missing, extra = sorted(set(target) - set(df.columns)), sorted(set(df.columns) - set(target))
    if missing or extra:
        raise ValueError(f"column sets differ; only in the target: {', '.join(missing) or 'none'}; only in the source: {', '.join(extra) or 'none'}")
    return df.select(*(F.col(f"`{c}`") for c in target))


def bind(df: DataFrame, target: list[str]) -> DataFrame:
    """Column N of the source to column N of the target."""
    if len(df.columns) != len(target):
        raise ValueError(f"the source has {len(df.columns)} columns, the table {len(target)}")
    return df.toDF(*target)
