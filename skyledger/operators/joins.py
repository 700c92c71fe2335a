"""Joins, some with a side of proven size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def month_side(dim: DataFrame) -> DataFrame:
    """A month dimension marked for broadcast.

    Month dimensions are grouped by ``yyyyMM`` and the parsers take years of 1900..2100 only,
    so at most 2,412 rows are sent whatever the size of the facts.
    """
    return F.broadcast(dim)


def star_join(fact: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """Inner equi-joins of a fact with dimensions, each on one shared key column.

    Columns of a dimension that the fact also has are dropped first, so every name
    stays unambiguous; pass a dimension already reduced to what is needed.
    """
    joined = fact
    for dim, key in dims:
        clash = [c for c in dim.columns if c in joined.columns and c != key]
        joined = joined.join(dim.drop(*clash), key)
    return joined


def missing_parents(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, months: bool = False
) -> DataFrame:
    """Child rows whose non-null key has no parent row; ``months`` says that it is a month key."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    keys = month_side(keys) if months else keys
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def fill_unmatched(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zero instead of null in the numeric columns a left join left unmatched."""
    return df.na.fill(0, subset=columns)


def any_of(*conditions: Column) -> Column:
    """True when a condition holds; unknown counts as false."""
    result = F.lit(False)
    for condition in conditions:
        result = result | F.coalesce(condition, F.lit(False))
    return result
