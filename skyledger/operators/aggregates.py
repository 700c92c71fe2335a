"""Aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_if(value: Column, condition: Column) -> Column:
    return F.sum(F.when(condition, value))


def avg_if(value: Column, condition: Column) -> Column:
    return F.avg(F.when(condition, value))


def min_if(value: Column, condition: Column) -> Column:
    return F.min(F.when(condition, value))


def max_if(value: Column, condition: Column) -> Column:
    return F.max(F.when(condition, value))


def mean_of_sums(df: DataFrame, outer: list[str], inner: list[str], value: Column) -> DataFrame:
    """Sum per outer + inner group, then the mean of those sums per outer group."""
    sums = df.groupBy(*outer, *inner).agg(F.sum(value).alias("_sum"))
    return sums.groupBy(*outer).agg(F.avg("_sum").alias("mean_of_sums"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Non-null keys that occur more than once, with their count."""
    counts = df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("copies"))
    return counts.filter("copies > 1")
