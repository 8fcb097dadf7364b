"""Aggregates whose nulls and empty sets mean something."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_or_null(value: Column) -> Column:
    """The sum, or null if any value is null or there is none."""
    return F.when((F.count(value) == F.count(F.lit(1))) & (F.count(F.lit(1)) > 0), F.sum(value))


def share(part: Column, digits: int = 6) -> Column:
    """The share of rows for which `part` is true; nulls count as false."""
    return F.round(F.count_if(F.coalesce(part, F.lit(False))) / F.count(F.lit(1)), digits)


def counts_in_order(rows: DataFrame, value: str, order: list[str]) -> DataFrame:
    """(ord, value, rows): how often each value of `order` occurs, numbered from 1; those that don't occur are left out."""
    counts = rows.where(F.col(value).isin(order)).groupBy(F.col(value).alias("value")).agg(F.count("*").alias("rows"))
    return counts.select(F.array_position(F.array(*map(F.lit, order)), F.col("value")).cast("int").alias("ord"), "value", "rows")


def upserted(state: DataFrame, changes: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """State after changes: a known key keeps its `first` and takes the new `last`, a new key is added, none is removed."""
    s, c = state.alias("s"), changes.alias("c")
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    on = same[0]
    for more in same[1:]:
        on = on & more
    known = F.col("s.present").isNotNull()
    joined = state.withColumn("present", F.lit(True)).alias("s").join(c, on, "full_outer")
    return joined.select(
        *[F.when(known, F.col(f"s.{k}")).otherwise(F.col(f"c.{k}")).alias(k) for k in keys],
        F.when(known, F.col(f"s.{first}")).otherwise(F.col(f"c.{first}")).alias(first),
        F.coalesce(f"c.{last}", f"s.{last}").alias(last),
    )
