"""Ordered operations: the first of a kind, the top of a group, caps, fill-forward and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def keep_first(rows: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in `order`; null keys form a kind of their own. The order must be total.

    A min over the whole row instead of a window: copies collapse before the shuffle, so a key may have any share of
    the rows.
    """
    rest = [c for c in rows.columns if c not in keys]
    at = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{n}") for n, c in enumerate(order)])
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), at).alias("row")) if rest else rows.distinct()
    return best.select(*keys, "row.*").select(*rows.columns) if rest else best


def top_per_group(rows: DataFrame, group: list[str], most: int, *order: Column | str, name: str = "rank") -> DataFrame:
    """The first `most` rows of each group with their rank. Spark cuts each partition to `most` before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn(name, rank).where(F.col(name) <= most)


def capped(rows: DataFrame, most: int, *order: Column | str) -> tuple[DataFrame, DataFrame]:
    """(kept, deferred): the `most` first rows in `order`, and the others. Both keep the input's columns."""
    kept = rows.orderBy(*order).limit(most)
    return kept, rows.exceptAll(kept)


def filled_forward(rows: DataFrame, value: Column, group: list[str], *order: Column | str) -> Column:
    """The latest non-null `value` up to and including each row."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def retained(rows: DataFrame, at: str, cutoff: Column, newest: int, tie: str) -> DataFrame:
    """Rows not older than `cutoff`, and of those the `newest` latest."""
    return rows.where(F.col(at) >= cutoff).orderBy(F.col(at).desc(), F.col(tie).desc()).limit(newest)
