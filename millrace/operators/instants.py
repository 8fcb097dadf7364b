"""Problem 4: one UTC instant for every readable time of every feed table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import timestamps as T


def normalise_instants(values: DataFrame, mirrors: DataFrame) -> DataFrame:
    """values(table_name, row_no, mirror_id, value) with `epoch_us`, null where a value denotes no instant.

    mirrors(mirror_id, zone_id) gives the zone of zoneless values. The order of day and month in slashed dates is a
    habit of the mirror: it is taken from all of the mirror's values that allow only one reading, whatever the table.
    A mirror with as much evidence for one order as for the other has no habit; see `numbers` for its values.
    Null, blank and unreadable values give null; repeated rows stay; an unknown or null mirror means UTC; an unknown
    zone id in `mirrors` counts as UTC. An empty table gives no rows. Other columns of `values` are ignored.
    """
    values = values.select("table_name", F.col("row_no").cast("long").alias("row_no"), "mirror_id", F.col("value").cast("string").alias("value"))
    day_first, month_first = T.slash_evidence(F.col("value"))
    evidence = values.where(F.col("value").contains("/") & F.col("mirror_id").isNotNull())
    habits = evidence.groupBy("mirror_id").agg((F.count_if(day_first) - F.count_if(month_first)).alias("lead"))
    habits = habits.where("lead <> 0").select("mirror_id", (F.col("lead") > 0).alias("day_first"))
    zones = mirrors.select("mirror_id", "zone_id").where(F.try_to_timestamp(F.concat(F.lit("2020-01-01 00:00:00 "), "zone_id")).isNotNull()).groupBy("mirror_id").agg(F.min("zone_id").alias("zone_id"))
    joined = values.join(zones, "mirror_id", "left").join(habits, "mirror_id", "left")
    # Each step is bound by a generator, which keeps the optimizer from repeating the regex and the arithmetic per use.
    parts = _bound(joined, "parts", T.components(F.col("value")))
    parts = _bound(parts, "n", T.numbers(F.col("parts"), F.col("day_first")))
    parts = _bound(parts, "local", T.local_micros(F.col("n")))
    return parts.select("table_name", "row_no", "mirror_id", "value", T.epoch_micros(F.col("n"), F.col("local"), F.col("zone_id")).alias("epoch_us"))


def with_instant(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """`rows` with the instant of `value` as `name`, null where it denotes none. Zoneless values are UTC; a slashed date is
    day first, with AM or PM month first."""
    parts = _bound(_bound(rows, "_parts", T.components(value.cast("string"))), "_n", T.numbers(F.col("_parts"), F.lit(None).cast("boolean")))
    local = _bound(parts, "_local", T.local_micros(F.col("_n")))
    return local.select(*rows.columns, T.epoch_micros(F.col("_n"), F.col("_local"), F.lit(None).cast("string")).alias(name))


def _bound(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, F.explode(F.array(value)))


def feed_values(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One long table of the time fields of several feed tables; tables: name to (table, name of its time field)."""
    parts = [t.select(F.lit(name).alias("table_name"), "row_no", "mirror_id", F.col(field).alias("value")) for name, (t, field) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def instants_found(values: DataFrame, mirrors: DataFrame) -> DataFrame:
    """The readable values only: (table_name, row_no, epoch_us)."""
    return normalise_instants(values, mirrors).where("epoch_us is not null").select("table_name", "row_no", "epoch_us")
