"""Filters that say why: an ordered chain of gates, the first that fails gives the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gated(rows: DataFrame, gates: list[tuple[str, list[tuple[str, Column]]]]) -> DataFrame:
    """`rows` with `gate`, `reason` (null if all pass) and `results`, an array of (gate, passed, reason) that ends at the
    first failing gate. gates: name and its ordered (reason, failing condition); a null condition doesn't fail."""
    reason, gate = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, checks in reversed(gates):
        for label, fails in reversed(checks):
            failing = F.coalesce(fails, F.lit(False))
            reason, gate = F.when(failing, F.lit(label)).otherwise(reason), F.when(failing, F.lit(name)).otherwise(gate)
    out = rows.withColumn("gate", gate).withColumn("reason", reason)
    names = F.array(*[F.lit(n) for n, _ in gates])
    upto = F.when(F.col("gate").isNull(), F.size(names)).otherwise(F.array_position(names, F.col("gate")).cast("int"))
    result = lambda n: F.struct(n.alias("gate"), (~n.eqNullSafe(F.col("gate"))).alias("passed"), F.when(n.eqNullSafe(F.col("gate")), F.col("reason")).alias("reason"))
    return out.withColumn("results", F.transform(F.slice(names, F.lit(1), upto), result))


def greedy_budget(items: Column, size, most: int) -> Column:
    """The items of an array that fit into `most` in their order: one that doesn't fit is left out, later ones may fit."""
    start = F.struct(F.lit(0).cast("long").alias("used"), F.filter(items, lambda _: F.lit(False)).alias("kept"))

    def step(state, item):
        used = state["used"] + size(item).cast("long")
        return F.when(used <= most, F.struct(used.alias("used"), F.array_append(state["kept"], item).alias("kept"))).otherwise(state)

    return F.aggregate(items, start, step, lambda s: s["kept"])
