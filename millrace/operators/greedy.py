"""Order-dependent deduplication without walking through the rows one by one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.tables import stored


def resolve(claims: DataFrame, probes: DataFrame | None = None, accepted: DataFrame | None = None) -> DataFrame:
    """(ord, first): for every record the first accepted one that it repeats, null if it is accepted itself.

    A record is accepted if no accepted earlier one shares a key with it; rejected ones block nothing. claims(ord, key): keys
    under which a record is found and looks for others; probes(ord, key): further keys under which it looks for others;
    accepted(key, ord): records settled before. `ord` may be of any type with an order. Each round settles every record whose earlier
    matches are settled; the lowest open one always is, so rounds end. A record known to be rejected blocks others no
    longer, but stays until it is sure which accepted one is its first. Keys are pre-aggregated to their lowest record in
    every round, so a key that most records share is no hot spot, and a round reads open records only. Null keys and ords
    match nothing; no keys, no rows.
    """
    keys = claims.select("ord", "key", F.lit(True).alias("claims"))
    if probes is not None:
        keys = keys.union(probes.select("ord", "key", F.lit(False)))
    none = F.lit(None).cast(keys.schema["ord"].dataType)
    # `has` is the least match of the record so far; `taken` holds what the round before has added to the accepted ones.
    open_ = stored(keys.where("ord is not null").select("ord", "key", "claims", none.alias("has")))
    taken = open_.select("key", "ord").limit(0) if accepted is None else accepted.select("key", "ord")
    settled: list[DataFrame] = []
    while not settled or not open_.isEmpty():
        claiming = open_.where("claims and key is not null")
        either = claiming.select("key", F.col("ord").alias("waits"), none.alias("new")).union(taken.select("key", none, "ord"))
        by_key = either.groupBy("key").agg(F.min("waits").alias("waits"), F.min("new").alias("new"))
        seen = open_.join(by_key, "key", "left").groupBy("ord").agg(F.min("waits").alias("waits"), F.min(F.least("has", "new")).alias("has"))
        repeats = F.coalesce(F.col("has") < F.col("ord"), F.lit(False))
        # Nothing that is open and stands before the record (before its match) could still be accepted.
        sure = F.coalesce(F.col("waits") >= F.when(repeats, F.col("has")).otherwise(F.col("ord")), F.lit(True))
        state = stored(seen.select("ord", repeats.alias("repeats"), sure.alias("sure"), F.when(repeats, F.col("has")).alias("first")))
        settled.append(state.where("sure").select("ord", "first"))
        taken = claiming.join(state.where("sure and not repeats"), "ord", "left_semi").select("key", "ord")
        left = open_.drop("has").join(state.where("not sure").select("ord", "repeats", "first"), "ord")
        open_ = stored(left.select("ord", "key", (F.col("claims") & ~F.col("repeats")).alias("claims"), F.col("first").alias("has")))
    return reduce(DataFrame.union, settled)


def first_of_kind(rows: DataFrame, order: str, keys: list[str]) -> DataFrame:
    """`rows` with `repeats`: the `order` of the accepted row that shares any of `keys` with it, null if it is accepted.

    `order` is a unique number. A row without keys is accepted.
    """
    long = rows.select(F.col(order).alias("ord"), F.explode(F.array(*[F.when(F.col(k).isNotNull(), F.xxhash64(F.lit(n), F.col(k).cast("string"))) for n, k in enumerate(keys)])).alias("key"))
    found = resolve(long).withColumnRenamed("ord", order).withColumnRenamed("first", "repeats")
    return rows.join(found, order, "left")
