"""A stream of deliveries: time-normalised, late ones marked, repeats dropped against the state.

Order-dependent deduplication has no streaming operator, so every micro-batch runs the batch operator (`resolve`)
against the state in shared storage and appends what it accepts; a batch that is replayed writes the same part again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.greedy import resolve
from millrace.tables import stored


def accepted_state(spark: SparkSession, folder: str) -> DataFrame:
    """(key, ord, part) of all accepted records; empty before the first batch."""
    empty = spark.createDataFrame([], "key bigint, ord bigint, part bigint")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema("key bigint, ord bigint, part bigint").parquet(folder) if there else empty


def accept_batch(batch: DataFrame, part: int, state_folder: str, out_folder: str, order: str, keys: list[str]) -> None:
    """Write the accepted rows of one micro-batch and their keys; `part` names both, so a replay changes nothing."""
    spark = batch.sparkSession
    rows = stored(batch)
    long = stored(rows.select(F.col(order).alias("ord"), F.explode(F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.xxhash64(F.lit(n), F.col(k).cast("string"))) for n, k in enumerate(keys)]))).alias("key")))
    before = accepted_state(spark, state_folder).where(F.col("part") < part).select("key", "ord")
    known = stored(before.join(long.select("key").distinct(), "key", "left_semi"))
    repeats = resolve(long, accepted=known).where("first is not null").select(F.col("ord").alias(order))
    taken = stored(rows.join(repeats, order, "left_anti"))
    taken.write.mode("overwrite").parquet(f"{out_folder}/part={part}")
    long.join(taken.select(F.col(order).alias("ord")), "ord", "left_semi").select("key", "ord").write.mode("overwrite").parquet(f"{state_folder}/part={part}")


def accept_stream(rows: DataFrame, state_folder: str, out_folder: str, checkpoint: str, order: str, keys: list[str]) -> StreamingQuery:
    """Run `accept_batch` over a stream until it is used up. `order` must grow from batch to batch."""
    writer = rows.writeStream.foreachBatch(lambda batch, part: accept_batch(batch, part, state_folder, out_folder, order, keys))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deliveries_per_window(rows: DataFrame, at: str, group: str, window: str = "1 day", late: str = "7 days") -> DataFrame:
    """Counts per window and group; rows later than `late` behind the newest one are dropped, as the look-back window does."""
    return rows.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), group).agg(F.count("*").alias("deliveries")).select("w.start", "w.end", group, "deliveries")
