"""Problem 7: texts into containers of one fixed capacity.

Sizes are tokens of a public tokenizer. A text longer than a container is cut into full ones and a rest; nothing else is
split. Items are spread over shards by the hash of their key and piece, each worth about SHARD containers or as many
items as such have at most, so shards are alike whatever the keys' or sources' distribution, don't depend on how the
rows are partitioned and are packed independently of one another. Within a shard
Karmarkar-Karp multiway differencing merges partial partitions, the most unbalanced first, the fullest windows of one
with the emptiest of the other, which gives windows of nearly equal sums; the number of windows starts at the least
possible and rises while any window exceeds the capacity.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tokens import TOKENIZERS, VOCABULARY, token_counts
from millrace.tables import stored

CAPACITY = 2048
#: Containers' worth of items in a shard.
SHARD = 128
#: Tasks that the shards are spread over at most.
TASKS = 10_000
#: Items of a shard, where they are so small that its containers would hold more.
ITEMS = 50_000


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item, by multiway differencing of `sizes` over `windows` windows.

    Every item starts as a partition with one filled window. The two partitions with the greatest differences between
    their fullest and emptiest window merge, the fullest windows of one with the emptiest of the other, until one
    partition is left; ties go by age, items in the order of falling size.
    """
    order = np.argsort(-sizes, kind="stable").tolist()
    falling = [int(sizes[i]) for i in order]
    n, at, age = len(order), 0, 0
    heap: list[tuple] = []  # (-difference, age, sums, groups) of merged partitions; single items wait in `falling`

    def take():
        """The partition with the greatest difference: a merged one or the next single item."""
        nonlocal at
        if heap and (at == n or -heap[0][0] >= falling[at]):
            return heapq.heappop(heap)
        at += 1
        return falling[at - 1], order[at - 1]

    while len(heap) + n - at > 1:
        a, b = take(), take()
        if len(a) == 2 and len(b) == 2:
            sums, groups = np.zeros(windows, np.int64), [[] for _ in range(windows)]
            sums[0], groups[0] = a[0], [a[1]]
            a = (0, 0, sums, groups)
        elif len(a) == 2:
            a, b = b, a
        sums, groups = a[2], a[3]
        if len(b) == 2:
            k = int(sums.argmin())
            sums[k] += b[0]
            groups[k].append(b[1])
        else:
            down, up = np.argsort(-sums, kind="stable"), np.argsort(b[2], kind="stable")
            sums = sums[down] + b[2][up]
            groups = [groups[i] + b[3][j] for i, j in zip(down.tolist(), up.tolist())]
        low = int(sums.min())
        sums -= low
        age += 1
        heapq.heappush(heap, (-int(sums.max()), age, sums, groups))
    out = np.zeros(n, np.int64)
    for _, _, _, groups in heap:
        for window, items in enumerate(groups):
            out[items] = window
    return out


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each item so that no window's sum exceeds `capacity`; every size is at most `capacity`.

    Items that fill a container have one of their own; differencing places the others.
    """
    out = np.zeros(len(sizes), np.int64)
    full = sizes == capacity
    out[full] = np.arange(full.sum())
    rest = sizes[~full]
    if not len(rest):
        return out
    windows = max(1, -(-int(rest.sum()) // capacity), int((rest * 2 > capacity).sum()))
    while True:
        placed = differencing(rest, windows)
        excess = np.maximum(np.bincount(placed, rest) - capacity, 0).sum()
        if not excess:
            out[~full] = placed + full.sum()
            return out
        windows += max(1, int(excess) // capacity)  # what doesn't fit needs that many more


def packed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, shard: int = SHARD, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(container, key, piece, first_token, n_tokens): where every text, or every piece of a longer one, lies.

    Null and empty texts are items of no size and get a container like others; a null key is an item too; repeated rows
    are items each; an empty table gives no rows; other columns are ignored. `piece` counts from 0, `first_token` is the
    piece's place in its text.
    """
    counts = stored(token_counts(docs, key, text, folder, vocabulary).withColumnRenamed(key, "key"))
    size = F.col("n_tokens").cast("long")
    total, texts = counts.agg(F.coalesce(F.sum(size), F.lit(0)), F.count("*")).first()
    shards = max(1, round(total / (capacity * shard)), -(-(texts + total // capacity) // ITEMS))
    full = F.when(size > 0, F.floor((size - 1) / capacity)).otherwise(F.lit(0).cast("long"))
    # Rows of one key (repeated ones, null keys) would meet in one shard, so these are told apart by their places.
    several = counts.groupBy(F.col("key").alias("of_key")).agg(F.count("*").alias("rows")).where("rows > 1")
    numbered = counts.withColumn("place", F.monotonically_increasing_id()).join(several, F.col("key").eqNullSafe(F.col("of_key")), "left")
    numbered = numbered.withColumn("row", F.when(F.col("rows").isNotNull(), F.col("place")).otherwise(F.lit(0).cast("long")))
    pieces = numbered.select("key", "row", size.alias("size"), F.explode(F.sequence(F.lit(0).cast("long"), full)).alias("piece"))
    length = F.least(F.col("size") - F.col("piece") * capacity, F.lit(capacity))
    key_of = F.struct("key", "row")
    items = pieces.select("key", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).alias("first_token"), length.cast("int").alias("n_tokens"), F.pmod(F.xxhash64(key_of, F.col("piece")), F.lit(shards)).alias("shard"))

    def work(table: pa.Table) -> pa.Table:
        # The order within a shard must not depend on how it was shuffled.
        table = table.sort_by([("key", "ascending"), ("piece", "ascending"), ("n_tokens", "ascending")])
        placed = pack(table.column("n_tokens").to_numpy().astype(np.int64), capacity)
        container = pa.array(placed + table.column("shard").to_numpy() * (1 << 32), pa.int64())
        return pa.table([container, *(table.column(c) for c in ("key", "piece", "first_token", "n_tokens"))], names=["container", key, "piece", "first_token", "n_tokens"])

    kind = counts.schema["key"].dataType.simpleString()
    # By number, so that small shards aren't packed in one task.
    return items.repartition(min(shards, TASKS), "shard").groupBy("shard").applyInArrow(work, f"container bigint, `{key}` {kind}, piece int, first_token bigint, n_tokens int")


def container_fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, items, tokens, the share of unused space and the fullest container's tokens."""
    each = packed.groupBy("container").agg(F.sum(F.col("n_tokens").cast("long")).alias("tokens"), F.count("*").alias("items"))
    return each.agg(
        F.count("*").alias("containers"), F.sum("items").alias("items"), F.sum("tokens").alias("tokens"),
        F.round(1 - F.sum("tokens") / (F.count("*") * capacity), 6).alias("unused"), F.max("tokens").alias("fullest"),
    )
