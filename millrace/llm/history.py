"""Problem 3: records that repeat something accepted before.

The history is four tables in shared storage, the first three bucketed, and nothing else of earlier batches is read:

* keys: hashes of the accepted records' canonical URLs, content hashes and main bodies (exact repeats);
* units: hashes of the accepted main bodies' sentences (shared coverage);
* bodies: the main bodies' word hashes by batch (the exact check of near repeats), found through the units;
* sites: the chrome lines known of the sites, so that a small batch's pages are freed of them too.

A batch is hashed once and joined with them bucket by bucket: the batch's side is spread over the history's buckets,
whatever the session's number of partitions, so the history isn't shuffled; then its accepted records are appended.
Repeats follow the records' order: a record is accepted if it repeats no accepted earlier one. That set is found in
rounds over the whole batch (`resolve`), not record by record.

Near repeats: two main bodies that share sentences worth COVERAGE of the longer one's words are compared by all of
their words; SIMILARITY of them in common (a multiset) is a repeat, a quotation is not. Only sentences that several
bodies have are joined, and of these only a body's rarest, counted in the batch and in the history: as few as leave less
than COVERAGE out. A frequent sentence thus makes no pairs, and bodies whose lengths rule a repeat out never meet.
Within a batch every body first meets the earliest one of each of its sentences only, which removes groups of copies
without pairing them; the bodies that remain are then paired fully until no pair of accepted ones is left untested,
which is the exact answer.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.functions.urls import canonical
from millrace.llm.boilerplate import _PACKED, chrome_of, page_lines, site_lines
from millrace.operators.greedy import resolve
from millrace.tables import delete, shared_dir, stored

COVERAGE, SIMILARITY = 0.2, 0.75
#: Words a main body needs to be compared at all.
BODY = 8
#: Batches that one step of `repeated_records` takes together.
STEP = 30


def _lists(column: pa.Array, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(b or b"", kind) for b in column.to_pylist()]


def _main_bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        get = lambda name, b=batch: b.column(b.schema.get_field_index(name))
        keys, sizes, units, weights, offsets, words = [], [], [], [], [0], []
        packed = zip(*(_lists(get(name), kind) for name, kind in zip(_PACKED, (np.int32, np.int32, np.int32, np.int64, np.int32))))
        for numbers, chrome, (counts, all_words, unit_lines, unit, weight) in zip(get("line_nos").to_pylist(), get("chrome").to_pylist(), packed):
            out = set(chrome or ())
            kept = np.array([n not in out for n in numbers], bool)
            body = all_words[kept.repeat(counts)]
            inside = kept[unit_lines]
            own = dict(zip(unit[inside].tolist(), weight[inside].tolist()))
            keys.append(xxhash.xxh3_64_intdigest(body.tobytes()) - (1 << 63) if len(body) >= BODY else None)
            sizes.append(len(body))
            units += own.keys()
            weights += own.values()
            offsets.append(len(units))
            words.append(np.sort(body).tobytes())
        ends = pa.array(offsets, pa.int32())
        flat = pa.array(units, pa.int64()), pa.array(weights, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [get("part"), get("ord"), get("article_no"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), *(pa.ListArray.from_arrays(ends, x) for x in flat), pa.array(words, pa.binary())],
            names=["part", "ord", "article_no", "body", "n_words", "units", "weights", "words"],
        )


def main_bodies(lines: DataFrame, site: DataFrame, wanted: DataFrame) -> DataFrame:
    """(part, ord, article_no, body, n_words, units, weights, words): the hashed main body of every article of
    wanted(part, ord, article_no); `lines` are the stored `page_lines` with words, `site` the known chrome lines.

    `body` is null if it has fewer than BODY words; `words` are the words' 32-bit hashes, sorted. Spelling of case, blanks,
    quotes and punctuation doesn't count; repeated rows stay.
    """
    about = wanted.join(chrome_of(lines, site).withColumnRenamed("page", "article_no"), "article_no", "left")
    # Line lists are read once more and meet what is known of their articles, which is small beside them.
    rows = lines.select(F.col("page").alias("article_no"), "line_nos", *_PACKED).join(about.hint("shuffle_hash"), "article_no")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(_main_bodies, f"part {kinds['part']}, ord {kinds['ord']}, article_no {kinds['article_no']}, body bigint, n_words int, units array<bigint>, weights array<int>, words binary")


class History:
    """The tables of one dataset's accepted records. The number of buckets is theirs: a new history takes that of the
    session's shuffle partitions, a later session finds it in the catalog."""

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None):
        self.spark, self.name = spark, name or f"millrace_{uuid.uuid4().hex}"
        self.folder = f"{shared_dir(spark)}/{self.name}"
        found = spark.sql(f"describe extended {self.name}_keys").where("col_name = 'Num Buckets'").first() if spark.catalog.tableExists(f"{self.name}_keys") else None
        self.buckets = int(found.data_type) if found else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def append(self, what: str, rows: DataFrame, by: str, partition_by: str | None = None) -> None:
        writer = rows.repartition(self.buckets, by).write.mode("append").option("compression", "zstd").option("path", f"{self.folder}/{what}")
        (writer.partitionBy(partition_by) if partition_by else writer).bucketBy(self.buckets, by).saveAsTable(f"{self.name}_{what}")

    def read(self, what: str) -> DataFrame | None:
        name = f"{self.name}_{what}"
        return self.spark.table(name) if self.spark.catalog.tableExists(name) else None

    def beside(self, what: str, rows: DataFrame, by: str, how: str = "inner", where: Column | None = None) -> DataFrame | None:
        """A table's rows joined with `rows`, which are spread over its buckets and hashed there; None if there is none."""
        past = self.read(what)
        if past is None:
            return None
        return (past if where is None else past.where(where)).join(rows.repartition(self.buckets, by).hint("shuffle_hash"), by, how)

    def drop(self) -> None:
        for what in ("keys", "units", "bodies", "sites"):
            self.spark.sql(f"drop table if exists {self.name}_{what}")
        delete(self.spark, self.folder)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(_lists(batch.column(2), np.int32), _lists(batch.column(3), np.int32)):
            ka, na = np.unique(a, return_counts=True)
            kb, nb = np.unique(b, return_counts=True)
            _, i, j = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
            both = int(np.minimum(na[i], nb[j]).sum())
            keep.append(both >= SIMILARITY * (len(a) + len(b) - both))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["body", "other"])


def _verified(pairs: DataFrame, history: History, parts: list[int]) -> DataFrame:
    """(body, other) of the stored pairs whose words are SIMILARITY the same; their words stand in `parts` of the history."""
    ids = pairs.select(F.explode(F.array("body", "other")).alias("body")).distinct()
    words = history.beside("bodies", ids, "body", "left_semi", F.col("part").isin(parts)).select("body", "words").dropDuplicates(["body"])
    words = stored(words)  # of the candidates, which are few beside the bodies
    both = pairs.join(words, "body").join(words.select(F.col("body").alias("other"), F.col("words").alias("others")), "other")
    return stored(both.select("body", "other", "words", "others").mapInArrow(_similar, "body bigint, other bigint"))


def _alike(n: str, m: str) -> Column:
    """Whether bodies of these numbers of words can be SIMILARITY the same."""
    return F.col(n).between(F.col(m) * SIMILARITY, F.col(m) / SIMILARITY)


def check_batch(records: DataFrame, part: int, history: History) -> DataFrame:
    """(ord, first): for every record the accepted earlier one that it repeats, null if it is accepted; accepted records
    join the history.

    records(ord, url_key, hash_key, body): `ord` is the order over all batches, keys may be null. The batch's main bodies
    (see `main_bodies`) are in `part` of the history's bodies already; only accepted ones are ever found, by their units.
    """
    own = F.explode(F.array_distinct(F.array_compact(F.array("url_key", "hash_key", "body"))))
    claims = stored(records.select("ord", own.alias("key")))
    past = history.beside("keys", claims.select("key").distinct(), "key", "left_semi")
    past = None if past is None else stored(past.select("key", "ord"))

    bodies = history.read("bodies").where((F.col("part") == part) & F.col("body").isNotNull())
    each = bodies.select("body", "ord", "n_words", F.explode(F.arrays_zip("units", "weights")).alias("u")).select("body", "ord", "n_words", F.col("u.units").alias("unit"), F.col("u.weights").alias("weight"))
    # Sentences that several bodies have, with the earliest of these in the batch.
    units = each.groupBy("unit").agg(F.count("*").alias("n"), F.min_by("body", "ord").alias("earliest"))
    met = None
    if history.read("units") is not None:
        units = stored(units)
        met = stored(history.beside("units", units.select("unit"), "unit"))
        units = units.join(met.groupBy("unit").agg(F.count("*").alias("before")), "unit", "left").withColumn("n", F.col("n") + F.coalesce("before", F.lit(0)))
    shared = each.join(units.where("n > 1"), "unit").dropDuplicates(["unit", "body"])
    frequent = Window.partitionBy("body").orderBy(F.col("n").desc(), "unit")
    rare = stored(shared.withColumn("left_out", F.sum("weight").over(frequent)).where(F.col("left_out") >= F.col("n_words") * COVERAGE).select("unit", "body", "n_words", "earliest"))

    pairs, parts = rare.where("body <> earliest").select("body", F.col("earliest").alias("other"), F.lit(part).cast("long").alias("other_part")), [part]
    if met is not None:
        # Bodies the history has word for word are settled by their keys.
        fresh = rare.join(past.select(F.col("key").alias("body")), "body", "left_anti")
        pairs = pairs.union(fresh.join(met, "unit").where(_alike("n_words", "m_words")).select("body", "other", "other_part"))
    tested = stored(pairs.distinct())
    if met is not None:
        parts += [r.other_part for r in tested.select("other_part").distinct().collect() if r.other_part != part]  # one a step
    links = _verified(tested, history, parts)
    tested = tested.select("body", "other")
    if past is not None:
        past = stored(past.union(history.beside("keys", links.select(F.col("other").alias("key")).distinct(), "key", "left_semi").select("key", "ord")).distinct())
    # Bodies that repeat none of those met so far; then, to be sure, those of all accepted records.
    alive = rare.select("body").distinct().join(links.select("body"), "body", "left_anti")
    if past is not None:
        alive = alive.join(past.select(F.col("key").alias("body")), "body", "left_anti")
    decided = None
    while True:
        rest = rare.join(alive, "body", "left_semi")
        a, b = rest.select("unit", "body", "n_words"), rest.select("unit", F.col("body").alias("other"), F.col("n_words").alias("m_words"))
        pairs = a.join(b, "unit").where((F.col("other") < F.col("body")) & _alike("n_words", "m_words")).select("body", "other").distinct()
        both_ways = tested.union(tested.select("other", "body"))
        pairs = stored(pairs.join(both_ways, ["body", "other"], "left_anti"))
        more = None if pairs.isEmpty() else _verified(pairs, history, [part])
        if decided is not None and (more is None or more.isEmpty()):
            break
        if more is not None:
            links, tested = links.union(more), tested.union(pairs)
        near = links.union(links.select("other", "body")).distinct()
        probes = records.select("ord", "body").join(near, "body").select("ord", F.col("other").alias("key"))
        decided = resolve(claims, probes, past)
        accepted = stored(records.join(decided.where("first is null"), "ord", "left_semi"))
        alive = accepted.select("body").distinct()
    history.append("keys", accepted.select("ord", own.alias("key")).select("key", "ord"), "key")
    new = history.beside("bodies", alive.where("body is not null"), "body", "left_semi", F.col("part") == part).dropDuplicates(["body"])
    history.append("units", new.select(F.explode("units").alias("unit"), F.col("body").alias("other"), F.col("n_words").alias("m_words"), F.col("part").alias("other_part")), "unit")
    return decided


#: Stands for a missing batch number, which is before all others.
NO_BATCH = -(1 << 31)


def repeated_records(records: DataFrame, articles: DataFrame, step: int = STEP, history: History | None = None) -> DataFrame:
    """(first_record_no, record_no) of every record that repeats an accepted earlier one.

    records(record_no, batch_no, article_no, canonical_url, content_hash), articles(article_no, canonical_url, content_hash,
    body_text); other columns are ignored. The order is batch_no (null first), then record_no; both may be any numbers.
    `step` existing batches are taken together; the result doesn't depend on it. Addresses are compared in their
    canonical form, an unusable one by its own spelling; a missing content hash is taken from the linked article; null
    values match nothing; a record that has nothing to compare is accepted; bodies of fewer than BODY words are only
    compared by content hash. Page chrome is told by the chrome lines that `history` knows and those found in
    `articles`, which join them. A record_no occurs once; rows without one are ignored. Empty tables give no rows. With
    a `history`, the records must be later than all of its own; without one, a history is made and dropped.
    """
    spark = records.sparkSession
    base = records.where("record_no is not null").select("record_no", F.coalesce(F.col("batch_no").cast("long"), F.lit(NO_BATCH)).alias("batch_no"), "article_no", "canonical_url", "content_hash")
    batches = sorted(r.batch_no for r in base.select("batch_no").distinct().collect())  # one a daily run
    if not batches:
        return spark.createDataFrame([], "first_record_no bigint, record_no bigint")
    starts = batches[::step]
    part = F.array_max(F.filter(F.array(*map(F.lit, starts)), lambda s: s <= F.col("batch_no"))).cast("long")
    base = base.withColumn("part", part).withColumn("ord", F.struct("batch_no", F.col("record_no").cast("long").alias("record_no")))
    kept = history or History(spark)

    lines = stored(page_lines(articles.where("article_no is not null"), words=True))
    site, known = stored(site_lines(lines)), kept.read("sites")
    if known is not None:
        site = stored(site.union(known.select("key", "header")).groupBy("key").agg(F.max("header").alias("header")))
    kept.append("sites", site if known is None else site.join(known.select("key"), "key", "left_anti"), "key")
    wanted = base.where("article_no is not null").groupBy("part", "article_no").agg(F.min("ord").alias("ord"))
    kept.append("bodies", main_bodies(lines, site, wanted), "body", "part")

    linked = articles.where("article_no is not null").groupBy("article_no").agg(F.min("content_hash").alias("own_hash"))
    hashed = kept.read("bodies").where(F.col("part").isin(starts)).groupBy("article_no").agg(F.min("body").alias("body"))
    rows = base.join(linked, "article_no", "left").join(hashed, "article_no", "left")
    url, content = F.coalesce("c.url", F.nullif(F.trim("canonical_url"), F.lit(""))), F.coalesce("content_hash", "own_hash")
    keyed = rows.withColumn("c", canonical(F.col("canonical_url"))).select(
        "part", "ord", F.when(url.isNotNull(), F.xxhash64(F.lit("url"), url)).alias("url_key"), F.when(content.isNotNull(), F.xxhash64(F.lit("hash"), content)).alias("hash_key"), "body",
    )
    keyed = stored(keyed, ["part"])
    found = [check_batch(keyed.where(F.col("part") == start).drop("part"), start, kept) for start in starts]
    if history is None:
        kept.drop()
    return reduce(DataFrame.union, found).where("first is not null").select(F.col("first.record_no").alias("first_record_no"), F.col("ord.record_no").alias("record_no"))
