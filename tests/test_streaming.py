"""Streams give what the batch operators give."""

import pytest

from millrace.operators.greedy import first_of_kind
from millrace.streaming.ingest import accept_stream, accepted_state, deliveries_per_window


def test_accepted_rows(spark, sf, tmp_path):
    rows = spark.read.parquet(f"{sf}/processed.parquet").select("record_no", "canonical_url", "content_hash").orderBy("record_no")
    source = f"{tmp_path}/in"
    for n in range(3):
        rows.where(f"record_no % 3 >= 0 and record_no between {n * 34 + 1} and {(n + 1) * 34}").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    accept_stream(stream, f"{tmp_path}/state", f"{tmp_path}/out", f"{tmp_path}/check", "record_no", ["canonical_url", "content_hash"]).awaitTermination()
    got = {r.record_no for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    part = rows.where("record_no <= 102")
    want = {r.record_no for r in first_of_kind(part, "record_no", ["canonical_url", "content_hash"]).where("repeats is null").collect()}
    assert got == want and accepted_state(spark, f"{tmp_path}/state").count() > 0


@pytest.mark.parametrize("late", ["7 days"])
def test_windows(spark, sf, tmp_path, late):
    rows = spark.read.parquet(f"{sf}/collected_item.parquet").select("fetched_at", "source_id")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = deliveries_per_window(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), "fetched_at", "source_id", late=late)
    query = stream.writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("windows").agg({"deliveries": "sum"}).first()[0] == rows.count()
