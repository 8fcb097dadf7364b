"""Problem 4 against datetime and zoneinfo, value by value."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from millrace.operators.instants import instants_found, normalise_instants

UTC = timezone.utc


def micros(d: datetime) -> int:
    return (d - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def run(spark, rows, mirrors=((1, "America/New_York"), (2, "Europe/Berlin"), (3, "nowhere/at all"))):
    values = spark.createDataFrame([("t", i, m, v) for i, (v, m) in enumerate(rows)], "table_name string, row_no long, mirror_id int, value string")
    out = normalise_instants(values, spark.createDataFrame(list(mirrors), "mirror_id int, zone_id string"))
    return {r.row_no: r.epoch_us for r in out.collect()}


def test_formats(spark):
    at = datetime(2026, 5, 3, 14, 5, 6, tzinfo=UTC)
    day, minute = datetime(2026, 5, 3, tzinfo=UTC), at.replace(second=0)
    cases = [
        ("2026-05-03T14:05:06Z", at), ("​ 2026-05-03t14:05:06z\xa0", at), ("20260503T140506", at), ("20260503140506", at),
        ("2026-05-03 16:05:06+02:00", at), ("2026-05-03T16:05:06+0200", at), ("2026-05-03T16:05:06+02", at),
        ("2026-05-03T16:05:06+02:00[Europe/Berlin]", at), ("2026-05-03T16:05:06[Europe/Berlin]", at),
        ("Sun, 03 May 2026 10:05:06 EDT", at), ("3 May 2026 10:05:06 -0400", at), ("2026-05-03 14:05:06 GMT", at),
        ("May 3, 2026 2:05 pm", minute), ("03.05.2026, 14:05", minute), ("2026/05/03 14:05", minute), ("2026年5月3日 14時05分", minute),
        ("May 3, 2026", day), ("2026-05-03", day), ("3 May 2026", day),
        (str(int(at.timestamp())), at), (f"{int(at.timestamp())}123", at + timedelta(milliseconds=123)),
        (f"{int(at.timestamp())}123456", at + timedelta(microseconds=123456)), (f"{int(at.timestamp())}.5", at + timedelta(milliseconds=500)),
        ("2026-05-03T14:05:06.1234567899Z", at + timedelta(microseconds=123456)), ("2026-05-03T14:05:60Z", at.replace(second=59)),
        ("12/31/2026 12:30 AM", datetime(2026, 12, 31, 0, 30, tzinfo=UTC)), ("1/2/2026 12:30 PM", datetime(2026, 1, 2, 12, 30, tzinfo=UTC)),
        ("1/2/2026 12:30", datetime(2026, 2, 1, 12, 30, tzinfo=UTC)), ("29 Feb 2028", datetime(2028, 2, 29, tzinfo=UTC)),
    ]
    got = run(spark, [(v, None) for v, _ in cases])
    assert {v: got[i] for i, (v, _) in enumerate(cases)} == {v: micros(d) for v, d in cases}


def test_no_instant(spark):
    bad = [None, "", " ", "soon", "n/a", "-", "|", "2026", "2026-13-01", "2026-02-29", "2026-01-01T24:00:00Z", "2026-01-01T10:61:00Z", "0000-00-00 00:00:00",
           "2026-05-03 10:00 XYZ", "2026-05-03T10:00[No/Where]", "13:00 PM", "1/2/2026 13:00 PM", "x" * 100_000, "9" * 19, "99/99/2026 10:00"]
    got = run(spark, [(v, 1) for v in bad])
    assert {bad[i]: v for i, v in got.items() if v is not None} == {}


def test_local_times_follow_the_mirror(spark):
    ny, berlin = ZoneInfo("America/New_York"), ZoneInfo("Europe/Berlin")
    rows = [
        ("2026-11-01 01:30:00", 1), ("2026-03-08 02:30:00", 1), ("2026-10-25 02:30", 2), ("2026-03-29T02:15:30.25", 2), ("2026-07-01", 2),
        ("2026-07-01 00:00", None), ("2026-07-01 00:00", 99), ("2026-07-01 00:00", 3), ("2026-07-01T00:00:00Z", 1),
    ]
    got = run(spark, rows)
    expected = [
        datetime(2026, 11, 1, 1, 30, tzinfo=ny), datetime(2026, 3, 8, 3, 30, tzinfo=ny), datetime(2026, 10, 25, 2, 30, tzinfo=berlin),
        datetime(2026, 3, 29, 3, 15, 30, 250000, tzinfo=berlin), datetime(2026, 7, 1, tzinfo=berlin),
        *[datetime(2026, 7, 1, tzinfo=UTC)] * 4,
    ]
    assert [got[i] for i in range(len(rows))] == [micros(d) for d in expected]


def test_slashed_order_is_learnt_per_mirror(spark):
    rows = [("25/12/2026 10:00", 2), ("03/04/2026 10:00", 2), ("12/25/2026 10:00", 1), ("03/04/2026 10:00", 1)]
    got = run(spark, rows, [(1, "UTC"), (2, "UTC")])
    assert got[1] == micros(datetime(2026, 4, 3, 10, tzinfo=UTC)) and got[3] == micros(datetime(2026, 3, 4, 10, tzinfo=UTC))


def test_empty_repeated_and_extra_columns(spark):
    schema = "table_name string, row_no long, mirror_id int, value string, zone_id string, n int, parts string"
    mirrors = spark.createDataFrame([(1, "UTC", "x"), (1, "UTC", "y")], "mirror_id int, zone_id string, value string")
    assert instants_found(spark.createDataFrame([], schema), mirrors).collect() == []
    twice = [("t", 1, 1, "2026-05-03", "clash", 1, "p")] * 2
    assert len(instants_found(spark.createDataFrame(twice, schema), mirrors).collect()) == 2


def test_days_from_civil_is_the_calendar(spark):
    from pyspark.sql import functions as F

    from millrace.functions.timestamps import days_from_civil

    days = spark.range(-200_000, 200_000, 37).select(F.col("id"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    wrong = days.where(days_from_civil(F.year("d"), F.month("d"), F.day("d")) != F.col("id"))
    assert wrong.count() == 0
