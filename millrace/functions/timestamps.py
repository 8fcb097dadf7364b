"""Many spellings of a time, one instant: microseconds since 1970-01-01 UTC.

All formats are alternatives of one regular expression with named groups. It is applied once per value
(`regexp_replace` writes every group into one delimited record), calendar ranges are checked on the parts and the
instant is assembled by integer day arithmetic. Everything stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names by their first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Zone abbreviations and their offsets from UTC in minutes.
ABBREVIATIONS = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0,
    "west": 60, "bst": 60, "cet": 60, "met": 60, "cest": 120, "mest": 120, "eet": 120, "eest": 180, "msk": 180,
    "ist": 330, "jst": 540, "kst": 540, "awst": 480, "acst": 570, "acdt": 630, "aest": 600, "aedt": 660,
    "nzst": 720, "nzdt": 780,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
    "akst": -540, "akdt": -480, "hst": -600, "brt": -180, "brst": -120, "art": -180, "nst": -210, "ndt": -150,
}

_MONTH = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_WEEKDAY = "(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?"
_DATES = {
    "iso": r"(?<y1>\d{4})(?<sep>[-/])(?<m1>\d{1,2})\k<sep>(?<d1>\d{1,2})",
    "compact": r"(?<y2>\d{4})(?<m2>\d{2})(?<d2>\d{2})(?=[t ]\d{4}|\d{6}$|$)",
    "kanji": r"(?<y3>\d{4})年(?<m3>\d{1,2})月(?<d3>\d{1,2})日",
    "dotted": r"(?<d4>\d{1,2})\.(?<m4>\d{1,2})\.(?<y4>\d{4})",
    "slashed": r"(?<a5>\d{1,2})/(?<b5>\d{1,2})/(?<y5>\d{4})",
    "day first": rf"(?:{_WEEKDAY},?\s+)?(?<d6>\d{{1,2}})\s+(?<n6>{_MONTH})\.?,?\s+(?<y6>\d{{4}})",
    "month first": rf"(?:{_WEEKDAY},?\s+)?(?<n7>{_MONTH})\.?\s+(?<d7>\d{{1,2}}),?\s+(?<y7>\d{{4}})",
}
_TIMES = {
    "colons": r"(?<h1>\d{1,2}):(?<i1>\d{2})(?::(?<s1>\d{2})(?:[.,](?<f1>\d+))?)?",
    "compact": r"(?<h2>\d{2})(?<i2>\d{2})(?:(?<s2>\d{2})(?:[.,](?<f2>\d+))?)?",
    "kanji": r"(?<h3>\d{1,2})時(?:(?<i3>\d{1,2})分)?(?:(?<s3>\d{1,2})秒)?",
}
_ZONE = r"(?:(?<zs>[+-])(?<zh>\d{2})(?::?(?<zm>\d{2}))?|(?<za>[a-z]{1,5}))"
PATTERN = (
    r"(?i)^(?:(?<c>-?\d{9,10}|\d{12,13}|\d{15,16}|\d{18,19})(?:\.(?<cf>\d+))?"
    rf"|(?:{'|'.join(_DATES.values())})"
    rf"(?:(?:\s*,\s*|\s*t\s*|\s+)?(?:{'|'.join(_TIMES.values())})(?:\s*(?<ap>[ap])\.?m\.?)?)?"
    rf"(?:\s*{_ZONE})?(?:\s*\[(?<zn>[a-z_]+(?:/[a-z_+-]+)*)\])?)$"
)

_FIELDS = {
    "year": "y1 y2 y3 y4 y5 y6 y7",
    "month": "m1 m2 m3 m4",
    "name": "n6 n7",
    "day": "d1 d2 d3 d4 d6 d7",
    "a": "a5",
    "b": "b5",
    "hour": "h1 h2 h3",
    "minute": "i1 i2 i3",
    "second": "s1 s2 s3",
    "fraction": "f1 f2",
    "half": "ap",
    "sign": "zs",
    "zone_h": "zh",
    "zone_m": "zm",
    "abbreviation": "za",
    "zone_id": "zn",
    "count": "c",
    "count_fraction": "cf",
}
_RECORD = "|" + "|".join("".join(f"${{{g}}}" for g in groups.split()) for groups in _FIELDS.values())


def trimmed(value: Column) -> Column:
    """`value` without Unicode blanks, byte-order marks and zero-width characters at its ends."""
    return F.regexp_replace(value, r"^[\s\p{Z}\x{200B}-\x{200D}\x{2060}\x{FEFF}\x{AD}]+|[\s\p{Z}\x{200B}-\x{200D}\x{2060}\x{FEFF}\x{AD}]+$", "")


def components(value: Column) -> Column:
    """An array: the named parts of `value` in the order of _FIELDS behind an empty one, or one element where no format fits."""
    # A bar delimits the record. No value that the pattern matches holds one; in others it is replaced, so they stay whole.
    return F.split(F.regexp_replace(F.translate(trimmed(value), "|", "¦"), PATTERN, _RECORD), r"\|")


def part(parts: Column, name: str) -> Column:
    """One part as text, null where it is absent."""
    return F.nullif(F.get(parts, list(_FIELDS).index(name) + 1), F.lit(""))


def _number(parts: Column, name: str) -> Column:
    return part(parts, name).cast("int")


def slash_evidence(value: Column) -> tuple[Column, Column]:
    """Whether a slashed date can only be day first, and whether only month first."""
    parts = F.regexp_extract(value, r"(\d{1,2})/(\d{1,2})/\d{4}", 1), F.regexp_extract(value, r"(\d{1,2})/(\d{1,2})/\d{4}", 2)
    first, second = (F.nullif(p, F.lit("")).cast("int") for p in parts)
    return (first > 12) & (second <= 12), (second > 12) & (first <= 12)


def days_from_civil(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date, by integer arithmetic on years that begin in March."""
    y = year - F.when(month <= 2, 1).otherwise(0)
    era = F.floor(y / 400)
    of_era = y - era * 400
    of_year = F.floor((F.lit(153) * (month + F.when(month > 2, -3).otherwise(9)) + 2) / 5) + day - 1
    return (era * 146097 + of_era * 365 + F.floor(of_era / 4) - F.floor(of_era / 100) + of_year - 719468).cast("long")


def _micros_of_fraction(digits: Column) -> Column:
    return F.rpad(F.substring(F.coalesce(digits, F.lit("0")), 1, 6), 6, "0").cast("long")


def numbers(parts: Column, day_first: Column) -> Column:
    """The parts (of `components`) as one struct of numbers, the order of a slashed date settled.

    `day_first` is that order; where it is null, a value with AM or PM is month first and any other day first.
    """
    slashed = part(parts, "a").isNotNull()
    first = F.coalesce(day_first, part(parts, "half").isNull())
    a, b = _number(parts, "a"), _number(parts, "b")
    named = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(part(parts, "name"), 1, 3))).cast("int")
    month = F.when(slashed, F.when(first, b).otherwise(a)).otherwise(F.coalesce(_number(parts, "month"), named))
    day = F.when(slashed, F.when(first, a).otherwise(b)).otherwise(_number(parts, "day"))
    zone_h, zone_m = _number(parts, "zone_h"), F.coalesce(_number(parts, "zone_m"), F.lit(0))
    offset = F.when(part(parts, "sign") == "-", -1).otherwise(1) * (zone_h * 60 + zone_m)
    table = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    by_name = F.try_element_at(table, F.lower(part(parts, "abbreviation")))
    return F.struct(
        _number(parts, "year").alias("year"),
        month.alias("month"),
        day.alias("day"),
        F.lower(part(parts, "half")).alias("half"),
        F.coalesce(_number(parts, "hour"), F.lit(0)).alias("clock"),
        F.coalesce(_number(parts, "minute"), F.lit(0)).alias("minute"),
        F.coalesce(_number(parts, "second"), F.lit(0)).alias("second"),
        _micros_of_fraction(part(parts, "fraction")).alias("micros"),
        (zone_h.isNotNull() | part(parts, "abbreviation").isNotNull()).alias("fixed"),
        F.when(zone_h.isNotNull(), F.when((zone_h <= 18) & (zone_m <= 59), offset)).otherwise(by_name).alias("minutes"),
        part(parts, "zone_id").alias("zone_id"),
        part(parts, "count").try_cast("long").alias("count"),
        F.length(F.ltrim(part(parts, "count"), F.lit("-"))).alias("digits"),
        _micros_of_fraction(part(parts, "count_fraction")).alias("count_micros"),
    )


def local_micros(n: Column) -> Column:
    """Microseconds since 1970-01-01 of the clock that `n` (of `numbers`) shows, null for an impossible one."""
    year, month, day, clock, half = (n[k] for k in ("year", "month", "day", "clock", "half"))
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    length = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    hour = F.when(half == "a", clock % 12).when(half == "p", clock % 12 + 12).otherwise(clock)
    in_range = (
        year.between(1, 9999) & month.between(1, 12) & (day >= 1) & (day <= length) & (n["minute"] <= 59) & (n["second"] <= 60)
        & F.when(half.isNotNull(), clock.between(1, 12)).otherwise(clock <= 23)
    )
    of_day = (hour * 3600 + n["minute"] * 60 + F.least(n["second"], F.lit(59))).cast("long")
    return F.when(in_range, (days_from_civil(year, month, day) * 86400 + of_day) * 1_000_000 + n["micros"])


def epoch_micros(n: Column, local: Column, zone_id: Column) -> Column:
    """The instant of `n` (of `numbers`) and `local` (of `local_micros`), null where they denote none.

    `zone_id` is the zone of values that name none (null: UTC). A local time that occurs twice is the first, one that
    is skipped moves forward by the change.
    """
    named = F.when(~n["fixed"], n["zone_id"])
    known = named.isNull() | F.try_to_timestamp(F.concat(F.lit("2020-01-01 00:00:00 "), named)).isNotNull()
    by_zone = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), F.coalesce(named, zone_id, F.lit("UTC"))))
    dated = F.when(n["fixed"], local - n["minutes"].cast("long") * 60_000_000).when(known, by_zone)
    count, digits = n["count"], n["digits"]
    counted = (
        F.when(digits <= 10, count * 1_000_000 + F.signum(count).cast("long") * n["count_micros"])
        .when(digits <= 13, count * 1000 + F.floor(n["count_micros"] / 1000))
        .when(digits <= 16, count)
        .otherwise(F.floor(count / 1000))
    )
    return F.when(digits.isNotNull(), counted).otherwise(dated)
