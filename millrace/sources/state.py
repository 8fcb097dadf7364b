"""Files of what has been processed, and of runs: strict reading, byte-stable writing, pruning by name."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE = "canonical_url string, content_hash string, first_seen_at string, last_decision string"
_KEYS = sorted(field.split()[0] for field in STATE.split(", "))


def state_lines(records: DataFrame) -> DataFrame:
    """(canonical_url, content_hash, line): every record as JSON with sorted keys, nulls included, non-ASCII as it is."""
    line = F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in _KEYS]), {"ignoreNullFields": "false"})
    return records.select("canonical_url", "content_hash", line.alias("line"))


def write_state(records: DataFrame, folder: str) -> None:
    """Records by address and content, one a line: the files in the order of their names hold the same bytes for the same
    records, however these were partitioned. The sort is a range shuffle; nothing is gathered."""
    state_lines(records).orderBy("canonical_url", "content_hash", "line").select("line").write.mode("errorifexists").text(folder)


def read_state(spark: SparkSession, folder: str) -> DataFrame:
    """The records below `folder`, none where it doesn't exist. A line that isn't an object, or has other keys than STATE's,
    is an error when it is read."""
    try:
        lines = spark.read.text(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return spark.createDataFrame([], STATE)
    keys = F.json_object_keys("value")
    bad = keys.isNull() | (F.size(F.array_except(keys, F.array(*map(F.lit, _KEYS)))) > 0)
    record = F.when(bad, F.raise_error(F.concat(F.lit("not a state record: "), F.substring("value", 1, 80)))).otherwise(F.from_json("value", STATE, {"mode": "FAILFAST"}))
    return lines.select(record.alias("r")).select("r.*")


def read_runs(spark: SparkSession, folder: str, schema: str, since: str | None = None) -> DataFrame:
    """Runs of files named run-YYYYMMDDTHHMMSS….json, with `started`, oldest first by that column. Other files are ignored;
    files before `since` (YYYYMMDDTHHMMSS) are pruned by their names and never opened."""
    started = F.regexp_extract("_metadata.file_name", r"^run-(\d{8}T\d{6})[^/]*\.json$", 1)
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", "run-[0-9]*T[0-9]*.json").json(folder)
    kept = rows.where(F.col("_metadata.file_name") >= f"run-{since}") if since else rows
    return kept.where(started != "").select(started.alias("started"), *rows.columns)
