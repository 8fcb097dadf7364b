"""Problem 3 over processed and normalized_article."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.history import repeated_records
from millrace.tables import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_records(table(spark, sf_dir, "processed"), table(spark, sf_dir, "normalized_article"))


QUERIES = {"p3_found": p3_found}
ORACLES: dict[str, str] = {}
