"""Problem 1 over collected_item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.truncation import truncated_values, truncation_rates
from millrace.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated_values(table(spark, sf_dir, "collected_item")).select("item_no", "field_name")


def p1_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation_rates(table(spark, sf_dir, "collected_item"))


QUERIES = {"p1_found": p1_found, "p1_rates": p1_rates}
ORACLES: dict[str, str] = {}
