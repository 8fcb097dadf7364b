"""Problem 5 over normalized_article."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.boilerplate import chrome_lines
from millrace.tables import table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chrome_lines(table(spark, sf_dir, "normalized_article"))


QUERIES = {"p5_found": p5_found}
ORACLES: dict[str, str] = {}
