"""Problem 6 over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.tokens import encode_texts
from millrace.tables import table


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"))


QUERIES = {"p6_ids": p6_ids}
ORACLES: dict[str, str] = {}
