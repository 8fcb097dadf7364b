"""Problem 7 over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.packing import container_fill, packed_texts
from millrace.tables import table


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_texts(table(spark, sf_dir, "documents"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return container_fill(packed_texts(table(spark, sf_dir, "documents")))


QUERIES = {"p7_containers": p7_containers, "p7_fill": p7_fill}
ORACLES: dict[str, str] = {}
