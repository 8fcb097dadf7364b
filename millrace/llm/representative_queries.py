"""Problem 2 over article_cluster, selector_output and normalized_article."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.representative import surviving_records
from millrace.tables import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {name: table(spark, sf_dir, name) for name in ("article_cluster", "selector_output", "normalized_article", "feed_source")}
    return surviving_records(t["article_cluster"], t["selector_output"], t["normalized_article"], t["feed_source"])


QUERIES = {"p2_found": p2_found}
ORACLES: dict[str, str] = {}
