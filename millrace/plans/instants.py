"""Problem 4 over the three feed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.instants import feed_values, instants_found
from millrace.tables import table

FIELDS = {"hn_algolia": "created_at", "hf_papers": "publishedat", "gh_releases": "published_at"}


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = feed_values({name: (table(spark, sf_dir, name), field) for name, field in FIELDS.items()})
    return instants_found(values, table(spark, sf_dir, "feed_mirror"))


QUERIES = {"p4_found": p4_found}
ORACLES: dict[str, str] = {}
