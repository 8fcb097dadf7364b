"""Problem 8 over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.languages import languages_found, text_languages
from millrace.tables import table


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages_found(table(spark, sf_dir, "documents"))


def p8_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its language and confidence, and a row for each of its parts."""
    judged = text_languages(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "language", F.round("confidence", 4).alias("confidence"), F.explode_outer("parts").alias("part")).select("doc_id", "language", "confidence", "part.*").toDF(
        "doc_id", "language", "confidence", "part_lang", "first_sentence", "last_sentence", "sentences", "part_confidence"
    )


QUERIES = {"p8_found": p8_found, "p8_segments": p8_segments}
ORACLES: dict[str, str] = {}
