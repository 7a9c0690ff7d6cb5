"""One query for each operator, over its whole table; oracle_sql, from sql.py, has SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, divergence, html_text, lm_scoring, mixing, neighbours, pii, quality_classifier, quality_rules, secrets, simhash, spelling, warc
from .common import SPACES, table
from .sql import oracle_sql

__all__ = ["oracle_sql", "queries"]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.report(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def _judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = quality_rules.measured(docs.select("doc_id", "lang", "text"), keep_text=False)
    q = lambda name: F.col(f"{quality_rules.QUALITY}.{name}").alias(name)
    out = quality_rules.judged(rows, quality_rules.certified(rows, labels))
    return out.select("doc_id", *map(q, ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10b_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op10, with a label for each document: bad where more than a twentieth of the characters are signs. So
    a language has enough labels for certificates in small tables too."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    loud = F.regexp_count(text, F.lit("[#*$%&|<>]")) * 20 > F.char_length(F.regexp_replace(text, SPACES, ""))
    return _judged(docs, docs.select("doc_id", F.when(loud, 0).otherwise(1).alias("quality")))


# Those columns of op6, op8 and op9 that SQL can say, from the same rows.


def op6b_base_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_secrets(spark, sf_dir).drop("spans")


def op8b_mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_mixing(spark, sf_dir).select("doc_id", "size", "source_size", "target")


def op9b_base_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_pii(spark, sf_dir).drop("spans")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_rows(table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_simhash": op2_simhash,
        "op3_html_text": op3_html_text,
        "op4_decontamination": op4_decontamination,
        "op5_warc_fixity": op5_warc_fixity,
        "op6_secrets": op6_secrets,
        "op7_lm_scoring": op7_lm_scoring,
        "op8_mixing": op8_mixing,
        "op9_pii": op9_pii,
        "op10_quality_rules": op10_quality_rules,
        "op10b_certified_rules": op10b_certified_rules,
        "op6b_base_secrets": op6b_base_secrets,
        "op8b_mixing_targets": op8b_mixing_targets,
        "op9b_base_personal_data": op9b_base_personal_data,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_nearest_vectors": op12_nearest_vectors,
        "op13_source_divergence": op13_source_divergence,
    }
