"""The corpus pipeline: five operators of the llm subpackage, one after the other over all documents.

Each stage takes any table with doc_id, text, lang and source. A null or empty text fails the quality rules; in the other
stages it is kept like any text (of several documents without words one stays, as their fingerprints are equal). Null ids,
languages and sources are values of their own. Repeated rows: all pass quality or none, one stays after near-dedup. Extra
columns pass through all stages; stages choose names for their own that no column has. An empty table gives an empty one,
with the columns of the stage. Rows that a stage keeps are unchanged, but for masking, which changes text and n_chars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import decontamination, mixing, pii, quality_rules, simhash
from lectern.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data masked."""
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their copies."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
]

#: SimHash components and the random mix have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
