"""A corpus pipeline of five operators: language ID, near-dedup, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
documents. All stages but the last return the columns they were given. Counts and rows of a stage come from its whole input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontaminate, language, mixing, secrets, simhash
from starloom.llm.common import read
from starloom.session import cut_lineage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; a text without letters, or of no clear language, goes."""
    return language.keep_identified(docs, *language.text_model(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the least id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind in brackets; n_chars follows."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes and how many copies of each (mix_copies)."""
    return mixing.mix(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
]

#: Language models, fingerprints and automata are beyond SQL: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
