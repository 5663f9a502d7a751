"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns a DataFrame that is written as Parquet and read back as the
next one's documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontam, mixing, neardup, packing, quality
from tessera.llm.common import read_table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_quality(docs, read_table(spark, sf_dir, "labels"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return neardup.keep_one_row(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.keep_clean_rows(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target shares, in random order."""
    return mixing.mix_sources(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of token ids, see ``packing.pack_tokens``."""
    return packing.pack_tokens(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", keep_uncontaminated),
    ("mixing", mix),
    ("tokens", pack),
]

#: SQL can fit no classifier; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
