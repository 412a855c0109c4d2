"""From documents to token shards: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotelake.catalog import table
from quotelake.llm import decontam, langid, mixing, simhash, tokens
from quotelake.llm.scratch import materialised, unused


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, mostly in no known language, or in which no language makes up 0.3 of the text, go."""
    return langid.keep_identified(docs, min_score=0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id."""
    return simhash.one_per_group(docs, k=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontam.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source is passed at least once and at most one and a half times; repeated documents are repeated rows."""
    number = unused(docs, "_pass")
    return mixing.mixed(docs, mixing.Mix(repetition=1.5), name=number).drop(number)


def write_token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each sequence in training order, with the documents that are in it."""
    return tokens.write_shards(docs, tokens.shard_folder(spark))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_shards", write_token_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # fingerprints, learned models and token ids are beyond SQL; tests compare with plain Python

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
