"""The corpus pipeline: toxic documents go, one of each group of near-duplicates stays, documents with benchmark passages
go, sources are mixed to target weights, and what is left is dealt into shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again for the next
one. All but the last return the columns of documents. Empty tables, nulls, ties, repeated rows and extra columns are
handled by the operators; each states its results in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labeldiff.llm import decontaminate, mixing, sharding, similar, toxicity
from labeldiff.llm.common import fresh, stored, table
from labeldiff.scratch import mark, release

SHARDS = 24
#: Exponent of the shares of sources, languages and topics that the mix is raked to; the budget is the largest that meets them.
ALPHA = {"source": 0.9, "lang": 0.9, "topic": 0.9}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that score 0.7 or more. The labels are learnt from the whole table of documents."""
    model = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model, 0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar sets of five-word shingles: the one with the smallest id."""
    return similar.keep_one(docs, shingle=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that contain ten consecutive words of a benchmark item (or a whole shorter item)."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their calibrated probabilities."""
    return mixing.draw(docs, None, ALPHA)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard."""
    return sharding.assign_shards(docs, "doc_id", [1.0] * SHARDS, fresh(docs.columns, "shard"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: Nearest neighbours, components and raking are iterative: tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, since = table(spark, sf_dir, "documents"), mark()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
            release(since, keep=1)
    return docs
