"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; it
is written as Parquet and read again for the next. All but the last return the columns of
``documents``; the last returns each document with its shard and slot.

Defined cases, in every stage: a null text is an empty one, which quality rules reject; a null id is
kept and dealt like any other; repeated rows of one id and text are copies, of which near-dedup keeps one,
while rows that share an id alone are judged by their own texts; ties go to the least id; an empty
table gives an empty result; further columns, whatever their names, go along up to mixing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rasterloom.llm import decontaminate, mixing, near_copies, quality_rules, sharding
from rasterloom.llm._common import discard, materialise, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, by their own failure or their host's."""
    return quality_rules.filter_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies stays: SimHash signatures of five-word shingles, similarity 0.8."""
    return near_copies.deduplicate(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


#: Shares of the mixed corpus' tokens. High quality is to dominate, so that its documents stay whole
#: and the scarcer domains are thinned to fit.
TARGETS = {"high": 0.92, "low": 0.05, "toxic": 0.03}


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are kept by their rates; the budget keeps what is of high quality and repeats nothing."""
    return mixing.emit(docs, table(spark, sf_dir, "labels"), mixing.MixSpec(targets=TARGETS, budget="keep high", max_rate=1.0))


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's shard and slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_domains),
    ("sharding", deal_shards),
]

#: Near-dedup, decontamination and mixing have no SQL form; the tests hold run() against the operators' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's table is removed when the next one has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
