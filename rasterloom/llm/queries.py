"""The queries of the training-data operators, each over its whole table, and their SQL.

Each query is thin: it calls its operator with production parameters and derives the
digest columns from the operator's own output.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import chat_format, decontaminate, language_id, license_scan, mixing, quality_rules, secret_scan, sharding, simhash, token_store
from ._common import scratch_dir, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.RULES if r.base]
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(said(F.filter("spans", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.round(c, 6) for c in ("probability", "cover")})


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                                                T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    done = chat_format.format_conversations(rows.unionByName(added))
    loss = chat_format.loss_text(F.col("formatted"), F.col("loss"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "level", "identical")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.withColumns({c: F.round(c, 6) for c in (*[f"p_{d}" for d in mixing.DOMAINS], "rate")})


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{scratch_dir(spark)}/rasterloom-tokens-{uuid.uuid4().hex}"
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, token_store.TokenSpec(public_tokenizers.path("word_bpe_49k.json")))
    return token_store.with_crc(token_store.read_tokens(spark, path))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_sharding, op3_secret_scan, op4_simhash, op5_license_scan, op6_chat_format, op7_mixing, op8_token_store, op9_decontamination, op10_language_id)}
