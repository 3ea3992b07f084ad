"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from rasterloom.llm import chat_format, decontaminate, language_id, license_scan, mixing, near_copies, quality_rules, secret_scan, sharding, simhash, token_store

LONG = "word and another thing " * 20_000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again today", "en", "a"), (1, "the quick brown fox jumps over the lazy dog again and again today", "en", "a"),
    (2, None, None, None), (None, "some text without an id but with enough words to pass the rule", "en", "a"), (3, "", "de", ""), (4, " \t\n", "de", "b"),
    (5, LONG, None, "b"), (6, "token = \"abcdefghij\"", "en", None), (7, "ünï¢ödé — “quotes” 日本語 🎉", "fr", "c"),
]
BASE = "doc_id long, text string, lang string, source string"
#: Columns with the names that the operators give to their own.
EXTRA = ["n_words", "base_failed", "kept", "shard", "slot", "size", "spans", "fingerprint", "component_id", "score", "lang_pred", "tokens", "start",
         "copies", "rate", "host", "__id", "__text", "__host", "__code", "__row", "n", "x", "u", "v", "cosine", "family", "probability", "held_out",
         "__gone", "__gone_hash", "__hash", "__n", "__copies", "__mix_id", "__mix_hash", "__label", "__node", "__key", "__task"]


def operators(spark):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again and again today"), (2, None), (None, "another item"), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (5, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    small = language_id.LanguageSpec(steps=3, docs_per_lang=5)
    return {
        "quality": quality_rules.assess, "quality filter": quality_rules.filter_documents, "sharding": sharding.shard_documents, "secrets": secret_scan.scan,
        "simhash": simhash.near_duplicates, "near copies": near_copies.deduplicate, "licenses": license_scan.scan,
        "leaks": lambda d: decontaminate.find_leaks(d, bench), "clean": lambda d: decontaminate.clean_documents(d, bench),
        "mixing": lambda d: mixing.mix(d, labels), "emit": lambda d: mixing.emit(d, labels), "language": lambda d: language_id.identify(d, small),
    }


#: Rows of the result for ROWS; None where the number is not one for each row.
ROWS_OUT = {"quality": 9, "sharding": 9, "secrets": 9, "simhash": 9, "mixing": 9, "language": 9}


@pytest.mark.parametrize("name", ["quality", "quality filter", "sharding", "secrets", "simhash", "near copies", "licenses", "leaks", "clean", "mixing", "emit", "language"])
def test_edges(spark, name):
    docs = spark.createDataFrame(ROWS, BASE)
    op = operators(spark)[name]
    plain = op(docs)
    rows = plain.collect()
    if name in ROWS_OUT:
        assert len(rows) == ROWS_OUT[name]
    assert op(docs.limit(0)).collect() == []
    wide = docs.select("*", *[F.lit("clash").alias(c) for c in EXTRA])
    out = op(wide)
    if name in ("quality filter", "near copies", "clean", "emit"):
        assert out.columns == wide.columns
    assert out.count() == len(rows)


def test_expected_edges(spark):
    docs = spark.createDataFrame(ROWS, BASE)
    q = {(r.doc_id, r.n_words): r for r in quality_rules.assess(docs).collect()}
    assert q[2, 0].base_failed and not q[2, 0].kept and q[5, 80_000].base_failed
    kept = quality_rules.filter_documents(docs).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 1]
    assert sorted((r.doc_id or 0) for r in near_copies.deduplicate(docs).collect()) == [0, 1, 2, 5, 6, 7]
    leaks = decontaminate.find_leaks(docs, spark.createDataFrame([(9, ROWS[0][1])], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in leaks] == [(1, 9)]
    s = secret_scan.scan(docs).where("doc_id = 6").first().spans
    assert [(x.kind, x.start, x.end) for x in s] == [("assign", 0, 19)]


def test_chat_edges(spark):
    rows = [(1, 0, "user", None, "x"), (1, None, None, "first", "x"), (1, 0, "user", None, "x"), (None, 1, "assistant", "a", "x"), (2, 0, "assistant", "", "x"), (3, 0, "system", "z" * 300_000, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in chat_format.format_conversations(turns).collect()}
    assert [tuple(t) for t in out[1].turns] == [("", "first"), ("user", ""), ("user", "")]
    assert all(r.identical for r in out.values()) and len(out) == 4
    assert chat_format.format_conversations(turns.limit(0)).collect() == []


def test_token_edges(spark, tmp_path):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    spec = token_store.TokenSpec(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.createDataFrame(ROWS, BASE).withColumn("part", F.lit("clash")).withColumn("tokens", F.lit("clash"))
    token_store.write_tokens(docs, f"file://{tmp_path}/a", spec)
    rows = token_store.with_crc(token_store.read_tokens(spark, f"file://{tmp_path}/a")).orderBy("start").collect()
    assert len(rows) == 9 and [r.n_tokens for r in rows if r.doc_id in (2, 3)] == [1, 1]
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:], strict=False))
    token_store.write_tokens(docs.limit(0), f"file://{tmp_path}/b", spec)
    assert token_store.with_crc(token_store.read_tokens(spark, f"file://{tmp_path}/b")).collect() == []
