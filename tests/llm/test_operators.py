"""Operators against brute force, exact round trips and held-out accuracy."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rasterloom.llm import chat_format, components, decontaminate, language_id, license_scan, mixing, near_copies, queries, quality_rules, secret_scan, sharding, simhash, token_store
from rasterloom.llm._common import RUN, sums_before


def rows_of(sf, name):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def test_quality_metrics_by_brute_force(spark, sf):
    got = {r.doc_id: r for r in queries.op1_quality_rules(spark, sf).collect()}
    for r in rows_of(sf, "documents"):
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        twice = Counter(windows)
        covered = {i + j for i, x in enumerate(windows) if twice[x] > 1 for j in range(5)}
        lines = [x for x in r["text"].split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        g = got[r["doc_id"]]
        assert (g.n_words, g.word_chars, g.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert g.n_symbols == sum(r["text"].count(c) for c in "#*$%&|<>") and g.n_dup_lines == len(lines) - len(set(lines))
        assert g.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_bad_host_takes_its_documents_along(spark):
    good, bad = " ".join(f"w{i}" for i in range(30)), "too short"
    rows = [(i, bad if i % 10 else good, "spam") for i in range(60)] + [(100 + i, good, f"h{i % 6}") for i in range(120)] + [(500, bad, "h1"), (501, good, None)]
    got = {r.doc_id: r for r in quality_rules.assess(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not got[0].base_failed and not got[0].kept and got[0].host_rate > 0.5
    assert got[100].kept and got[501].kept and got[501].host_docs is None and not got[500].kept


def test_lpt_and_slots(spark, sf):
    units = [(random.Random(k).randint(1, 99), str(k)) for k in range(200)]
    placed, loads = sharding.lpt(units, 7), Counter()
    for size, key in sorted(units, key=lambda u: (-u[0], u[1])):
        assert placed[key] == min(range(7), key=lambda s: (loads[s], s))
        loads[placed[key]] += size
    rows = queries.op2_sharding(spark, sf).collect()
    text = {r["doc_id"]: r["text"] for r in rows_of(sf, "documents")}
    shards, slots, sizes = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        assert r.size == len(text[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        shards[text[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(len(s) == 1 for s in shards.values()) and len(rows) == len(text)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) <= sum(sizes.values()) / 40 + max(r.size for r in rows)


def test_shards_of_rows_without_ids_of_their_own(spark):
    rows = [(None if i % 3 else 7, "same text" if i % 4 else f"text {i}") for i in range(3000)]
    spec = sharding.Sharding(n_shards=5, rows_per_bucket=20)
    slots = defaultdict(list)
    for r in sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), spec).collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == 3000 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_secrets_by_brute_force(spark, sf):
    planted = [(-1, "passwd: short token=secret: abcdefgh AKIAAKIA1234567890 KEY"), (-2, "x" * 70_000 + "\nAPI_KEY='0123456789abcdef'"), (-3, "é🎉 deadbeef" * 9),
               (-4, "ghp_" + "a" * 36 + " xoxb-0123456789ab -----BEGIN RSA PRIVATE KEY-----"), (-5, "0123456789abcdef" * 3)]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(planted, "doc_id long, text string"))
    text = {r["doc_id"]: r["text"] for r in rows_of(sf, "documents")} | dict(planted)
    found = 0
    for r in secret_scan.scan(docs).collect():
        want = sorted((m.start(), k, m.end(), rule.kind) for k, rule in enumerate(secret_scan.RULES)
                      for m in re.finditer(rule.regex.replace("(?i:", "(?ai:"), text[r.doc_id]) if len(m.group(rule.group)) >= rule.min_chars)
        assert [tuple(s) for s in r.spans] == want
        found += len(want)
    assert found >= 7


def test_many_matches_and_turns(spark):
    """Rows with more matches or turns than one run of the running sums holds."""
    for n in (0, 1, RUN, RUN + 1, 5 * RUN):
        values = [7 * i % 11 for i in range(n)]
        got = spark.createDataFrame([(values,)], "v array<int>").select(sums_before(F.col("v"))).first()[0]
        assert got == [sum(values[:i]) for i in range(n)]
    text = "é ".join(f"token={'a' * (6 + i % 4)}" for i in range(1000))
    got = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    assert [(s.start, s.end) for s in got] == [m.span() for m in re.finditer("token=(a+)", text) if len(m.group(1)) >= 8]
    rows = [(1, i, "user" if i % 3 else "assistant", "x" * (i % 5) + ("<s>" if i % 7 == 0 else "")) for i in range(1000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat_format.format_conversations(df).withColumn("said", chat_format.loss_text(F.col("formatted"), F.col("loss"))).first()
    assert r.identical and [tuple(t) for t in r.turns] == [x[2:] for x in rows] and r.said == "".join(x[3] for x in rows if x[2] == "assistant")


def test_trigram_queries():
    assert secret_scan.trigram_query(r"[0-9a-f]{32,}") is None
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == frozenset([frozenset(["aki", "kia"])])
    assert secret_scan.trigram_query("(abcd|xyz)+q?") == frozenset([frozenset(["abc", "bcd"]), frozenset(["xyz"])])
    assert secret_scan.trigram_query("ab|wxyz") is None
    for text, regex in (("zzfoobarzz", "fo+bar"), ("a colour", "colou?r"), ("xAxxBx", "x(A|a)x+Bx")):
        query = secret_scan.trigram_query(regex)
        assert re.search(regex, text) and (query is None or any(all(g in text.lower() for g in c) for c in query))


def brute_classes(codes, d):
    parent = list(range(len(codes)))
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(codes)), 2):
        if (codes[i] ^ codes[j]).bit_count() <= d:
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(codes))]


def test_gray_index_finds_every_link(spark):
    rng = random.Random(5)
    codes = [rng.getrandbits(64) for _ in range(150)]
    for c in list(codes[:12]):  # balls and chains around some codes
        for _ in range(25):
            c2 = c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            codes.append(c2)
            c = c2 if rng.random() < 0.5 else c
    codes += codes[:30] + [0, 0, 3, 1 << 63]
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame(list(enumerate(signed)), "__id long, __code long")
    found = {r["__code"]: r["__component"] for r in simhash.code_components(df, simhash.SimHash(min_parts=9)).collect()}
    assert [found[s] for s in signed] == brute_classes(codes, 2)


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_query_by_brute_force(spark, sf):
    for text in ("", "One TWO", "a b c d e f g", "Ünï ÄB x\ty\nz " * 30):
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    docs = sorted((r["doc_id"], r["text"]) for r in rows_of(sf, "documents"))
    codes = [plain_fingerprint(t) for _, t in docs]
    least = brute_classes(codes, 2)
    want = {d: (f"{c:016x}", docs[least[i]][0]) for i, ((d, _), c) in enumerate(zip(docs, codes, strict=True))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash(spark, sf).collect()} == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(i + 1, i) for i in range(40)] + [(100 + i, 100) for i in range(1, 60)] + [(a, b) for a, b in ((rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)) if a > b]
    got = {r.u: r.v for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {n: got.get(n, n) for n in label} == label


def least_of_classes(n, pairs):
    least = list(range(n))
    for _ in range(n):
        before = list(least)
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            return set(least)


def test_near_copies(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    rows, n = [], 0
    for _ in range(25):
        base = [word() for _ in range(400)]
        for k in range(4):
            w = list(base)
            for _ in range(k * 3):  # nine words changed of 400: a similarity of about 0.8
                w[rng.randrange(len(w))] = word()
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n + k, " ".join(word() for _ in range(300))) for k in range(40)]
    sets = [{tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for _, t in rows]
    pairs = {(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for spec in (near_copies.NearCopySpec(), near_copies.NearCopySpec(group_rows=20, values_per_task=3, tree_rows=4), near_copies.NearCopySpec(part_bits=10)):
        kept = {r.doc_id for r in near_copies.deduplicate(docs, spec).collect()}
        assert kept <= set(range(n + 40)) and len(kept ^ set(least_of_classes(n + 40, pairs))) <= 1  # an index miss of 1 in 100


def test_near_copies_at_the_bound(spark):
    """Pairs at 0.8 go and pairs at 0.7 stay, by the exact similarity; rows that share an id are judged by their own text."""
    rng = random.Random(9)
    rows, n, sets = [], 0, {}
    for k in range(120):
        base = [f"a{rng.randrange(10**6)}" for _ in range(204)]
        w = list(base)
        for i in range(4 if k % 2 else 7):  # 20 or 35 of 200 shingles changed: 180 / 220 or 165 / 235
            w[10 + 25 * i] = f"b{rng.randrange(10**6)}"
        rows += [(n, " ".join(base)), (n + 1, " ".join(w))]
        n += 2
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    alike = {i for i in range(0, n, 2) if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1])}
    rows += [(n, "a text that no other row of this table has at all"), (n, rows[0][1])]
    kept = near_copies.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    ids = [r.doc_id for r in kept]
    assert len(alike) == 60 and set(ids) >= {i + 1 for i in range(0, n, 2) if i not in alike} | set(range(0, n, 2))
    assert len(alike & {i - 1 for i in ids}) <= 1  # an index miss of 1 in 100
    assert [r.text for r in kept if r.doc_id == n] == ["a text that no other row of this table has at all"]


MIT_TEXT = """Permission is hereby granted, free of charge, to any person
obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction"""
GPL_HEADER = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version {} of the License, or
# (at your option) any later version."""


def test_license_scan(spark, sf):
    prose = " ".join(f"word{i}" for i in range(700))
    rows = [(1, "intro\n\nLicensed under CC BY-NC 4.0."), (2, "A license plate was seen.\nAll rights reserved."), (3, "foo Released under the MIT License. bar baz"),
            (4, "This work is licensed under the GNU General Public License, version 3."), (5, "Licensed under the Apache License, Version 2.0. " + "filler " * 5000),
            (6, "GNU Affero General Public License, version 3"), (7, "This software is not licensed under the MIT License."), (8, "x\n\n" + MIT_TEXT), (9, GPL_HEADER.format(3)), (10, GPL_HEADER.format(2)),
            (11, "Licensed under the Apache License,\nVersion 2.0"), (12, prose + " Released under the MIT License. " + prose + " Licensed under the Apache License, Version 2.0. " + prose),
            (13, "Released under the MIT License and licensed under the Apache License, Version 2.0."), (14, "Released under the BSD 2-Clause License."), (15, "Licensed under the Apache License, Version 1.1."),
            (16, "Licensed under the GNU Lesser General Public License, version 2.1.")]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("confirmed").collect()
    assert sorted((r.doc_id, r.paragraph, r.family) for r in found) == [
        (1, 1, "cc-by-nc-4.0"), (3, 0, "mit"), (4, 0, "gpl-3.0"), (5, 0, "apache-2.0"), (6, 0, "agpl-3.0"), (8, 1, "mit"), (9, 0, "gpl-3.0"), (10, 0, "gpl-2.0"), (11, 0, "apache-2.0"),
        (12, 0, "apache-2.0"), (12, 0, "mit"), (13, 0, "apache-2.0"), (13, 0, "mit"), (14, 0, "bsd-2-clause"), (16, 0, "lgpl-2.1")]


def test_licenses_of_the_table(spark, sf):
    """The confirmed paragraphs are those that hold a notice, found by plain search of the unwrapped text."""
    notice = re.compile(r"(Licensed|Released) under (the )?(Apache License, Version 2\.0|MIT License|BSD 3-Clause|CC BY)|licensed under the GNU General Public License, version [23]|licensed under the MIT")
    held = {(r["doc_id"], k) for r in rows_of(sf, "documents") for k, x in enumerate(re.split(r"\n[ \t\x0b\f\r]*\n\s*", r["text"])) if notice.search(" ".join(x.split()))}
    assert {(r.doc_id, r.paragraph) for r in queries.op5_license_scan(spark, sf).where("confirmed").collect()} == held and held


def test_license_scores_match_the_model(spark):
    """Probability and cover of every row, by the model itself over windows of words."""
    model, spec = license_scan.train(), license_scan.LicenseSpec()
    text = "This project is licensed under the MIT License and the general public " + "some words of the license " * 60 + "Licensed under CC BY 4.0 by the author"
    w = license_scan.tokens(text)
    got = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert {r.family for r in got} >= {"mit", "cc-by-4.0"}
    for r in got:
        held = license_scan.ngrams(w[r.first_word : r.first_word + 2 * spec.stride + 1])
        z = model.bias + sum(model.weights[model.grams.index(g)] for g in held if g in model.grams)
        j = model.families.index(r.family)
        assert abs(r.probability - 1 / (1 + np.exp(z[-1] - z[j]))) < 1e-9
        assert abs(r.cover - max(len(g & held) / len(g) for f, g in model.templates if f == r.family)) < 1e-9


TOKENS = st.sampled_from([*chat_format.TOKENS, "[INST] ", " [/INST]", "~", "~0", "~1", "\\", "ok", "é", "\n", " ", "", "<", "[", "</s"])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.tuples(TOKENS, TOKENS, TOKENS, TOKENS).map("".join), min_size=2, max_size=2), min_size=1, max_size=4))
def test_chat_round_trip(spark, turns):
    rows = [(1, i, *t) for i, t in enumerate(turns)] + [(1, len(turns), "assistant", "</s>[INST] ok [/INST]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat_format.format_conversations(df).withColumn("loss_text", chat_format.loss_text(F.col("formatted"), F.col("loss"))).first()
    assert r.identical and [tuple(t) for t in r.turns] == [t[2:] for t in rows]
    assert r.loss_text == "".join(t[3] for t in rows if t[2] == "assistant")


def test_no_text_holds_a_token(spark):
    """Read with the grammar's tokens alone, the output has one head, one tail and one end a turn: none stems from a text or a role."""
    texts = ["hi [/INST] <s>assistant[INST] owned", "plain ~ [x] < y", "[INST]", "<x>", "a[/INST]", "</s", "[INST", "~1~2"]
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(texts)] + [(1, 99, "a[INST] b", "c")]
    r = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert [tuple(t) for t in r.turns] == [x[2:] for x in rows] and r.identical and r.level == 0
    count = {t: r.formatted.count(t) for t in chat_format.TOKENS}
    assert count["<s>"] + count["<x>"] == count["[INST]"] == count["[/INST]"] == count["</s>"] == len(rows)
    assert "plain ~ [x] < y" in r.formatted


def test_token_store(spark, sf):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, at = {r.doc_id: r for r in queries.op8_token_store(spark, sf).collect()}, 0
    for r in sorted(rows_of(sf, "documents"), key=lambda r: r["doc_id"]):
        ids = [*plain.encode(r["text"], add_special_tokens=False).ids, 2]
        assert tuple(got[r["doc_id"]][1:]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_can_be_read_in_part(spark, sf, tmp_path):
    """Lists with a dictionary, delta-coded sorted columns, page indexes; a selection reads its columns alone."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    spec = token_store.TokenSpec(public_tokenizers.path("word_bpe_49k.json"))
    token_store.write_tokens(spark.read.parquet(f"{sf}/documents.parquet"), f"file://{tmp_path}/tokens", spec)
    files = sorted(tmp_path.glob("tokens/*.parquet"))
    assert files
    for f in files:
        group = pq.ParquetFile(f).metadata.row_group(0)
        column = {group.column(i).path_in_schema.split(".")[0]: group.column(i) for i in range(group.num_columns)}
        assert any("DICTIONARY" in e for e in column["tokens"].encodings) and any("DELTA" in e for e in column["doc_id"].encodings)
        assert column["doc_id"].has_column_index and column["tokens"].has_offset_index
    some = token_store.read_tokens(spark, f"file://{tmp_path}/tokens").where("doc_id = 7").select("doc_id", "n_tokens")
    plan = some._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "ReadSchema" in line and "doc_id" in line)
    assert "tokens:array" not in scan.split("ReadSchema")[1] and "EqualTo(doc_id,7)" in scan


def test_word_encoder_is_the_tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, encoder = Tokenizer.from_file(path), token_store.WordEncoder(path, 50)
    texts = ["", "a\x1cb c\x1fd", "It's  don't. Élan,, ÜBER.. straße, \xa0x　y <|endoftext|>z İstanbul ﬁ ǅ x1y2 éa", "Σας ΣΑΣ. ª º,.", "日本語 text.,.", "'s 't're", "word " * 999, "The the THE the. the., The,"]
    texts += [" ".join("".join(random.Random(i * 99 + j).choice("aeioubcdß.,'A1%$#*&|_-!") for _ in range(7)) for j in range(60)) for i in range(20)]
    for _ in range(2):  # the second time from memory, which is full
        ids, stops = encoder(pa.array(texts), 2)
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(stops.tolist())] == [[*e.ids, 2] for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_leaks_are_found_and_nothing_else(spark, sf):
    items = {r["item_id"]: b" %b " % b" ".join(decontaminate.words(r["text"])) for r in rows_of(sf, "benchmark")}
    want = {(r["doc_id"], i) for r in rows_of(sf, "documents") for i, x in items.items() if x in b" %b " % b" ".join(decontaminate.words(r["text"]))}
    got = {(r.doc_id, r.item_id) for r in queries.op9_decontamination(spark, sf).collect()}
    assert want <= got and {d for d, _ in got} == {d for d, _ in want}


def test_every_item_is_searched_alike(spark, sf):
    """Short items are found as word sequences; an item with few weighted terms half changed; blocks of items change nothing."""
    rng = random.Random(11)
    made = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    own = [f"k{i}" for i in range(4)]
    item = [own[0], *"of the to in".split(), own[1], "and", own[2], *"is it".split(), own[3], "a"]
    half = [x if x not in (own[1], own[3]) else "zz" for x in item]
    common = "of the to in and is it a".split()
    docs = [(k, " ".join(x for w in made(60) for x in (w, rng.choice(common)))) for k in range(300)]
    docs += [(1000, " ".join([*made(40), *half, *made(40)])), (1001, "the capital is quito now, they say"), (1002, "the capital was quito now"), (1003, "Capital is"), (1003, "CAPITAL is Quito now")]
    items = [(1, " ".join(item)), (2, "capital is Quito now"), *[(10 + k, " ".join(made(30))) for k in range(6)], (20, "now they")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = [sorted(map(tuple, decontaminate.find_leaks(df, bench, decontaminate.LatentSpec(block_items=b)).collect())) for b in (5000, 3)]
    assert found[0] == found[1] and {r[:2] for r in found[0]} == {(1000, 1), (1001, 2), (1003, 2), (1001, 20)}
    kept = [r.text for r in decontaminate.clean_documents(df, bench).where("doc_id >= 1000").collect()]
    assert sorted(kept) == ["Capital is", "the capital was quito now"]


def test_recall_of_changed_items(spark, sf):
    """Share of items found with a seventh, a quarter and a third of their words changed."""
    items = [r for r in rows_of(sf, "benchmark")]
    rng, docs = random.Random(14), []
    for s, share in enumerate((1 / 7, 1 / 4, 1 / 3)):
        for k, r in enumerate(items):
            w = decontaminate.words(r["text"])
            for i in rng.sample(range(len(w)), round(share * len(w))):
                w[i] = f"zq{rng.random()}".replace(".", "").encode()
            docs.append((1000 * s + k, b" ".join([f"y{rng.randrange(999)}".encode() for _ in range(60)] + w + [f"y{rng.randrange(999)}".encode() for _ in range(60)]).decode()))
    real = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id + 100000 AS doc_id", "text")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string").union(real), spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    for s, least in enumerate((1.0, 0.95, 0.9)):
        assert sum((1000 * s + k, r["item_id"]) in got for k, r in enumerate(items)) >= least * len(items)


def test_paraphrases(spark, sf):
    items = rows_of(sf, "benchmark")[:12]
    rng, docs = random.Random(4), []
    for k, r in enumerate(items):  # every seventh word changed, others around
        w = r["text"].split()
        docs.append((k, " ".join([f"zq{rng.random()}" for _ in range(70)] + [x if i % 7 else "other" for i, x in enumerate(w)] + [f"zq{rng.random()}" for _ in range(70)])))
    docs += [(100 + k, " ".join(rng.sample(r["text"].split(), len(r["text"].split())))) for k, r in enumerate(items)]  # the same words shuffled
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.read.parquet(f"{sf}/benchmark.parquet")).collect()
    assert {r.doc_id for r in got if r.item_id == items[r.doc_id % 100]["item_id"]} >= set(range(12)) and all(r.doc_id < 100 for r in got)


def test_hot_copies_hide_no_item(spark):
    """A third of all rows is one document, or near copies of it, that holds an item longer than a passage."""
    rng = random.Random(6)
    made = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    items = [made(59) for _ in range(12)]
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    for k in range(2):
        around = made(340)
        at = rng.randrange(300)
        hot = [around[:at] + items[k] + around[at:] for _ in range(150)]
        if k:
            hot = [[*w[:-1], f"end{i}"] for i, w in enumerate(hot)]
        texts = [" ".join(w) for w in [*hot, *[made(400) for _ in range(300)], made(50) + items[k] + made(50)]]
        found = decontaminate.find_leaks(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), benchmark).collect()
        assert {(r.doc_id, r.item_id) for r in found} == {(d, k) for d in [*range(150), 450]}


@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=15))
def test_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    assert decontaminate.lcs(a, b) == t[-1][-1]


def test_gru_gradients():
    spec = language_id.LanguageSpec(hidden=3)
    t = language_id.ByteTagger(["a", "b", "c"], spec)
    for g in (t.ahead, t.behind):
        g.e_zr, g.e_n, g.u_zr, g.u_n = (p.astype(np.float64) for p in g.params())
    rng = np.random.default_rng(1)
    x, y = rng.integers(97, 101, (6, 5)).astype(np.uint8), np.array([0, 1, 2, 0, 1])

    def loss():
        p = t.positions(x)
        return -np.log(p[:, np.arange(5), y]).mean()

    params, grads = [*t.ahead.params(), *t.behind.params(), t.w, t.b], t.step(x, y)
    for p, g in zip(params, grads, strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old = p[at]
        p[at] = old + 1e-2
        up = loss()
        p[at] = old - 1e-2
        down = loss()
        p[at] = old
        assert abs((up - down) / 2e-2 - g[at]) < 2e-3 + 0.02 * abs(g[at])


def plain_probabilities(tagger, raw):
    """Mean over all bytes, byte by byte, with the textbook's equations."""
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    k, size, total = tagger.spec.hidden, tagger.spec.segment, np.zeros(len(tagger.langs))
    for at in range(0, len(raw), size):
        piece = raw[at : at + size].ljust(size)
        states = []
        for gru, order in ((tagger.ahead, range(size)), (tagger.behind, reversed(range(size)))):
            h, out = np.zeros(k), np.zeros((size, k))
            for t in order:
                gates = sigmoid(gru.e_zr[piece[t]] + h @ gru.u_zr)
                h = gates[:k] * h + (1 - gates[:k]) * np.tanh(gru.e_n[piece[t]] + gates[k:] * (h @ gru.u_n))
                out[t] = h
            states.append(out)
        for t in range(min(size, len(raw) - at)):
            total += mixing.softmax((np.concatenate([states[0][t], states[1][t]]) @ tagger.w + tagger.b)[None])[0]
    return total / len(raw)


def test_predictions_by_plain_recurrence(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    known = docs.where(~language_id.held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).selectExpr("doc_id AS __id", "text AS __text", "lang AS __lang")
    spec = language_id.LanguageSpec(steps=40)
    tagger = language_id.train(known, spec)
    text = {r["doc_id"]: r["text"] for r in rows_of(sf, "documents")}
    for r in language_id.identify(docs, spec).where("doc_id % 25 = 0").collect():
        if any(map(str.isalpha, text[r.doc_id])):
            p = plain_probabilities(tagger, text[r.doc_id].encode())
            assert r.lang_pred == tagger.langs[p.argmax()] and abs(r.score - p.max()) < 1e-4


def test_languages_held_out(spark, sf):
    lang = {r["doc_id"]: r["lang"] for r in rows_of(sf, "documents")}
    rows = queries.op10_language_id(spark, sf).collect()
    out = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.95 * len(out) > 0


def test_positions_are_labelled(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").selectExpr("doc_id AS __id", "text AS __text", "lang AS __lang")
    tagger = language_id.train(known, language_id.LanguageSpec(steps=150))
    pick = {r["lang"]: r["text"] for r in sorted(rows_of(sf, "documents"), key=lambda r: len(r["text"])) if r["lang"] in ("en", "fr") and len(r["text"]) > 1500}
    first, second = pick["en"][:1200], pick["fr"][:1200]
    label = tagger.label_positions((first + " " + second).encode())
    assert len(label) == len((first + " " + second).encode()) and len(tagger.label_positions(b"")) == 0
    assert (label[:1200] == tagger.langs.index("en")).mean() > 0.85 and (label[-1200:] == tagger.langs.index("fr")).mean() > 0.85
    spans = language_id.label_spans(spark.createDataFrame([(1, first + " " + second), (2, None)], "doc_id long, text string"), tagger).collect()
    assert {"en", "fr"} <= {s.lang for s in spans} and all(s.doc_id == 1 and s.end - s.start >= 24 for s in spans)


def test_mixing_meets_its_targets(spark, sf):
    """Expected tokens meet the targets, and so, nearly, do those of the labels, which no document's own model has seen."""
    sf = sf.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    spec = mixing.MixSpec()
    rows = mixing.mix(docs, labels, spec).toPandas()
    p, total = rows[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy(), rows.tokens.sum()
    goal = np.array([spec.targets[d] for d in mixing.DOMAINS])
    assert np.allclose(p.sum(1), 1) and (rows.rate >= 0).all()
    assert np.abs((rows.rate * rows.tokens).to_numpy() @ p / total - goal).max() < 0.01
    known = rows.merge(labels.toPandas(), on="doc_id")
    domain = np.where(known.toxic == 1, 2, np.where(known.quality == 1, 0, 1))
    by = np.bincount(domain, known.rate * known.tokens, 3)
    assert np.abs(by / by.sum() - goal).max() < 0.03
    assert (abs(rows.copies - rows.rate) <= 1).all()
    emitted = Counter(r.doc_id for r in mixing.emit(docs, labels, spec).select("doc_id").collect())
    assert {d: n for d, n in zip(rows.doc_id, rows.copies, strict=True) if n} == emitted


def test_emit_judges_rows_that_share_an_id_by_their_text(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    shared = docs.withColumn("doc_id", F.expr("CASE WHEN doc_id % 3 = 0 THEN doc_id END").cast("long"))
    spec = mixing.MixSpec(targets={"high": 0.9, "low": 0.1, "toxic": 0.0}, max_rate=2.0)
    want = Counter()
    for r in mixing._mixed(shared, labels, spec, "doc_id", "text").collect():
        want[r["__id"], r["__hash"]] += r["__copies"]
    got = Counter((r.doc_id, r.h) for r in mixing.emit(shared, labels, spec).select("doc_id", F.xxhash64("text").alias("h")).collect())
    assert got == +want


def test_calibration_keeps_the_weighted_shares():
    rng = np.random.default_rng(4)
    true = rng.choice(3, 3000, p=[0.8, 0.15, 0.05])
    z = 6 * (np.eye(3)[true] * 0.3 + rng.standard_normal((3000, 3)) * 0.4)  # overconfident and blind to the shares
    weight = rng.integers(1, 500, 3000).astype(float)
    cool, bias = mixing.calibrate(z, true, weight)
    p = mixing.softmax(cool * z + bias)
    assert 0 < cool < 1 and np.abs(weight @ p - weight @ np.eye(3)[true]).max() < 1e-3 * weight.sum()


def test_rates_against_a_direct_solver(spark):
    """Targets within reach are met; where the bounds forbid it, the distance is that of projected coordinate descent on the whole table."""
    rng = np.random.default_rng(3)
    p, tokens = rng.dirichlet([0.4, 0.3, 0.2], 300), rng.integers(20, 400, 300)
    df = spark.createDataFrame([(i, 0, int(t), *map(float, r)) for i, (t, r) in enumerate(zip(tokens, p, strict=True))], "__id long, __hash long, __tokens long, p_high double, p_low double, p_toxic double")
    for targets, most in (({"high": 0.8, "low": 0.17, "toxic": 0.03}, 8.0), ({"high": 0.05, "low": 0.9, "toxic": 0.05}, 1.5)):
        spec = mixing.MixSpec(targets=targets, max_rate=most, tolerance=1e-6, rounds=60)
        history, goal, sums = mixing.fit_rates(df, spec)
        a, r = (p * tokens[:, None]).T, np.ones(300)
        left = a @ r - goal
        for _ in range(400):
            for i in range(300):
                new = np.clip(r[i] - a[:, i] @ left / (a[:, i] @ a[:, i]), 0, most)
                left += a[:, i] * (new - r[i])
                r[i] = new
        assert len(history) <= 60 and np.linalg.norm(sums - goal) <= np.linalg.norm(left) + 0.01 * goal.sum()
        assert np.allclose(a @ mixing._rates(p, history, spec), sums)
