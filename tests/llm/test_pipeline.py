"""The pipeline: stage by stage on the small tables, and the queries' registration."""

import re
from collections import Counter

import pyarrow.parquet as pq

import corpus_pipeline
from rasterloom.llm import decontaminate, queries


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def test_stages(spark, sf, tmp_path):
    docs, before = spark.read.parquet(f"{sf}/documents.parquet"), None
    columns = docs.columns
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns, name
        out.write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert before is None or set(ids) <= before and ids
        before = set(ids)
        kept.append(before)
    text = {r["doc_id"]: r["text"] for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}

    def good(t):
        w = words(t)
        x = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        n = Counter(x)
        return len(w) >= 10 and 100 * len({i + j for i, y in enumerate(x) if n[y] > 1 for j in range(5)}) <= 20 * len(w)

    assert kept[0] == {d for d, t in text.items() if good(t)}  # no host of these tables is rejected

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = {d: shingles(text[d]) for d in kept[0]}
    near = lambda a, b: 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    least = {d: d for d in kept[0]}
    pairs = [(a, b) for a in kept[0] for b in kept[0] if a < b and near(a, b)]
    for _ in least:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    assert kept[1] == set(least.values())
    items = [b" %b " % b" ".join(decontaminate.words(r["text"])) for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    assert kept[1] - kept[2] == {d for d in kept[1] if any(x in b" %b " % b" ".join(decontaminate.words(text[d])) for x in items)}
    assert len(kept[3]) >= 0.7 * len(kept[2]) and kept[4] == kept[3]


def test_near_dedup_by_brute_force(spark, sf):
    """Over 1,000 documents: what stays are the least ids of the classes of similarity 0.8, found through all shared shingles."""
    sf = sf.replace("sf0.001", "sf0.01")
    text = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    sets = {}
    for d, t in text.items():
        w = t.lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    shared = Counter((a, b) for ds in holders.values() for i, a in enumerate(ds) for b in ds[i + 1 :])
    least = {d: d for d in text}
    links = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9]
    while any(least[a] != least[b] for a, b in links):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).collect()}
    want = set(least.values())
    assert not want - kept and len(kept - want) <= 0.02 * len(links)  # none too many gone; an index miss of 1 in 100


def test_run_on_odd_tables(spark, sf, tmp_path):
    """Null ids and texts, repeated rows, ids with several texts, clashing columns; and an empty table."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs.where("doc_id % 10 = 1")
    odd = odd.unionByName(odd).unionByName(docs.where("doc_id % 10 = 2").selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars"))
    odd = odd.unionByName(docs.where("doc_id % 10 = 3").selectExpr("CAST(11 AS BIGINT) AS doc_id", "text", "lang", "CAST(NULL AS STRING) AS source", "n_chars"))
    odd = odd.unionByName(docs.where("doc_id = 21").selectExpr("doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars")).selectExpr("*", "1 AS copies", "2 AS __gone", "3 AS kept")
    for name, df in (("odd", odd), ("none", odd.limit(0))):
        folder = f"file://{tmp_path}/{name}"
        df.write.parquet(f"{folder}/documents.parquet")
        for t in ("labels", "benchmark"):
            spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
        rows = corpus_pipeline.run(spark, folder).collect()
        if name == "none":
            assert rows == []
            continue
        slots = {}
        for r in rows:
            slots.setdefault(r.shard, []).append(r.slot)
        assert rows and all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert {r.doc_id for r in rows} <= {None, *(r.doc_id for r in odd.collect())} and any(r.doc_id is None for r in rows)


def test_registered(spark):
    import __spark_entry__ as e

    names = e.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(e.oracle_sql()) <= set(names) and set(queries.QUERIES) <= set(names)
