"""Near copies at a similarity of 0.8 over five-word shingles, by wide SimHash signatures.

A 64-bit fingerprint can't find such copies: at a Jaccard similarity of 0.8 about 15 % of
its bits differ, ten of 64, and an index for ten differing bits prunes nothing. So the
signature is wider and holds many codes of ``code_bits`` + 1 parts each. Two texts are
candidates if some code differs by at most ``code_bits`` bits, and the last ``check_words``
words of their signatures by no more than ``spread`` standard deviations over what a pair at
``min_similarity`` differs by. The number of codes follows from
``min_recall``, the share of pairs at ``min_similarity`` that are to meet in some code; the
number of bits of a part from the number of rows, so that groups stay small. Candidates are linked
only where the exact Jaccard similarity of their shingles is ``min_similarity``.

By the pigeonhole principle two such codes agree on one of their parts. Codes are dealt by table,
part and value; each such group is searched with the Gray-order index of ``simhash`` and returns a
spanning forest of its nearest candidates, never all pairs. Groups of more than ``group_rows`` are
cut in slices, and every two slices are a task, so that no task grows with the input. The first
``first_tables`` tables are searched and confirmed first; pairs inside a class found so far are
then left out. Where a similarity refutes a tree's edge, the tree's texts are compared once more, class
with class: shingles go along, whole signatures choose the pairs, and only confirmed links come
out, as few as join the classes. So no link hangs on a refuted one. Such trees are cut in slices
too. Texts of equal shingles
are one node from the start, so that copies cost nothing there.

Defined cases: as in ``simhash``; texts of fewer than ``shingle`` words have one shingle,
the whole text, and texts without words are copies of each other. Any column may be null or have
any name; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import BROADCAST_IDS, discard, fresh, materialise, without_texts
from .components import connected_components
from .simhash import GrayIndex, gray_rank, union_classes


@dataclass(frozen=True)
class NearCopySpec:
    """``group_rows``, ``tree_rows`` and ``values_per_task`` bound a task and change no result; ``part_bits``: None, from the rows."""

    shingle: int = 5
    min_similarity: float = 0.8
    min_recall: float = 0.99
    code_bits: int = 2
    part_bits: int | None = None
    first_tables: int = 3
    check_words: int = 4
    spread: float = 3.0
    group_rows: int = 100_000
    tree_rows: int = 1_000
    values_per_task: int = 16
    codes_per_task: int = 10_000


@dataclass(frozen=True)
class Layout:
    """Codes of a signature: ``tables`` codes of ``parts`` parts of ``bits`` bits, one behind the other, in ``words`` words."""

    parts: int
    bits: int
    tables: int
    words: int


def differing(spec: NearCopySpec) -> float:
    """Share of the bits in which two signatures at ``min_similarity`` differ, for sets of one size."""
    return math.acos(2 * spec.min_similarity / (1 + spec.min_similarity)) / math.pi


def most_bits(bits: int, spec: NearCopySpec) -> int:
    """Bits of so many in which a candidate may differ."""
    share = differing(spec)
    return math.floor(share * bits + spec.spread * math.sqrt(share * (1 - share) * bits))


def layout(rows: int, spec: NearCopySpec) -> Layout:
    """Parts are wide enough for at most 65,536 rows a value on average, and 8 bits at least."""
    parts = spec.code_bits + 1
    bits = spec.part_bits or max(8, math.ceil(math.log2(max(rows, 1) / 65_536)))
    differ, n = differing(spec), parts * bits
    meet = sum(math.comb(n, k) * differ**k * (1 - differ) ** (n - k) for k in range(spec.code_bits + 1))
    tables = math.ceil(math.log(1 - spec.min_recall) / math.log(1 - meet))
    return Layout(parts, bits, tables, max(8, -(-tables * n // 64)))


def shingle_hashes(text: str | None, spec: NearCopySpec) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n, k = len(words), spec.shingle
    if not n:
        return np.empty(0, np.uint64)
    whole = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(length + 1) - 1
    pieces = {whole[a:b] for a, b in zip((ends - length).tolist(), ends[k - 1 :].tolist())} if n >= k else {whole}  # noqa: B905
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(p, 42) for p in pieces), np.uint64, len(pieces)))


def signature(hashes: np.ndarray, words: int) -> np.ndarray:
    """Words of 64 bits; each bit is the majority of that bit over the distinct shingles' hashes."""
    out = np.zeros(words, np.uint64)
    for j in range(words if len(hashes) else 0):
        mixed = hashes * np.uint64(0x9E3779B97F4A7C15 + 2 * j)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        ones = np.zeros(64, np.int64)
        for at in range(0, len(mixed), 1 << 15):
            part = mixed[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
            ones += np.add.reduce(np.unpackbits(part, axis=1, bitorder="little"), axis=0, dtype=np.int32)
        out[j] = np.packbits(2 * ones > len(mixed), bitorder="little").view(np.uint64)[0]
    return out


def _tree(parent: np.ndarray, q: np.ndarray, p: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(new parent, q, p): the pairs that join classes, nearest first (Boruvka's rounds)."""
    order = np.argsort(far, kind="stable")
    q, p, kept = q[order], p[order], []
    while True:
        apart = parent[q] != parent[p]
        q, p = q[apart], p[apart]
        if not len(q):
            break
        first = np.full(len(parent), len(q))
        for side in (q, p):
            np.minimum.at(first, parent[side], np.arange(len(q)))
        pick = np.unique(first[first < len(q)])
        kept.append((q[pick], p[pick]))
        parent = union_classes(parent, q[pick], p[pick])
    return parent, np.concatenate([q, *[k[0] for k in kept]]), np.concatenate([p, *[k[1] for k in kept]])


def _group_pairs(codes: np.ndarray, checks: np.ndarray, nodes: np.ndarray, labels: np.ndarray, spec: NearCopySpec, leaf: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of nodes of two classes (labels) inside one group: a spanning forest."""
    codes, most = codes.astype(np.uint64), most_bits(64 * checks.shape[1], spec)
    _, first, at = np.unique(labels, return_index=True, return_inverse=True)
    parent, left, right = first[at], [nodes[:0]], [nodes[:0]]
    members = np.argsort(gray_rank(codes), kind="stable")
    kept, cuts = codes[members], np.arange(0, len(codes), leaf)
    low, high = np.bitwise_and.reduceat(kept, cuts), np.bitwise_or.reduceat(kept, cuts)
    mask = ~(low ^ high)
    width = np.minimum(leaf, len(kept) - cuts)
    for who, group in GrayIndex(mask, low & mask).search(codes, spec.code_bits):
        label = parent[members]
        first, last = np.minimum.reduceat(label, cuts), np.maximum.reduceat(label, cuts)
        new = ~((first[group] == last[group]) & (first[group] == parent[who]))
        who, group = who[new], group[new]
        for at in range(0, len(who), 1 << 14):
            w, g = who[at : at + (1 << 14)], group[at : at + (1 << 14)]
            q = np.repeat(w, width[g])
            place = np.arange(len(q)) - np.repeat(np.cumsum(width[g]) - width[g], width[g]) + np.repeat(cuts[g], width[g])
            p = members[place]
            near = (q < p) & (np.bitwise_count(codes[q] ^ codes[p]) <= spec.code_bits)
            q, p = q[near], p[near]
            far = np.bitwise_count(checks[q] ^ checks[p]).sum(axis=1, dtype=np.int64)
            near = (far <= most) & (parent[q] != parent[p])
            q, p, far = q[near], p[near], far[near]
            parent, q, p = _tree(parent, q, p, far)
            left.append(nodes[q])
            right.append(nodes[p])
    u, v = np.concatenate(left), np.concatenate(right)
    return np.maximum(u, v), np.minimum(u, v)


def _alike(x: np.ndarray, y: np.ndarray, spec: NearCopySpec) -> bool:
    """If the exact Jaccard similarity of two sorted sets is ``min_similarity``."""
    least, most = sorted((len(x), len(y)))
    if least < spec.min_similarity * most - 1e-9:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= spec.min_similarity * (least + most - both) - 1e-9


def _shingles(asked: DataFrame, nodes: DataFrame, docs: DataFrame, spec: NearCopySpec, id_col: str, text_col: str) -> DataFrame:
    """__node and __set, the shingles of its text, for the nodes ``asked`` for."""

    @F.pandas_udf("binary")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_hashes(t, spec).tobytes() for t in texts])

    asked = materialise(nodes.join(asked, "__node").select("__node", F.col("__id").alias("__of"), F.col("__text_hash").alias("__of_hash")), "asked")
    few = F.broadcast(asked) if asked.count() <= BROADCAST_IDS else asked
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__of"), text.alias("__text"), F.xxhash64(text).alias("__of_hash")).join(few, ["__of", "__of_hash"])
    held = materialise(rows.select("__node", hashed("__text").alias("__set")), "shingles")
    once = materialise(held.dropDuplicates(["__node"]), "shingles")
    discard(asked, held)
    return once


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, spec: NearCopySpec, id_col: str, text_col: str) -> DataFrame:
    """The pairs (u, v) whose exact similarity is ``min_similarity``."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_alike(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), spec) for x, y in zip(a, b, strict=True)], dtype=bool)

    sets = _shingles(pairs.select(F.col("u").alias("__node")).union(pairs.select("v")).distinct(), nodes, docs, spec, id_col, text_col)
    one = materialise(pairs.join(sets.select(F.col("__node").alias("u"), F.col("__set").alias("__a")), "u"), "sides")
    both = one.join(sets.select(F.col("__node").alias("v"), F.col("__set").alias("__b")), "v")
    links = materialise(both.select("u", "v", alike("__a", "__b").alias("__same")).where("__same").select("u", "v"), "links")
    discard(sets, one)
    return links


def _between_classes(x: pd.DataFrame, spec: NearCopySpec) -> pd.DataFrame:
    """Links that join the classes (__label) of some nodes, nearest signatures first; each is confirmed."""
    sig = np.stack([np.asarray(v, np.int64).view(np.uint64) for v in x["__sig"]])
    sets, node = [np.frombuffer(v, "<u8") for v in x["__set"]], x["__node"].to_numpy(np.int64)
    _, first, at = np.unique(x["__label"].to_numpy(np.int64), return_index=True, return_inverse=True)
    parent, most, near = first[at].tolist(), most_bits(64 * sig.shape[1], spec), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    label = first[at]
    for i in range(len(sig) - 1):
        far = np.bitwise_count(sig[i + 1 :] ^ sig[i]).sum(axis=1, dtype=np.int64)
        hit = np.flatnonzero((far <= most) & (label[i + 1 :] != label[i]))
        near.append(np.stack([far[hit], np.full(len(hit), i), i + 1 + hit]))
    near, out = np.concatenate([np.zeros((3, 0), np.int64), *near], axis=1), []
    for i, j in near[1:, np.argsort(near[0], kind="stable")].T.tolist():
        a, b = root(i), root(j)
        if a != b and _alike(sets[i], sets[j], spec):
            parent[a] = b
            out.append((max(node[i], node[j]), min(node[i], node[j])))
    return pd.DataFrame(np.array(out, np.int64).reshape(-1, 2), columns=["u", "v"])


def _searched_again(trees: DataFrame, nodes: DataFrame, docs: DataFrame, spec: NearCopySpec, id_col: str, text_col: str) -> DataFrame:
    """Links between the classes of each tree; trees: __tree, __sig, __node and __label."""
    sets = _shingles(trees.select("__node"), nodes, docs, spec, id_col, text_col)
    slices = materialise(trees.groupBy("__tree").agg(F.ceil(2 * F.count("*") / spec.tree_rows).cast("int").alias("__slices")), "slices")
    rows = materialise(trees.join(sets, "__node"), "trees").join(slices, "__tree").withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__slices") - 1)))
    own = F.pmod(F.xxhash64("__node"), F.col("__slices"))
    task = F.xxhash64("__tree", F.least(own, "__other"), F.greatest(own, "__other"))
    rows = rows.select(task.alias("__task"), "__sig", "__set", "__node", "__label")
    return rows.groupBy("__task").applyInPandas(lambda x: _between_classes(x, spec), "u long, v long").distinct()


def _deal(nodes: DataFrame, tables: range, form: Layout, spec: NearCopySpec) -> DataFrame:
    """__task, __key, __code, c<j>, __node and __label, a row for each part of each code; hot keys in slices."""
    sig, n = F.col("__sig"), form.bits

    def part(at: int) -> Column:
        word, low = divmod(at * n, 64)
        value = F.shiftrightunsigned(F.get(sig, F.lit(word)), low)
        if low + n > 64:
            value = value.bitwiseOR(F.shiftleft(F.get(sig, F.lit(word + 1)), 64 - low))
        return value.bitwiseAND(F.lit((1 << n) - 1))

    def code(t: int) -> Column:
        return reduce(lambda a, p: a.bitwiseOR(F.shiftleft(part(t * form.parts + p), p * n)), range(1, form.parts), part(t * form.parts))

    dealt = [F.struct((F.lit((t * form.parts + p) << n) + part(t * form.parts + p)).alias("k"), code(t).alias("c")) for t in tables for p in range(form.parts)]
    checks = [F.get(sig, F.lit(form.words - 1 - j)).alias(f"c{j}") for j in range(spec.check_words)]
    rows = nodes.select("__node", "__label", *checks, F.explode(F.array(*dealt)).alias("__d"))
    rows = rows.select(F.col("__d.k").alias("__key"), F.col("__d.c").alias("__code"), *[f"c{j}" for j in range(spec.check_words)], "__node", "__label")
    # Byte values searched by one task: fewer where there are more signatures. It changes no result.
    per = max(1, min(spec.values_per_task, (spec.codes_per_task << n) // max(1, nodes.count())))
    rows = rows.withColumn("__task", F.shiftleft(F.floor(F.col("__key") / per).cast("long"), 24))
    hot = rows.groupBy("__key").count().where(F.col("count") > spec.group_rows)
    hot = materialise(hot.select("__key", F.ceil(2 * F.col("count") / spec.group_rows).cast("int").alias("__slices")), "hot")
    if hot.isEmpty():
        return rows
    rows = rows.join(hot, "__key", "left")
    own, other = F.pmod(F.xxhash64("__node"), F.col("__slices")), F.col("__other")
    pair = F.least(own, other) * F.col("__slices") + F.greatest(own, other)
    sliced = rows.where("__slices IS NOT NULL").withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__slices") - 1)))
    sliced = sliced.withColumn("__task", F.xxhash64("__key", pair)).drop("__other", "__slices")
    return rows.where("__slices IS NULL").drop("__slices").unionByName(sliced)


def _candidates(nodes: DataFrame, tables: range, form: Layout, spec: NearCopySpec) -> DataFrame:
    """Candidate pairs (u, v), u > v, of nodes with different labels: a forest of each group."""
    checks = [f"c{j}" for j in range(spec.check_words)]

    def search(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("__key", kind="stable")
        code, node, label = (x[c].to_numpy(np.int64) for c in ("__code", "__node", "__label"))
        check = np.stack([x[c].to_numpy(np.int64).view(np.uint64) for c in checks], axis=1)
        cuts = np.flatnonzero(np.diff(x["__key"].to_numpy(), prepend=-1))
        found = [_group_pairs(code[a:b], check[a:b], node[a:b], label[a:b], spec) for a, b in zip(cuts, [*cuts[1:], len(x)], strict=True) if b - a > 1]
        return pd.DataFrame({"u": np.concatenate([f[0] for f in found] or [node[:0]]), "v": np.concatenate([f[1] for f in found] or [node[:0]])})

    return _deal(nodes, tables, form, spec).groupBy("__task").applyInPandas(search, "u long, v long").distinct()


def copy_groups(docs: DataFrame, spec: NearCopySpec = NearCopySpec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__id, __text_hash, __group and __group_hash (the least id of the row's group and its text's hash), a row for each row of ``docs`` with an id."""
    form = layout(docs.count(), spec)

    @F.pandas_udf("struct<sig: array<long>, whole: binary>")
    def sign(texts: pd.Series) -> pd.DataFrame:
        known: dict = {}
        for t in texts:
            if t not in known:
                h = shingle_hashes(t, spec)
                known[t] = (signature(h, form.words).view(np.int64), xxhash.xxh3_128_digest(h.tobytes()))
        return pd.DataFrame({"sig": [known[t][0] for t in texts], "whole": [known[t][1] for t in texts]})

    text = F.coalesce(F.col(text_col), F.lit(""))
    signed = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__text_hash"), sign(text).alias("__s")).where("__id IS NOT NULL")
    signed = materialise(signed.select("__id", "__text_hash", F.col("__s.sig").alias("__sig"), F.col("__s.whole").alias("__whole")), "signatures")
    least = F.min(F.struct("__id", "__text_hash")).alias("__least")
    nodes = signed.groupBy("__whole").agg(least, F.any_value("__sig").alias("__sig")).select("__whole", F.xxhash64("__whole").alias("__node"), "__sig", "__least.*")
    nodes = materialise(nodes, "nodes")

    # Classes so far as stars (u, v), v the least node: further links are added to them, so that few rounds are left.
    def labelled(stars: DataFrame | None) -> DataFrame:
        if stars is None:
            return nodes.withColumn("__label", F.col("__node"))
        own = stars.select(F.col("u").alias("__node"), F.col("v").alias("__label"))
        return nodes.join(own, "__node", "left").withColumn("__label", F.coalesce("__label", "__node"))

    stars = tried = refuted = None
    for tables in (range(spec.first_tables), range(spec.first_tables, form.tables)):
        pairs = _candidates(labelled(stars) if stars is None else materialise(labelled(stars), "labels"), tables, form, spec)
        pairs = materialise(pairs if tried is None else pairs.join(tried, ["u", "v"], "left_anti"), "pairs")
        found = _confirmed(pairs, nodes, docs, spec, id_col, text_col)
        lost = pairs.join(found, ["u", "v"], "left_anti")
        stars = connected_components(found if stars is None else stars.union(found))
        tried, refuted = (pairs, lost) if tried is None else (tried, refuted.union(lost))
    refuted = materialise(refuted, "refuted")
    if not refuted.isEmpty():  # class with class, in the trees that lost an edge
        tree = connected_components(stars.union(refuted)).select(F.col("u").alias("__node"), F.col("v").alias("__tree"))
        trees = materialise(labelled(stars).join(tree, "__node", "left").withColumn("__tree", F.coalesce("__tree", "__node")), "trees")
        broken = trees.join(refuted.select(F.col("u").alias("__node")).distinct(), "__node").select("__tree").distinct()
        again = materialise(trees.join(broken, "__tree", "left_semi").select("__tree", "__sig", "__node", "__label"), "again")
        more = materialise(_searched_again(again, nodes, docs, spec, id_col, text_col), "more")
        stars = stars if more.isEmpty() else connected_components(stars.union(more))
    named = materialise(labelled(stars).drop("__sig"), "classes")
    heads = named.groupBy("__label").agg(least).select("__label", F.col("__least.__id").alias("__group"), F.col("__least.__text_hash").alias("__group_hash"))
    groups = materialise(named.join(materialise(heads, "heads"), "__label").select("__whole", "__group", "__group_hash"), "named")
    return signed.drop("__sig").join(groups, "__whole").select("__id", "__text_hash", "__group", "__group_hash")


def deduplicate(docs: DataFrame, spec: NearCopySpec = NearCopySpec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of copies, that of the least id, with all columns; rows without an id stay.

    Of rows that share an id and a text, one stays; rows that share an id alone are rows of their own.
    """
    groups = materialise(copy_groups(docs, spec, id_col, text_col), "groups")
    head = (F.col("__id") == F.col("__group")) & (F.col("__text_hash") == F.col("__group_hash"))
    kept = without_texts(docs, groups.where(~head).select("__id", "__text_hash"), id_col, text_col)
    if groups.where(head).groupBy("__id", "__text_hash").count().where("count > 1").isEmpty():
        return kept
    (own,) = fresh(docs, "hash")
    kept = kept.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return kept.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, own]).unionByName(kept.where(F.col(id_col).isNull())).drop(own)
