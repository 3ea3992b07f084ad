"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are sorted by Gray rank, so that neighbours share long bit patterns. Runs of
neighbours are the index's groups: the bits on which all members agree are factored out
into the group's node (a mask and a pattern), and nodes are grouped again, level by level.
A search for codes within d bits walks down with the differences accumulated so far, each
node adding only the bits its parent had not fixed, and leaves a whole group as soon as
the sum passes d.

Distributed: the distinct fingerprints are cut at quantiles of the Gray rank into parts of
bounded size; the parts' masks and patterns are the uppermost nodes (one row a part on the
driver). Each fingerprint goes to its own part and, for each pair of parts in one direction,
to the parts it may have links with. Each part is searched with its own index; it returns a
spanning forest of the links, never all pairs, and the forests are joined by distributed
connected components. Equal fingerprints are one node from the start.

Defined cases: null and blank texts have fingerprint zero and link like any other; repeated
ids are repeated rows of one component; rows with a null id take part through their
fingerprint but can't name a component; an empty table gives an empty result. Other columns
aren't read, and whole texts are hashed whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialise
from .components import connected_components


@dataclass(frozen=True)
class SimHash:
    """``shingle`` words, links at ``max_bits`` or fewer; parts of about ``part_codes`` codes, ``min_parts`` at least."""

    shingle: int = 3
    max_bits: int = 2
    part_codes: int = 50_000
    min_parts: int = 64


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if it is set in over half the shingles' XXH64 (seed 42)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z alone, and ASCII white space
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) < shingle:
        pieces = [whole]
    else:
        length = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(length + 1) - 1
        pieces = [whole[a:b] for a, b in zip((ends - length).tolist(), ends[shingle - 1 :].tolist())]  # noqa: B905
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, 42) for p in pieces], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.add.reduce(np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, spec: SimHash, id_col: str, text_col: str) -> DataFrame:
    """__id and __code, the fingerprint as a signed long."""
    k = spec.shingle

    @F.pandas_udf("long")
    def code(texts: pd.Series) -> pd.Series:
        known: dict = {}
        out = np.empty(len(texts), np.uint64)
        for i, t in enumerate(texts):
            if t not in known:
                known[t] = fingerprint(t, k)
            out[i] = known[t]
        return pd.Series(out.view(np.int64))

    return docs.select(F.col(id_col).alias("__id"), code(F.coalesce(F.col(text_col), F.lit(""))).alias("__code"))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray order, as signed longs of the same order."""
    r = codes.astype(np.uint64)
    for s in (1, 2, 4, 8, 16, 32):
        r = r ^ (r >> np.uint64(s))
    return (r ^ np.uint64(1 << 63)).view(np.int64)


class GrayIndex:
    """Hierarchy over nodes that are sorted by Gray rank; the lowest level has a mask and a pattern each."""

    def __init__(self, masks: np.ndarray, patterns: np.ndarray, fan: int = 8):
        self.levels = [(masks, patterns)]
        self.fan = fan
        while len(self.levels[-1][0]) > fan:
            m, p = self.levels[-1]
            cuts = np.arange(0, len(m), fan)
            low, high = np.bitwise_and.reduceat(p | ~m, cuts), np.bitwise_or.reduceat(p & m, cuts)
            mask = np.bitwise_and.reduceat(m, cuts) & ~(low ^ high)
            self.levels.append((mask, high & mask))

    def search(self, codes: np.ndarray, d: int, held: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place in codes, lowest node) that may be within d, for block after block of codes.

        Blocks are so small that even where no group can be left, about ``held`` pairs are held at once.
        """
        block = max(64, min(4096, held // max(1, len(self.levels[0][0]))))
        for at in range(0, len(codes), block):
            own = codes[at : at + block]
            m, p = self.levels[-1]
            who = np.repeat(np.arange(len(own)), len(m))
            node = np.tile(np.arange(len(m)), len(own))
            seen = np.zeros(len(who), np.uint64)
            far = np.zeros(len(who), np.uint8)
            for level in range(len(self.levels) - 1, -1, -1):
                m, p = self.levels[level]
                far = far + np.bitwise_count((own[who] ^ p[node]) & (m[node] & ~seen))
                near = far <= d
                who, node, far = who[near], node[near], far[near]
                if level:
                    seen = np.repeat(m[node], self.fan)
                    below = len(self.levels[level - 1][0])
                    who, far = np.repeat(who, self.fan), np.repeat(far, self.fan)
                    node = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
                    there = node < below
                    who, node, far, seen = who[there], node[there], far[there], seen[there]
            yield at + who, node


def union_classes(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the classes of a and b; parent holds each place's least member of its class."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent = up


def local_forest(codes: np.ndarray, nodes: np.ndarray, own: np.ndarray, d: int, leaf: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, least node of its class) from the links of all codes with the part's own codes."""
    order = np.argsort(nodes, kind="stable")  # places by node id: a class's least place is its least node
    codes, nodes, own = codes[order].astype(np.uint64), nodes[order], own[order]
    members = np.flatnonzero(own)
    members = members[np.argsort(gray_rank(codes[members]), kind="stable")]
    if not len(members):
        return nodes[:0], nodes[:0]
    kept = codes[members]
    cuts = np.arange(0, len(kept), leaf)
    low, high = np.bitwise_and.reduceat(kept, cuts), np.bitwise_or.reduceat(kept, cuts)
    mask = ~(low ^ high)
    index = GrayIndex(mask, low & mask)
    parent = np.arange(len(codes))
    width = np.minimum(leaf, len(kept) - cuts)
    for who, group in index.search(codes, d):
        # A group whose members are all in the query's class already has nothing to add.
        label = parent[members]
        first, last = np.minimum.reduceat(label, cuts), np.maximum.reduceat(label, cuts)
        new = ~((first[group] == last[group]) & (first[group] == parent[who]))
        who, group = who[new], group[new]
        for at in range(0, len(who), 1 << 14):
            w, g = who[at : at + (1 << 14)], group[at : at + (1 << 14)]
            q = np.repeat(w, width[g])
            place = np.arange(len(q)) - np.repeat(np.cumsum(width[g]) - width[g], width[g]) + np.repeat(cuts[g], width[g])
            near = np.bitwise_count(codes[q] ^ kept[place]) <= d
            parent = union_classes(parent, q[near], members[place[near]])
    moved = parent != np.arange(len(parent))
    return nodes[moved], nodes[parent[moved]]


def code_components(codes: DataFrame, spec: SimHash = SimHash()) -> DataFrame:
    """__code and __component for each distinct code; codes: __id and __code."""
    spark, d = codes.sparkSession, spec.max_bits
    distinct = materialise(codes.groupBy("__code").agg(F.min("__id").cast("long").alias("__node")).where("__node IS NOT NULL"), "codes")
    count = distinct.count()
    if not count:
        return distinct.select("__code", F.col("__node").alias("__component"))
    parts = max(spec.min_parts, -(-count // spec.part_codes))
    rank = F.col("__code")
    for s in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, s))
    signed = rank.bitwiseXOR(F.lit(-(1 << 63)))  # as gray_rank
    at = [i / parts for i in range(1, parts)]
    cuts = np.unique(np.array(distinct.agg(F.percentile_approx(signed, at, 100 * parts)).first()[0], np.int64))

    @F.pandas_udf("int")
    def part_of(c: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, gray_rank(c.to_numpy(np.int64)), side="left").astype(np.int32))

    placed = materialise(distinct.withColumn("__part", part_of("__code")), "parts")
    tops = placed.groupBy("__part").agg(F.bit_and("__code").alias("low"), F.bit_or("__code").alias("high")).orderBy("__part").collect()
    number = np.array([r["__part"] for r in tops], np.int64)
    low, high = (np.array([r[c] for r in tops], np.int64).view(np.uint64) for c in ("low", "high"))
    mask = ~(low ^ high)
    pattern = low & mask

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = GrayIndex(mask, pattern)
        for x in batches:
            own = x["__part"].to_numpy(np.int64)
            yield pd.DataFrame({"__part": own.astype(np.int32), "__code": x["__code"], "__node": x["__node"], "__own": True})
            code = x["__code"].to_numpy(np.int64).view(np.uint64)
            for who, node in upper.search(code, d):
                there, here = number[node], own[who]
                # One direction for each pair of parts, so dealt that all parts get about as many visitors.
                go = (there != here) & (((here + there) % 2 == 1) == (here < there))
                w = who[go]
                yield pd.DataFrame({"__part": there[go].astype(np.int32), "__code": x["__code"].to_numpy()[w], "__node": x["__node"].to_numpy()[w], "__own": False})

    def forest(x: pd.DataFrame) -> pd.DataFrame:
        u, v = local_forest(x["__code"].to_numpy(np.int64).view(np.uint64), x["__node"].to_numpy(np.int64), x["__own"].to_numpy(bool), d)
        return pd.DataFrame({"u": u, "v": v})

    routed = placed.select("__code", "__node", "__part").mapInPandas(route, "__part int, __code long, __node long, __own boolean")
    edges = routed.groupBy("__part").applyInPandas(forest, "u long, v long")
    least = connected_components(edges)
    out = placed.join(least.withColumnRenamed("u", "__node"), "__node", "left")
    return out.select("__code", F.coalesce("v", "__node").alias("__component"))


def near_duplicates(docs: DataFrame, spec: SimHash = SimHash(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id, the least id reachable over links."""
    codes = materialise(with_fingerprints(docs, spec, id_col, text_col), "fingerprints")
    found = materialise(code_components(codes, spec), "components")
    return codes.join(found, "__code", "left").select(
        F.col("__id").alias(id_col), F.lpad(F.lower(F.hex("__code")), 16, "0").alias("fingerprint"), F.col("__component").alias("component_id"))
