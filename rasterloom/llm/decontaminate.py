"""Benchmark decontamination by latent semantic retrieval.

1. The benchmark's terms are the vocabulary; every document becomes the sequence of its
   words' term numbers (-1 for any other word), written once in the shared folder.
2. Document frequencies over the passages of all distinct texts give TF-IDF weights, so that a
   large group of copies makes no term common; terms in more than ``max_df`` of the passages
   carry none, except that an item keeps the rarest ``min_share`` of its terms (``min_terms``
   at least).
3. A distributed randomised SVD of all unit TF-IDF passages, the benchmark's own stacked
   below with equal total weight: each task sums A'(A G) for a random G, terms by columns,
   Spark adds them up, and the driver takes the Nystrom decomposition of that one sketch.
   Only matrices of the vocabulary's height and the sketch's width reach the driver.
4. Overlapping passages of all documents are projected and compared with all projected
   item passages; those with a cosine of ``min_cosine`` are candidates. Only passages without a
   weighted word are left out, which loses nothing, as their cosine is 0: step 5 asks for terms
   of a region wider than the passage, so one may be all that a passage holds of an item.
5. Around a candidate, the longest common subsequence of words with the whole item must
   cover ``min_lcs`` of it, and the passage must hold ``min_answer`` of the item's weighted
   terms (the part of the item that answers it). That leaves paraphrases and copies.

Items of fewer than ``min_item_words`` words hold too little for a paraphrase: they are found as
whole word sequences, wherever they stand (cosine, lcs and answer are 1).

The benchmark is the query set. Vocabulary, frequencies and latent space are those of all items;
the search takes at most ``block_items`` of them at a time, which bounds what a task holds and
changes no result. Defined cases: null or empty texts and items find nothing; repeated items are
reported by their least id, once for each document; repeated ids are rows of their own in the
search, one row in the result, and stay or go by their own text; empty tables give an empty
result. Other columns aren't read; texts are searched whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialise, without_texts

_WORD = re.compile(r"\w+")
#: Blocks of punctuation beyond ASCII; texts without it are split by a byte table.
_FAR_MARKS = re.compile("[\u0080-\u00bf\u00d7\u00f7\u2000-\u2bff\u3000-\u303f\ufe30-\ufe6f\uff00-\uff0f]")
_TABLE = bytes(b if b >= 128 or chr(b).isalnum() or b == ord("_") else 32 for b in range(256))


@dataclass(frozen=True)
class LatentSpec:
    """A passage is two blocks of ``half`` words, one block further each time."""

    half: int = 16
    rank: int = 96
    oversample: int = 8
    max_df: float = 0.01
    min_terms: int = 4
    min_share: float = 0.5
    min_cosine: float = 0.4
    min_lcs: float = 0.6
    min_answer: float = 0.5
    min_item_words: int = 5
    block_items: int = 5_000
    seed: int = 5


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and underscores, as UTF-8."""
    low = (text or "").lower()
    if not low.isascii() and _FAR_MARKS.search(low):
        low = " ".join(_WORD.findall(low))
    return low.encode("utf-8", "replace").translate(_TABLE).split()


def _encode(docs: DataFrame, vocabulary: dict[bytes, int], kind: str) -> DataFrame:
    """__id, __hash and __ids: the term numbers of all words as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for whole in batches:
            for low in range(0, whole.num_rows, 512):
                b = whole.slice(low, 512)
                out = []
                for t in b.column("__text").to_pylist():
                    w = words(t)
                    out.append(np.fromiter(map(get, w, repeat(-1)), "<i4", len(w)).tobytes())
                yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__hash"), pa.array(out, pa.binary())], ["__id", "__hash", "__ids"])

    return docs.mapInArrow(run, f"__id {kind}, __hash long, __ids binary")


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some documents one behind the other, and where each begins (with the end)."""
    raw = column.to_pylist()
    begin = np.concatenate([[0], np.cumsum([len(x) >> 2 for x in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), "<i4"), begin


def _blocks(begin: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word's block of ``size`` words inside its document, and each document's first block."""
    n = np.diff(begin)
    first = np.concatenate([[0], np.cumsum(-(-n // size))]).astype(np.int64)
    own = np.repeat(np.arange(len(n)), n)
    return first[own] + (np.arange(begin[-1]) - begin[own]) // size, first


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for whole in batches:
        for low in range(0, whole.num_rows, 512):
            b = whole.slice(low, 512)
            ids, begin = _joined(b.column("__ids"))
            yield b, ids, begin


def _frequencies(encoded: DataFrame, terms: int, spec: LatentSpec) -> tuple[np.ndarray, int]:
    """Passages (disjoint ones, of two blocks) of the distinct texts that hold each term, and their number.

    Each of n equal texts counts 1 / n, so that no text is shuffled.
    """
    twice = materialise(encoded.groupBy("__hash").agg(F.count("*").alias("__n")).where("__n > 1"), "copies")
    if twice.count() <= 500_000:
        twice = F.broadcast(twice)  # at most 8 MB
    shared = encoded.join(twice, "__hash", "left").select((1 / F.coalesce("__n", F.lit(1))).alias("__part"), "__ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms + 1)
        for b, ids, begin in _batches(batches):
            block, first = _blocks(begin, 2 * spec.half)
            part = np.repeat(b.column("__part").to_numpy(), np.diff(first))
            df[terms] += part.sum()
            hit = ids >= 0
            cell = np.unique(block[hit] * terms + ids[hit])
            df[:terms] += np.bincount(cell % terms, part[cell // terms], minlength=terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], ["term", "df"])

    rows = shared.mapInArrow(run, "term int, df double").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(terms + 1, np.int64)
    for r in rows:  # a row for each term of the benchmark
        df[r["term"]] = round(r["df"])
    return df[:terms], int(df[terms])


def _unit_rows(row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, value) of unit TF-IDF rows from occurrences; rows ascend."""
    terms = len(weight)
    cell, tf = np.unique(row * terms + term, return_counts=True)
    row, term = cell // terms, cell % terms
    value = tf * weight[term]
    norm = np.sqrt(np.bincount(row, value * value))
    return row, term, value / norm[row]


def _sketch(row: np.ndarray, term: np.ndarray, value: np.ndarray, g: np.ndarray, out: np.ndarray) -> None:
    """out += A' (A g) for the sparse rows of A."""
    if not len(row):
        return
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    value = value.astype(g.dtype)
    y = np.add.reduceat(value[:, None] * g[term], starts, axis=0)
    order = np.argsort(term, kind="stable")
    which = np.cumsum(np.diff(row, prepend=row[0]) != 0)
    t = term[order]
    first = np.flatnonzero(np.diff(t, prepend=-1))
    out[t[first]] += np.add.reduceat(value[order, None] * y[which[order]], first, axis=0)


def _directions(encoded: DataFrame, own: tuple, weight: np.ndarray, spec: LatentSpec) -> np.ndarray:
    """Right singular vectors (terms x rank) of the corpus' and the benchmark's passages."""
    terms, width = len(weight), min(spec.rank + spec.oversample, len(weight))
    g = np.random.default_rng(spec.seed).standard_normal((terms, width))
    light = g.astype(np.float32)  # for the passages, whose sums are then kept in double precision

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, rows = np.zeros((terms + 1, width)), 0
        for _, ids, begin in _batches(batches):
            block, _ = _blocks(begin, 2 * spec.half)
            hit = np.flatnonzero(ids >= 0)
            hit = hit[weight[ids[hit]] > 0]
            if len(hit):
                a = _unit_rows(block[hit], ids[hit].astype(np.int64), weight)
                rows += len(np.unique(a[0]))
                _sketch(*a, light, y)
        y[terms, 0] = rows
        some = np.flatnonzero(np.abs(y).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(y[some, j]) for j in range(width)]], ["term", *[f"y{j}" for j in range(width)]])

    kind = "term int, " + ", ".join(f"y{j} double" for j in range(width))
    sums = encoded.select("__ids").mapInArrow(run, kind).groupBy("term").agg(*[F.sum(f"y{j}") for j in range(width)])
    y = np.zeros((terms + 1, width))
    for r in sums.collect():  # a row for each term of the benchmark
        y[r[0]] = r[1:]
    corpus, y = y[terms, 0], y[:terms]
    stacked = np.zeros_like(y)
    _sketch(*own, g, stacked)
    y += stacked * (max(corpus, 1.0) / max(1, len(np.unique(own[0]))))
    shift = 1e-7 * np.linalg.norm(y)
    y += shift * g
    core = g.T @ y
    lower = np.linalg.cholesky((core + core.T) / 2)
    u, _, _ = np.linalg.svd(np.linalg.solve(lower, y.T).T, full_matrices=False)
    return u[:, : spec.rank]


def lcs(item: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    at: dict[int, int] = {}
    for i, t in enumerate(item):
        at[t] = at.get(t, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for t in text:
        if m := at.get(t, 0):
            both = row & m
            row = ((row + both) | (row - both)) & full
    return len(item) - row.bit_count()


class Searcher:
    """The latent space, the items' passages in it, and the checks of candidates; plain numpy, sent to the executors."""

    def __init__(self, space: np.ndarray, weight: np.ndarray, coded: list[list[int]], own: tuple, owner: np.ndarray, spec: LatentSpec):
        queries = np.zeros((len(owner), space.shape[1]))
        np.add.at(queries, own[0], own[2][:, None] * space[own[1]])
        queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-12)
        self.queries = np.ascontiguousarray(queries.T.astype(np.float32))
        self.lifted = (weight[:, None] * space).astype(np.float32)
        self.weighted = weight > 0
        self.coded, self.owner, self.spec = coded, owner, spec
        self.keys = [frozenset(x for x in c if weight[x] > 0) for c in coded]
        self.length = np.array([len(c) for c in coded], np.int64)
        self.least = np.ceil(spec.min_answer * np.array([len(k) for k in self.keys]) - 1e-9)

    def candidates(self, ids: np.ndarray, begin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(block, item passage, cosine) of passages near an item's passage; a passage is named by its first block."""
        half = self.spec.half
        block, first = _blocks(begin, half)
        hit = np.flatnonzero(ids >= 0)
        hit = hit[self.weighted[ids[hit]]]
        if not len(hit):
            return
        blocks = int(first[-1])
        count = np.bincount(block[hit], minlength=blocks + 1)
        more = np.ones(blocks, bool)  # a document's last block is a passage of its own
        more[first[1:][np.diff(first) > 0] - 1] = False
        some = np.flatnonzero(count[:blocks] + more * count[1:])
        starts = np.flatnonzero(np.diff(block[hit], prepend=-1))
        sums = np.zeros((blocks + 1, self.lifted.shape[1]), np.float32)
        sums[block[hit][starts]] = np.add.reduceat(self.lifted[ids[hit]], starts, axis=0)
        for low in range(0, len(some), 4096):
            w = some[low : low + 4096]
            p = sums[w] + more[w, None] * sums[w + 1]
            p /= np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-12)
            cosine = p @ self.queries
            i, q = np.divmod(np.flatnonzero(cosine.ravel() >= self.spec.min_cosine), cosine.shape[1])
            yield w[i], q, cosine[i, q]

    def leaks(self, ids: np.ndarray, begin: np.ndarray) -> list[tuple]:
        """(document, item, cosine, lcs, answer, first word, end word), the best region of each pair."""
        half, spec, found = self.spec.half, self.spec, []
        _, first = _blocks(begin, half)
        place = np.flatnonzero(ids >= 0)
        place = place[self.weighted[ids[place]]]
        weighted = ids[place].tolist()
        pairs: dict[tuple[int, int], list] = {}
        for w, q, c in self.candidates(ids, begin):
            doc, k = np.searchsorted(first, w, side="right") - 1, self.owner[q]
            start = begin[doc] + (w - first[doc]) * half
            low, high = np.maximum(begin[doc], start - self.length[k]), np.minimum(begin[doc + 1], start + 2 * half + self.length[k])
            a, b = np.searchsorted(place, low), np.searchsorted(place, high)
            able = np.flatnonzero(b - a >= self.least[k])  # weighted words enough for the answer
            for d, i, *x in zip(*(v[able].tolist() for v in (doc, k, w, c, low, high, a, b)), strict=True):
                pairs.setdefault((d, i), []).append(x)
        for (d, k), at in pairs.items():
            item, best, reach = self.coded[k], None, -1
            for _, c, low, high, a, b in sorted(at):
                if high <= reach:
                    continue
                reach = high
                answer = len(self.keys[k].intersection(weighted[a:b])) / len(self.keys[k])
                if answer < spec.min_answer or (share := lcs(item, ids[low:high].tolist()) / len(item)) < spec.min_lcs:
                    continue
                if best is None or (share, c) > (best[1], best[0]):
                    best = (c, share, answer, low - int(begin[d]), high - int(begin[d]))
            if best:
                found.append((d, k, *best))
        return found


_FOUND = "item_id long, cosine double, lcs double, answer double, first_word long, end_word long"


def _rows(b: pa.RecordBatch, found: list[tuple], ids_of: list[int]) -> pa.RecordBatch:
    """The found (document, item, cosine, lcs, answer, first word, end word) of a batch as rows."""
    at = pa.array([f[0] for f in found], pa.int64())
    columns = [b.column("__id").take(at), b.column("__hash").take(at), pa.array([ids_of[f[1]] for f in found], pa.int64())]
    columns += [pa.array([f[j] for f in found], t) for j, t in ((2, pa.float64()), (3, pa.float64()), (4, pa.float64()), (5, pa.int64()), (6, pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["__id", "__hash", "item_id", "cosine", "lcs", "answer", "first_word", "end_word"])


def _mixed(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit number for each n consecutive ids."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(ids) - n + 1, np.uint64)
    for j in range(n):
        out = (out ^ ids[j : len(ids) - n + 1 + j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _exact(encoded: DataFrame, coded: list[list[int]], ids_of: list[int], kind: str) -> DataFrame:
    """Documents that hold one of the items as a sequence of words, the first place of each."""
    by: dict[int, dict[int, list[int]]] = {}
    for k, c in enumerate(coded):
        by.setdefault(len(c), {}).setdefault(int(_mixed(np.array(c, "<i4"), len(c))[0]), []).append(k)
    sought = {n: np.array(sorted(at), np.uint64) for n, at in by.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, ids, begin in _batches(batches):
            found: dict[tuple[int, int], int] = {}
            for n, numbers in sought.items():
                mixed = _mixed(ids, n)
                for at in np.flatnonzero(np.isin(mixed, numbers)).tolist():
                    d = int(np.searchsorted(begin, at, side="right")) - 1
                    for k in by[n][int(mixed[at])]:
                        if at + n <= begin[d + 1] and ids[at : at + n].tolist() == coded[k]:
                            found.setdefault((d, k), at - int(begin[d]))
            yield _rows(b, [(d, k, 1.0, 1.0, 1.0, at, at + len(coded[k])) for (d, k), at in found.items()], ids_of)

    return encoded.mapInArrow(run, f"__id {kind}, __hash long, {_FOUND}")


def _weights(encoded: DataFrame, coded: list[list[int]], terms: int, spec: LatentSpec) -> np.ndarray:
    df, passages = _frequencies(encoded, terms, spec)
    weight = np.log((1 + passages) / (1 + df)) + 1
    stop = df > spec.max_df * passages
    for c in coded:  # an item keeps its rarest terms where too few are below max_df
        t = np.unique(c)
        least = max(spec.min_terms, int(np.ceil(spec.min_share * len(t))))
        if (~stop[t]).sum() < least:
            stop[t[np.argsort(df[t], kind="stable")[:least]]] = False
    weight[stop] = 0
    return weight


def _passages(coded: list[list[int]], weight: np.ndarray, half: int) -> tuple[tuple, np.ndarray]:
    """((row, term, value) of the items' passages, each row's item): as the documents', the last one moved back to the item's end."""
    owner, row, term = [], [], []
    for k, c in enumerate(coded):
        for s in sorted({min(s, max(0, len(c) - 2 * half)) for s in range(0, len(c), half)}):
            t = [x for x in c[s : s + 2 * half] if weight[x] > 0]
            if t:
                row += [len(owner)] * len(t)
                term += t
                owner.append(k)
    return _unit_rows(np.array(row, np.int64), np.array(term, np.int64), weight), np.array(owner)


def _latent(encoded: DataFrame, items: list[tuple[int, list[int]]], terms: int, spec: LatentSpec, kind: str) -> list[DataFrame]:
    weight = _weights(encoded, [c for _, c in items], terms, spec)
    space = _directions(encoded, _passages([c for _, c in items], weight, spec.half)[0], weight, spec)

    def search(block: list[tuple[int, list[int]]]) -> DataFrame:
        coded, ids_of = [c for _, c in block], [i for i, _ in block]
        searcher = Searcher(space, weight, coded, *_passages(coded, weight, spec.half), spec)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b, ids, begin in _batches(batches):
                yield _rows(b, searcher.leaks(ids, begin), ids_of)

        return encoded.mapInArrow(run, f"__id {kind}, __hash long, {_FOUND}")

    return [search(items[at : at + spec.block_items]) for at in range(0, len(items), spec.block_items)]


def _leaks(docs: DataFrame, benchmark: DataFrame, spec: LatentSpec, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """__id, __hash (of the text) and what was found, a row for each row of ``docs`` and item it holds."""
    kind = docs.schema[id_col].dataType.simpleString()
    items = benchmark.where(F.col(item_text_col).isNotNull()).groupBy(F.col(item_text_col).alias("t")).agg(F.min(item_col).cast("long").alias("i"))
    rows = sorted((r["i"] is None, r["i"] or 0, ws) for r in items.collect() if (ws := words(r["t"])))  # the query set
    items = [(None if none else i, ws) for none, i, ws in rows]
    if not items:
        return docs.sparkSession.createDataFrame([], f"__id {kind}, __hash long, {_FOUND}")
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
    coded = [(i, [vocabulary[w] for w in ws]) for i, ws in items]
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("__id"), text.alias("__text"), F.xxhash64(text).alias("__hash"))
    encoded = materialise(_encode(source, vocabulary, kind), "terms", compression="zstd")
    long, short = ([x for x in coded if (len(x[1]) >= spec.min_item_words) == way] for way in (True, False))
    found = _latent(encoded, long, len(vocabulary), spec, kind) if long else []
    if short:
        found.append(_exact(encoded, [c for _, c in short], [i for i, _ in short], kind))
    return materialise(reduce(DataFrame.union, found), "leaks")


def find_leaks(docs: DataFrame, benchmark: DataFrame, spec: LatentSpec = LatentSpec(), id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document and item it holds: id, item_id, cosine, lcs, answer, first_word, end_word."""
    leaks = _leaks(docs, benchmark, spec, id_col, text_col, item_col, item_text_col)
    best = leaks.groupBy("__id", "item_id").agg(F.max(F.struct("lcs", "cosine", "answer", "first_word", "end_word")).alias("b"))
    return best.select(F.col("__id").alias(id_col), "item_id", "b.cosine", "b.lcs", "b.answer", "b.first_word", "b.end_word")


def clean_documents(docs: DataFrame, benchmark: DataFrame, spec: LatentSpec = LatentSpec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; a row goes by its own text, whatever its id."""
    leaked = _leaks(docs, benchmark, spec, id_col, text_col, "item_id", "text").select("__id", "__hash")
    return without_texts(docs, leaked, id_col, text_col)
