"""Language identification by a bidirectional gated recurrent network over bytes.

A GRU reads the UTF-8 bytes of a text in each direction, in segments of fixed length whose
state starts at zero; both states of a byte give it a distribution over the languages (every
position is labelled), and a document's probabilities are the mean over all its bytes. The
network is trained here, in numpy, by backpropagation through time with Adam.

Training reads a bounded sample of every language: at most ``docs_per_lang`` labelled rows of each,
chosen by a hash of the id, and at most ``segments_per_doc`` segments of each, evenly spread over
the whole text and cut out on the executors. It learns from the language label and the text alone.
Prediction reads every byte of every text, on the executors, and sees
nothing but the text.

Defined cases: null text, and text without a letter, is ``und`` with score 0; so is every
text if nothing could be learned; rows without a label teach nothing; repeated rows are
predicted alike; an empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The answer where there is nothing to read.
UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageSpec:
    """``segment``: bytes read from one zero state in prediction, ``train_segment`` in training."""

    hidden: int = 8
    segment: int = 128
    train_segment: int = 64
    docs_per_lang: int = 150
    segments_per_doc: int = 32
    steps: int = 250
    batch: int = 256
    rate: float = 0.02
    seed: int = 11


class Gru:
    """One direction. Gates: update z, reset r, candidate n; e_* are the bytes' contributions with bias."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        draw = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
        self.e_zr, self.e_n = draw(256, 2 * hidden), draw(256, hidden)
        self.u_zr, self.u_n = draw(hidden, 2 * hidden), draw(hidden, hidden)

    def params(self) -> list[np.ndarray]:
        return [self.e_zr, self.e_n, self.u_zr, self.u_n]

    def run(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States (time, batch, hidden) for bytes x (time, batch)."""
        steps, width = x.shape
        k = self.u_n.shape[0]
        out = np.empty((steps, width, k), np.float32)
        h, trail = np.zeros((width, k), np.float32), []
        zr, n, u, w = (np.empty((width, c), np.float32) for c in (2 * k, k, k, 2 * k))
        for t in range(steps):
            if keep:
                zr, n, u = np.empty_like(zr), np.empty_like(n), np.empty_like(u)
            np.take(self.e_zr, x[t], axis=0, out=zr)
            np.matmul(h, self.u_zr, out=w)
            zr += w
            zr *= 0.5  # the logistic function through tanh
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            np.matmul(h, self.u_n, out=u)
            np.take(self.e_n, x[t], axis=0, out=n)
            n += zr[:, k:] * u
            np.tanh(n, out=n)
            new = out[t]
            np.subtract(h, n, out=new)
            new *= zr[:, :k]
            new += n
            if keep:
                trail.append((h, zr, n, u))
            h = new
        return out, trail

    def back(self, x: np.ndarray, trail: list, d_out: np.ndarray) -> list[np.ndarray]:
        """Gradients of params() from those of the states, through time."""
        steps, width = x.shape
        k = self.u_n.shape[0]
        d_zr, d_n = np.empty((steps, width, 2 * k), np.float32), np.empty((steps, width, k), np.float32)
        g_zr, g_n, dh = np.zeros_like(self.u_zr), np.zeros_like(self.u_n), np.zeros((width, k), np.float32)
        for t in range(steps - 1, -1, -1):
            h, zr, n, u = trail[t]
            z, r = zr[:, :k], zr[:, k:]
            dh = dh + d_out[t]
            a_n = dh * (1 - z) * (1 - n * n)
            d_n[t] = a_n
            d_zr[t, :, :k] = dh * (h - n) * z * (1 - z)
            d_zr[t, :, k:] = a_n * u * r * (1 - r)
            d_u = a_n * r
            g_zr += h.T @ d_zr[t]
            g_n += h.T @ d_u
            dh = dh * z + d_u @ self.u_n.T + d_zr[t] @ self.u_zr.T
        order = np.argsort(x.ravel(), kind="stable")
        seen, first = np.unique(x.ravel()[order], return_index=True)
        sums = []
        for d in (d_zr, d_n):
            g = np.zeros((256, d.shape[-1]), np.float32)
            g[seen] = np.add.reduceat(d.reshape(-1, d.shape[-1])[order], first, axis=0)
            sums.append(g)
        return [*sums, g_zr, g_n]


class ByteTagger:
    """Both directions and the output layer."""

    def __init__(self, langs: list[str], spec: LanguageSpec):
        rng = np.random.default_rng(spec.seed)
        self.langs, self.spec = langs, spec
        self.ahead, self.behind = Gru(spec.hidden, rng), Gru(spec.hidden, rng)
        self.w = (rng.standard_normal((2 * spec.hidden, len(langs))) * 0.3).astype(np.float32)
        self.b = np.zeros(len(langs), np.float32)

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (time, batch, language) of every position of bytes x (time, batch)."""
        k = self.spec.hidden
        p = self.ahead.run(x)[0] @ self.w[:k]
        p += (self.behind.run(x[::-1])[0] @ self.w[k:])[::-1]
        p += self.b
        np.exp(p, out=p)  # states are within -1 and 1, so the sums stay small
        p /= p.sum(-1, keepdims=True)
        return p

    def step(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy of all positions; y: language of each column."""
        k = self.spec.hidden
        a, ta = self.ahead.run(x, keep=True)
        b, tb = self.behind.run(x[::-1], keep=True)
        both = np.concatenate([a, b[::-1]], axis=-1)
        p = both @ self.w + self.b
        p = np.exp(p - p.max(-1, keepdims=True))
        p /= p.sum(-1, keepdims=True)
        p[:, np.arange(len(y)), y] -= 1
        p /= p.shape[0] * p.shape[1]
        d = p @ self.w.T
        flat = p.reshape(-1, p.shape[-1])
        return [*self.ahead.back(x, ta, d[..., :k]), *self.behind.back(x[::-1], tb, d[::-1, :, k:]),
                both.reshape(-1, 2 * k).T @ flat, flat.sum(0)]

    def fit(self, segments: np.ndarray, labels: np.ndarray) -> None:
        rng, spec = np.random.default_rng(self.spec.seed + 1), self.spec
        params = [*self.ahead.params(), *self.behind.params(), self.w, self.b]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for t in range(1, spec.steps + 1):
            pick = rng.integers(0, len(segments), spec.batch)
            rate = spec.rate * min(1.0, 2 * (1 - (t - 1) / spec.steps))
            for p, g, a, b in zip(params, self.step(np.ascontiguousarray(segments[pick].T), labels[pick]), m, v, strict=True):
                g = np.clip(g, -1, 1)
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)

    def label_positions(self, text: bytes) -> np.ndarray:
        """The language's number for each byte of a text."""
        size = self.spec.segment
        data = np.frombuffer(text.ljust(-(-len(text) // size) * size), np.uint8).reshape(-1, size)
        best = [self.positions(np.ascontiguousarray(data[at : at + 4096].T)).argmax(-1).T.ravel() for at in range(0, len(data), 4096)]
        return np.concatenate([*best, np.zeros(0, np.int64)])[: len(text)]

    def documents(self, texts: list[bytes], block: int = 4096) -> np.ndarray:
        """Mean probabilities of each non-empty text over all its bytes."""
        size = self.spec.segment
        count = np.array([-(-len(t) // size) for t in texts], np.int64)
        total = np.zeros((len(texts), len(self.langs)))
        owner = np.repeat(np.arange(len(texts)), count)
        data = np.frombuffer(b"".join(t.ljust(int(c) * size) for t, c in zip(texts, count, strict=True)), np.uint8).reshape(-1, size)
        left = np.full(len(owner), size)
        left[np.cumsum(count)[count > 0] - 1] -= (count * size - np.array([len(t) for t in texts], np.int64))[count > 0]
        for at in range(0, len(data), block):
            p = self.positions(np.ascontiguousarray(data[at : at + block].T))
            short = np.flatnonzero(left[at : at + block] < size)
            for s in short.tolist():
                p[left[at + s] :, s] = 0
            sums = p.sum(0)
            for lang in range(len(self.langs)):
                total[:, lang] += np.bincount(owner[at : at + block], sums[:, lang], len(texts))
        return total / np.maximum(np.array([len(t) for t in texts], np.int64), 1)[:, None]


def train(labelled: DataFrame, spec: LanguageSpec = LanguageSpec()) -> ByteTagger | None:
    """Fit on rows of __id, __text and __lang, all non-null; None if there are none."""
    place = Window.partitionBy("__lang").orderBy(F.xxhash64("__id", F.lit(spec.seed)), "__id", F.xxhash64("__text"))
    rows = labelled.withColumn("__n", F.row_number().over(place)).where(F.col("__n") <= spec.docs_per_lang)
    size = spec.train_segment

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column("__text").to_pylist():
                raw = t.encode()
                whole = np.frombuffer(raw.ljust(-(-len(raw) // size) * size), np.uint8).reshape(-1, size)
                some = np.unique(np.linspace(0, len(whole) - 1, min(len(whole), spec.segments_per_doc)).astype(np.int64))
                out.append(whole[some].tobytes())  # a long text teaches no more than a few short ones
            yield pa.RecordBatch.from_arrays([b.column("__lang"), b.column("__n"), pa.array(out, pa.binary())], ["__lang", "__n", "__cut"])

    sample = sorted(rows.select("__text", "__lang", "__n").mapInArrow(cut, "__lang string, __n int, __cut binary").collect())
    langs = sorted({r["__lang"] for r in sample if r["__cut"]})
    if not langs:
        return None
    segments = np.frombuffer(b"".join(r["__cut"] for r in sample), np.uint8).reshape(-1, size)
    labels = np.repeat([langs.index(r["__lang"]) if r["__cut"] else 0 for r in sample], [len(r["__cut"]) // size for r in sample])
    # Languages weigh the same: segments are drawn by language first.
    rng = np.random.default_rng(spec.seed)
    each = max(1, spec.batch * spec.steps // (4 * len(langs)))
    pick = np.concatenate([rng.choice(own, each) for k in range(len(langs)) if len(own := np.flatnonzero(labels == k))])
    tagger = ByteTagger(langs, spec)
    tagger.fit(segments[pick], labels[pick])
    return tagger


def predict(docs: DataFrame, tagger: ByteTagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score for each row of ``docs``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 512):
                b = whole.slice(low, 512)
                texts = b.column("__text").to_pylist()
                lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                read = [i for i, t in enumerate(texts) if tagger and t and any(map(str.isalpha, t))]
                if read:
                    p = tagger.documents([texts[i].encode() for i in read])
                    best = p.argmax(1)
                    for i, k, s in zip(read, best.tolist(), p[np.arange(len(best)), best].tolist(), strict=True):
                        lang[i], score[i] = tagger.langs[k], min(1.0, s)
                yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], [id_col, "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return rows.mapInArrow(tag, f"`{id_col}` {kind}, lang_pred string, score double")


def label_spans(docs: DataFrame, tagger: ByteTagger, id_col: str = "doc_id", text_col: str = "text", least: int = 24) -> DataFrame:
    """id, start, end, lang: runs of at least ``least`` bytes of one label (bytes of the UTF-8 text, end exclusive)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, rows = [], []
            for i, t in enumerate(b.column("__text").to_pylist()):
                label = tagger.label_positions(t.encode())
                cuts = np.flatnonzero(np.diff(label, prepend=-1))
                for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(label)], strict=True) if len(label) else ():
                    if z - a >= least:
                        who.append(i)
                        rows.append((a, z, tagger.langs[label[a]]))
            yield pa.RecordBatch.from_arrays([b.column("__id").take(pa.array(who, pa.int64())), *[pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.string()))]],
                                             [id_col, "start", "end", "lang"])

    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, start long, end long, lang string")


def held_out(id_col: str = "doc_id"):
    """The rows that training leaves out: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, spec: LanguageSpec = LanguageSpec(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score: trained on the labelled rows that aren't held out."""
    known = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    tagger = train(known.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.col(lang_col).alias("__lang")), spec)
    return predict(docs, tagger, id_col, text_col).withColumn("held_out", held_out(id_col)).select(id_col, "held_out", "lang_pred", "score")
