"""Mixing documents to target weights by soft membership of domains.

1. Softmax regressions, trained here on the labelled table (at most ``max_labelled`` rows,
   chosen by a hash of the id), predict each document's posteriors over the domains from the
   presence of words and a few shapes of the text. Labels: toxic, else high or low quality.
   Documents are in ``folds`` folds by a hash of their id; each is predicted by the model
   that has seen nothing of its fold, so that labelled documents are no surer than others. A
   temperature and a bias for each domain, fitted to those predictions of the labelled rows
   with rows weighed by their tokens, calibrate them: classes weighed alike in training
   are corrected to the shares they have, and expected tokens are those of the labels.
2. A distributed projected-gradient solver fits a rate to every document, within 0 and
   ``max_rate``, so that the expected tokens of each domain (the sum of rate x tokens x
   posterior) meet the targets in the least-squares sense, with a small pull towards rate 1.
   A round is one pass over the thin table of posteriors; a document's rate is recomputed
   from the residuals of all rounds (as many numbers as domains each), so that no round
   writes anything, and the driver sees one sum a domain.
3. A document is emitted floor(rate + u) times, with u in [0, 1) from the hash of its id.

Defined cases: null text has no words and no tokens; labels of null, and documents without
a label, teach nothing; of several labels of one id the last domain counts (toxic, else low), of
several texts of a labelled id the least; where some fold leaves fewer than two labelled domains
every posterior is even; repeated rows are rows of their own, also where they share an id; a null
id is an id like any other; an empty table gives an empty result. Only the named columns are read,
and all columns are handed through by ``emit``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import BROADCAST_IDS, fresh, materialise

DOMAINS = ("high", "low", "toxic")


@dataclass(frozen=True)
class MixSpec:
    """``targets``: shares of the budget by domain. ``budget``: tokens in all; None: the tokens
    there are; "keep <domain>": so many that the named domain's own tokens are its share."""

    targets: dict[str, float] = field(default_factory=lambda: {"high": 0.8, "low": 0.17, "toxic": 0.03})
    budget: float | str | None = None
    max_rate: float = 8.0
    pull: float = 1e-4
    rounds: int = 20
    tolerance: float = 2e-4
    max_labelled: int = 4_000
    folds: int = 3
    vocabulary: int = 1_500
    min_df: int = 5
    seed: int = 17


_SYMBOLS = b"#*$%&|<>!"
_UPPER = bytes(range(65, 91))


def shapes(text: str, words: list[str]) -> list[float]:
    """Log words, mean word length, shares of symbols, capitals and repeated lines."""
    raw = text.encode("utf-8", "replace")
    size, lines = max(1, len(raw)), text.split("\n")
    return [np.log1p(len(words)), len(raw) / max(1, len(words)), (size - len(raw.translate(None, _SYMBOLS))) / size if raw else 0.0,
            (size - len(raw.translate(None, _UPPER))) / size if raw else 0.0, 1 - len(set(lines)) / len(lines)]


@dataclass
class DomainModel:
    vocabulary: dict[str, int]
    words: np.ndarray  # word x domain
    shape: np.ndarray  # shape x domain
    bias: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def logits(self, words: set[str], shape: list[float]) -> np.ndarray:
        hit = [self.vocabulary[x] for x in self.vocabulary.keys() & words]
        z = self.bias + ((np.array(shape) - self.mean) / self.scale) @ self.shape
        return z + self.words[hit].sum(0) if hit else z


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


@dataclass
class FoldedModel:
    """A model for each fold, that has not seen it, and the calibration of them all."""

    models: list[DomainModel]
    cool: float
    bias: np.ndarray

    def posteriors(self, texts: list[str], folds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents x domains, tokens); tokens are the words between white space."""
        z, tokens = np.zeros((len(texts), len(DOMAINS))), np.zeros(len(texts), np.int64)
        for i, (t, f) in enumerate(zip(texts, folds.tolist(), strict=True)):
            w = t.split()
            tokens[i] = len(w)
            z[i] = self.models[f].logits(set(w), shapes(t, w))
        return softmax(self.cool * z + self.bias), tokens


def calibrate(z: np.ndarray, domains: np.ndarray, weight: np.ndarray, steps: int = 60) -> tuple[float, np.ndarray]:
    """(factor of the logits, bias) of least weighted log loss, by damped Newton steps.

    At the optimum the weighted sum of each domain's posteriors is that of its labels.
    """
    k = z.shape[1]
    goal, weight = np.eye(k)[domains], weight / weight.sum()
    features = np.concatenate([z[:, :, None], np.broadcast_to(np.eye(k), (len(z), k, k))], axis=2)  # row x domain x parameter
    theta, damp = np.concatenate([[1.0], np.zeros(k)]), 1e-3
    ridge = 1e-6 * (theta - theta[0] * np.eye(k + 1)[0] + 1)

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        p = softmax(features @ theta)
        return float(-(weight * np.log(np.maximum((p * goal).sum(1), 1e-300))).sum() + (ridge * (theta - np.eye(k + 1)[0]) ** 2).sum()), p

    now, p = loss(theta)
    for _ in range(steps):
        slope = np.einsum("n,nd,ndf->f", weight, p - goal, features) + 2 * ridge * (theta - np.eye(k + 1)[0])
        mean = np.einsum("nd,ndf->nf", p, features)
        bend = np.einsum("n,nd,ndf,ndg->fg", weight, p, features, features) - np.einsum("n,nf,ng->fg", weight, mean, mean)
        step = np.linalg.solve(bend + damp * np.eye(k + 1), slope)
        tried, q = loss(theta - step)
        if tried < now:
            theta, p, damp = theta - step, q, max(damp / 10, 1e-9)
            if now - tried < 1e-12:
                break
            now = tried
        else:
            damp *= 10
    return (float(theta[0]), theta[1:]) if theta[0] > 0 else (0.0, theta[1:])


def train(rows: list[np.ndarray], names: np.ndarray, shape: np.ndarray, domains: np.ndarray, spec: MixSpec) -> tuple[DomainModel, np.ndarray]:
    """Softmax regression with classes weighed alike, by gradient descent in numpy; and each word's place in it, or -1.

    ``rows`` holds each text's distinct words as places in ``names``.
    """
    k, n = len(DOMAINS), len(rows)
    flat, size = np.concatenate(rows), np.array([len(r) for r in rows])
    count = np.bincount(flat, minlength=len(names))
    order = np.lexsort((names, -count))
    common = order[count[order] >= spec.min_df][: 4 * spec.vocabulary]
    y = np.eye(k)[domains]
    weight = y / np.maximum(y.sum(0), 1)
    # The words whose presence differs most between domains, in standard errors.
    rate = np.stack([np.bincount(flat, np.repeat(weight[:, j], size), len(names))[common] for j in range(k)], axis=1)
    rate = (rate + 0.5 / n).clip(max=1)
    spread = (rate.max(1) - rate.min(1)) / np.sqrt(rate.mean(1))
    common = common[np.sort(np.argsort(-spread, kind="stable")[: spec.vocabulary])]
    place = np.full(len(names), -1)
    place[common] = np.arange(len(common))
    x = np.zeros((n, len(common) + shape.shape[1]), np.float32)
    hit = place[flat]
    x[np.repeat(np.arange(n), size)[hit >= 0], hit[hit >= 0]] = 1
    mean, scale = shape.mean(0), shape.std(0) + 1e-6
    x[:, len(common) :] = (shape - mean) / scale
    row = weight.sum(1) * n / max(1, int((y.sum(0) > 0).sum()))
    w, b = np.zeros((x.shape[1], k), np.float32), np.zeros(k)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(300):
        d = (softmax(x @ w + b) - y) * (row / n)[:, None]
        vw = 0.9 * vw - 0.1 * (x.T @ d.astype(np.float32) + 1e-3 * w)
        vb = 0.9 * vb - 0.1 * d.sum(0)
        w, b = w + vw, b + vb
    m = len(common)
    return DomainModel({str(names[i]): j for j, i in enumerate(common)}, w[:m].astype(float), w[m:].astype(float), b, mean, scale), place


def train_folds(rows: list[np.ndarray], names: np.ndarray, shape: np.ndarray, tokens: np.ndarray, domains: np.ndarray, folds: np.ndarray, spec: MixSpec) -> FoldedModel | None:
    """None where some fold leaves fewer than two domains to learn from."""
    if any(len(set(domains[folds != f].tolist())) < 2 for f in range(spec.folds)):
        return None
    models, z = [], np.zeros((len(rows), len(DOMAINS)))
    for f in range(spec.folds):
        other = np.flatnonzero(folds != f)
        model, place = train([rows[i] for i in other], names, shape[other], domains[other], spec)
        models.append(model)
        for i in np.flatnonzero(folds == f):
            at = place[rows[i]]
            z[i] = model.bias + ((shape[i] - model.mean) / model.scale) @ model.shape + model.words[at[at >= 0]].sum(0)
    absent = np.array([d not in domains for d in range(len(DOMAINS))])
    cool, bias = calibrate(z, domains, tokens + 1.0)
    return FoldedModel(models, cool, np.where(absent, -1e9, bias))


def _model(sample: pa.Table, spec: MixSpec) -> FoldedModel | None:
    words = sample["words"].combine_chunks()
    coded = words.flatten().dictionary_encode()
    rows = np.split(coded.indices.to_numpy(), words.offsets.to_numpy()[1:-1] - words.offsets.to_numpy()[0])
    shape = sample["shape"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    return train_folds(rows, np.array(coded.dictionary.to_pylist(), object), shape, *(sample[c].to_numpy() for c in ("tokens", "__domain", "__fold")), spec)


def posteriors(docs: DataFrame, labels: DataFrame, spec: MixSpec, id_col: str, text_col: str) -> DataFrame:
    """__id, __hash (of the text), __tokens and p_<domain>, a row for each row of ``docs``."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)
    known = labels.select(F.col("doc_id").alias("__id"), domain.alias("__domain")).where("__domain IS NOT NULL AND __id IS NOT NULL")
    known = known.groupBy("__id").agg(F.max("__domain").alias("__domain"))
    chosen = known.orderBy(F.xxhash64("__id", F.lit(spec.seed)), "__id").limit(spec.max_labelled)
    text = F.coalesce(F.col(text_col), F.lit(""))
    fold = F.pmod(F.xxhash64(F.col(id_col), F.lit(spec.seed + 1)), F.lit(spec.folds)).cast("int")
    source = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__hash"), fold.alias("__fold"), text.alias("__text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            split = [t.split() for t in x["__text"]]
            yield pd.DataFrame({"__id": x["__id"], "__fold": x["__fold"], "__domain": x["__domain"], "words": [sorted(set(w)) for w in split],
                                "shape": [shapes(t, w) for t, w in zip(x["__text"], split, strict=True)], "tokens": [len(w) for w in split]})

    sample = source.join(F.broadcast(chosen), "__id").groupBy("__id", "__fold", "__domain").agg(F.min("__text").alias("__text"))
    sample = sample.mapInPandas(features, f"__id {kind}, __fold int, __domain int, words array<string>, shape array<double>, tokens long").toArrow()  # at most max_labelled rows
    model = _model(sample.sort_by("__id").combine_chunks(), spec) if sample.num_rows else None

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            texts = x["__text"].tolist()
            if model:
                p, tokens = model.posteriors(texts, x["__fold"].to_numpy())
            else:
                p, tokens = np.full((len(texts), len(DOMAINS)), 1 / len(DOMAINS)), np.array([len(t.split()) for t in texts], np.int64)
            yield pd.DataFrame({"__id": x["__id"], "__hash": x["__hash"], "__tokens": tokens, **{f"p_{d}": p[:, j] for j, d in enumerate(DOMAINS)}})

    return source.mapInPandas(predict, f"__id {kind}, __hash long, __tokens long, " + ", ".join(f"p_{d} double" for d in DOMAINS))


def _rates(p: np.ndarray, history: list[np.ndarray], spec: MixSpec) -> np.ndarray:
    """Rates after the rounds whose residuals (times the preconditioner) are in ``history``."""
    r = np.ones(len(p))
    for e in history:
        r = np.clip(r - (p @ e + spec.pull * (r - 1)), 0, spec.max_rate)
    return r


def _collect(thin: DataFrame, numbers: int, run) -> np.ndarray:
    """Sum over all tasks of the row of numbers that ``run`` adds up from (posteriors, tokens) blocks."""
    names = [f"s{j}" for j in range(numbers)]

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(numbers)
        for x in batches:
            total += run(x[[f"p_{d}" for d in DOMAINS]].to_numpy(), x["__tokens"].to_numpy())
        yield pd.DataFrame([total], columns=names)

    rows = thin.drop("__id", "__hash").mapInPandas(task, ", ".join(f"{c} double" for c in names))
    return np.array([float(v or 0) for v in rows.agg(*[F.sum(c) for c in names]).first()])


def _sums(thin: DataFrame, history: list[np.ndarray], spec: MixSpec) -> np.ndarray:
    """Expected tokens of each domain under the rates."""
    return _collect(thin, len(DOMAINS), lambda p, tokens: (_rates(p, history, spec) * tokens) @ p)


def _gram(thin: DataFrame, history: list[np.ndarray], away: np.ndarray, spec: MixSpec) -> np.ndarray:
    """Sum of tokens x p p' over the documents that can follow the residual ``away``: those that
    no bound holds, and those at a bound that it leads away from."""

    def run(p: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        r, pull = _rates(p, history, spec), p @ away
        free = ((r > 0) | (pull < 0)) & ((r < spec.max_rate) | (pull > 0))
        return ((p * (tokens * free)[:, None]).T @ p).ravel()

    return _collect(thin, len(DOMAINS) ** 2, run).reshape(len(DOMAINS), -1)


def fit_rates(thin: DataFrame, spec: MixSpec) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(history of the solver, targets in tokens, expected tokens reached).

    The gradient of half the squared distance is taken in the metric of the Gram matrix of
    the documents that are free to follow it, damped, which makes a step nearly exact while the
    bounds hold the same documents; the projection is onto [0, max_rate]. A step that does
    not come nearer is refused and the damping raised, so targets that the bounds put out
    of reach are approached and not overshot.
    """
    present = _sums(thin, [], spec)
    share = np.array([spec.targets.get(d, 0.0) for d in DOMAINS])
    share = share / share.sum()
    total = present.sum()
    if isinstance(spec.budget, str):
        kept = DOMAINS.index(spec.budget.removeprefix("keep "))
        total = float(present[kept] / share[kept])
    elif spec.budget is not None:
        total = float(spec.budget)
    goal = share * total
    history, sums, damp, refused = [], present, 1e-4, 0
    gram = _gram(thin, history, sums - goal, spec)
    unit = max(np.trace(gram), 1.0) / len(DOMAINS) * np.eye(len(DOMAINS))
    for _ in range(spec.rounds if present.sum() else 0):
        if np.abs(sums - goal).max() <= spec.tolerance * max(total, 1.0) or refused > 4:
            break
        tried = [*history, np.linalg.solve(gram + damp * unit, sums - goal)]
        new = _sums(thin, tried, spec)
        if np.linalg.norm(new - goal) < 0.999 * np.linalg.norm(sums - goal):
            history, sums, damp, refused = tried, new, max(damp / 4, 1e-6), 0
            gram = _gram(thin, history, sums - goal, spec)
        else:  # too long a step, or as near as the bounds allow
            damp, refused = damp * 10, refused + 1
    return history, goal, sums


def _mixed(docs: DataFrame, labels: DataFrame, spec: MixSpec, id_col: str, text_col: str) -> DataFrame:
    """__id, __hash, __tokens, p_<domain>, __rate and __copies, a row for each row of ``docs``."""
    thin = materialise(posteriors(docs, labels, spec, id_col, text_col), "posteriors")
    history, _, _ = fit_rates(thin, spec)

    @F.pandas_udf("double")
    def rate(*p: pd.Series) -> pd.Series:
        return pd.Series(_rates(np.stack([c.to_numpy() for c in p], axis=1), history, spec))

    u = F.pmod(F.xxhash64("__id", F.lit(spec.seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.least(F.floor(F.col("__rate") + u), F.lit(int(np.ceil(spec.max_rate)))).cast("int")
    return thin.withColumn("__rate", rate(*[F.col(f"p_{d}") for d in DOMAINS])).withColumn("__copies", copies)


def mix(docs: DataFrame, labels: DataFrame, spec: MixSpec = MixSpec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, tokens, p_<domain>, rate and copies, a row for each row of ``docs``."""
    rated = _mixed(docs, labels, spec, id_col, text_col)
    return rated.select(F.col("__id").alias(id_col), F.col("__tokens").alias("tokens"), *[f"p_{d}" for d in DOMAINS], F.col("__rate").alias("rate"), F.col("__copies").alias("copies"))


def emit(docs: DataFrame, labels: DataFrame, spec: MixSpec = MixSpec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, with all their columns.

    The copies come back to the texts by id and text, which decide them, so rows that share an
    id are judged one by one; Spark splits a hot partition of texts.
    """
    a, b, c, n = fresh(docs, "mix_id", "mix_hash", "copies", "n")
    found = _mixed(docs, labels, spec, id_col, text_col).where("__copies != 1").select(F.col("__id").alias(a), F.col("__hash").alias(b), F.col("__copies").alias(c))
    other = materialise(found.groupBy(a, b).agg(F.max(c).alias(c)), "copies")
    if other.count() <= BROADCAST_IDS:
        other = F.broadcast(other)
    same = F.col(id_col).eqNullSafe(F.col(a)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(b))
    joined = docs.join(other, same, "left").withColumn(c, F.coalesce(c, F.lit(1)))
    return joined.where(F.col(c) > 0).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(c)))).select(*[docs[x] for x in docs.columns])
