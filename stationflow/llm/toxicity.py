"""Toxicity scores by non-negative positive-unlabelled learning.

A linear classifier is fitted to confirmed toxic texts and to unlabelled ones. The unlabelled risk is corrected by the
class prior: ``prior * R(toxic as 1) + max(0, R(unlabelled as 0) - prior * R(toxic as 0))``. Where the second
part turns negative, its gradient is taken the other way, which keeps the fit from running into the positives it has.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, hashed_sample, per_batch

WORDS = re.compile(r"[^\W\d_]+")
#: Lengths of word beginnings that count as features besides the word.
PREFIXES = range(3, 9)


@dataclass(frozen=True)
class FitSettings:
    """Bounds of the fit: rows of either kind, characters of a text taken into the fit, features,
    the log-likelihood gain a feature needs (about the log of the number of candidates), rounds of the fit."""
    positives: int = 1500
    unlabelled: int = 4000
    max_chars: int = 20_000
    features: int = 1000
    least_seen: int = 4
    least_evidence: float = 10.0
    rounds: int = 400
    rate: float = 0.05
    ridge: float = 1e-4


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def scores(self, texts: list[str | None]) -> list[float]:
        known: dict[str, tuple[str, ...]] = {}
        out = []
        for text in texts:
            found: set[str] = set()
            for w in set(WORDS.findall((text or "").lower())):
                hit = known.get(w)
                if hit is None:
                    hit = known[w] = tuple(f for f in word_features(w) if f in self.weights)
                found.update(hit)
            out.append(1 / (1 + float(np.exp(-np.clip(self.bias + sum(self.weights[f] for f in sorted(found)), -30, 30)))))
        return out


def word_features(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in PREFIXES if n <= len(word))]


def text_features(text: str) -> set[str]:
    return {f for w in set(WORDS.findall(text.lower())) for f in word_features(w)}


def fit(positive: list[str], unlabelled: list[str], prior: float, settings: FitSettings = FitSettings()) -> Model:
    """Fit on texts; without positives or unlabelled texts every score is the prior."""
    prior = min(max(prior, 1e-3), 0.5)
    if not positive or not unlabelled:
        return Model({}, float(np.log(prior / (1 - prior))))
    positive, unlabelled = sorted(set(positive)), sorted(set(unlabelled))
    names = choose_features(positive, unlabelled, prior, settings)
    at = {f: i for i, f in enumerate(names)}
    p, u = presence(positive, at), presence(unlabelled, at)
    w, b = nn_pu(p, u, prior, settings)
    return Model(dict(zip(names, w.tolist())), float(b))


def choose_features(positive: list[str], unlabelled: list[str], prior: float, settings: FitSettings) -> list[str]:
    """Features that set the positives off most from what the unlabelled texts hold besides positives.

    Most features are seen once. A table of hashed counts, which are never too low, keeps those from being remembered at all.
    """
    rough = np.zeros(1 << 22, dtype=np.int32)

    def slots(features):
        return np.array([hash(f) & (len(rough) - 1) for f in features], dtype=np.int64)

    for text in positive:
        rough[np.unique(slots(text_features(text)))] += 1
    in_p: Counter[str] = Counter()
    for text in positive:
        features = list(text_features(text))
        in_p.update([f for f, n in zip(features, rough[slots(features)].tolist()) if n >= settings.least_seen])
    in_p = Counter({f: n for f, n in in_p.items() if n >= settings.least_seen})
    in_u = Counter(f for text in unlabelled for f in text_features(text) if f in in_p)
    names = sorted(in_p)
    p = np.array([in_p[f] for f in names]) / (len(positive) + 1)
    u = np.array([in_u[f] for f in names]) / (len(unlabelled) + 1)
    n = np.maximum((u - prior * p) / (1 - prior), 0.5 / (len(unlabelled) + 1))
    gain = np.where(p > n, p * np.log(p / n) + (1 - p) * np.log((1 - p) / (1 - n)), 0)
    order = np.lexsort((np.arange(len(names)), -gain))[:settings.features]
    return [names[i] for i in order if gain[i] * len(positive) >= settings.least_evidence]


def presence(texts: list[str], at: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(texts), len(at)))
    for row, text in enumerate(texts):
        x[row, [at[f] for f in text_features(text) if f in at]] = 1
    return x


def nn_pu(p: np.ndarray, u: np.ndarray, prior: float, settings: FitSettings) -> tuple[np.ndarray, float]:
    """Weights and bias under the sigmoid loss, by full-batch Adam from zero.

    The loss is bounded, so a few positives far on the right side cannot outweigh all unlabelled texts.
    """
    w = np.zeros(p.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    p, u = (np.hstack([x, np.ones((len(x), 1))]) for x in (p, u))
    for step in range(1, settings.rounds + 1):
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        slope_p, slope_u = p.T @ (sp * (1 - sp)) / len(p), u.T @ (su * (1 - su)) / len(u)
        clean = slope_u - prior * slope_p
        g = clean - prior * slope_p if su.mean() >= prior * sp.mean() else -clean
        g[:-1] += settings.ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= settings.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], w[-1]


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, settings: FitSettings = FitSettings()) -> Model:
    """Fit on bounded samples (:class:`FitSettings`) of rows that are not held out.

    Positives are documents with a label ``toxic`` of 1; unlabelled texts are documents whatever their label. The class prior is
    the share of ones among the labels not held out. Ids are sampled first, so only the sampled texts move.
    """
    spark = docs.sparkSession
    learnable = labels.select("doc_id", "toxic").where((fold_of(F.col("doc_id")) > 0) & F.col("toxic").isNotNull())
    prior = learnable.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("p")).first()["p"] or 0.0
    fits = docs.where((fold_of(F.col("doc_id")) > 0) & F.col("text").isNotNull() & (F.length("text") <= settings.max_chars)).select("doc_id")
    toxic = learnable.where("toxic = 1").select("doc_id").distinct()
    chosen = {kind: [r["doc_id"] for r in hashed_sample(ids.distinct(), ["doc_id"], n).collect()]
              for kind, ids, n in (("p", fits.join(toxic, "doc_id", "left_semi"), settings.positives), ("u", fits, settings.unlabelled))}
    rows = [(i, kind) for kind, ids in chosen.items() for i in ids]
    wanted = spark.createDataFrame(rows, "doc_id bigint, kind string")
    # at most positives + unlabelled ids
    texts = docs.select("doc_id", "text").where(F.length("text") <= settings.max_chars).join(F.broadcast(wanted), "doc_id").select("kind", "text").collect() if rows else []
    return fit([r["text"] for r in texts if r["kind"] == "p"], [r["text"] for r in texts if r["kind"] == "u"], prior, settings)


def with_scores(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with its columns and a score from 0 to 1 of every whole text; null and empty texts get the score of no features."""
    columns = [c for c in docs.columns if c != out]
    kinds = dict(docs.dtypes)
    schema = "".join(f"`{c}` {kinds[c]}, " for c in columns) + f"`{out}` double"
    return per_batch(docs.select(*columns), lambda rows: {**rows, out: model.scores(rows[text])}, schema)
