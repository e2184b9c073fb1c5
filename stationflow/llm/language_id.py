"""Language identification with a string kernel.

The kernel of two texts is the number of different character n-grams (one to three characters, blended) that both
have, over the geometric mean of their own numbers, counted within the n-grams of the landmarks. Nystroem features are the
kernels to the landmarks times the inverse root of the landmarks' kernel matrix; one ridge regression per language
tells it from the rest. All steps after the n-gram lookup are linear, so they fold into one matrix, and a slice of texts is
scored by one sparse product with it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KeyIndex, fold_of, per_batch

ORDERS = (1, 2, 3)
UNKNOWN = "und"


@dataclass(frozen=True)
class FitSettings:
    """Bounds of the fit: rows and landmarks of a language and of all languages together, characters of a text taken into the fit."""
    rows: int = 150
    landmarks: int = 30
    all_rows: int = 9000
    all_landmarks: int = 900
    max_chars: int = 20_000
    ridge: float = 1e-2

    def rows_of(self, languages: int) -> int:
        return max(1, min(self.rows, self.all_rows // languages))

    def landmarks_of(self, languages: int) -> int:
        return max(1, min(self.landmarks, self.all_landmarks // languages))


#: Texts whose n-grams are held as a dense matrix at a time.
CHUNK = 256


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams of the lower-cased text; 21 bits a character, so codes are exact."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64) + 1
    out, code = [c], c
    for n in ORDERS[1:]:
        code = (code[:-1] << 21) | c[n - 1:]
        out.append(code)
    return np.concatenate(out)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray

    @cached_property
    def index(self) -> KeyIndex:
        return KeyIndex(self.codes, np.arange(len(self.codes)))

    @cached_property
    def padded(self) -> np.ndarray:
        return np.vstack([self.weights, np.zeros((1, self.weights.shape[1]))])

    def present(self, text: str) -> np.ndarray:
        """Numbers of the known n-grams a text has."""
        flags = np.zeros(len(self.codes) + 1, dtype=bool)
        flags[self.index.find(grams(text), -1)] = True
        return np.flatnonzero(flags[:-1])

    def presences(self, texts: list[str]) -> np.ndarray:
        """A row for each text: its known n-grams, scaled to length one."""
        out = np.zeros((len(texts), len(self.codes)), dtype=np.float32)
        for row, text in enumerate(texts):
            some = self.present(text)
            out[row, some] = 1 / np.sqrt(max(len(some), 1))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; without a letter, or without anything learnt, ``und`` and 0."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        some = [i for i, t in enumerate(texts) if self.languages and has_letter(t)]
        if some:
            sets = [self.present(texts[i]) for i in some]
            sizes = np.array([len(s) for s in sets])
            # one row of zeros behind the last text, so that a text without known n-grams has a place to sum from
            flat = np.concatenate([*sets, [len(self.codes)]])
            sums = np.add.reduceat(self.padded[flat], np.cumsum(sizes) - sizes, axis=0)
            values = np.where(sizes[:, None] > 0, sums, 0) / np.sqrt(np.maximum(sizes, 1))[:, None]
            best = values.argmax(axis=1)
            for i, k, v in zip(some, best.tolist(), values.max(axis=1).tolist()):
                names[i], scores[i] = self.languages[k], (min(max(v, -1.0), 1.0) + 1) / 2
        return names, scores


def fit(texts: list[str], languages: list[str], settings: FitSettings = FitSettings()) -> Model:
    """Fit on labelled texts, in the given order; the first ones of each language are the landmarks."""
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros(0, dtype=np.int64), np.zeros((0, 0)))
    marks = [i for l in names for i in [k for k, x in enumerate(languages) if x == l][:settings.landmarks_of(len(names))]]
    codes = np.unique(np.concatenate([grams(texts[i]) for i in marks]))
    blank = Model(names, codes, np.zeros((len(codes), len(names))))
    base = blank.presences([texts[i] for i in marks])
    kernel = np.vstack([blank.presences(texts[at:at + CHUNK]) @ base.T for at in range(0, len(texts), CHUNK)]).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[marks])
    keep = values > 1e-8 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep])
    phi = kernel @ half
    target = np.where(np.array(languages)[:, None] == np.array(names), 1.0, -1.0)
    # each language weighs the same, however many rows it has
    weight = (1 / np.array([languages.count(l) for l in names]))[[names.index(l) for l in languages]][:, None]
    w = np.linalg.solve((phi * weight).T @ phi + settings.ridge / len(names) * np.eye(phi.shape[1]), (phi * weight).T @ target)
    parts = half @ w
    weights = sum(base[at:at + CHUNK].T.astype(np.float64) @ parts[at:at + CHUNK] for at in range(0, len(marks), CHUNK))
    return Model(names, codes, weights)


def train(docs: DataFrame, settings: FitSettings = FitSettings()) -> Model:
    """Fit on a bounded sample per language of rows that are not held out, have a language and a letter.

    The sample takes the rows with the least hash of their id; only sampled texts leave the executors.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= settings.max_chars)
                        & (fold_of(F.col("doc_id")) > 0) & F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return fit([], [], settings)
    # a row is taken when its hash is below its language's share; twice the rows asked for, the surplus is cut below
    most = settings.rows_of(len(counts))
    share = F.element_at(F.create_map(*[F.lit(x) for l, n in counts.items() for x in (l, min(1.0, 2 * most / n))]), F.col("lang"))
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    rows = (usable.withColumn("h", hashed).where(F.col("h") < share * float(1 << 40))
            .orderBy("h", "doc_id", "text").limit(3 * most * len(counts)).collect())
    taken: dict[str, int] = {}
    picked, seen = [], set()
    for r in rows:
        if taken.get(r["lang"], 0) < most and r["text"] not in seen:
            seen.add(r["text"])
            taken[r["lang"]] = taken.get(r["lang"], 0) + 1
            picked.append(r)
    return fit([r["text"] for r in picked], [r["lang"] for r in picked], settings)


def with_language(docs: DataFrame, model: Model, text: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1) of every whole text."""
    columns = [c for c in docs.columns if c not in out]
    kinds = dict(docs.dtypes)
    schema = "".join(f"`{c}` {kinds[c]}, " for c in columns) + f"`{out[0]}` string, `{out[1]}` double"

    def add(rows):
        return rows | dict(zip(out, model.predict(rows[text])))

    return per_batch(docs.select(*columns), add, schema)
