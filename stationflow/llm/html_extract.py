"""Main text of pages by a linear-chain conditional random field over leaf blocks.

Every leaf block of a page is main text or not. The field scores blocks by their ancestors (tags, words of their
classes, ids and roles) and their text, and neighbours by whether the label goes on. It is trained on
labelled pages by maximum likelihood and decoded by Viterbi.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed_sample, per_batch
from .html_pages import Block, blocks_of, made_pages

# Beginnings of class, id and role words, by what they usually frame.
GROUPS = {
    "ad": "ad ads adv advert banner sponsor promo".split(), "menu": "nav menu breadcrumb pagin pager tab toolbar".split(),
    "header": "header masthead topbar logo".split(), "footer": "footer copyright contentinfo legal colophon".split(),
    "side": "sidebar aside widget related complementary recommend more".split(), "share": "share social follow".split(),
    "notice": "cookie notice consent alert popup modal overlay gdpr newsletter subscri signup".split(),
    "comment": "comment repl disqus discuss respon feedback".split(), "form": "form search login".split(), "hidden": ["hidden"],
    "content": "article content post entry story main text body".split(),
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
LAYOUT = {"article", "main", "aside", "form", "nav", "footer", "header"}
SHORT = {"ad", "ads", "adv", "nav", "tab", "more"}


@dataclass(frozen=True)
class FitSettings:
    """Bounds of the fit: pages put together from frames, pages of the table, characters and blocks of such a page, rounds."""
    made: int = 360
    pages: int = 150
    max_chars: int = 60_000
    max_blocks: int = 200
    rounds: int = 250
    rate: float = 0.1
    ridge: float = 2e-5


def context_features(ancestors) -> list[str]:
    out = {f"near={ancestors[-1][0]}" if ancestors else "near=", "frame=" + next((tag for tag, _ in reversed(ancestors) if tag in LAYOUT), "")}
    for tag, words in ancestors:
        out.add(f"in={tag}")
        for w in words:
            out.add(f"word={w}")
            out.update(f"group={g}" for g, stems in GROUPS.items() if any(w == s if s in SHORT else w.startswith(s) for s in stems))
    return sorted(out)


def text_features(block: Block) -> list[str]:
    n = block.text.count(" ") + 1
    share = block.linked / max(len(block.text), 1)
    return [f"words={min(n.bit_length(), 6)}", f"linked={min(int(share * 3), 3)}", f"stop={block.text[-1] in '.!?'}", f"sign={'©' in block.text}"]


@dataclass(frozen=True)
class Model:
    """Weights of the features for main text, and of the four transitions."""
    weights: dict[str, float]
    moves: tuple[tuple[float, float], tuple[float, float]]
    contexts: dict = field(default_factory=dict, compare=False)

    def emission(self, block: Block) -> float:
        known = self.contexts.get(block.ancestors)
        if known is None:
            if len(self.contexts) > 20_000:
                self.contexts.clear()
            known = self.contexts[block.ancestors] = sum(self.weights.get(f, 0.0) for f in context_features(block.ancestors))
        return known + sum(self.weights.get(f, 0.0) for f in text_features(block))

    def decode(self, blocks: list[Block]) -> list[bool]:
        """Best labels of all blocks together; on a tie a block is left out."""
        if not blocks:
            return []
        (m00, m01), (m10, m11) = self.moves
        off, on, back = 0.0, self.emission(blocks[0]), []
        for b in blocks[1:]:
            e = self.emission(b)
            back.append((on + m10 > off + m00, on + m11 > off + m01))
            off, on = max(off + m00, on + m10), max(off + m01, on + m11) + e
        label, out = on > off, []
        for step in reversed(back):
            out.append(label)
            label = step[1] if label else step[0]
        return [label, *out[::-1]]

    def main_text(self, page: str | None) -> str:
        """Blocks of the main text, joined by line breaks; empty for a null or empty page."""
        blocks = blocks_of(page)
        return "\n".join([b.text for b, keep in zip(blocks, self.decode(blocks)) if keep])


def fit(pages: list[tuple[list[Block], list[bool]]], settings: FitSettings = FitSettings()) -> Model:
    """Maximum likelihood by Adam; forward and backward sums run over all pages at once, block by block."""
    pages = [p for p in pages if p[0]]
    seen = sorted({f for blocks, _ in pages for b in blocks for f in context_features(b.ancestors) + text_features(b)})
    at = {f: i for i, f in enumerate(seen)}
    longest = max(len(b) for b, _ in pages)
    x = np.zeros((sum(len(b) for b, _ in pages), len(seen) + 1))
    x[:, -1] = 1
    place, row = np.full((len(pages), longest), -1), 0
    y = np.zeros((len(pages), longest), dtype=np.int64)
    for k, (blocks, labels) in enumerate(pages):
        for t, b in enumerate(blocks):
            x[row, [at[f] for f in context_features(b.ancestors) + text_features(b)]] = 1
            place[k, t], y[k, t] = row, labels[t]
            row += 1
    real = place >= 0
    w, moves = np.zeros(x.shape[1]), np.zeros((2, 2))
    m, v = np.zeros(w.size + 4), np.zeros(w.size + 4)
    truth = np.zeros(len(x))
    truth[place[real]] = y[real]
    follows = real[:, 1:]
    seen_moves = np.array([[(follows & (y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    for step in range(1, settings.rounds + 1):
        e = np.zeros((len(pages), longest, 2))
        e[..., 1][real] = (x @ w)[place[real]]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, longest):
            nxt = np.logaddexp(alpha[:, t - 1, :1] + moves[0], alpha[:, t - 1, 1:] + moves[1]) + e[:, t]
            alpha[:, t] = np.where(real[:, t, None], nxt, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            ahead = e[:, t + 1] + beta[:, t + 1]
            nxt = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
            beta[:, t] = np.where(real[:, t + 1, None], nxt, beta[:, t])
        total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        chance = np.exp(alpha[..., 1] + beta[..., 1] - total[:, None])
        pair = alpha[:, :-1, :, None] + moves + (e + beta)[:, 1:, None, :] - total[:, None, None, None]
        expected = np.exp(pair)[follows].sum(axis=0)
        g = np.zeros_like(m)
        hope = np.zeros(len(x))
        hope[place[real]] = chance[real]
        g[:w.size] = x.T @ (hope - truth) / len(x) + settings.ridge * w
        g[w.size:] = ((expected - seen_moves) / len(x) + settings.ridge * moves).ravel()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        delta = settings.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, moves = w - delta[:w.size], moves - delta[w.size:].reshape(2, 2)
    # the constant feature belongs to every block
    weights = dict(zip(seen, w.tolist()))
    for f in seen:
        if f.startswith("words="):
            weights[f] += float(w[-1])
    return Model(weights, tuple(map(tuple, moves.tolist())))


def labelled_by_text(page: str, text: str) -> tuple[list[Block], list[bool]]:
    """Blocks of a page whose main text is known: those that are lines of the text, or headings that begin one, are main text."""
    lines = [" ".join(line.split()) for line in text.split("\n")]
    whole, blocks = set(lines), blocks_of(page)
    heads = {b.text for b in blocks if b.ancestors and b.ancestors[-1][0] in HEADINGS and any(line.startswith(b.text) for line in lines)}
    return blocks, [b.text in whole or b.text in heads for b in blocks]


def train(pages: DataFrame | None = None, documents: DataFrame | None = None, settings: FitSettings = FitSettings()) -> Model:
    """Fit on pages put together from frames and, if given, on a bounded hashed sample of ``pages``.

    A sampled page is labelled by the document its address names by number (the first number after a slash). Pages without such a document,
    without any of its lines, or beyond the bounds in :class:`FitSettings` are not learnt from.
    """
    labelled = [(blocks_of(p), labels) for p, labels in made_pages(settings.made)]
    if pages is not None and documents is not None:
        spark = pages.sparkSession
        number = F.regexp_extract("url", r"/(\d{1,18})", 1)
        slim = pages.select("page_id", F.when(number != "", number.cast("bigint")).alias("doc_id")).where("doc_id IS NOT NULL AND page_id IS NOT NULL")
        chosen = [(r["page_id"], r["doc_id"]) for r in hashed_sample(slim.distinct(), ["page_id", "doc_id"], settings.pages).collect()]
        if chosen:
            # at most settings.pages rows on either side, and one row of each id whatever its repeats
            some = F.broadcast(spark.createDataFrame(chosen, f"page_id {dict(pages.dtypes)['page_id']}, doc_id bigint"))
            texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").join(some.select("doc_id").distinct(), "doc_id", "left_semi")
                     .where(F.length("text") <= settings.max_chars).groupBy("doc_id").agg(F.min("text").alias("text")).collect()}
            first = F.min(F.struct("doc_id", "html")).alias("first")
            found = pages.select("page_id", "html").join(some, "page_id").where(F.length("html") <= settings.max_chars).groupBy("page_id").agg(first)
            found = found.select("page_id", "first.doc_id", "first.html").orderBy("page_id").collect()
            for r in found:
                if r["doc_id"] in texts:
                    blocks, labels = labelled_by_text(r["html"], texts[r["doc_id"]])
                    if any(labels) and len(blocks) <= settings.max_blocks:
                        labelled.append((blocks, labels))
    return fit(labelled, settings)


def main_texts(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars) of every page's whole html. Null and empty pages give an empty text."""
    schema = f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars bigint"

    def extract(rows):
        texts = list(map(model.main_text, rows["html"]))
        return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": list(map(len, texts))}

    return per_batch(pages.select("page_id", "url", "html"), extract, schema, rows=256)
