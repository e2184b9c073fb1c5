"""Benchmark decontamination: rare n-gram seeds, then local alignment.

The words and adjacent word pairs of the test items are counted over all documents. Of every piece of an item its rare n-grams become
seeds: the commonest ones are left out, but never more than every sufficient alignment has to keep, so that each of them holds a seed
however common the item, the copy or the edit is. Seeds join documents to items: a document that has a seed of an item and enough of
its words is aligned with it, around the seed, by Smith-Waterman over words; the score is the alignment's share of a perfect one.
Test items go through in blocks of bounded size, two passes over the documents for each block.

The guarantee. An alignment of m matches and e other columns scores 2m - e. Its matches form at most e + 1 runs, so one that scores s
holds at least m - (e + 1) >= s - 1 - m >= s - 1 - length adjacent pairs, and at least s / 2 matches. Of a piece with P places one of
the P - kept + 1 rarest is therefore in the text. Items whose 50 words are enough are cut into pieces that every 50 words in a row
fit into, and into pieces that lie side by side. Every alignment that scores enough of a whole item, or of such a piece, is found. Only one
worth 50 words of a longer item that is so thinly spread that no piece has its share may be missed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import arrow_schema, per_batch

WORDS = re.compile(r"[^\W_]+")
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of a seed.
WIDTHS = (1, 2)


@dataclass(frozen=True)
class Settings:
    """Least score, words below which an item is needed whole, aligned words that are enough of any item, items and characters of a block of items."""
    least: float = 0.6
    whole: int = 3
    run: int = 50
    block_items: int = 20_000
    block_chars: int = 8_000_000

    def needed(self, length):
        """Words whose matches an alignment with an item of ``length`` words has to be worth."""
        return np.minimum(np.maximum(self.least * length, np.minimum(length, self.whole)), self.run)

    def kept(self, length: int, width: int) -> int:
        """Places of ``width`` adjacent words that every alignment worth ``needed`` words keeps."""
        score = math.ceil(MATCH * float(self.needed(length)) - 1e-9)
        return math.ceil(score / MATCH) if width == 1 else score - 1 - length

    def pieces(self, length: int) -> list[tuple[int, int]]:
        """Parts of an item that get seeds of their own: the whole item, or for longer ones overlapping and adjacent parts."""
        size = int(self.run / self.least + 1e-9)
        if length <= size:
            return [(0, length)]
        overlapping = [*range(0, length - size, size - self.run + 1), length - size]
        return sorted({(a, a + size) for a in overlapping} | {(a, min(a + size, length)) for a in range(0, length, size)})


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def spans(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of ``rows`` in a list that is cut at ``first``, and how many each row has."""
    n = first[rows + 1] - first[rows]
    return np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


def look_up(known: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of those codes that are in the ordered list ``known``, and their numbers there."""
    some = np.flatnonzero(codes) if len(known) else np.zeros(0, dtype=np.int64)
    number = np.minimum(np.searchsorted(known, codes[some]), len(known) - 1)
    hit = known[number] == codes[some]
    return some[hit], number[hit]


@dataclass
class Block:
    """Test items of one block with their words as numbers and their n-grams as codes.

    ``grams`` are the distinct codes in order. ``words`` and ``times`` list the distinct words of the items and how often each
    stands in its item, cut at ``word_first``. ``choose`` sets ``seeds``, codes in order, and ``owner``, their items, cut at ``seed_first``;
    ``held`` has the places and numbers of each item's own seeds.
    """
    items: list[tuple[int, np.ndarray]]
    vocab: dict[str, int]
    settings: Settings

    def __post_init__(self):
        self.grams = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *(self.codes(w, n) for _, w in self.items for n in WIDTHS)]))
        bags = [np.unique(w, return_counts=True) for _, w in self.items]
        self.words = np.concatenate([np.zeros(0, dtype=np.int64), *(w for w, _ in bags)])
        self.times = np.concatenate([np.zeros(0, dtype=np.int64), *(n for _, n in bags)])
        self.word_first = np.cumsum([0, *(len(w) for w, _ in bags)])
        self.lengths = np.array([len(w) for _, w in self.items], dtype=np.int64)

    @classmethod
    def of(cls, rows: list[tuple[int, str]], settings: Settings) -> Block:
        vocab: dict[str, int] = {}
        items = [(i, np.array([vocab.setdefault(w, len(vocab) + 1) for w in words_of(t)], dtype=np.int64)) for i, t in rows]
        return cls([x for x in items if len(x[1])], vocab, settings)

    def codes(self, ids: np.ndarray, n: int) -> np.ndarray:
        """Code of the n words from each place on, 0 where one of them is in no item. The number of words is part of it."""
        if len(ids) < n:
            return np.zeros(0, dtype=np.int64)
        base, code, known = len(self.vocab) + 1, np.zeros(len(ids) - n + 1, dtype=np.int64), np.ones(len(ids) - n + 1, dtype=bool)
        for k in range(n):
            part = ids[k:len(ids) - n + 1 + k]
            code, known = code * base + part, known & (part > 0)
        return np.where(known, code * 4 + n, 0)

    def ids(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.vocab.get, words, repeat(0)), dtype=np.int64, count=len(words))

    def rare(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Seeds of one piece: its rarest places, as many as the guarantee takes, words or pairs, whichever the documents hold less often."""
        best, least = None, None
        for n in WIDTHS:
            must = self.settings.kept(len(words), n)
            if must < 1:
                continue
            codes = self.codes(words, n)
            times = counts[np.searchsorted(self.grams, codes)]
            rarest = np.argsort(times, kind="stable")[:len(codes) - must + 1]
            if least is None or times[rarest].sum() < least:
                best, least = codes[rarest], times[rarest].sum()
        return best

    def choose(self, counts: np.ndarray) -> Block:
        """Take the seeds of every item, by how often each of ``grams`` stands in the documents. A seed no document has finds nothing and is left out."""
        chosen = []
        for _, words in self.items:
            codes = np.unique(np.concatenate([self.rare(words[a:b], counts) for a, b in self.settings.pieces(len(words))]))
            chosen.append(codes[counts[np.searchsorted(self.grams, codes)] > 0])
        flat, owner = np.concatenate([np.zeros(0, dtype=np.int64), *chosen]), np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        self.seeds, first = np.unique(flat[order], return_index=True)
        self.seed_first = np.append(first, len(flat))
        self.widths = [n for n in WIDTHS if (self.seeds % 4 == n).any()] or WIDTHS[:1]
        self.held = []
        for (_, words), codes in zip(self.items, chosen):
            found = [look_up(codes, self.codes(words, n)) for n in WIDTHS]
            self.held.append((np.concatenate([at for at, _ in found]), np.searchsorted(self.seeds, codes[np.concatenate([number for _, number in found])])))
        return self

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the seeds in a text, ordered by number."""
        found = [look_up(self.seeds, self.codes(ids, n)) for n in self.widths]
        places, numbers = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(numbers, kind="stable")
        return places[order], numbers[order]

    def possible(self, ids: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        """Items that have one of the seeds and ``needed`` of whose words, each as often as it stands in both, are in the text.

        A match gives what one word of a perfect alignment gives and nothing else gives more than 0, so no other item can score enough.
        """
        items = np.unique(self.owner[spans(self.seed_first, np.unique(seeds))[0]])
        if not len(items):
            return items
        in_text, n = np.unique(ids, return_counts=True)
        at, sizes = spans(self.word_first, items)
        found = np.minimum(np.searchsorted(in_text, self.words[at]), len(in_text) - 1)
        both = np.where(in_text[found] == self.words[at], np.minimum(n[found], self.times[at]), 0)
        return items[np.add.reduceat(both, np.cumsum(sizes) - sizes) >= self.settings.needed(self.lengths[items]) - 1e-9]

    def offsets(self, k: int, places: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Where item ``k`` would begin in a text, by each of its seeds there."""
        at, seed = self.held[k]
        lo = np.searchsorted(numbers, seed)
        n = np.searchsorted(numbers, seed, side="right") - lo
        return np.unique(places[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())] - np.repeat(at, n))


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and the place in ``text`` where it ends. One numpy row per word of the item."""
    steps = np.arange(len(text) + 1) * -GAP
    row, best, end = np.zeros(len(text) + 1, dtype=np.int64), 0, 0
    for w in item:
        new = np.zeros_like(row)
        new[1:] = row[:-1] + np.where(text == w, MATCH, MISMATCH)
        np.maximum(new, row + GAP, out=new)
        np.maximum(new, 0, out=new)
        # a gap in the item costs the same for each word, so running maxima carry it along the row
        row = np.maximum.accumulate(new + steps) - steps
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def stretches(offsets: np.ndarray, length: int, reach: int, size: int) -> list[tuple[int, int]]:
    """Windows from ``reach`` before each offset to ``reach`` after the item's end, those that overlap joined to one."""
    out: list[tuple[int, int]] = []
    for o in offsets.tolist():
        lo, hi = max(0, o - reach), min(size, o + length + reach)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def crowded(member: np.ndarray, width: int, needed: float) -> bool:
    """Whether ``needed`` of some ``width`` words in a row are words of the item, as ``member`` says."""
    total = np.append(0, np.cumsum(member))
    width = min(width, len(member))
    return (total[width:] - total[:len(total) - width]).max() >= needed - 1e-9


def aligned(block: Block, text: str | None) -> list[tuple[int, float, int]]:
    """(item, score, last word) of the best alignment with every item that has a seed in the text, if it scores enough.

    That is ``least`` of the whole item, or for longer items ``run`` words' worth, and at least ``whole`` words' worth or the whole item. The
    score stays a share of the whole item.
    An alignment that does has at most ``reach`` words more than the item, so the stretches hold every one that passes through a seed.
    Where fewer words of a stretch are words of the item than it takes, no alignment can reach it and none is computed.
    """
    ids = block.ids(text)
    if not len(block.seeds) or not ids.any():
        return []
    places, numbers = block.hits(ids)
    out = []
    for k in block.possible(ids, numbers).tolist():
        item_id, item = block.items[k]
        needed = float(block.settings.needed(len(item)))
        reach = math.ceil(MATCH * (len(item) - needed))
        own = np.zeros(len(block.vocab) + 1, dtype=bool)
        own[item] = True
        member = own[ids]
        best, end = 0, 0
        for lo, hi in stretches(block.offsets(k, places, numbers), len(item), reach, len(ids)):
            if not crowded(member[lo:hi], len(item) + reach, needed):
                continue
            score, at = smith_waterman(item, ids[lo:hi])
            if score > best:
                best, end = score, lo + at
        if best >= MATCH * needed - 1e-9:
            out.append((item_id, best / (MATCH * len(item)), end))
    return out


def blocks(benchmark: DataFrame, settings: Settings):
    """Test items in blocks, each bounded in items and characters; only one block is on the driver at a time. A longer item is a block by itself."""
    rows, chars = [], 0
    for r in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        if rows and (len(rows) >= settings.block_items or chars + len(r["text"]) > settings.block_chars):
            yield Block.of(rows, settings)
            rows, chars = [], 0
        rows.append((r["item_id"], r["text"]))
        chars += len(r["text"])
    if rows:
        yield Block.of(rows, settings)


def frequencies(docs: DataFrame, block: Block) -> np.ndarray:
    """How often each of the block's ``grams`` stands in all documents. A task adds up its rows in one array and sends it once."""
    target = arrow_schema("gram bigint, n bigint")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(block.grams), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                # a 0 after each text, so that no pair reaches over its end
                parts = [x for text in batch.column(0).slice(at, 512).to_pylist() for x in (block.ids(text), (0,))]
                ids = np.concatenate(parts)
                for n in WIDTHS:
                    total += np.bincount(look_up(block.grams, block.codes(ids, n))[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], schema=target)

    out = np.zeros(len(block.grams), dtype=np.int64)
    for r in docs.select("text").mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[r["gram"]] = r["n"]
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, item_id, score, last_word, *extra) of every document and item that align with ``settings.least`` of the item or ``settings.run`` words of it.

    Null and empty texts and items without a word give nothing. Repeated documents each give their rows; repeated items too.
    """
    kinds = dict(docs.dtypes)
    schema = f"doc_id {kinds['doc_id']}, item_id bigint, score double, last_word bigint" + "".join(f", `{c}` {kinds[c]}" for c in extra)
    found = None
    for block in blocks(benchmark, settings):
        block.choose(frequencies(docs, block))

        def align(rows, block=block):
            hits = [(i, *hit) for i, text in enumerate(rows["text"]) for hit in aligned(block, text)]
            out = {"item_id": [h[1] for h in hits], "score": [h[2] for h in hits], "last_word": [h[3] for h in hits]}
            return out | {c: [rows[c][h[0]] for h in hits] for c in ("doc_id", *extra)}

        part = cut_lineage(per_batch(docs.select("doc_id", "text", *extra), align, schema), "leaks")
        found = part if found is None else found.union(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def per_document(found: DataFrame) -> DataFrame:
    """One row per document with a leak: its items, the best score and how many there are."""
    return found.groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("score").alias("score"), F.count_distinct("item_id").alias("n_items"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the rows that hold an item; a row is judged by its own text, whatever its id.

    Each block of items is a pass that counts, over ``docs`` as given, and one that tests and filters at once, so no row moves.
    """
    columns = docs.columns
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    out = docs
    for block in blocks(benchmark, settings):
        block.choose(frequencies(docs, block))

        def clean(rows, block=block):
            keep = [i for i, text in enumerate(rows["text"]) if not aligned(block, text)]
            return {c: [rows[c][i] for i in keep] for c in columns}

        out = per_batch(out, clean, schema)
    return out
