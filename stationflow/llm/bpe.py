"""Byte-pair encoding by speculation: propose tokens greedily, check neighbours, merge only what fails.

A word's greedy longest-match tokens are its encoding exactly if every two neighbours, encoded together, stay as
they are. That holds for merge tables in which each merge comes after the merges that make its two halves; a table
where this fails is refused. The neighbour check runs on all pairs of a batch at once, in numpy; words
with a failing pair are merged one by one.
"""

from __future__ import annotations

import heapq
import functools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KeyIndex, per_batch

NEVER = 1 << 40
#: Runs of text remembered per Python worker. Beyond it they become the older generation, from which those met
#: again are taken over, and the generation before is forgotten.
KEPT = 120_000
#: Longer words are merged one by one, so that no table of words gets wide.
WIDE = 48
POWERS = np.array([pow(0x100000001B3, n, 1 << 64) for n in range(256)], dtype=np.uint64)
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """Printable stand-ins of the 256 byte values, as byte-level vocabularies write them."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


def text_key(data: bytes) -> int:
    """Key of a byte string, as :meth:`WordBPE.propose` builds it up byte by byte."""
    return sum((b + 1) * int(POWERS[n]) for n, b in enumerate(data)) % (1 << 64)


class WordBPE:
    """Encoder and decoder of one vocabulary file of the word-end kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        #: Special tokens as runs of text; a run of words has no space, so nothing else looks like them.
        self.marks = {" " + s: i for s, i in self.specials.items()}
        self.text_of = {i: s for s, i in (self.vocab | self.specials).items()}
        self.words = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in self.specials) + ")")
        self.symbols = dict(enumerate(byte_symbols()))
        self._tables([tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]])
        self.known: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}
        self.encoded: dict[str, tuple[bytes, str]] = {}

    def _tables(self, merges):
        size = max(self.vocab.values()) + 1
        self.left, self.right = np.arange(size), np.arange(size)
        self.rank = np.full(size, -1, dtype=np.int64)
        self.rank_of_pair: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for r, (a, b) in enumerate(merges):
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            if max(self.rank[x], self.rank[y]) >= r:
                raise ValueError(f"merge {r} comes before the merges of its halves")
            self.rank_of_pair[x, y] = r
            self.made.append(z)
            if self.rank[z] < 0:
                self.left[z], self.right[z], self.rank[z] = x, y, r
        self.size = size
        self.pair_ranks = KeyIndex(np.array([x * size + y for x, y in self.rank_of_pair]), np.array(list(self.rank_of_pair.values())))
        self.made_of = np.array(self.made)
        #: Tokens that merging really arrives at from their own characters; only these are proposed.
        reached = [(s, t) for s, t in self.vocab.items() if self.merged(self._pieces(s)) == [t]]
        byte_of = {c: b for b, c in self.symbols.items()}
        last = [(bytes(map(byte_of.get, s.removesuffix(self.end))), t) for s, t in reached if s.endswith(self.end)]
        inner = [(bytes(map(byte_of.get, s)), t) for s, t in reached if not s.endswith(self.end)]
        self.longest_inner, self.longest_last = max(len(s) for s, _ in inner), max(len(s) for s, _ in last)
        self.inner, self.last = (KeyIndex(np.array([text_key(s) for s, _ in some], dtype=np.uint64), np.array([t for _, t in some])) for some in (inner, last))
        self.length = np.zeros(size, dtype=np.int64)
        for s, t in inner + last:
            self.length[t] = len(s)
        self.first_ids = np.array([self.vocab.get(self.symbols[b], -1) for b in range(256)])
        self.last_ids = np.array([self.vocab.get(self.symbols[b] + self.end, -1) for b in range(256)])
        if min(self.first_ids.min(), self.last_ids.min()) < 0:
            raise ValueError("a byte is missing from the vocabulary")

    def _pieces(self, token: str) -> list[int] | None:
        """Ids of a token's characters; the last one carries the word end."""
        body = token.removesuffix(self.end)
        if not body:
            return None
        try:
            ids = [self.vocab[c] for c in body]
            return ids if body == token else [*ids[:-1], self.vocab[body[-1] + self.end]]
        except KeyError:
            return None

    def merged(self, ids: list[int] | None) -> list[int]:
        """Exact merging: the lowest rank first, leftmost among equals."""
        ids, rank = list(ids or ()), self.rank_of_pair.get
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        # entries of pairs that have changed since are passed over when they come up
        waiting = [(r, i) for i, p in enumerate(zip(ids, ids[1:])) if (r := rank(p, NEVER)) < NEVER]
        heapq.heapify(waiting)
        while waiting:
            low, i = heapq.heappop(waiting)
            j = after[i]
            if ids[i] is None or j == len(ids) or rank((ids[i], ids[j]), NEVER) != low:
                continue
            ids[i], ids[j], after[i] = self.made[low], None, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < len(ids) and (r := rank((ids[left], ids[after[left]]), NEVER)) < NEVER:
                    heapq.heappush(waiting, (r, left))
        return [x for x in ids if x is not None]

    def propose(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest token first, from the left, for all words at once; the last token of a word carries the word end.

        ``data`` holds the words' bytes one after the other. Returns the tokens and the word of each, in order.
        """
        end_of = np.repeat(ends, ends - starts)
        token = self.first_ids[data]
        token[ends - 1] = self.last_ids[data[ends - 1]]
        key, live = np.zeros(len(data), dtype=np.uint64), np.arange(len(data))
        for n in range(1, max(self.longest_inner, self.longest_last) + 1):
            live = live[live + n <= end_of[live]]
            key[live] += (data[live + n - 1].astype(np.uint64) + np.uint64(1)) * POWERS[n - 1]
            closes = live + n == end_of[live]
            for some, index in ((live[~closes], self.inner), (live[closes], self.last)):
                found = index.find(key[some], -1)
                token[some[found >= 0]] = found[found >= 0]
        tokens, words = [], []
        word, at = np.arange(len(starts)), starts
        while len(word):
            here = token[at]
            tokens.append(here)
            words.append(word)
            at = at + self.length[here]
            on = at < ends[word]
            word, at = word[on], at[on]
        tokens, words = np.concatenate(tokens), np.concatenate(words)
        order = np.argsort(words, kind="stable")
        return tokens[order], words[order]

    def merge_all(self, ids: np.ndarray) -> list[list[int]]:
        """Exact merging of many words; a row holds a word's ids, filled up with -1."""
        out: list[list[int]] = [[]] * len(ids)
        row, ranks = np.arange(len(ids)), np.full((len(ids), max(ids.shape[1] - 1, 1)), NEVER)
        both = (ids[:, :-1] >= 0) & (ids[:, 1:] >= 0)
        ranks[:, :ids.shape[1] - 1][both] = self._rank_of((ids[:, :-1] * self.size + ids[:, 1:])[both])
        while len(row):
            best = ranks.argmin(axis=1)
            low = ranks[np.arange(len(row)), best]
            done = low == NEVER
            for r, left in zip(row[done].tolist(), ids[done].tolist()):
                out[r] = [i for i in left if i >= 0]
            row, ids, ranks, best, low = row[~done], ids[~done], ranks[~done], best[~done], low[~done]
            if not len(row):
                break
            each = np.arange(len(row))
            ids[each, best] = self.made_of[low]
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > best[:, None]), axis=1)
            columns = np.arange(max(ids.shape[1] - 1, 1))
            ranks = np.take_along_axis(ranks, np.minimum(columns + (columns >= best[:, None]), ranks.shape[1] - 1), axis=1)
            for at in (best - 1, best):
                r = each[(at >= 0) & (at < ranks.shape[1])]
                a = at[r]
                x, y = ids[r, a], ids[r, np.minimum(a + 1, ids.shape[1] - 1)]
                real = (y >= 0) & (a + 1 < ids.shape[1])
                ranks[r, a] = NEVER
                ranks[r[real], a[real]] = self._rank_of(x[real] * self.size + y[real])
        return out

    def pairs_hold(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether each two tokens, standing side by side, come out of merging unchanged.

        Followed backwards from the finished tokens: at each step the token made last is taken apart at the inner
        edge. A merge across the border that would have come before the two edge pieces grew refutes
        the pair. Grown pieces carry the rank of the growth; on a tie the left of two equal merges goes first.
        """
        x, y = x.astype(np.int64), y.astype(np.int64)
        grown_x, grown_y = np.full(len(x), NEVER), np.full(len(x), NEVER)
        ok, live = np.ones(len(x), dtype=bool), np.arange(len(x))
        while len(live):
            a, b = x[live], y[live]
            across = self._rank_of(a * self.size + b)
            bad = (across < grown_x[live]) & (across <= grown_y[live])
            ok[live[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            more = ~bad & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[more], a[more], b[more], ra[more], rb[more]
            open_y = rb >= ra
            s = live[open_y]
            grown_y[s], y[s] = rb[open_y], self.left[b[open_y]]
            s = live[~open_y]
            grown_x[s], x[s] = ra[~open_y], self.right[a[~open_y]]
        return ok

    def _rank_of(self, keys):
        return self.pair_ranks.find(keys, NEVER)

    def learn(self, chunks: set[str]) -> None:
        """Encode new runs of text without white space; remember them as packed ids and as tokens."""
        parts = {c: [c] if c in self.marks else self.words.findall(c) for c in chunks}
        self.learn_words(set(chain.from_iterable(parts.values())).difference(self.encoded))
        encoded, known = self.encoded, self.known
        for c, words in parts.items():
            if len(words) == 1:
                known[c] = encoded[words[0]]
            else:
                both = [encoded[w] for w in words]
                known[c] = (b"".join([w[0] for w in both]), " ".join([w[1] for w in both]))

    def learn_words(self, words: set[str]) -> None:
        plain = [w for w in words if w not in self.marks]
        tokens = {w: [self.marks[w]] for w in words if w in self.marks}
        if plain:
            raw = [w.encode() for w in plain]
            sizes = np.array(list(map(len, raw)))
            ends = np.cumsum(sizes)
            starts, data = ends - sizes, np.frombuffer(b"".join(raw), dtype=np.uint8)
            ids, word = self.propose(data, starts, ends)
            inside = np.flatnonzero(word[1:] == word[:-1])
            wrong = np.zeros(len(plain), dtype=bool)
            wrong[word[inside[~self.pairs_hold(ids[inside], ids[inside + 1])]]] = True
            cuts = np.flatnonzero(np.diff(word, prepend=-1))
            flat = ids.tolist()
            for w, a, b in zip(plain, cuts.tolist(), [*cuts[1:].tolist(), len(flat)]):
                tokens[w] = flat[a:b]
            # two texts of one key are as good as impossible, yet the tokens have to spell the word
            for k, w in enumerate(plain):
                if "".join([self.text_of[t] for t in tokens[w]]) != self.form(w) + self.end:
                    wrong[k] = True
            self._merge_failed(plain, raw, np.flatnonzero(wrong), sizes, tokens)
        for w, t in tokens.items():
            self.encoded[w] = (array("i", t).tobytes(), self.decode(t))

    def _merge_failed(self, plain, raw, failed, sizes, tokens):
        long = sizes[failed] > WIDE
        for k in failed[long].tolist():
            tokens[plain[k]] = self.merged(self._pieces(self.form(plain[k]) + self.end))
        failed = failed[~long]
        failed = failed[np.argsort(sizes[failed])]
        for part in np.array_split(failed, max(1, len(failed) // 1000)):
            if len(part):
                width = int(sizes[part].max())
                data = np.frombuffer(b"".join([raw[k].ljust(width, b"\0") for k in part.tolist()]), dtype=np.uint8).reshape(len(part), width)
                ids = self.first_ids[data]
                ids[np.arange(width) >= sizes[part][:, None]] = -1
                each = np.arange(len(part))
                ids[each, sizes[part] - 1] = self.last_ids[data[each, sizes[part] - 1]]
                for k, t in zip(part.tolist(), self.merge_all(ids)):
                    tokens[plain[k]] = t

    def form(self, word: str) -> str:
        """The word's UTF-8 bytes as byte symbols."""
        if word.isascii() and word.isprintable():
            return word
        return word.encode().decode("latin-1").translate(self.symbols)

    def split(self, text: str) -> list[str]:
        """Special tokens, each after a space, and runs without white space of what stands between them, in lower case."""
        out: list[str] = []
        for i, part in enumerate(self.special.split(text) if "<|" in text else (text,)):
            if i % 2:
                out.append(" " + part)
            elif part:
                # a capital sigma turns into the same small one wherever it stands
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                # str.split takes four control characters for white space that the word pattern does not
                out += self.words.findall(part) if SEPARATORS.search(part) else part.split()
        return out

    def encode(self, texts: list[str | None]) -> Iterator[list[tuple[bytes, str]]]:
        """For every text, its runs of words as (packed ids, tokens joined by spaces)."""
        for at in range(0, len(texts), 64):
            split = [self.split(t or "") for t in texts[at:at + 64]]
            new = set().union(*split).difference(self.known)
            if len(self.known) + len(new) > KEPT:
                self.older, self.known, self.encoded = self.known, {}, {}
                new = set().union(*split)
            back = {c: self.older[c] for c in new if c in self.older}
            self.known.update(back)
            if len(new) > len(back):
                self.learn(new.difference(back))
            for chunks in split:
                yield list(map(self.known.__getitem__, chunks))

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.text_of[i] for i in ids])


@functools.cache
def load(path: str) -> WordBPE:
    """One encoder per Python worker."""
    return WordBPE(path)


def encode_documents(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``ids`` (array of int) and ``decoded`` (tokens joined by one space) of every whole text.

    Null and empty texts give no ids and an empty decoded text. ``path`` names a vocabulary file that
    every executor can open, as installed packages are. Rows pass one by one: repeated rows stay, and other
    columns, whatever their names, are left behind.
    """
    kinds = dict(docs.dtypes)
    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "ids array<int>, decoded string"

    def encode(rows):
        model, packed, shown = load(path), [], []
        for words in model.encode(rows[text]):
            packed.append(b"".join([w[0] for w in words]))
            shown.append(" ".join([w[1] for w in words]))
        ends = np.cumsum([0] + [len(p) // 4 for p in packed])
        values = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"))
        ids = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), values).cast(pa.list_(pa.int32()))
        return {c: rows[c] for c in keep} | {"ids": ids, "decoded": shown}

    return per_batch(docs.select(*{*keep, text}), encode, schema, rows=256)


def digests(encoded: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Number of tokens and SHA-256 of the ids and of the decoded text."""
    as_text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(*keep, F.size("ids").cast("long").alias("n_tokens"), F.sha2(as_text.cast("binary"), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
