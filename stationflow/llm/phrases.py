"""Phrase collocations by dynamic itemset counting.

The corpus is cut into shards that are scanned in turn, round and round. All words are counted from the first scan on. A longer phrase becomes active
with the scan after the one in which both its subphrases (without its last and without its first word) reached the threshold, and is
counted for one full cycle, so every count is exact. No phrase below the threshold can be part of one above it, so nothing is missed.

Tasks learn what has reached the threshold from a table with one byte per slot of a phrase's hash: the scan in which a phrase of that slot first
did. A shared slot can only make a phrase active that need not be; it is still counted for a full cycle, exactly. Bytes are never changed once set,
so every scan derives the same activation of a phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path

LEAST = 30
MOST_WORDS = 4
SHARDS = 2
TOP = 2000
#: Slots of each of the three tables: about one per CHARS_A_SLOT characters, at most 2^MOST_BITS.
MOST_BITS, CHARS_A_SLOT = 24, 32
#: Bytes of text that are taken apart at once: at most a million words, so the codes of the words held and of a chunk stay below 2^21.
CHUNK, CODE = 1 << 21, (1 << 21) - 1
#: Words a task tells apart before it hands its counts on and starts anew.
MOST_HELD = 1 << 19
#: Places a task collects of one length before it adds equal ones up, and different phrases it holds before it hands them on.
GATHER, HOLD = 600_000, 200_000
NEVER = 255
UNKNOWN = "und"
#: A-Z lower-cased, the ends of pieces as full stops, a tab as a space.
LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\x0a\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9 + b" ")
FOUND = "lang string, n int, phrase string, start int, c bigint"

# ---- inside a task ---------------------------------------------------------------------------


def mixed(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its words but the last, and its last word's."""
    x = (x ^ h) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def slots(x: np.ndarray, bits: int) -> np.ndarray:
    return ((x * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - bits)).astype(np.int64)


def order_key(n: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """One number to order phrases by, so that equal ones lie side by side. Up to three codes fit one number; phrases of four are mixed, and
    two that share a number may part equal ones, which are then handed on as two counts and added up later."""
    if n < 4:
        return high << 21 | low
    return (high.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (low.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def word_hash(lang: str, word: str) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang))


class Words(dict):
    """Codes of words; code 0 stands for the end of a piece and for words that can be part of nothing that is counted now."""

    def __init__(self, lang: str, table: np.ndarray, bits: int, all_words: bool):
        super().__init__({".": 0})
        self.seed, self.table, self.bits, self.all_words = xxhash.xxh64_intdigest(lang), table, bits, all_words
        self.words, self.hashes, self.reached = [""], [0], [NEVER]
        self.arrays = None

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word, self.seed)
        x = (h * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 29
        reached = int(self.table[((x * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)])
        code = 0
        if reached != NEVER or self.all_words:
            code = len(self.words)
            self.words.append(word)
            self.hashes.append(h)
            self.reached.append(reached)
        self[word] = code
        return code

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and reached scans by code."""
        if self.arrays is None or len(self.arrays[0]) != len(self.words):
            self.arrays = np.array(self.hashes, dtype=np.uint64), np.array(self.reached, dtype=np.int16)
        return self.arrays


def chunks(text: bytes) -> Iterator[tuple[pa.Array, int]]:
    """Words of a text and how many of them the chunk before had already; an end of a piece is the word ``.``."""
    at, kept = 0, b""
    while at < len(text):
        end = at + CHUNK
        if end >= len(text):
            end, whole = len(text), True
        else:
            cut = text.rfind(b".", at, end)
            whole = cut >= at
            if not whole:
                cut = text.rfind(b" ", at, end)
            if cut < at:  # a word that is longer than a chunk
                cut = min((p for p in (text.find(b" ", end), text.find(b".", end)) if p >= 0), default=len(text)) - 1
            end = cut + 1
        body = b" ".join([kept, text[at:end].replace(b".", b" . ")]).strip(b" ")
        had = len(kept.split())
        if body:
            yield pa.compute.ascii_split_whitespace(pa.array([body], pa.binary()).cast(pa.string())).flatten(), had
        kept, at = b"" if whole else b" ".join(body.rsplit(maxsplit=MOST_WORDS - 1)[-(MOST_WORDS - 1):]), end


class Counter:
    """Counts of the active phrases of one language within a task."""

    def __init__(self, lang: str, scan: int, shards: int, tables: np.ndarray, bits: int):
        self.lang, self.scan, self.shards, self.tables, self.bits = lang, scan, shards, tables, bits
        self.total = 0
        self.renew()

    def renew(self):
        self.words = Words(self.lang, self.tables[0], self.bits, self.scan < self.shards)
        self.singles, self.begun = np.zeros(1, dtype=np.int64), False
        self.gathered = {n: [] for n in range(2, MOST_WORDS + 1)}
        self.held = {n: 0 for n in range(2, MOST_WORDS + 1)}

    def codes(self, different: list[str]) -> np.ndarray:
        return np.fromiter(map(self.words.__getitem__, different), dtype=np.int64, count=len(different))

    def add(self, words: pa.Array, had: int) -> Iterator[pa.Table]:
        coded = words.dictionary_encode()
        places, different = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        codes = self.codes(different)
        if len(self.words) > MOST_HELD and self.begun:  # start anew with this chunk
            yield from self.tables_out()
            self.renew()
            codes = self.codes(different)
        self.begun = True
        ids = codes[places]
        hashes, reached = self.words.numbers()
        if self.scan < self.shards:
            new = np.bincount(ids[had:], minlength=len(hashes))
            new[: len(self.singles)] += self.singles
            self.total += len(ids) - had - int(new[0])
            new[0] = 0
            self.singles = new
        level, x = reached[ids], mixed(np.uint64(0), hashes[ids])
        for n in range(2, MOST_WORDS + 1):
            if len(level) < 2 or self.scan < n - 1:
                return
            start = np.maximum(level[:-1], level[1:]) + 1
            at = np.flatnonzero((start <= self.scan) & (self.scan < start + self.shards))
            at = at[at + n > had]
            if len(at):
                yield from self.gather(n, ids, at, start[at])
            x = mixed(x[:-1], hashes[ids[n - 1:]])
            level = np.full(len(start), NEVER, dtype=np.int16)
            if n < MOST_WORDS:
                live = np.flatnonzero(start <= NEVER)
                level[live] = np.maximum(self.tables[n - 1][slots(x[live], self.bits)], start[live])

    def gather(self, n: int, ids: np.ndarray, at: np.ndarray, start: np.ndarray) -> Iterator[pa.Table]:
        high = np.zeros(len(at), dtype=np.int64)
        for k in range(n - 1):
            high = high << 21 | ids[at + k]
        self.gathered[n].append((high, ids[at + n - 1], start.astype(np.int64), np.ones(len(at), dtype=np.int64)))
        self.held[n] += len(at)
        if self.held[n] > GATHER:
            self.merge(n)
            if self.held[n] > HOLD:
                yield self.phrases(n)

    def merge(self, n: int) -> None:
        """Add up equal phrases."""
        if not self.gathered[n]:
            return
        high, low, start, c = (np.concatenate(x) for x in zip(*self.gathered[n]))
        order = np.argsort(order_key(n, high, low))
        high, low = high[order], low[order]
        first = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        self.gathered[n] = [(high[first], low[first], start[order][first], np.add.reduceat(c[order], first))]
        self.held[n] = len(first)

    def phrases(self, n: int) -> pa.Table:
        high, low, start, c = self.gathered[n][0]
        self.gathered[n], self.held[n] = [], 0
        codes = [(high >> 21 * (n - 2 - k)) & CODE for k in range(n - 1)] + [low]
        every = np.concatenate(codes)
        seen = np.zeros(len(self.words.words), dtype=bool)
        seen[every] = True
        used, places = np.flatnonzero(seen), (np.cumsum(seen) - 1)[every]
        words = pa.array([self.words.words[i] for i in used.tolist()], pa.string())
        texts = [words.take(pa.array(p)) for p in np.split(places, n)]
        return self.table(n, pa.compute.binary_join_element_wise(*texts, " "), start, c)

    def table(self, n: int, phrases, start, c) -> pa.Table:
        size = len(c)
        return pa.table({"lang": pa.array([self.lang] * size, pa.string()), "n": pa.array(np.full(size, n), pa.int32()), "phrase": phrases,
                         "start": pa.array(start, pa.int32()), "c": pa.array(c, pa.int64())})

    def tables_out(self) -> Iterator[pa.Table]:
        """Everything counted so far; the number of all words stands under the empty phrase."""
        if self.total:
            yield self.table(0, pa.array([""], pa.string()), np.zeros(1), np.array([self.total]))
            self.total = 0
        seen = np.flatnonzero(self.singles)
        if len(seen):
            yield self.table(1, pa.array([self.words.words[i] for i in seen.tolist()], pa.string()), np.zeros(len(seen)), self.singles[seen])
        for n in self.gathered:
            self.merge(n)
            if self.gathered[n]:
                yield self.phrases(n)


def counting(scan: int, shards: int, shared: Broadcast, bits: int):
    """Function for ``mapInArrow`` over (lang, text as bytes) that counts the phrases active in a scan."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, counters, waiting = shared.value, {}, {}

        def take(lang, texts):
            counter = counters.get(lang)
            if counter is None:
                counter = counters[lang] = Counter(lang, scan, shards, tables, bits)
            for words, had in chunks(b".".join(texts).translate(LETTERS)):
                for out in counter.add(words, had):
                    yield from out.to_batches(max_chunksize=50_000)

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                held = waiting.setdefault(lang, [0, []])
                held[1].append(text.as_py())
                held[0] += len(held[1][-1])
                if held[0] >= CHUNK:
                    yield from take(lang, waiting.pop(lang)[1])
            # with many languages counts are handed on early, so that what is held is bounded over all of them
            if len(counters) + len(waiting) > 64 or sum(len(c.words) for c in counters.values()) > 2 * MOST_HELD:
                for lang in list(waiting):
                    yield from take(lang, waiting.pop(lang)[1])
                for lang in list(counters):
                    for out in counters.pop(lang).tables_out():
                        yield from out.to_batches(max_chunksize=50_000)
        for lang in list(waiting):
            yield from take(lang, waiting.pop(lang)[1])
        for counter in counters.values():
            for out in counter.tables_out():
                yield from out.to_batches(max_chunksize=50_000)
    return run


def slot_numbers(bits: int):
    """Function for ``mapInArrow`` over (lang, n, phrase): (n, slot)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], int] = {}
        for batch in batches:
            out = []
            for lang, phrase in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist()):
                x = 0
                for word in phrase.split(" "):
                    h = known.get((lang, word))
                    if h is None:
                        if len(known) > MOST_HELD:
                            known.clear()
                        h = known[(lang, word)] = word_hash(lang, word)
                    x = ((x ^ h) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
                    x ^= x >> 29
                out.append(((x * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF) >> (64 - bits))
            yield pa.RecordBatch.from_arrays([batch["n"], pa.array(out, pa.int64())], names=["n", "slot"])
    return run


# ---- scans -----------------------------------------------------------------------------------


def write_shards(docs: DataFrame, shards: int, text: str, lang: str, doc_id: str) -> str:
    """Texts with their language in one folder per shard; the shard is a hash of id and text."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    slim = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"), body.cast("binary").alias("text"),
                       F.pmod(F.xxhash64(F.col(f"`{doc_id}`").cast("string"), body), F.lit(shards)).cast("int").alias("shard"), F.octet_length(body).alias("size"))
    path = scratch_path(docs.sparkSession, "phrase-shards")
    slim.write.partitionBy("shard").parquet(path)
    return path


def mark(spark: SparkSession, tables: np.ndarray, reached: DataFrame, scan: int, bits: int) -> bool:
    """Set the free slots of the phrases (lang, n, phrase) to ``scan``; says whether there was any. Slots come to the driver as bitmaps of fixed size."""
    numbers = reached.mapInArrow(slot_numbers(bits), "n int, slot bigint")
    maps = numbers.groupBy("n", F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    for row in maps:
        here = np.flatnonzero(np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8), bitorder="little"))
        # buckets count from 1 for positions above 0; bucket 1 begins with slot 1
        at = (row["bucket"] - 1) * 8 * len(row["bits"]) + here + 1
        at = at[at < 1 << bits] if row["bucket"] else np.array([0])
        free = at[tables[row["n"] - 1][at] == NEVER]
        tables[row["n"] - 1][free] = scan
    return bool(maps)


def phrase_counts(docs: DataFrame, least: int = LEAST, shards: int = SHARDS, most_bits: int = MOST_BITS, text: str = "text", lang: str = "lang",
                  doc_id: str = "doc_id") -> DataFrame:
    """(lang, n, phrase, c): exact counts of all phrases of one to four words with at least ``least`` occurrences; n = 0 has the number of all words."""
    spark = docs.sparkSession
    path = write_shards(docs, shards, text, lang, doc_id)
    stored = spark.read.schema("lang string, text binary, shard int, size int").parquet(path)
    chars = stored.agg(F.sum("size").alias("n")).first()["n"] or 0
    bits = min(most_bits, max(16, (chars // CHARS_A_SLOT).bit_length()))
    tables = np.full((MOST_WORDS - 1, 1 << bits), NEVER, dtype=np.uint8)
    state, scan, until = None, 0, shards - 1
    while scan <= until:
        shared = spark.sparkContext.broadcast(tables)
        texts = stored.where(F.col("shard") == scan % shards).select("lang", "text")
        found = texts.mapInArrow(counting(scan, shards, shared, bits), FOUND)
        found = found.withColumn("reached", F.lit(None).cast("int"))
        both = found if state is None else state.unionByName(found)
        added = both.groupBy("lang", "n", "phrase").agg(F.min("start").alias("start"), F.sum("c").alias("c"), F.min("reached").alias("reached"))
        now = (F.col("c") >= least) & (F.col("n") > 0)
        added = added.withColumn("reached", F.coalesce("reached", F.when(now, F.lit(scan))))
        # a phrase that was counted for a full cycle without reaching the threshold never will
        state = cut_lineage(added.where((F.col("start") + shards - 1 > scan) | now | (F.col("n") == 0)), "phrase-state")
        shared.unpersist()
        if mark(spark, tables, state.where((F.col("reached") == scan) & (F.col("n") < MOST_WORDS)).select("lang", "n", "phrase"), scan, bits):
            until = scan + shards
        scan += 1
    return state.where((F.col("c") >= least) | (F.col("n") == 0)).select("lang", "n", "phrase", "c")


# ---- collocations ----------------------------------------------------------------------------


def part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def lowest_cuts(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of every phrase of two and more words, at the cut with the lowest score; equal scores go to the earliest cut."""
    words = F.split("phrase", " ")
    cuts = counts.where("n > 1").select("lang", "phrase", F.col("c").alias("a"), "n", words.alias("words"), F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    sides = F.array(F.struct(F.lit("l").alias("side"), part(F.col("words"), F.lit(1), F.col("k")).alias("part")),
                    F.struct(F.lit("r").alias("side"), part(F.col("words"), F.col("k") + 1, F.col("n") - F.col("k")).alias("part")))
    long = cuts.select("lang", "phrase", "a", "k", F.inline(sides))
    known = counts.where("n between 1 and 3").select("lang", F.col("phrase").alias("part"), "c")
    pairs = long.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == "l", F.col("c"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("c"))).alias("r"))
    scored = pairs.withColumn("score", F.expr("(CAST(a AS DECIMAL(30,0)) * 2000000) div (CAST(l AS DECIMAL(30,0)) + r)"))
    return scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def swallowed(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longest): for phrases inside longer ones the count of the most frequent longer one."""
    words = F.split("phrase", " ")
    long = counts.where("n > 2").select("lang", "c", "n", words.alias("words"), F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("size"))
    inner = long.select("lang", "c", "words", "size", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("size") + 1)).alias("at"))
    return inner.select("lang", part(F.col("words"), F.col("at"), F.col("size")).alias("phrase"), "c").groupBy("lang", "phrase").agg(F.max("c").alias("longest"))


def collocations(docs: DataFrame, least: int = LEAST, shards: int = SHARDS, top: int = TOP, covered: int = 80, most_bits: int = MOST_BITS, text: str = "text",
                 lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to four words of every language.

    a, l and r are the occurrences of the phrase and of its two parts at the cut with the lowest score, n all words of the language. Phrases
    with ``covered`` per cent of their occurrences inside one longer phrase are left out. A null language is ``und``, a null text is empty; equal
    rows count each; a text of any length is taken apart in chunks. An empty table has no phrases.
    """
    counts = cut_lineage(phrase_counts(docs, least, shards, most_bits, text, lang, doc_id), "phrases")
    kept = lowest_cuts(counts).join(swallowed(counts), ["lang", "phrase"], "left").where(F.coalesce(F.col("longest") * 100 < F.col("a") * covered, F.lit(True)))
    best = "PARTITION BY {} ORDER BY score DESC, a DESC, phrase"
    first = kept.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("nth", F.expr(f"row_number() OVER ({best.format('lang, bucket')})"))
    ranked = first.where(F.col("nth") <= top).withColumn("rank", F.expr(f"row_number() OVER ({best.format('lang')})").cast("bigint")).where(F.col("rank") <= top)
    totals = counts.where("n = 0").select("lang", F.col("c").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
