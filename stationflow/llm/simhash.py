"""SimHash fingerprints and near-duplicate groups through an index of byte positions.

Two 64-bit fingerprints that differ in at most three bits agree in at least five of their eight bytes. The index
lists fingerprints by the values of four byte positions. The fourteen position sets used are those
whose four numbers have an exclusive-or of zero: every five positions contain exactly one of them, so a pair with five
equal bytes meets in some list. Within a list the equal bytes of each pair are tallied, pairs
with five or more are kept and verified bit by bit. A list longer than ``LIST`` is
cut by a fifth byte; such a list can hold at most 2^24 different fingerprints, whatever the size of the input.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import per_batch
from .components import Forest, label_components

BITS = 3
SHARED = 8 - BITS
POSITION_SETS = [c for c in combinations(range(8), SHARED - 1) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
#: Longest list whose pairs are compared directly.
LIST = 256
BIT_OF = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def fingerprint(text: bytes | None) -> int:
    """Signed 64-bit SimHash of a text's 3-word shingles; a text without words has fingerprint zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], dtype="<u8")
    octets = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ BIT_OF for k in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str, keep: list[str], out: str = "fp") -> DataFrame:
    """``keep`` columns and the fingerprint of every whole text. Nulls count as empty texts."""
    kinds = dict(docs.dtypes)
    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + f"`{out}` bigint"
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("binary").alias("__text"))
    return per_batch(slim, lambda rows: {c: rows[c] for c in keep} | {out: list(map(fingerprint, rows["__text"]))}, schema)


def octet(fp: Column, position: int) -> Column:
    return F.shiftright(fp, 8 * position).bitwiseAND(F.lit(255))


def posting_key(fp: Column, number: int) -> Column:
    """Number of the position set, then the four bytes at its positions."""
    key = F.lit(number).cast("bigint")
    for p in POSITION_SETS[number]:
        key = F.shiftleft(key, 8).bitwiseOR(octet(fp, p))
    return key


def fifth_bytes(fp: Column, key: Column) -> Column:
    """For a posting, the four ways to fix one more byte: position and value as one number."""
    number = F.shiftright(key, 32).cast("int")
    rest = F.array(*[F.array(*[F.lit(p) for p in range(8) if p not in c]) for c in POSITION_SETS])
    return F.transform(F.element_at(rest, number + 1), lambda p: p * 256 + F.call_function("shiftright", fp, p * 8).bitwiseAND(F.lit(255)).cast("int"))


def list_links(lists: list[list[int]]) -> dict[str, list[int]]:
    """Links of the fingerprints of each list, thinned to a forest over the slice: no connection is lost."""
    forest = Forest()
    short = [x for x in lists if len(x) <= LIST]
    if short:
        flat, owner = np.concatenate([np.array(x, dtype=np.int64) for x in short]), np.repeat(np.arange(len(short)), [len(x) for x in short])
        at = np.arange(len(flat))
        for shift in range(1, max(map(len, short))):
            at = at[at + shift < len(flat)]
            at = at[owner[at] == owner[at + shift]]
            a, b = flat[at], flat[at + shift]
            for x, y in verified(a, b):
                forest.link(x, y)
    for x in lists:
        if len(x) > LIST:
            cube_links(np.unique(np.array(x, dtype=np.int64)), forest)
    a, b = forest.edges()
    return {"a": a, "b": b}


def verified(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    differ = a ^ b
    tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    some = tally >= SHARED
    a, b, differ = a[some], b[some], differ[some]
    close = np.bitwise_count(differ.view(np.uint64)) <= BITS
    return list(zip(a[close].tolist(), b[close].tolist()))


def cube_links(fps: np.ndarray, forest: Forest) -> None:
    """Links within a long list that shares five bytes: all masks of up to three of the 24 free bits are looked up."""
    free = [b for b in range(64) if ((fps[0] ^ fps) >> np.int64(b) & 1).any()]
    for n in range(1, BITS + 1):
        for bits in combinations(free, n):
            mask = np.bitwise_or.reduce(np.array([1 << b for b in bits], dtype=np.uint64)).view(np.int64)
            other = fps ^ mask
            at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
            hit = (fps[at] == other) & (fps < other)
            for x, y in zip(fps[hit].tolist(), other[hit].tolist()):
                forest.link(x, y)


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between different fingerprints of the table's column ``fp`` (one row each)."""
    postings = fps.select("fp", F.explode(F.array(*[posting_key(F.col("fp"), i) for i in range(len(POSITION_SETS))])).alias("key"))
    lengths = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = postings.join(lengths, "key")
    short = shared.where(F.col("n") <= LIST).groupBy("key").agg(F.collect_list("fp").alias("fps")).select("fps")
    long = shared.where(F.col("n") > LIST).select("fp", "key", F.explode(fifth_bytes(F.col("fp"), F.col("key"))).alias("fifth"))
    long = long.groupBy("key", "fifth").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")
    return per_batch(short.unionByName(long), lambda rows: list_links(rows["fps"]), "a bigint, b bigint", rows=4096)


def fingerprint_groups(fps: DataFrame) -> DataFrame:
    """(fp, root) of every fingerprint that has a link; root is the smallest fingerprint reachable."""
    return label_components(cut_lineage(links(fps), "links"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp, component_id) of every row: groups under "at most three bits apart", followed all the way.

    Texts without words have fingerprint zero and are linked like any other. Null texts count as empty.
    Equal ids and repeated rows stay as they are; ``component_id`` is the least id of the group, null
    only where no row of the group has an id. Copies meet as one fingerprint before anything is compared.
    """
    slim = cut_lineage(with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", ["doc_id"]), "fingerprints")
    return slim.join(component_of(slim.groupBy("fp").agg(F.min("doc_id").alias("first"))), "fp").select("doc_id", "fp", "component_id")


def component_of(fps: DataFrame) -> DataFrame:
    """(fp, component_id) from one row per fingerprint with its least id ``first``."""
    fps = cut_lineage(fps, "distinct")
    rooted = fps.join(fingerprint_groups(fps.select("fp")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the least id (a row without an id comes last).

    Rows get a number in a written table, so the choice is stable and repeated rows are told apart.
    """
    marked = docs.withColumn("__row", F.monotonically_increasing_id())
    keep = [c for c in marked.columns if c != text]
    kinds = dict(marked.dtypes)
    schema = "".join(f"`{c}` {kinds[c]}, " for c in marked.columns) + "`__fp` bigint"

    def add(rows):
        return {**rows, "__fp": [fingerprint(None if t is None else t.encode()) for t in rows[text]]}

    marked = cut_lineage(per_batch(marked.select(*keep, text).select(*marked.columns), add, schema), "marked")
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("__row").alias("row"))
    firsts = cut_lineage(marked.groupBy(F.col("__fp").alias("fp")).agg(F.min(order).alias("first")), "firsts")
    rooted = firsts.join(fingerprint_groups(firsts.select("fp")), "fp", "left")
    kept = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first")).select(F.col("first.row").alias("__row"))
    return marked.join(kept, "__row", "left_semi").select(*docs.columns)
