"""Prefix trie of conversations by the Euler-tour technique.

Every node has an enter arc and an exit arc; the arcs form one list that walks the whole trie. The list is ranked distributedly: parts of the arcs
are ranked alone, which leaves one link per run of arcs inside a part; the list of those runs is halved by random mates until one task can
rank it, and the ranks flow back. What lies between a node's two arcs is its subtree, so leaves and saved tokens of a subtree are differences
of the prefix sums at the two positions. Children of a node follow each other by id.

A node is named by its smallest member and its depth. Two prefixes are one node if their 128-bit digests are equal: sums of digests of the turns, each
taken with its place, so that a prefix of any length is a running sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import PART_ROWS, cut_by_range, part_ends, running

#: Conversations of one family share the head of the family's first one.
FAMILY = 100
#: Heads have 0 to HEADS - 1 turns.
HEADS = 6
#: Links of the list that one task ranks.
SOLO = 500_000
#: Ids that are written out by one task are those with the same higher bits.
ID_BITS = 16

# ---- conversations ---------------------------------------------------------------------------


def ordered_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, p, a, b, chars): turns numbered from 1 by turn (null first), with two digests of role and text and the text's code points.

    Turns with equal numbers follow each other by role, then by digest. Null roles and texts are empty. Rows without a
    conversation are left out. Texts are not shuffled.
    """
    said = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text)]
    slim = turns.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("bigint").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), said[0].alias("role"), F.xxhash64(*said).alias("a"),
        F.xxhash64(F.lit("second"), said[1], said[0]).alias("b"), F.char_length(said[1]).cast("bigint").alias("chars"))
    numbered = running(cut_lineage(slim, "turns"), ["turn", "role", "a", "b"], {"p": F.lit(1)}, ["conv_id"], "numbered-turns")
    return cut_lineage(numbered.select("conv_id", "p", "a", "b", "chars"), "ordered-turns")


def rebuilt_turns(ordered: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, d, a, b, chars, last) and conversations (conv_id, n_turns) with the head of the family's first conversation put before them.

    Conversation c takes the first h turns of conversation c - c % family, then its own after its first h; h is the CRC-32 of its id modulo ``heads``.
    """
    convs = ordered.groupBy("conv_id").agg(F.max("p").alias("own")).withColumns({
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads, "family": F.col("conv_id") - F.col("conv_id") % family})
    head = ordered.where(F.col("p") < heads).withColumnRenamed("conv_id", "family")
    lengths = head.groupBy("family").agg(F.max("p").alias("there"))
    convs = convs.join(lengths, "family", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    convs = cut_lineage(convs.withColumn("n_turns", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "conversations")
    shared = convs.join(head, "family").where("p <= h").select("conv_id", F.col("p").alias("d"), "a", "b", "chars", "n_turns")
    own = ordered.join(convs, "conv_id").where("p > h").select("conv_id", (F.col("p") - F.col("h") + F.col("taken")).alias("d"), "a", "b", "chars", "n_turns")
    turns = shared.unionByName(own).withColumn("last", F.col("d") == F.col("n_turns")).drop("n_turns")
    return cut_lineage(turns, "rebuilt-turns"), convs.select("conv_id", "n_turns")


def _digest(parts: list[Column], d: Column) -> list[Column]:
    return [F.xxhash64(*parts[:2], d), F.xxhash64(*parts[2:], d)]


def members(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, ka, kb, pa, pb, chars, last): every prefix of every conversation with its digest and its parent's, the empty one included."""
    digests = {f"w{i}": x for i, x in enumerate(
        [half for c in ("a", "b") for h in [F.xxhash64("d", c)] for half in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))])}
    summed = running(turns.withColumns(digests), ["d"], {f"k{i}": F.col(f"w{i}") for i in range(4)}, ["conv_id"], "prefixes")
    here = _digest([F.col(f"k{i}") for i in range(4)], F.col("d"))
    above = _digest([F.col(f"k{i}") - F.col(f"w{i}") for i in range(4)], F.col("d") - 1)
    names = ["ka", "kb", "pa", "pb"]
    deep = summed.select("conv_id", F.col("d").alias("depth"), *[c.alias(n) for c, n in zip([*here, *above], names)], "chars", "last")
    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    root = [*_digest([zero] * 4, zero), none, none]
    tops = convs.select("conv_id", zero.alias("depth"), *[c.alias(n) for c, n in zip(root, names)], zero.alias("chars"), (F.col("n_turns") == 0).alias("last"))
    return cut_lineage(deep.unionByName(tops), "prefixes")


def ends_digest(prefixes: DataFrame) -> DataFrame:
    """(ka, kb, ends_sha256) of prefixes at which conversations end: SHA-256 of their ids, ascending, comma-joined.

    Ids with the same higher bits become one text; the texts of a prefix go through the digest one after the other, so memory does not depend on
    how many conversations end at it.
    """
    block = F.shiftright("conv_id", ID_BITS)
    texts = prefixes.where("last").groupBy("ka", "kb", block.alias("block")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    lined = texts.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "block")
    return lined.mapInArrow(digest_runs, "ka bigint, kb bigint, ends_sha256 string")


def digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per run of rows with the same key."""
    names = ["ka", "kb", "ends_sha256"]
    key, state, done = None, None, []
    for batch in batches:
        for ka, kb, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if (ka, kb) != key:
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (ka, kb), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
            done = []
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names=names)


# ---- nodes and their neighbours --------------------------------------------------------------


def trie_nodes(prefixes: DataFrame) -> DataFrame:
    """One row per node: smallest member, depth, members, code points of its last text, its digest and its parent's."""
    same = [F.max(c).alias(c) for c in ("depth", "pa", "pb", "chars")]
    return cut_lineage(prefixes.groupBy("ka", "kb").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *same), "nodes")


def linked_nodes(nodes: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``nodes`` with parent_conv_id, n_children, first_child and next_sibling (smallest members).

    Every node stands in the list of its parent's children and at the head of its own. The lists are range-sorted end to end, so
    a node of very many children is spread over parts; what goes on across an edge of parts is carried over, one row per part.
    """
    heads = nodes.select(F.col("ka").alias("la"), F.col("kb").alias("lb"), F.lit(0).alias("kind"), "conv_id", "depth")
    items = nodes.where("depth > 0").select(F.col("pa").alias("la"), F.col("pb").alias("lb"), F.lit(1).alias("kind"), "conv_id", "depth")
    ranged = cut_by_range(cut_lineage(heads.unionByName(items), "children"), ["la", "lb", "kind", "conv_id"], "child-lists", part_rows)
    ranged = ranged.withColumn("g", F.struct("la", "lb"))
    ends = part_ends(ranged, F.col("g"))
    at = F.struct("g", "kind", "conv_id")
    is_first, is_last, child = F.col("g") == F.col("__first"), F.col("g") == F.col("__last"), F.col("kind") == 1
    edges = ranged.join(F.broadcast(ends), "__part").where(is_first | is_last).groupBy("__part").agg(
        F.first("__first").alias("first"), F.first("__last").alias("last"), F.min_by("conv_id", at).alias("conv"), F.count_if(is_first & child).alias("n_first"),
        F.max(F.when(is_last & ~child, F.col("conv_id"))).alias("owner")).collect()  # one row per part
    edges.sort(key=lambda r: r["__part"])
    fixes, owner = [], None
    for i, row in enumerate(edges):
        carried = owner if i and edges[i - 1]["last"] == row["first"] else None
        follower, more = None, 0
        for later in edges[i + 1:]:
            if later["first"] != row["last"]:
                break
            follower = later["conv"] if follower is None else follower
            more += later["n_first"]
            if later["last"] != row["last"]:
                break
        fixes.append((row["__part"], carried, follower, more))
        owner = row["owner"] if row["owner"] is not None or row["first"] != row["last"] else carried
    fixes = nodes.sparkSession.createDataFrame(fixes, "__part INT, carried BIGINT, follower BIGINT, more BIGINT")
    lists = Window.partitionBy("__part", "g")
    inside = lists.orderBy("kind", "conv_id")
    ends = ends.join(F.broadcast(fixes), "__part")
    linked = ranged.join(F.broadcast(ends), "__part").withColumns({
        "owner": F.coalesce(F.max(F.when(~child, F.col("conv_id"))).over(lists), F.when(is_first, F.col("carried"))),
        "next": F.coalesce(F.lead("conv_id").over(inside), F.when(is_last, F.col("follower"))),
        "n": F.count_if(child).over(lists) + F.when(is_last, F.col("more")).otherwise(0)})
    both = linked.groupBy("conv_id", "depth").agg(
        F.max(F.when(child, F.col("owner"))).alias("parent_conv_id"), F.max(F.when(child, F.col("next"))).alias("next_sibling"),
        F.max(F.when(~child, F.col("next"))).alias("first_child"), F.max(F.when(~child, F.col("n"))).alias("n_children"))
    return nodes.drop("pa", "pb").join(both, ["conv_id", "depth"])


# ---- the tour --------------------------------------------------------------------------------

ENTER, EXIT = 0, 1
ID = ["conv_id", "depth", "arc"]
SUMS = ["arcs", "leaves", "saved"]
_LINK = "conv_id bigint, depth bigint, arc int, next_conv_id bigint, next_depth bigint, next_arc int, arcs bigint, leaves bigint, saved bigint"
_RANK = "conv_id bigint, depth bigint, arc int, arcs bigint, leaves bigint, saved bigint"


def shaped(columns: list, ddl: str) -> pa.Table:
    """Arrow table of the columns that ``ddl`` names, all whole numbers."""
    kinds = [c.split() for c in ddl.split(", ")]
    return pa.table({n: pa.array(c) if isinstance(c, np.ndarray) else c for c, (n, _) in zip(columns, kinds)}).cast(
        pa.schema([(n, pa.int64() if k == "bigint" else pa.int32()) for n, k in kinds]))


def rank_runs(following: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First item of the run that each item belongs to, and the weights of the run before it, by pointer jumping.

    ``following`` is the index of the item after each one, -1 at the end of a run.
    """
    n = len(following)
    first, before = np.arange(n), np.zeros_like(weights)
    has = np.flatnonzero(following >= 0)
    first[following[has]] = has
    before[following[has]] = weights[has]
    while True:
        on = first[first]
        if np.array_equal(on, first):
            return first, before
        before, first = before + before[first], on


def index_of(conv: np.ndarray, depth: np.ndarray, arc: np.ndarray, to: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Index of the arcs ``to`` (conv, depth, arc) among those given, -1 where it is not among them."""
    size, every = len(conv), np.concatenate([np.column_stack([conv, depth, arc]), np.column_stack(to)])
    order = np.lexsort((np.arange(len(every)) >= size, every[:, 2], every[:, 1], every[:, 0]))
    same = np.r_[False, (every[order][1:] == every[order][:-1]).all(axis=1)]
    known = order < size
    latest = np.maximum.accumulate(np.where(known, np.arange(len(order)), -1))
    starts = np.maximum.accumulate(np.where(~same, np.arange(len(order)), 0))
    hit = np.where(~known & (latest >= starts), order[latest], -1)
    out = np.full(len(every), -1)
    out[order] = hit
    return out[size:]


def column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def optional(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column with nulls, 0 in their place, and where it has values."""
    return table[name].fill_null(0).to_numpy(), table[name].is_valid().to_numpy()


def part_arcs(nodes: pa.Table):
    """Arcs of a part's nodes, enter arcs first: (conv, depth, arc), what follows each, whether anything does, and weights (1, leaf, saved)."""
    conv, depth = column(nodes, "conv_id"), column(nodes, "depth")
    child, has_child = optional(nodes, "first_child")
    sibling, has_sibling = optional(nodes, "next_sibling")
    parent, has_parent = optional(nodes, "parent_conv_id")
    n = len(conv)
    ids = np.tile(conv, 2), np.tile(depth, 2), np.repeat([ENTER, EXIT], n)
    after_enter = np.where(has_child, child, conv), np.where(has_child, depth + 1, depth), np.where(has_child, ENTER, EXIT)
    after_exit = np.where(has_sibling, sibling, parent), np.where(has_sibling, depth, depth - 1), np.where(has_sibling, ENTER, EXIT)
    after = tuple(np.concatenate(x) for x in zip(after_enter, after_exit))
    goes_on = np.concatenate([np.ones(n, bool), has_sibling | has_parent])
    weights = np.zeros((2 * n, 3), dtype=np.int64)
    weights[:, 0] = 1
    weights[:n, 1] = ~has_child
    weights[:n, 2] = (column(nodes, "n_convs") - 1) * column(nodes, "chars")
    return ids, after, goes_on, weights


def part_runs(nodes: pa.Table) -> tuple:
    ids, after, goes_on, weights = part_arcs(nodes)
    following = np.where(goes_on, index_of(*ids, after), -1)
    first, before = rank_runs(following, weights)
    return ids, after, goes_on, weights, following, first, before


def run_links(nodes: pa.Table) -> pa.Table:
    """One link per run of arcs inside the part: its first arc, the arc after its last one, and the run's weights."""
    ids, after, goes_on, weights, following, first, before = part_runs(nodes)
    last = np.flatnonzero(following < 0)
    head, end = first[last], ~goes_on[last]
    total = (before + weights)[last]
    return shaped([*[x[head] for x in ids], *[pa.array(x[last], mask=end) for x in after], *total.T], _LINK)


def rank_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights before every link of a list that one task holds."""
    batches = list(batches)
    if not batches:
        return
    links = pa.Table.from_batches(batches)
    if not links.num_rows:
        return
    ids = [column(links, c) for c in ID]
    after = [optional(links, f"next_{c}") for c in ID]
    following = np.where(after[0][1], index_of(*ids, tuple(x for x, _ in after)), -1)
    weights = np.column_stack([column(links, c) for c in SUMS])
    _, before = rank_runs(following, weights)
    yield from shaped([*ids, *before.T], _RANK).to_batches()


def rank_list(links: DataFrame, solo: int = SOLO) -> DataFrame:
    """(arc, weights before it) of every link of one list. Longer lists than ``solo`` are halved by random mates first.

    In a round every link draws a coin from a hash; a link whose coin is 1 and whose predecessor's is 0 is taken over by it, about a quarter of them. The
    links taken over get their ranks from their predecessors' at the end, round by round.
    """
    taken, turn = [], 0
    while links.count() > solo:
        def coin(prefix, at=turn):
            return F.xxhash64(*[f"{prefix}{c}" for c in ID], F.lit(at)).bitwiseAND(F.lit(1))
        keeps = (coin("") == 0) & F.col("next_conv_id").isNotNull() & (coin("next_") == 1)
        named = links.select(*[F.col(c).alias(f"next_{c}") for c in ID], *[F.col(f"next_{c}").alias(f"then_{c}") for c in ID], *[F.col(c).alias(f"more_{c}") for c in SUMS])
        mates = cut_lineage(links.where(keeps).join(named, [f"next_{c}" for c in ID]), "mates")
        gone = mates.select(*[F.col(f"next_{c}").alias(c) for c in ID], *[F.col(c).alias(f"by_{c}") for c in ID], *SUMS)
        longer = mates.select(*ID, *[F.col(f"then_{c}").alias(f"next_{c}") for c in ID], *[(F.col(c) + F.col(f"more_{c}")).alias(c) for c in SUMS])
        left = links.where(~F.coalesce(keeps, F.lit(False))).join(gone.select(*ID), ID, "left_anti")
        links = cut_lineage(left.unionByName(longer), "shorter-list")
        taken.append(gone)
        turn += 1
    ranks = cut_lineage(links.repartition(1).mapInArrow(rank_alone, _RANK), "ranks")
    for gone in reversed(taken):
        by = ranks.select(*[F.col(c).alias(f"by_{c}") for c in ID], *[F.col(c).alias(f"to_{c}") for c in SUMS])
        found = gone.join(by, [f"by_{c}" for c in ID]).select(*ID, *[(F.col(c) + F.col(f"to_{c}")).alias(c) for c in SUMS])
        ranks = cut_lineage(ranks.unionByName(found), "ranks")
    return ranks


def subtree_sums(nodes: DataFrame, part_rows: int = PART_ROWS, solo: int = SOLO) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens, entered, left) of every node: what lies between its two arcs, and the arcs' places in the tour."""
    ranged = cut_by_range(nodes, ["conv_id", "depth"], "tour", part_rows)

    def first_pass(key, part):
        links = run_links(part)
        return links.append_column("__part", pa.array(np.full(links.num_rows, key[0].as_py(), dtype=np.int32)))

    def second_pass(key, part, ranks):
        ids, _, _, _, _, first, before = part_runs(part)
        heads = np.flatnonzero(first == np.arange(len(first)))
        at = index_of(*[column(ranks, c) for c in ID], tuple(x[heads] for x in ids))
        start = np.zeros_like(before)
        start[heads] = np.column_stack([column(ranks, c) for c in SUMS])[at]
        place = before + start[first]
        n = part.num_rows
        span = place[n:] - place[:n]
        return pa.table([part["conv_id"], part["depth"], span[:, 1], span[:, 2], place[:n, 0], place[n:, 0]], names=["conv_id", "depth", "n_leaves", "saved_tokens", "entered", "left"])

    runs = cut_lineage(ranged.groupBy("__part").applyInArrow(first_pass, f"{_LINK}, __part int"), "tour-runs")
    ranks = rank_list(runs.drop("__part"), solo).join(runs.select(*ID, "__part"), ID)
    return ranged.groupBy("__part").cogroup(ranks.groupBy("__part")).applyInArrow(
        second_pass, "conv_id bigint, depth bigint, n_leaves bigint, saved_tokens bigint, entered bigint, left bigint")


def prefix_trie(turns: DataFrame, part_rows: int = PART_ROWS, solo: int = SOLO) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns`` (conv_id, turn, role, text), one row per node.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, entered, left): ``entered`` and ``left`` are the
    places of the node's arcs in the tour. An empty table has no node. Nulls and ties are as in :func:`ordered_turns`; repeated rows are turns of their own.
    """
    rebuilt, convs = rebuilt_turns(ordered_turns(turns))
    prefixes = members(rebuilt, convs)
    nodes = cut_lineage(linked_nodes(trie_nodes(prefixes), part_rows), "linked-nodes")
    out = nodes.join(subtree_sums(nodes, part_rows, solo), ["conv_id", "depth"]).join(ends_digest(prefixes), ["ka", "kb"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), "entered", "left")
