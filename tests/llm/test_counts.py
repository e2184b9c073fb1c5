"""Phrases, the prefix trie and the mix against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from stationflow.llm import mixing, phrases, prefix, prefix_trie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_phrases(rows, least=30, top=2000):
    found, words = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            ws = re.findall("[^ \t]+", piece)
            words[lang] += len(ws)
            for n in range(1, 5):
                found[lang].update(tuple(ws[i:i + n]) for i in range(len(ws) - n + 1))
    out = []
    for lang, counts in found.items():
        often = {p: c for p, c in counts.items() if c >= least}
        over = collections.Counter()
        for p, c in often.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    over[p[i:i + n]] = max(over[p[i:i + n]], c)
        ranked = []
        for p, a in often.items():
            if len(p) > 1 and 100 * over[p] < 80 * a:
                score, k = min((2_000_000 * a // (often[p[:k]] + often[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), often[p[:k]], often[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, words[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def babble(seed, n, vocabulary=12, ends=".,\n\t "):
    rng = random.Random(seed)
    return "".join(f"w{min(rng.randrange(vocabulary), rng.randrange(vocabulary))}" + rng.choice(" " * 12 + ends) for _ in range(n))


PHRASE_ROWS = [(i, babble(i, 300), "en" if i % 3 else "de") for i in range(12)] + [
    (20, "The Same Line. " * 50, "en"), (20, "The Same Line. " * 50, "en"), (21, None, "en"), (22, "", None), (None, "no id here " * 40, None), (23, "x" * 5000, "fr"),
    (24, "é ß 漢 😀 " * 40, "fr"), (25, "und " * 33, "und")]


@pytest.mark.parametrize("settings", [{}, {"shards": 4, "most_bits": 4}, {"least": 2, "top": 7, "shards": 1}])
def test_phrases_are_those_of_brute_force(spark, docs, settings):
    got = sorted(tuple(r) for r in phrases.collocations(docs(PHRASE_ROWS), **settings).collect())
    want = plain_phrases([(r[2], r[1]) for r in PHRASE_ROWS], settings.get("least", 30), settings.get("top", 2000))
    assert got == want and want


def test_phrases_of_odd_and_empty_tables(spark, odd, none):
    assert phrases.collocations(none).collect() == []
    got = sorted(tuple(r) for r in phrases.collocations(odd.withColumnRenamed("n_chars", "reached")).collect())
    assert got == plain_phrases([(r["lang"], r["text"]) for r in odd.collect()])


def test_long_texts_are_taken_apart_without_loss(monkeypatch):
    text = b"one two three four " * 40 + b"." + b"five six " * 30 + b"q" * 90 + b" seven eight."
    for size in (7, 16, 50, 10_000):
        monkeypatch.setattr(phrases, "CHUNK", size)
        for n in (1, 2, 3, 4):
            grams = collections.Counter()
            for words, had in phrases.chunks(text):
                words = [w.encode() for w in words.to_pylist()]
                grams.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1) if i + n > had and b"." not in words[i:i + n])
            want = collections.Counter(tuple(ws[i:i + n]) for ws in (p.split() for p in text.split(b".")) for i in range(len(ws) - n + 1))
            assert grams == want, (size, n)


def test_phrases_when_a_task_starts_anew_often(spark, docs, monkeypatch):
    """Counting as tasks do, with room for a few words and phrases only."""
    for name, size in (("MOST_HELD", 6), ("HOLD", 5), ("GATHER", 10), ("CHUNK", 64)):
        monkeypatch.setattr(phrases, name, size)
    text = babble(3, 400).encode().translate(phrases.LETTERS)
    tables = np.zeros((3, 1 << 4), dtype=np.uint8)
    tables[1], tables[2] = 1, 2
    counter = phrases.Counter("en", 3, 4, tables, 4)
    got = collections.Counter()
    for words, had in phrases.chunks(text):
        for out in counter.add(words, had):
            for r in out.to_pylist():
                got[r["n"], r["phrase"]] += r["c"]
    for out in counter.tables_out():
        for r in out.to_pylist():
            got[r["n"], r["phrase"]] += r["c"]
    want = collections.Counter()
    for ws in (p.split() for p in text.decode().split(".")):
        want[0, ""] += len(ws)
        for n in range(1, 5):
            want.update((n, " ".join(ws[i:i + n])) for i in range(len(ws) - n + 1))
    assert got == want


def plain_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    whole = {}
    for c, turns in own.items():
        turns.sort()
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = [t[1:] for t in sorted(own.get(c - int(math.fmod(c, 100)), []))[:h]] + [t[1:] for t in turns[h:]]
    nodes, kids, out = collections.defaultdict(list), collections.defaultdict(list), {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    for path in nodes:
        if path:
            kids[path[:-1]].append(path)
    for path in sorted(nodes, key=len, reverse=True):
        leaves, saved = sum(out[k][4] for k in kids[path]) or 1, sum(out[k][5] for k in kids[path])
        saved += (len(nodes[path]) - 1) * len(path[-1][1]) if path else 0
        ends = ",".join(str(c) for c in sorted(nodes[path]) if len(whole[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out[path] = (min(nodes[path]), len(path), parent, len(nodes[path]), leaves, saved, len(kids[path]), hashlib.sha256(ends.encode()).hexdigest())
    return sorted((v[0], v[1], v[2] if v[2] is not None else -1, *v[3:]) for v in out.values())


def trie_rows(df, **sizes):
    got = prefix_trie.prefix_trie(df, **sizes).collect()
    places = sorted(x for r in got for x in (r["entered"], r["left"]))
    assert places == list(range(2 * len(got)))
    return sorted((r["conv_id"], r["depth"], r["parent_conv_id"] if r["parent_conv_id"] is not None else -1, r["n_convs"], r["n_leaves"], r["saved_tokens"], r["n_children"], r["ends_sha256"]) for r in got)


TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def crowd(seed, convs, said):
    rng = random.Random(seed)
    return [(c, t if t else None, rng.choice(["user", None]), rng.choice(said)) for c in range(convs) for t in range(rng.randrange(9))]


@pytest.mark.parametrize("sizes", [{}, {"part_rows": 9, "solo": 6}])
def test_trie_is_that_of_brute_force(spark, sizes):
    rows = crowd(1, 90, ["a", "b", "", None, "a long one 😀"]) + crowd(2, 60, ["x"]) + [(1000 + c, 1, "user", f"only {c}") for c in range(70)]
    seen, unique = set(), []
    for row in rows:  # one row per turn: ties are tested apart
        if (row[0], row[1]) not in seen:
            seen.add((row[0], row[1]))
            unique.append(row)
    unique += [(7000, t, "user", f"turn {t % 3}") for t in range(300)] + [(-5, 1, "u", "below zero"), (None, 1, "u", "no conversation")]
    df = spark.createDataFrame(unique, TURNS)
    assert trie_rows(df, **sizes) == plain_trie(unique)


def test_trie_of_ties_repeats_and_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    rows = [(0, 1, "b", "x"), (0, 1, "a", "x"), (0, 1, "a", "x"), (0, None, None, None), (1, 5, "a", "y")]
    df = spark.createDataFrame([(*r, "other") for r in rows], TURNS + ", depth STRING")
    assert trie_rows(df) == plain_trie(rows)
    again = spark.createDataFrame(list(reversed([(*r, "other") for r in rows])), TURNS + ", depth STRING")
    assert trie_rows(again) == plain_trie(rows)


def test_ids_of_many_conversations_in_order(spark):
    rows = [(c, 1, "u", "same") for c in [5, 70_000, 69_999, 1 << 40, -3, 200_000]]
    rows = [(c * 100, t, r, x) for c, t, r, x in rows]
    assert trie_rows(spark.createDataFrame(rows, TURNS)) == plain_trie(rows)


def test_running_sums_over_parts(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b", "b", "b", "c"]), i, rng.randrange(9)) for i in range(400)]
    df = spark.createDataFrame(rows, "g STRING, i INT, v INT")
    got = {r["i"]: (r["total"], r["place"]) for r in prefix.running(df, ["i"], {"total": df["v"], "place": df["v"] * 0 + 1}, ["g"], part_rows=13).collect()}
    seen = collections.defaultdict(lambda: [0, 0])
    for g, i, v in rows:
        seen[g][0] += v
        seen[g][1] += 1
        assert got[i] == tuple(seen[g])


def plain_targets(sizes, weights=(1, 2, 3), repeats=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(repeats * sizes[s] for s in stopped)
        heavy = sum(w[s] for s in names if s not in stopped)
        over = {s for s in names if s not in stopped and w[s] * rest > repeats * sizes[s] * heavy}
        if not over:
            return {s: float(repeats * sizes[s]) if s in stopped else w[s] * rest / heavy for s in names}
        stopped |= over


def test_mix_comes_near_its_targets(spark, docs):
    rng = random.Random(3)
    rows = [(i, "word " * rng.randrange(40), None, rng.choice(["a", "b", "c", None, "tiny" if i % 40 == 0 else "big", "big", "big"])) for i in range(900)]
    rows += [(1, "the same row", None, "b")] * 30 + [(None, "no id", None, "c"), (2, None, None, "a"), (3, "", None, "empty")]
    got = mixing.mix(docs(rows)).collect()
    assert len(got) == len(rows) and all(r["taken"] in [r["size"] * k for k in range(4)] for r in got)
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    for r in got:
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert r["source_size"] == sizes[r["source"]]
    want = plain_targets(sizes)
    assert {r["source"]: r["target"] for r in got} == pytest.approx(want)
    for source, target in want.items():
        assert abs(taken[source] - target) <= 2 * largest[source] + 1, source
    assert sum(sizes.values()) - max(largest.values()) <= sum(taken.values()) <= sum(sizes.values())
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs(rows).repartition(7)).collect()))


def test_mix_of_odd_and_empty_tables(spark, odd, none, docs):
    assert mixing.mix(none).collect() == []
    assert len(mixing.mix(odd.withColumnRenamed("n_chars", "taken").withColumnRenamed("lang", "rank")).collect()) == odd.count()
    assert {(r["size"], r["taken"], r["target"]) for r in mixing.mix(docs([(1, None, None, "a"), (2, " ", None, None)])).collect()} == {(0, 0, 0.0)}
