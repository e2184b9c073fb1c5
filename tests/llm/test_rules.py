"""Quality rules, address rules and shards: against plain Python, and on odd rows."""

import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from stationflow.llm import quality_rules, shards, url_reputation
from .conftest import ODD_ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    n, rep = len(words), len(covered)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), rep, n < 50 or 100 * rep > 50 * n


def test_statistics_agree_with_python(docs):
    texts = [r[1] for r in ODD_ROWS] + ["a b c a b c\nx\nx\n\nx", "a b c d a b c", "x x x x", "one\ntwo\none | two", "é é é é # $"]
    df = docs([(i, t) for i, t in enumerate(texts)])
    got = {r["doc_id"]: r for r in quality_rules.judge(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_statistics(t), t


def test_lines_are_cleaned_before_documents_are_judged(docs):
    good = "A clean sentence with enough words in it stands here."
    text = "\n".join(["Home | News | Sport | About", good, "no end of a sentence", "We use cookies on this site.", good + "!", "$$$ ### *** &&& .", "Next", ""])
    row = quality_rules.clean_lines(docs([(1, text)])).first()
    assert row["clean_text"] == good + "\n" + good + "!"
    assert row["n_lines"] == 7 and row["n_bad_lines"] == 5 and not row["line_verdict"]
    assert quality_rules.clean_lines(docs([(1, good + "\n" + good + "\nx")])).first()["line_verdict"]


def test_quality_rules_on_odd_rows(odd, none):
    assert quality_rules.judge(odd).count() == len(ODD_ROWS)
    assert quality_rules.judge(none).count() == 0
    assert quality_rules.judge(odd.withColumns({"n_words": F.lit("x"), "clean_text": F.lit(1), "__lines": F.lit(0)})).count() == len(ODD_ROWS)


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"), ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
    ("https://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"), ("x://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
    ("http://a.org/fr/", "a.org", "/fr/", "org/fr/", "allow"), ("http://a.org/fr", "a.org", "/fr", None, "allow"), ("http://a.net", "a.net", "", None, "allow"),
    ("http://a.net?x/", "a.net", "", None, "allow"), ("no address", "", "", None, "allow"), (None, "", "", None, "allow"), ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("", "", "", None, "allow"), ("http://ÄB.net/", "Äb.net", "/", "net/", "block"),
])
def test_address_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url)], "page_id bigint, url string")
    r = url_reputation.judge(pages, spark.createDataFrame([], "host string, good int")).first()
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)


def test_reputation_shrinks_towards_domain_and_suffix(spark):
    outcomes = [("bad.spam.com", 0)] * 40 + [("ok.fine.com", 1)] * 40 + [(f"h{i}.fine.com", 1) for i in range(20)] + [(f"h{i}.spam.com", 0) for i in range(20)] + [("x.org", None)]
    hosts = sorted({h for h, _ in outcomes} | {"new.spam.com", "new.fine.com", "else.io"})
    pages = spark.createDataFrame([(i, f"http://{h}/p") for i, h in enumerate(hosts)], "page_id bigint, url string")
    rows = {r["host"]: r for r in url_reputation.judge(pages, spark.createDataFrame(outcomes, "host string, good int"), rules=[]).collect()}
    assert rows["bad.spam.com"]["verdict"] == "block" and rows["ok.fine.com"]["verdict"] == "allow"
    assert rows["new.spam.com"]["upper"] < rows["new.fine.com"]["upper"] and rows["else.io"]["verdict"] == "allow"


def test_outcomes_follow_the_number_in_the_address(spark):
    pages = spark.createDataFrame([(1, "http://a.b/en/7?x"), (2, "http://a.b/x"), (3, None), (4, "http://c.d/8"), (5, "http://c.d/" + "9" * 25)], "page_id bigint, url string")
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (8, None, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert [tuple(r) for r in url_reputation.page_outcomes(pages, labels).collect()] == [("a.b", 0)]


def test_shards_move_only_into_the_new_one(docs):
    df = docs([(i, "x" * (i % 7)) for i in range(4000)])
    rows = shards.assign(df).collect()
    counts = [sum(r["shard"] == s for r in rows) for s in range(40)]
    assert len(rows) == 4000 and min(counts) > 50 and max(counts) < 160
    assert all(r["grown_shard"] in (r["shard"], 40) for r in rows)
    moved = sum(r["grown_shard"] == 40 for r in rows)
    assert abs(moved - 4000 / 41) < 5 * math.sqrt(4000 / 41)
    # the next one moves rows into itself again
    next_rows = {r["doc_id"]: r for r in shards.assign(df, shards=41).collect()}
    assert all(next_rows[r["doc_id"]]["shard"] == r["grown_shard"] for r in rows)
    assert all(r["grown_shard"] in (r["shard"], 41) for r in next_rows.values())


@pytest.mark.parametrize("factor", [0.25, 3.0])
def test_a_changed_weight_moves_rows_only_where_it_weighs(spark, factor):
    tree = shards.Tree.of(40)
    path = ("1", "0", 9)
    assert any(p == path for p, _ in tree.weights)
    changed = shards.Tree(tuple((p, w * factor if p == path else w) for p, w in tree.weights))
    rows = spark.range(8000).select(F.col("id").cast("string").alias("key"))
    both = shards.with_shard(shards.with_shard(rows, "key", tree, "old"), "key", changed, "new").collect()
    place = {p[2]: p for p, _ in tree.weights}
    moved = [(place[r["old"]], place[r["new"]]) for r in both if r["old"] != r["new"]]
    assert moved
    for old, new in moved:
        gains, loses = (new, old) if factor > 1 else (old, new)
        # at each level rows move only into or out of the changed branch
        assert gains[0] == path[0]
        assert loses[0] != path[0] or gains[1] == path[1]
        assert loses[:2] != path[:2] or gains == path
    share = {f: sum(r[f] == 9 for r in both) / len(both) for f in ("old", "new")}
    total = 39 + factor
    assert abs(share["old"] - 1 / 40) < 0.01 and abs(share["new"] - factor / total) < 0.015


def test_slots_are_gapless_with_copies_and_odd_rows(spark, docs, monkeypatch):
    monkeypatch.setattr(shards, "BLOCK_ROWS", 16)
    df = docs([(7, "copy")] * 100 + [(None, None)] * 3 + [(i, "t") for i in range(300)] + ODD_ROWS)
    rows = shards.assign(df).collect()
    assert len(rows) == 403 + len(ODD_ROWS)
    for s in range(40):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    for r in rows:
        if r["doc_id"] == 7 and r["size"] == 20:
            assert r["text_crc32"] == zlib.crc32(b"copy")
    assert shards.assign(docs([])).count() == 0


def test_an_id_with_many_texts_is_numbered_in_many_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(shards, "BLOCK_ROWS", 4)
    rows = shards.assign(docs([(1, "x" * i) for i in range(400)]), shards=4, base=4).collect()
    assert len({r["shard"] for r in rows}) == 1 and sorted(r["slot"] for r in rows) == list(range(400))
    keys = spark.createDataFrame([(r["size"], r["text_crc32"]) for r in rows], "size bigint, crc bigint").select(F.concat_ws(":", F.lit("1"), "size", "crc").alias("k"))
    assert keys.select(F.floor(shards.hashed(F.col("k"), F.lit("slot")) / shards.RANGE * 50)).distinct().count() == 50
