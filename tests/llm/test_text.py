"""Tokens, licences, leaks, languages, toxicity and extraction: against brute force, and on odd rows."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stationflow.llm import bpe, decontaminate, html_extract, language_id, license_scan, toxicity
from stationflow.llm.html_pages import blocks_of, made_pages
from .conftest import ODD_ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abcABC   don't 'LL 12\n\t\x1c\x1f\x85​éÉàÇßẞΣσςİıﬁ漢字😀👍🏽!!??..--<|>|Жж̧́é٣५क्षि"


@pytest.fixture(scope="module")
def model():
    return bpe.WordBPE(PATH)


def test_tokens_equal_the_library(model):
    rng, library = random.Random(3), Tokenizer.from_file(PATH)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["", None, "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "ab" * 300, "it's the tokenization of internationalisation"]
    for text, words in zip(texts, model.encode(texts)):
        want = library.encode(text or "", add_special_tokens=False).ids
        got = [i for packed, _ in words for i in memoryview(packed).cast("i")]
        assert got == want and " ".join(t for _, t in words) == library.decode(want, skip_special_tokens=False)


def test_neighbour_check_and_merging_agree(model):
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("aeinorsthl") for _ in range(rng.randint(1, 12)))
        ids = model.merged(model._pieces(word + model.end))
        pairs = [(a, b) for a, b in zip(ids, ids[1:])]
        if pairs:
            import numpy as np
            assert model.pairs_hold(*np.array(pairs).T).all()


def test_token_rows(odd, none):
    rows = bpe.digests(bpe.encode_documents(odd.withColumn("ids", F.lit("clash")), PATH)).collect()
    assert len(rows) == len(ODD_ROWS)
    empty = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert all(r["n_tokens"] == 0 and r["ids_sha256"] == hashlib.sha256(b"").hexdigest() == r["decoded_sha256"] for r in empty)
    assert bpe.digests(bpe.encode_documents(none, PATH)).count() == 0


def test_forgotten_words_are_learnt_again(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 50)
    small, texts = bpe.WordBPE(PATH), [f"word{i % 90} number{i} and the rest" for i in range(400)]
    whole = Tokenizer.from_file(PATH)
    for text, words in zip(texts, small.encode(texts)):
        assert b"".join(p for p, _ in words) == b"".join(i.to_bytes(4, "little") for i in whole.encode(text, add_special_tokens=False).ids)


MIT = """Copyright (c) 2020 Some Body. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""


def test_templates_take_optional_and_replaceable_regions():
    t, p = tuple(license_scan.TEMPLATES.items()), tuple(license_scan.PHRASES.items())
    assert "mit" in [x[2] for x in license_scan.scan(MIT.encode(), t, p)["spans"]]
    assert license_scan.scan(MIT.replace("free of charge", "for a charge").encode(), t, p)["spans"] == []
    own = (("x", "alpha <<beginOptional>>beta <<beginOptional>>gamma<<endOptional>><<endOptional>> <<var;1-2>> omega"),)
    accepted = lambda s: bool(license_scan.scan(s.encode(), own, ())["spans"])
    assert all(map(accepted, ["alpha beta gamma y omega", "Alpha; beta y z OMEGA", "alpha y omega", "alpha beta omega"]))
    assert not any(map(accepted, ["alpha omega", "alpha y z w q omega", "beta gamma y omega", "alpha y"]))
    for bad in ("a <<beginOptional>> b", "a <<endOptional>>", "a <<what>>"):
        with pytest.raises(ValueError):
            license_scan.compile_template(bad)


def longest_match(parts, words, at):
    """End of the longest way through a template from ``at``, by trying all; parts are words, (low, high) and lists that may be left out."""
    if not parts:
        return at
    head, rest = parts[0], parts[1:]
    if isinstance(head, bytes):
        tries = [at + 1] if at < len(words) and words[at] == head else []
        ends = [longest_match(rest, words, t) for t in tries]
    elif isinstance(head, tuple):
        ends = [longest_match(rest, words, at + n) for n in range(head[0], head[1] + 1) if at + n <= len(words)]
    else:
        ends = [longest_match(rest, words, at), longest_match([*head, *rest], words, at)]
    return max((e for e in ends if e is not None), default=None)


def test_automata_accept_what_trying_all_ways_accepts():
    rng = random.Random(8)

    def template(depth):
        out = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.random()
            if kind < 0.55 or depth == 0:
                out.append(rng.choice([b"a", b"b", b"c"]))
            elif kind < 0.75:
                low = rng.randint(0, 2)
                out.append((low, low + rng.randint(0, 2)))
            else:
                out.append(template(depth - 1))
        return out

    def written(parts):
        return " ".join(p.decode() if isinstance(p, bytes) else f"<<var;{p[0]}-{p[1]}>>" if isinstance(p, tuple)
                        else f"<<beginOptional>>{written(p)}<<endOptional>>" for p in parts)

    found = 0
    for _ in range(400):
        parts = [rng.choice([b"a", b"b"]), *template(2)]
        words = rng.choices([b"a", b"b", b"c"], k=rng.randint(1, 9))
        spans = license_scan.scan(b" ".join(words), (("x", written(parts)),), ())["spans"]
        want = [(at, end, "x") for at in range(len(words)) if (end := longest_match(parts, words, at)) is not None]
        assert spans == want, (written(parts), words)
        found += len(want)
    assert found > 200


def test_licence_rows(docs, odd, none):
    texts = ["The MIT License, the mit license. Apache-License?", "General public licenses", None, "x" + " mit license" * 1000]
    rows = {r["doc_id"]: r for r in license_scan.report(license_scan.license_spans(docs(list(enumerate(texts))))).collect()}
    assert (rows[0]["n_words"], rows[0]["n_base"], rows[0]["first_word"], rows[0]["last_word"], rows[0]["base_labels"]) == (8, 3, 1, 6, "apache,mit")
    assert rows[1]["n_base"] == 0 and rows[1]["first_word"] is None and rows[1]["labels"] == "" and rows[1]["score"] == 0
    assert rows[2]["n_words"] == 0 and rows[3]["n_base"] == 1000 and rows[3]["last_word"] == 1999
    assert license_scan.report(license_scan.license_spans(odd)).count() == len(ODD_ROWS)
    assert license_scan.report(license_scan.license_spans(none)).count() == 0


def plain_alignment(a, b):
    h, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = [[rng.randint(1, 4) for _ in range(rng.randint(1, 12))] for _ in range(2)]
        assert decontaminate.smith_waterman(np.array(a), np.array(b))[0] == plain_alignment(a, b)


def test_exact_and_edited_leaks_are_found_and_others_left(spark, docs):
    rng = random.Random(4)
    words = lambda n: [rng.choice("bcdfgklmnprst") + rng.choice("aeiou") + rng.choice("bdgklmnrst") for _ in range(n)]
    items = [words(35) for _ in range(20)] + [words(2)]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(98, None), (99, " ")], "item_id bigint, text string")
    rows, leaked = [], set()
    for k in range(120):
        body = words(200)
        if k % 3 == 0:
            item = list(items[k % 20])
            if k % 2:
                for at in rng.sample(range(35), 4):
                    item[at] = "changed"
                del item[20]
            body[50:50] = item
            leaked.add((k, k % 20))
        rows.append((k, ", ".join(body).upper()))
    found = decontaminate.leaks(docs(rows + ODD_ROWS_LIKE), benchmark).where("item_id < 20")
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == leaked
    small = decontaminate.leaks(docs(rows), benchmark, decontaminate.Settings(block_items=3)).where("item_id < 20")
    assert {(r["doc_id"], r["item_id"]) for r in small.collect()} == leaked
    kept = decontaminate.without_leaks(docs(rows), benchmark.where("item_id < 20"))
    assert {r["doc_id"] for r in kept.collect()} == set(range(120)) - {d for d, _ in leaked} and kept.columns == docs([]).columns
    assert decontaminate.leaks(docs([]), benchmark).count() == 0 and decontaminate.leaks(docs(rows), benchmark.limit(0)).count() == 0


def test_many_equally_edited_leaks_are_found_beside_an_exact_one(spark, docs):
    rng = random.Random(8)
    item, outside = [f"w{k}" for k in range(38)], lambda n: [f"o{rng.randint(0, 10**6)}" for _ in range(n)]
    edited = ["changed" if k in (6, 18, 30) else w for k, w in enumerate(item)]
    rows = [(k, " ".join(outside(40) + (item if k == 0 else edited) + outside(40))) for k in range(301)]
    # common trigrams of the item alone are no leak
    rows += [(1000 + k, " ".join(outside(40) + item[:3] + outside(40) + item[20:23])) for k in range(30)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    found = {r["doc_id"]: r["score"] for r in decontaminate.leaks(docs(rows), benchmark).collect()}
    assert found == {0: 1.0} | {k: (2 * 35 - 3) / 76 for k in range(1, 301)}
    assert {r["doc_id"] for r in decontaminate.without_leaks(docs(rows), benchmark).collect()} == set(range(1000, 1030))


def test_long_runs_and_long_insertions_are_found(spark, docs):
    item, long = [f"w{k}" for k in range(40)], [f"v{k}" for k in range(500)]
    other = lambda n: [f"o{k}" for k in range(n)]
    rows = [(1, item[:20] + other(28) + item[20:]), (2, item[:20] + other(36) + item[20:]), (3, other(30) + long[100:350] + other(9)),
            (4, long[200:260]), (5, other(30) + long[100:149] + other(9)), (6, item[:22])]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(long))], "item_id bigint, text string")
    found = decontaminate.leaks(docs([(k, " ".join(w)) for k, w in rows]), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found} == {(1, 1): 0.65, (3, 2): 0.5, (4, 2): 0.12}


def seeded(items, texts, settings=decontaminate.Settings()):
    """A block whose seeds are chosen by plain counts over the texts."""
    block = decontaminate.Block.of(list(enumerate(" ".join(w) for w in items)), settings)
    counts = Counter(c for t in texts for n in decontaminate.WIDTHS for c in block.codes(block.ids(" ".join(t)), n).tolist())
    return block.choose(np.array([counts[c] for c in block.grams.tolist()], dtype=np.int64))


def test_leaks_equal_the_alignment_of_whole_texts():
    rng = random.Random(5)
    for k in range(250):
        item = [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 20))]
        text = [w for w in item for w in ([w] if rng.random() < .7 else [w, *rng.choices("abcxyz", k=rng.randint(1, 6))] if rng.random() < .6 else [])]
        text = rng.choices("abcdefgh", k=rng.randint(0, 30)) + text + rng.choices("abcdefgh", k=rng.randint(0, 30))
        # common words and pairs beside it, so that the rare ones differ from case to case
        others = [rng.choices("abcdefghijklmnop", k=40) for _ in range(k % 4)] + [item[a:a + 4] * 50 for a in range(0, len(item), 1 + k % 7)]
        got = decontaminate.aligned(seeded([item], [text, *others]), " ".join(text))
        score = plain_alignment(item, text) / 2
        assert [x[1] for x in got] == [score / len(item)] * (score >= max(0.6 * len(item), min(len(item), 3)) - 1e-9)


def test_every_sufficient_alignment_of_a_longer_item_has_a_seed():
    """Pieces of 50 words in a row, and thin copies of the whole item, however common each of its pairs is elsewhere."""
    rng = random.Random(6)
    for length in (60, 84, 100, 131, 200):
        item = [rng.choice("abcdefghijklmnopqrst") + rng.choice("xyz") for _ in range(length)]
        common = [item[a:a + 2] * rng.randint(1, 90) for a in range(length)]
        start = rng.randint(0, length - 50)
        thin = [w for k, w in enumerate(item) for w in ([w, "between"] if k % 2 else [w])]
        for text in (item[start:start + 50], thin):
            text = ["before"] * 5 + text + ["after"] * 5
            block = seeded([item], [text, *common])
            assert len(block.seeds) < len({*zip(item, item[1:])} | {*item})
            assert [x[1] for x in decontaminate.aligned(block, " ".join(text))] == [plain_alignment(item, text) / (2 * length)]


def test_copies_without_three_adjacent_words_are_found(spark, docs):
    """Recall on rewritten copies: a word put in after every second one, and words changed at random, beside clean documents."""
    rng = random.Random(9)
    words = lambda n: [f"{rng.choice('bcdfgklm')}{rng.choice('aeiou')}{rng.choice('rstx')}" for _ in range(n)]
    items = [words(rng.randint(20, 60)) for _ in range(30)]
    rows, planted, enough = [], set(), set()
    for d in range(90):
        item = items[d % 30]
        if d < 30:
            copy = [w for k, w in enumerate(item) for w in ([w, "indeed"] if k % 2 else [w])]
        else:
            copy = [w if rng.random() > 0.15 else "changed" for w in item]
        text = words(100) + copy + words(100)
        rows.append((d, " ".join(text)))
        planted.add((d, d % 30))
        enough |= {(d, k) for k in (d % 30,) if plain_alignment(items[k], text) >= 1.2 * len(items[k]) - 1e-9}
    rows += [(1000 + d, " ".join(words(200))) for d in range(60)]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs(rows), benchmark).collect()}
    assert found & planted == enough and len(enough) >= 0.9 * len(planted)
    assert not any(d >= 1000 for d, _ in found)


ODD_ROWS_LIKE = [(1000 + i, *r[1:]) for i, r in enumerate(ODD_ROWS)]


def test_languages_of_held_out_texts(docs, odd, none):
    rng = random.Random(2)
    parts = {"aa": ["tha", "ing", "ow"], "bb": ["sch", "ung", "ei"], "cc": ["eau", "oi", "que"]}
    rows = [(i, " ".join("".join(rng.choices(parts[l], k=rng.randint(1, 3))) for _ in range(30)), l) for i in range(300) for l in [["aa", "bb", "cc"][i % 3]]]
    model = language_id.train(docs(rows))
    out = language_id.with_language(docs(rows).withColumn("score", F.lit("clash")), model).collect()
    assert all(r["lang_pred"] == r["lang"] and 0.5 < r["score"] <= 1 for r in out)
    strange = language_id.with_language(odd, model).collect()
    assert len(strange) == len(ODD_ROWS) and all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in strange)
    assert language_id.with_language(none, language_id.train(none)).count() == 0
    assert {r["lang_pred"] for r in language_id.with_language(odd, language_id.train(none)).collect()} == {"und"}


def test_kernel_scores_equal_the_unfolded_form():
    texts, langs = ["abab abc", "abba ab", "xyz zyx", "xxy yz"], ["p", "p", "q", "q"]
    settings = language_id.FitSettings(landmarks=2)
    model = language_id.fit(texts, langs, settings)
    sets = [set(model.present(t).tolist()) for t in texts + ["abz"]]
    k = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets[:4]] for a in sets])
    values, vectors = np.linalg.eigh(k[:4])
    phi = k @ (vectors / np.sqrt(values))
    y = np.where(np.array(langs)[:, None] == np.array(["p", "q"]), 1.0, -1.0)
    w = np.linalg.solve(phi[:4].T @ phi[:4] / 2 + settings.ridge / 2 * np.eye(4), phi[:4].T @ y / 2)
    names, scores = model.predict(["abz"])
    value = (phi[4] @ w).max()
    assert names == [["p", "q"][int((phi[4] @ w).argmax())]] and abs(scores[0] - (min(max(value, -1), 1) + 1) / 2) < 1e-6


def test_toxic_texts_are_learnt_from_positives_and_unlabelled(spark, docs, odd, none):
    rng = random.Random(6)
    plain = ["".join(rng.choices("abdeglmnorst", k=rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        words, toxic = rng.choices(plain, k=60), i % 6 == 0
        if toxic:
            words[rng.randrange(60)], words[rng.randrange(60)] = "xidiot", rng.choice(["xscum!", "xmoron"])
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    label_rows = spark.createDataFrame(labels + [(None, 1, 1), (1, None, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs(rows), label_rows)
    got = {r["doc_id"]: r["score"] for r in toxicity.with_scores(docs(rows), model).collect()}
    assert sum((got[i] >= 0.5) == (i % 6 == 0) for i in range(900)) >= 890
    assert toxicity.with_scores(odd, model).count() == len(ODD_ROWS)
    nothing = toxicity.train(none, label_rows.limit(0))
    assert all(r["score"] < 0.5 for r in toxicity.with_scores(odd, nothing).collect()) and toxicity.with_scores(none, nothing).count() == 0


def test_first_step_follows_the_slope_of_the_stated_risk():
    rng = np.random.default_rng(3)
    settings = toxicity.FitSettings(rounds=1, ridge=0.0)
    for prior, share in ((0.1, 0.3), (0.45, 0.02)):
        p, u = (rng.random((50, 4)) < [0.9, 0.5, 0.2, 0.4]).astype(float), (rng.random((300, 4)) < [share, 0.5, 0.6, 0.4]).astype(float)
        one = lambda x: np.hstack([x, np.ones((len(x), 1))])

        def parts(w):
            as_one, as_zero = 1 - toxicity.sigmoid(one(p) @ w), toxicity.sigmoid(one(p) @ w)
            return prior * as_one.mean(), toxicity.sigmoid(one(u) @ w).mean() - prior * as_zero.mean()

        assert parts(np.zeros(5))[1] > 0  # the corrected part counts, so the risk is the plain sum
        slope = np.array([(sum(parts(e * 1e-6)) - sum(parts(-e * 1e-6))) / 2e-6 for e in np.eye(5)])
        w, b = toxicity.nn_pu(p, u, prior, settings)
        # the first step of Adam is the rate against the sign of each slope
        steps = np.append(w, b)
        far = np.abs(slope) > 1e-6
        assert far.sum() >= 4 and np.allclose(steps[far], -settings.rate * np.sign(slope[far]), atol=1e-4)


def test_risk_falls_and_stays_non_negative_in_effect():
    rng = np.random.default_rng(0)
    p, u = (rng.random((60, 1)) < 0.9).astype(float), (rng.random((400, 1)) < 0.2).astype(float)
    w, b = toxicity.nn_pu(p, u, 0.15, toxicity.FitSettings())
    assert w[0] > 1 and b < -1


def test_blocks_of_broken_pages():
    page = ("<html><head><title>t</title><script>var x='</p>';</script><style>p{}</style></head><body><!-- <p>no</p> --><p><b>one<br>two<p>thr&eacute;e &amp;&nbsp; x"
            "<ul><li>a<li>b</ul><div hidden>secret</div><a href='x>y'>link</a></i></body>")
    assert [b.text for b in blocks_of(page)] == ["one two", "thrée & x", "a", "b", "secret", "link"]
    assert blocks_of(None) == blocks_of("") == [] and [b.text for b in blocks_of("a < b <<p>c")] == ["a < b <", "c"]
    assert len(blocks_of("<p>" * 2000 + "<a " * 2000)) <= 2


def test_held_out_pages_are_labelled_right():
    model = html_extract.train()
    wrong = sum(got != want for page, labels in made_pages(120, seed=12) for got, want in zip(model.decode(blocks_of(page)), labels))
    assert wrong <= 3


def test_viterbi_equals_all_label_sequences():
    from itertools import product
    model = html_extract.train(settings=html_extract.FitSettings(made=60, rounds=30))
    for page, _ in made_pages(40, seed=8):
        blocks = blocks_of(page)[:9]
        e = [model.emission(b) for b in blocks]
        score = lambda y: sum(x for x, l in zip(e, y) if l) + sum(model.moves[a][b] for a, b in zip(y, y[1:]))
        best = max(product((0, 1), repeat=len(e)), key=score)
        assert abs(score(tuple(map(int, model.decode(blocks)))) - score(best)) < 1e-9


def test_page_rows(spark):
    pages = spark.createDataFrame([(1, None, None), (1, "u", ""), (2, "u", "<article><p>Main text of the page stands here.</p></article><footer>f</footer>"),
                                   (None, "http://a/5", "<p>" + "long " * 50_000 + "</p>")], "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    rows = html_extract.main_texts(pages, html_extract.train(pages, spark.createDataFrame([(5, "long")], "doc_id bigint, text string"))).collect()
    assert len(rows) == 4 and [r["text"] for r in rows if r["page_id"] == 2] == ["Main text of the page stands here."]
    assert [r["n_chars"] for r in rows if r["page_id"] == 1] == [0, 0] and re.match("long", [r for r in rows if r["page_id"] is None][0]["text"] or "long")


def test_no_text_is_lost_round_raw_and_unclosed_elements():
    def texts(body):
        return [b.text for b in blocks_of(f"<body>{body}</body>")]
    for n in (1, 15, 30, 300):
        assert texts("<p>" + "İ" * n + "</p><SCRIPT>x = '</p>'</ScripT ><p>A</p><p>B</p>") == ["İ" * n, "A", "B"]
    assert texts("<p>one</p><svg width='1'/><p>two</p>") == ["one", "two"]
    assert texts("<p>one</p><svg><path d='M0'/></svg><p>two</p>") == ["one", "two"]
    assert texts("<div><button>press</div><p>two</p><p>three</p>") == ["press", "two", "three"]
    assert texts("<p>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p><object><p>shown</p></object>") == ["let x=2 be", "shown"]
    assert texts("<p>one</p><styles>two</styles><style>p{}</styleX></style><p>three</p>") == ["one", "two", "three"]
    assert texts("<p>one</p><script>never closed <p>two</p>") == ["one"]


def test_extractor_does_not_depend_on_the_order_of_repeated_ids(spark):
    pages = [(i % 4, f"http://a/{i % 3}", f"<nav>home {i}</nav><p>{'text of the page number ' + str(i)} </p>") for i in range(12)]
    documents = [(i % 3, f"text of the page number {i}") for i in range(12)]
    models = [html_extract.train(spark.createDataFrame(p, "page_id bigint, url string, html string"), spark.createDataFrame(d, "doc_id bigint, text string"),
                                 html_extract.FitSettings(made=20, rounds=5)) for p, d in ((pages, documents), (pages[::-1], documents[::-1]))]
    page = "<nav>menu</nav><article><p>some words here.</p></article>"
    assert models[0].main_text(page) == models[1].main_text(page)
    named = spark.createDataFrame([("x", "http://a/1", "<p>one</p>")], "page_id string, url string, html string")
    assert html_extract.main_texts(named, html_extract.train(named, spark.createDataFrame([(1, "one")], "doc_id bigint, text string"))).first()["page_id"] == "x"


def test_very_long_words_are_merged_in_time(model):
    rng, library = random.Random(4), Tokenizer.from_file(PATH)
    for letters in ("acgt", "ab", "x", "é1"):
        word = "".join(rng.choices(letters, k=200_000))
        began = time.monotonic()
        [words] = model.encode([word])
        assert time.monotonic() - began < 30
        assert [i for packed, _ in words for i in memoryview(packed).cast("i")] == library.encode(word, add_special_tokens=False).ids
