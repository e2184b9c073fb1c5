"""Near-duplicate groups and the pipeline against brute force."""

import os
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stationflow.llm import components, simhash
from .conftest import ODD_ROWS


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    """Smallest index reachable by steps of at most three bits, for every index."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 3 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def near_copies(seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(1, 6)))
    rows = []
    for k in range(12):
        base = [word() for _ in range(rng.choice([1, 2, 3, 30, 200]))]
        for c in range(rng.randint(1, 8)):
            copy = list(base)
            if c and len(copy) > 3:
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy).upper() if c % 2 else "  ".join(copy))
    return rows


def test_groups_equal_brute_force(docs):
    texts = near_copies() + ["", None, " \n", "a"]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs(list(enumerate(texts)))).withColumn("hex", simhash.as_hex(F.col("fp"))).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    label = plain_groups(fps)
    for i in range(len(texts)):
        assert got[i]["hex"] == f"{fps[i]:016x}" and got[i]["component_id"] == label[i]


def test_long_lists_lose_no_link(spark, docs, monkeypatch):
    monkeypatch.setattr(simhash, "LIST", 4)
    rng = random.Random(3)
    fps = {rng.getrandbits(64)}
    while len(fps) < 160:
        fps.add(rng.choice(sorted(fps)) ^ (1 << rng.randrange(40)) ^ (1 << rng.randrange(64)))
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    got = {r["fp"]: r["root"] for r in simhash.fingerprint_groups(spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect()}
    label = plain_groups(fps)
    for i, x in enumerate(signed):
        members = [signed[j] for j in range(len(fps)) if label[j] == label[i]]
        assert got.get(x, x) == min(members)


def test_every_close_pair_meets_in_a_list():
    for shared in range(256):
        if shared.bit_count() == simhash.SHARED:
            assert sum(all(shared >> p & 1 for p in c) for c in simhash.POSITION_SETS) == 1


def test_chains_are_followed_to_the_end(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)], "a bigint, b bigint")
    got = {r["fp"]: r["root"] for r in components.label_components(links).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(40)) and len(got) == 101
    assert components.label_components(links.limit(0)).count() == 0


def test_one_row_of_each_group_stays(docs, odd, none):
    texts = near_copies(5)
    label = plain_groups([plain_fingerprint(t) for t in texts])
    df = docs([(i, t) for i, t in enumerate(texts)] + [(i, t) for i, t in enumerate(texts[:5])])
    kept = simhash.keep_one(df.withColumn("fp", F.lit("extra")))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(label)) and kept.columns == [*df.columns, "fp"]
    fps = [plain_fingerprint(r[1]) for r in ODD_ROWS]
    assert simhash.keep_one(odd).count() == len(set(plain_groups(fps)))
    assert simhash.near_duplicates(odd).count() == len(ODD_ROWS)
    assert simhash.keep_one(none).count() == 0 and simhash.near_duplicates(none).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the given tables")
def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline as cp
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(cp.STAGES) == 5
    state, texts = docs, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in cp.STAGES:
        before = {r["doc_id"] for r in state.select("doc_id").collect()}
        out = stage(spark, state, sf).cache()
        after = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert after <= before and len(after) > 0.5 * len(before), name
        if name == "near_duplicates":
            ids = sorted(before)
            label = plain_groups([plain_fingerprint(texts[i]) for i in ids])
            assert after == {ids[k] for k in set(label)}
        if name == "decontamination":
            from stationflow.llm.decontaminate import words_of
            items = [" " + " ".join(words_of(r["text"])) + " " for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert after == {i for i in before if not any(x in " " + " ".join(words_of(texts[i])) + " " for x in items)}
        if name != "tokens":
            assert out.columns == docs.columns
        state = out
    assert cp.run(spark, sf).count() == state.count()
