"""The pipeline's near-dedup stage against brute-force Jaccard similarity."""

import random

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from foldmill.llm import near_copies, simhash
from llm import brute
from llm.brute import kept_of_similar as kept, shingles

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def near_texts():
    rng = random.Random(11)
    rows = []
    for family in range(25):      # similarities from 0.5 to 1
        own = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([12, 60, 300]))]
        rows += [edited(rng, own, rng.randint(0, max(1, len(own) // 20))) for _ in range(8)]
    rows += ["a b c", "A b  C", "a b", "", None, " \n", "a a a a a a a a a", "a a a a a a"]
    rng.shuffle(rows)
    return list(enumerate(rows, start=-5))


@pytest.mark.parametrize("block", [near_copies.BLOCK, 3])
def test_stage_keeps_one_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rows = near_texts()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows] + [(None, "a b", "en", "s", 0)] * 2, DOCS)
    found = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert found.count(None) == 2
    assert {i for i in found if i is not None} == kept(rows)


def test_stage_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == kept(rows)


def test_bands_meet_at_the_similarity():
    # 4,000 pairs of similarity 0.8: none without a shared band, and about 0.8 ** 6 of bands shared.
    rng = np.random.default_rng(12)
    hashes = np.concatenate([np.sort(np.concatenate([both, own])) for both, owns in (
        (rng.integers(0, 1 << 63, 80, np.uint64), rng.integers(0, 1 << 63, (2, 10), np.uint64))
        for _ in range(4000)) for own in owns])
    keys = near_copies.bands(hashes, np.full(8000, 90)).reshape(4000, 2, -1)
    equal = keys[:, 0] == keys[:, 1]
    assert equal.any(axis=1).all()
    assert equal.mean() == pytest.approx(0.8 ** near_copies.ROWS, abs=0.01)


def test_close_links_come_from_fingerprints(spark, monkeypatch):
    # Without bands only SimHash links are left: those within its distance, if the sets are similar.
    found_by = near_copies._members
    monkeypatch.setattr(near_copies, "_members", lambda nodes: found_by(nodes).limit(0))
    rng = random.Random(13)
    rows = []
    for family in range(30):
        own = [f"w{rng.randrange(3000)}" for _ in range(400)]
        rows += [" ".join(own), edited(rng, own, 1), edited(rng, own, 200)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    component = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
    sets = [shingles(t) for t in rows]
    hashes = [np.array([xxhash.xxh64_intdigest(s, simhash.SEED) for s in own], np.uint64) for own in sets]
    prints = simhash.majority(np.concatenate(hashes), np.array([len(h) for h in hashes]))
    near = {i for i in range(0, 90, 3) if np.bitwise_count(prints[i] ^ prints[i + 1]) <= simhash.DISTANCE}
    assert len(near) > 20
    for i in range(0, 90, 3):
        assert component[i] == i and component[i + 2] == i + 2
        assert component[i + 1] == (i if i in near else i + 1)
