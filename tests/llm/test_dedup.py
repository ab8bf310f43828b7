"""Operators 4, 9 and 10 against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from foldmill.llm.components import component_labels
from foldmill.llm.lempel_ziv import duplicate_spans
from foldmill.llm.prefix_free import repeated_bytes
from foldmill.llm.simhash import (CHAIN, SEGMENTS, _in_budget, _masks, chain_patterns, keep_one, linked,
                                  near_links, simhash_components)
from llm import brute

SCHEMA = "doc_id long, text string"


def texts(seed=1, docs=120):
    """Copies, shared passages, loops, breaks in the middle of copies, nulls and empty texts."""
    rng = random.Random(seed)
    vocabulary = [w + rng.choice(["", ".", ",", "é"]) for w in "a bb ccc the of dog runs ßü x".split()]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(15, 60))) for _ in range(6)]
    out = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            if kind < 0.4:
                parts.append(rng.choice(passages))
            elif kind < 0.5:
                parts.append(" ".join(rng.choices(vocabulary, k=2) * rng.randint(1, 60)))
            elif kind < 0.6:
                cut = rng.choice(passages)
                parts.append(cut[rng.randint(0, len(cut)):])
            else:
                parts.append(" ".join(f"{rng.choice(vocabulary)}{rng.randint(0, 99)}"
                                      for _ in range(rng.randint(1, 50))))
        out.append(rng.choice(["\n", "  ", "\t"]).join(parts) if rng.random() < 0.95 else None)
    return list(enumerate(out, start=-10))


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup(spark, seed):
    rows = texts(seed)
    found = duplicate_spans(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute.substring_dedup(rows)
    own = dict(rows)
    for r in found:
        gone = {i for s in r.spans for i in range(s.start, s.start + s.length)}
        kept = [w for i, w in enumerate(brute.words(own[r.doc_id])) if i not in gone]
        assert len(gone) == r.n_removed
        assert brute.words(r.kept_text) == tuple(kept)
        assert gone or r.kept_text == (own[r.doc_id] or "")


@pytest.mark.parametrize("seed", [3, 4])
def test_byte_dedup(spark, seed):
    rows = texts(seed)
    found = repeated_bytes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
            for r in found} == brute.byte_dedup(rows)


def test_dedup_of_small_windows(spark):
    rows = texts(5, 60)
    found = duplicate_spans(spark.createDataFrame(rows, SCHEMA), window=5, gram=2).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
            for r in found} == brute.substring_dedup(rows, 5)


@pytest.mark.parametrize("operator", [duplicate_spans, repeated_bytes, simhash_components])
def test_odd_tables(spark, operator):
    long_text = " ".join(f"w{i}" for i in range(60))
    empty = spark.createDataFrame([], SCHEMA + ", lang string")
    assert operator(empty).count() == 0
    # Nulls everywhere, repeated rows, an id with two texts, columns with clashing names.
    rows = [(None, long_text), (None, None), (1, long_text), (1, long_text), (2, None), (2, "x"), (3, "")]
    clash = spark.createDataFrame(
        [(i, t, "p", 1, [1], "w", 0, "r") for i, t in rows],
        SCHEMA + ", part string, place long, lone array<int>, windows string, fingerprint int, rest string")
    found = operator(clash).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
    if operator is duplicate_spans:
        assert sorted(r.n_removed for r in found if r.doc_id == 1) == [0, 60]
        assert sorted(r.n_removed for r in found if r.doc_id is None) == [0, 0]
    if operator is repeated_bytes:
        assert sorted(r.n_removed for r in found if r.doc_id == 1) == [0, len(long_text)]
    if operator is simhash_components:
        assert {r.component_id for r in found if r.doc_id is None} == {None}
        assert {r.component_id for r in found if r.doc_id in (2, 3)} == {2}


def test_dedup_carries_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (None, None, "y")], SCHEMA + ", part string")
    assert sorted(r.rest.part for r in duplicate_spans(docs, carry=True).collect()) == ["x", "y"]


def test_very_long_text(spark):
    word = " ".join(f"w{i % 977}" for i in range(300_000))
    found = duplicate_spans(spark.createDataFrame([(1, word)], SCHEMA)).first()
    assert (found.n_words, found.n_removed) == (300_000, 300_000 - 977)


def test_simhash(spark):
    rows = texts(7, 80)
    rng = random.Random(8)
    for i in range(60):     # near copies of one text
        own = [f"word{n}" for n in range(300)]
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(300)] = "Changed"
        rows.append((1000 + i, " ".join(own)))
    found = simhash_components(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = {i: brute.simhash(t) for i, t in rows}
    assert {r.doc_id: r.fingerprint % 2 ** 64 for r in found} == prints
    labels = brute.components(prints)
    assert {r.doc_id: r.component_id for r in found} == labels
    stay = keep_one(spark.createDataFrame(rows + [(None, "x")], SCHEMA)).collect()
    assert {r.doc_id for r in stay} == set(labels.values()) | {None}


def test_links_of_random_fingerprints(spark):
    rng = random.Random(9)
    prints = set()
    for _ in range(40):
        center = rng.getrandbits(64)
        for _ in range(20):
            near = center
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                near ^= 1 << bit
            prints.add(near)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = near_links(spark.createDataFrame(signed, "fingerprint long"))
    labels = {r.node: r.component for r in component_labels(edges, "one", "other").collect()}
    want = brute.components({s[0]: s[0] % 2 ** 64 for s in signed})
    assert {s[0]: labels.get(s[0], s[0]) for s in signed} == want


def test_links_across_blocks(spark, monkeypatch):
    monkeypatch.setattr("foldmill.llm.simhash.BLOCK", 8)
    prints = [(1 << b | 1 << c,) for b in range(12) for c in range(b)]
    edges = near_links(spark.createDataFrame(prints, "fingerprint long"))
    assert {r.component for r in component_labels(edges, "one", "other").collect()} == {3}


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 63), max_size=4))
def test_every_near_pair_has_a_key(bits):
    difference = sum(1 << b for b in bits)
    assert any(not difference & mask and _in_budget(np.array([difference], np.uint64), start, 4, SEGMENTS)[0]
               for start, mask in _masks(4, SEGMENTS, CHAIN))


def test_chain_patterns():
    assert chain_patterns(4, 8, 5) == [(0, 1, 2), (0, 1, 3), (0, 1, 4), (0, 2, 3), (0, 2, 4)]


def test_walk_gives_a_forest():
    values = np.array([0, 1, 3, 7, 15, 255 << 40], np.uint64)
    assert len(linked(values, 4)) == 4


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 160)]
    odd = [(7, 7), (None, 3)]
    found = component_labels(spark.createDataFrame(path + star + odd, "a long, b long"), "a", "b").collect()
    assert {(r.node, r.component) for r in found} == (
        {(i, 0) for i in range(61)} | {(i, 100) for i in range(100, 160)})
    nothing = spark.createDataFrame([], "a long, b long")
    assert component_labels(nothing, "a", "b").count() == 0


@pytest.mark.parametrize("size", [64, 1024, 2048, 4096])
def test_words_that_a_rolling_hash_confuses(spark, size):
    """A Thue-Morse word and its complement in two documents of 21 words that else agree."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(size))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(n, " ".join([*(f"w{i}" for i in range(10)), word, *(f"v{i}" for i in range(10))]))
            for n, word in enumerate([one, other, one])]
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in
             duplicate_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute.substring_dedup(rows)
    assert [found[n][1] for n in range(3)] == [0, 0, 21]
