"""Operators 2 and 5 against plain restatements, and very long texts."""

import itertools
import math
import random

import numpy as np
import pytest

from foldmill.llm.line_quality import Chain
from foldmill.llm.order_minhash import fingerprint_edits
from llm import brute


def texts():
    rng = random.Random(2)
    rows = [None, "", " \n ", "one", "one two", "a b c", "a b c a b c a b c", "x " * 500, "ü€ 𝄞 ü€ 𝄞"]
    rows += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 400))) for _ in range(25)]
    rows.append(" ".join(f"w{rng.randrange(5000)}" for _ in range(60_000)))     # very long
    return list(enumerate(rows))


def test_fingerprints_are_those_of_the_definition(spark):
    rows = texts()
    found = {r.doc_id: r for r in fingerprint_edits(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        text, follower = text or "", rows[i - 1][1] or ""       # descending ids, the first after the last
        third = len(text) // 3
        edited = text[:len(text) - third] + follower[:third]
        row, own = found[i], brute.order_minhash(text)
        assert row.fingerprint == own and row.edited_fingerprint == brute.order_minhash(edited)
        assert row.near_edited == pytest.approx(brute.order_likeness(own, brute.order_minhash(edited)))
        assert row.near_next == pytest.approx(brute.order_likeness(own, brute.order_minhash(follower)))


def enumerated(scores, steps):
    """Log of the sum over all labelings, P(good) per line and expected steps."""
    total, good, pairs = 0.0, np.zeros(len(scores)), np.zeros((2, 2))
    for labels in itertools.product((0, 1), repeat=len(scores)):
        weight = math.exp(sum(s for s, y in zip(scores, labels) if y)
                          + sum(steps[a][b] for a, b in zip(labels, labels[1:])))
        total += weight
        good += weight * np.array(labels)
        for a, b in zip(labels, labels[1:]):
            pairs[a][b] += weight
    return math.log(total), good / total, pairs / total


def test_marginals_are_those_of_all_labelings():
    rng = np.random.default_rng(4)
    chain = Chain(3)
    chain.steps = rng.normal(size=(2, 2))
    sizes = [1, 5, 2, 7, 3, 1]
    rows = np.concatenate([[0], np.cumsum(sizes)])
    scores = 2 * rng.normal(size=rows[-1])
    good, pairs = chain.marginals(scores, rows)
    want = [enumerated(scores[a:b], chain.steps) for a, b in zip(rows[:-1], rows[1:])]
    assert good == pytest.approx(np.concatenate([w[1] for w in want]))
    assert pairs == pytest.approx(sum(w[2] for w in want))


def test_marginals_are_the_slope_of_the_likelihood():
    """The slope of the log sum by the score of a line is its marginal, by a step its expected number."""
    rng = np.random.default_rng(5)
    chain = Chain(1)
    chain.steps = rng.normal(size=(2, 2))
    scores, tiny = rng.normal(size=6), 1e-6
    good, pairs = chain.marginals(scores, np.array([0, 6]))
    for at in range(6):
        moved = scores + tiny * (np.arange(6) == at)
        slope = (enumerated(moved, chain.steps)[0] - enumerated(scores, chain.steps)[0]) / tiny
        assert good[at] == pytest.approx(slope, abs=1e-4)
    for a, b in itertools.product((0, 1), repeat=2):
        moved = chain.steps.copy()
        moved[a, b] += tiny
        slope = (enumerated(scores, moved)[0] - enumerated(scores, chain.steps)[0]) / tiny
        assert pairs[a, b] == pytest.approx(slope, abs=1e-4)
