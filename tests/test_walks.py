"""Letter-pair shuffles that are walked side by side."""

import random
import tracemalloc
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from foldmill.operators import walks
from foldmill.operators.scorers import NeighbourScorer, walk_seed
from foldmill.operators.walks import shuffle_all


def pairs(text):
    return Counter(zip(text, text[1:]))


@pytest.mark.parametrize("few", [0, 24, 10 ** 9])
def test_walks_do_not_depend_on_their_company(monkeypatch, few):
    rng = random.Random(1)
    seqs = ["", "a", "ab", "aab", "aaaa", "éü€a", "abcabcabd" * 9] + [
        "".join(rng.choice("ACGU") for _ in range(rng.randint(2, 400))) for _ in range(50)]
    owners = [i for i in range(len(seqs)) for _ in range(3)]
    seeds = [walk_seed(1, str(o), n) for n, o in enumerate(owners)]
    alone = [shuffle_all([seqs[o]], [0], [s])[0] for o, s in zip(owners, seeds)]
    monkeypatch.setattr(walks, "FEW", few)
    assert shuffle_all(seqs, owners, seeds) == alone
    for owner, shuffled in zip(owners, alone):
        own = seqs[owner]
        assert pairs(shuffled) == pairs(own) and shuffled[:1] == own[:1] and shuffled[-1:] == own[-1:]
    assert len(set(alone[-150:])) > 140


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet="abcé\x00", max_size=40), max_size=6), st.integers(0, 2 ** 64 - 1))
def test_pairs_and_ends_stay(seqs, seed):
    owners = list(range(len(seqs))) * 2
    for owner, shuffled in zip(owners, shuffle_all(seqs, owners, [seed ^ n for n in range(len(owners))])):
        own = seqs[owner]
        assert pairs(shuffled) == pairs(own) and shuffled[:1] == own[:1] and shuffled[-1:] == own[-1:]


@pytest.mark.parametrize("few", [0, 10 ** 9])
def test_every_shuffle_is_as_likely(monkeypatch, few):
    monkeypatch.setattr(walks, "FEW", few)
    rng = random.Random(few)
    found = Counter(shuffle_all(["ABACABDA"], [0] * 24_000, [rng.getrandbits(64) for _ in range(24_000)]))
    assert len(found) == 6 and all(abs(n - 4000) < 350 for n in found.values())


def test_energies_take_memory_for_one_sequence():
    seqs = ["acgu" * 5000] * 100
    tracemalloc.start()
    try:
        energies = NeighbourScorer().fold(seqs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(set(energies)) == 1 and peak < 2_000_000
