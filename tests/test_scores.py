"""Medians, scores, positions and folds against plain arithmetic."""

import random
import statistics
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from foldmill.operators import keys, ranking, robust, scoring, selection
from foldmill.operators.scorers import (
    PAIR_ENERGY, CommandScorer, LetterGraph, PairingScorer, dinucleotide_shuffle, iteration_rng)


def scores(spark, cases, **options):
    """Scores of (name, observed, requested, values) cases."""
    observed = spark.createDataFrame([c[:3] for c in cases], "k string, orig_mfe double, n_shuffles int")
    background = spark.createDataFrame([(c[0], v) for c in cases for v in c[3]], "k string, mfe double")
    result = robust.with_error(robust.score(robust.summarise(observed, background, ["k"], **options)))
    return {r.k: r for r in result.collect()}


GOLDEN = [
    ("below", -6.0, 5, [-5, -4, -3, -2, -1], -3.0, -2.0235, 1 / 6, 0),
    ("lost", -6.0, 6, [-5, -4, -3, -2, -1], -3.0, -2.0235, 2 / 7, 1),
    ("above", -2.0, 6, [-5, -4, -3, -2, -1], -3.0, 0.6745, 5 / 7, 1),
    ("flat", -3.0, 3, [-3, -3, -3], -3.0, None, 1.0, 0),
    ("none", -4.2, 0, [], None, None, None, 0),
]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_golden_scores(spark, limit):
    got = scores(spark, [(n, o, e, [float(v) for v in vs]) for n, o, e, vs, *_ in GOLDEN],
                 final_rows=limit)
    for name, observed, requested, _, median, z, p, missing in GOLDEN:
        row = got[name]
        assert (row.median_mfe, row.n_missing, row.n_shuffles_requested) == (median, missing, requested)
        assert row.zscore == (None if z is None else pytest.approx(z, abs=1e-4))
        assert row.pvalue == (None if p is None else pytest.approx(p))


def test_too_few_valid_shuffles(spark):
    got = scores(spark, [("bad", -1.0, 100, [float(-i) for i in range(89)]),
                         ("good", -1.0, 100, [float(-i) for i in range(90)])])
    assert got["bad"].error == "insufficient shuffles (89/100)" and got["good"].error is None


@pytest.mark.parametrize("limit", [1_000_000, 20, 0])
def test_random_groups(spark, limit):
    rng = random.Random(limit)
    cases = []
    for i in range(40):
        size = rng.choice([1, 2, 3, 10, 15, 60])
        values = [round(rng.uniform(-9, 0), rng.choice([0, 2])) for _ in range(size)]
        cases.append((f"k{i}", round(rng.uniform(-9, 0), 2), size + rng.randint(0, 3), values))
    got = scores(spark, cases, final_rows=limit)
    for name, observed, requested, values in cases:
        median = statistics.median(values)
        mad = statistics.median(abs(v - median) for v in values)
        lost = requested - len(values) if observed <= median else 0
        row = got[name]
        assert row.median_mfe == pytest.approx(median) and row.n_valid == len(values)
        assert row.pvalue == pytest.approx(
            (sum(v <= observed for v in values) + lost + 1) / (requested + 1))
        assert row.zscore == (None if mad == 0 else pytest.approx((observed - median) / (mad * 1.4826)))


def test_index_and_median_of_one_large_group(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "small").otherwise("large").alias("g"),
        F.pmod(F.col("id") * 7919, F.lit(5003)).alias("v"))
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.g, []).append(r.v)
    indexed = ranking.with_index(rows, ["g"], ["v"]).collect()
    for group, values in groups.items():
        assert [r.v for r in sorted((r for r in indexed if r.g == group), key=lambda r: r.idx)] == sorted(values)
        assert sorted(r.idx for r in indexed if r.g == group) == list(range(len(values)))
    medians = {r.g: r.median for r in selection.grouped_median(rows, ["g"], "v").collect()}
    assert medians == {g: statistics.median(v) for g, v in groups.items()}


@pytest.mark.parametrize("bound", ["BROADCAST_ROWS", "BROADCAST_TEXT_BYTES"])
def test_large_key_tables_are_shuffled(spark, monkeypatch, bound):
    cases = [(f"k{i}", -1.0, 9, [float(-j) for j in range(i + 3)]) for i in range(6)]
    want = {k: (r.median_mfe, r.zscore, r.pvalue) for k, r in scores(spark, cases).items()}
    monkeypatch.setattr(keys, bound, 0)
    got = scores(spark, cases, final_rows=4)
    assert {k: (r.median_mfe, r.zscore, r.pvalue) for k, r in got.items()} == want


def test_index_of_equal_rows(spark):
    rows = spark.range(0, 3000, 1, 12).select(F.lit("g").alias("g"), F.lit(1).alias("v"))
    indexed = ranking.with_index(rows, ["g"], ["v"])
    assert sorted(r.idx for r in indexed.collect()) == list(range(3000))


def test_index_over_all_rows_and_null_groups(spark):
    rows = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, v int")
    assert {(r.g, r.v): r.idx for r in ranking.with_index(rows, ["g"], ["v"]).collect()} == \
        {(None, 1): 0, (None, 3): 1, ("a", 2): 0}
    assert [r.v for r in ranking.with_index(rows, [], [F.col("v").desc()]).orderBy("idx").collect()] == [3, 2, 1]


@settings(max_examples=200, deadline=None)
@given(st.text("ACGU", max_size=60) | st.text(max_size=30), st.integers(0, 5))
def test_shuffle_keeps_letter_pairs(seq, seed):
    out = dinucleotide_shuffle(seq, iteration_rng(seed, "s", 1))
    assert Counter(zip(out, out[1:])) == Counter(zip(seq, seq[1:]))
    assert out[:1] == seq[:1] and out[-1:] == seq[-1:]
    assert out == dinucleotide_shuffle(seq, iteration_rng(seed, "s", 1))


def test_shuffle_reaches_all_arrangements_evenly():
    graph = LetterGraph("ACAGATA")
    seen = Counter(graph.shuffle(iteration_rng(0, "s", i)) for i in range(6000))
    assert len(seen) == 6
    assert all(850 < n < 1150 for n in seen.values())


def best_pairing(seq, span):
    energy = {}
    for pair, value in PAIR_ENERGY.items():
        energy[pair] = energy[pair[::-1]] = value
    letters = seq.replace("T", "U")

    @lru_cache(None)
    def best(i, j):
        if j - i < 4:
            return 0
        options = [best(i + 1, j)]
        for k in range(i + 4, min(j, i + (span or j)) + 1):
            if letters[i] + letters[k] in energy:
                options.append(energy[letters[i] + letters[k]] + best(i + 1, k - 1) + best(k + 1, j))
        return min(options)
    return best(0, len(letters) - 1)


@pytest.mark.parametrize("span", [None, 6, 12])
def test_pairing_energy_equals_brute_force(span):
    rng = np.random.default_rng(5)
    for _ in range(60):
        seqs = ["".join(rng.choice(list("ACGUTNé"), int(rng.integers(1, 36)))) for _ in range(4)]
        assert PairingScorer(span).fold(seqs) == [best_pairing(s, span) for s in seqs]


def sequences(spark):
    rng = np.random.default_rng(7)
    rows = [(f"s{i}", "".join(rng.choice(list("ACGU"), size)), shuffles)
            for i, (size, shuffles) in enumerate([(30, 10), (60, 25), (5, 10), (80, 0), (40, 300)])]
    return rows, spark.createDataFrame(rows, "seqname string, seq string, n_shuffles int")


def test_folds_do_not_depend_on_blocks_or_tasks(spark, monkeypatch):
    rows, df = sequences(spark)
    scorer = PairingScorer(10)
    first = sorted(map(tuple, scoring.fold_all(df, scorer, seed=4, tasks=3).collect()))
    monkeypatch.setattr(scoring, "MAX_BLOCK", 7)
    assert sorted(map(tuple, scoring.fold_all(df, scorer, seed=4, tasks=5).collect())) == first
    want = [(name, n, i, best_pairing(seq if i == 0 else dinucleotide_shuffle(
        seq, iteration_rng(4, name, i)), 10), None) for name, seq, n in rows for i in range(n + 1)]
    assert first == sorted(want)


def test_scores_of_folds(spark):
    rows, df = sequences(spark)
    folds = scoring.fold_all(df, PairingScorer(), seed=1)
    got = {r.seq_name: r for r in scoring.score_folds(folds).collect()}
    assert set(got) == {r[0] for r in rows} and got["s3"].n_shuffles_requested == 0
    assert got["s3"].median_mfe is None and got["s3"].orig_mfe is not None
    energies = [r.mfe for r in folds.filter("seqname = 's4' and iteration > 0").collect()]
    assert got["s4"].median_mfe == statistics.median(energies) and got["s4"].n_valid == 300
    assert scoring.raw_shuffles(folds).filter("transcript_id = 's4'").count() == 300


class Failing:
    """Gives no energy for short sequences and fails on long ones."""

    def fold(self, seqs):
        if any(len(s) > 70 for s in seqs):
            raise ValueError("too long")
        return [None if len(s) < 10 else -float(len(s)) for s in seqs]


def test_failures_become_error_rows(spark):
    _, df = sequences(spark)
    scored = scoring.score_folds(scoring.fold_all(df, Failing()))
    failed = {r.seqname: r.error for r in scoring.errors(scored).collect()}
    assert failed == {"s2": "invalid orig MFE", "s3": "invalid orig MFE; ValueError: too long"}
    assert {r.seq_name for r in scoring.results(scored).collect()} == {"s0", "s1", "s4"}


def test_raw_shuffles_close_gaps(spark):
    folds = spark.createDataFrame(
        [("a", 0, -1.0), ("a", 1, -2.0), ("a", 2, None), ("a", 3, -3.0)],
        "seqname string, iteration int, mfe double")
    for bounded in (True, False):
        assert sorted(tuple(r) for r in scoring.raw_shuffles(folds, bounded).collect()) == \
            [("a", 1, -2.0), ("a", 2, -3.0)]


def test_command_scorer(tmp_path):
    program = tmp_path / "fold.sh"
    program.write_text(
        "#!/bin/sh\nwhile read -r line; do case \"$line\" in\n"
        "'>'*) echo \"$line\" ;;\n*N*) echo \"$line\"; echo broken ;;\n"
        "*) echo \"$line\"; echo \".... (-${#line}.50)\" ;; esac; done\n")
    program.chmod(0o755)
    scorer = CommandScorer((str(program),))
    assert scorer.available() and not CommandScorer(("no-such-program",)).available()
    assert scorer.fold(["ACGU", "ANGU", "ACGUA"]) == [-4.5, None, -5.5]


def test_timed_samples(spark):
    samples = spark.createDataFrame([(1, "a", 30, 2, "ACGU" * 7), (2, "b", 80, 1, "A" * 80)],
                                    "tier int, seqname string, length int, n_shuffles int, seq string")
    timed = {r.seqname: r for r in scoring.time_samples(samples, Failing()).collect()}
    assert timed["a"].wall >= 0 and timed["a"].rss_kb > 0
    assert timed["b"].wall is None


@pytest.mark.parametrize("final", [1, 5, 40])
def test_medians_by_counting(spark, final):
    """Groups of all shapes, a null one too, against the sorted values."""
    rng = random.Random(final)
    shapes = {"even": [rng.uniform(-1e9, 1e9) for _ in range(600)], "wide": [10.0 ** rng.randint(-300, 300) for _ in range(301)],
              "equal": [2.5] * 500, "two": [1.0] * 250 + [7.0] * 250, "one": [-0.0], "rising": [float(i) for i in range(777)],
              "ends": [float("-inf"), float("inf"), 0.0, 1.0], None: [float(i % 9) for i in range(100)]}
    rows = spark.createDataFrame([(g, v) for g, vs in shapes.items() for v in vs] + [("even", None)], "g string, v double")
    counted = rows.na.drop(subset=["v"]).groupBy("g", "v").agg(F.count("*").alias("w"))
    found = {r.g: (r.n, r.median) for r in selection.counted_median(counted, ["g"], "v", "w", 777, 8, final).collect()}
    assert found == {g: (len(v), statistics.median(v)) for g, v in shapes.items()}
    assert {r.g: (r.n, r.median) for r in selection.grouped_median(rows, ["g"], "v").collect()} == found
    assert selection.grouped_median(rows.limit(0), ["g"], "v").collect() == []


def test_medians_by_counting_sort_no_group(spark):
    rows = spark.range(100_000).select(F.lit("g").alias("g"), F.pmod(F.col("id") * 7919, F.lit(100_003)).alias("v"))
    plan = selection.grouped_median(rows, ["g"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and selection.passes(100_000) == 1
