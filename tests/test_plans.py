"""The physical plans have the shape that holds at scale."""

import random

import pyarrow as pa
import pytest

import __spark_entry__
from foldmill.operators import splice

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    df = __spark_entry__.queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["topk_longest_per_tier", "keep_last_dedupe", "best_by_priority"])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    last = text.rindex("WindowGroupLimit")
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < last


@pytest.mark.parametrize("name", ["array_index", "raw_shuffle_rows", "robust_zscore_skewed", "exact_group_median"])
def test_no_group_is_brought_into_one_task(spark, name):
    assert "SinglePartition" not in plan(spark, name)


@pytest.mark.parametrize("name", ["tier_assign", "tier_histogram", "topk_longest_per_tier", "resume_anti"])
def test_only_needed_columns_are_read(spark, name):
    text = plan(spark, name)
    assert "n_chars" in text and "text:string" not in text


def test_exploded_sides_are_not_broadcast(spark):
    # Only the bins that are wanted, which were counted, are broadcast, to prune the genome.
    text = plan(spark, "splice_exons")
    assert "SortMergeJoin" in text and text.count("BroadcastHashJoin") == 1
    assert "LeftSemi, BuildRight" in text


def test_scores_shuffle_the_background_once(spark):
    # Counted values are stored; the summary shuffles them and the observed rows.
    text = plan(spark, "robust_zscore")
    assert text.count("Exchange hashpartitioning") <= 2
    assert "lineitem" not in text and "_weight:bigint" in text


def test_shuffles_are_dealt_out_evenly(spark):
    assert "RoundRobinPartitioning" in plan(spark, "shuffle_shape")


def test_pairs_are_counted_where_shuffles_are_drawn(spark):
    # The shuffled texts do not leave the task.
    assert plan(spark, "dinuc_shuffle_invariants").count("MapInPandas") == 1


@pytest.mark.parametrize("name", ["splice_exons", "coding_phase"])
def test_exons_are_not_joined_in_growing_arrays(spark, monkeypatch, name):
    plans = []
    settled = splice.settle

    def settle(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return settled(df)

    monkeypatch.setattr(splice, "settle", settle)
    plan(spark, name)
    assert plans and all("MapInArrow" in p for p in plans)
    assert not any("Filter" in line and "aggregate(" in line for p in plans for line in p.splitlines())


def test_overlapping_spans_are_joined():
    rng = random.Random(5)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for top in (60, 1 << 61):
        rows = [[], None] + [sorted({(a, a + rng.randint(0, top // 9)) for a in rng.choices(range(0, top, max(1, top // 60)), k=n)})
                             for n in (1, 2, 5, 9, 0, 30)]
        found = splice.merged_spans(pa.array([r and [{"start": a, "end": b} for a, b in r] for r in rows], kind))
        for row, own in zip(rows, found.to_pylist()):
            want = []
            for a, b in row or []:
                if want and a <= want[-1][1]:
                    want[-1] = (want[-1][0], max(want[-1][1], b))
                else:
                    want.append((a, b))
            assert [(s["start"], s["end"]) for s in own] == want


def test_a_line_is_read_once(spark):
    lines = spark.createDataFrame([("x\ts\texon\t5\t9\t.\t+\t.\tParent=t:A.1",), ("x\ts\tCDS\t5\tno\t.\t+\t1\tParent=A.1",),
                                   ("x\ts\tCDS\t5\t8\t.\t+\t1\tnone",), ("x\ts\tCDS\t5\t8\t.\t+",)], "raw string")
    for anchored in (False, True):
        found = splice.features(lines, anchored)
        text = found._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("regexp_extract(") == 1
        assert [tuple(r) for r in found.collect()] == [("A", "A.1", "exon", "x", 5, 9, "+", None)]


def test_exons_meet_a_bin_in_one_row(spark, monkeypatch):
    plans, tables = [], []
    settled = splice.settle

    def settle(df):
        tables.append(settled(df))
        return tables[-1]

    monkeypatch.setattr(splice, "settle", settle)
    features = spark.createDataFrame(
        [("T", "exon", "x", 10 * i + 1, 10 * i + 4, "+") for i in range(50)],
        "tx_id string, type string, seqid string, start long, end long, strand string")
    genome = spark.createDataFrame([("x", 1, "ACGTé" * 100)], "seqid string, seq_start long, seq string")
    spliced = splice.splice(splice.transcript_models(features), splice.cut_into_bins(genome, 256), 256)
    plans.append(spliced._jdf.queryExecution().optimizedPlan().toString())
    assert [r.seq for r in spliced.collect()] == ["ACGT" * 50]
    assert [t.count() for t in tables] == [2]
    assert "aggregate(" not in plans[0] and "MapInArrow" in plans[0]


def test_spans_are_cut_at_bins_and_from_pieces():
    rng = random.Random(6)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    text = "".join(rng.choice("ACGTé😀") for _ in range(200))
    rows = [None, []]
    for n in (1, 3, 8):
        at = sorted(rng.sample(range(1, 200), 2 * n))
        rows.append(list(zip(at[::2], at[1::2])))
    spans = pa.array([r and [{"start": a, "end": b} for a, b in r] for r in rows], kind)
    for size in (7, 50, 1000):
        number, bins, parts = splice.binned_spans(spans, size)
        want = {}
        for row, own in enumerate(rows):
            for a, b in own or []:
                for at in range((a - 1) // size, (b - 1) // size + 1):
                    want.setdefault((row, at), []).append((max(a, at * size + 1), min(b, (at + 1) * size)))
        got = [[(s["start"], s["end"]) for s in p] for p in parts.to_pylist()]
        assert list(zip(zip(number.to_pylist(), bins.to_pylist()), got)) == list(want.items())
        # Pieces that begin and end within their bins have a part of what is asked of them.
        starts = [at * size + 3 for _, at in want]
        pieces = [text[s - 1:(at + 1) * size - 2] for (_, at), s in zip(want, starts)]
        bases = splice.cut_bases(pa.array(pieces), pa.array(starts, pa.int64()), parts)
        assert bases.to_pylist() == ["".join(p[max(a - s, 0):max(b - s + 1, 0)] for a, b in own)
                                     for p, s, own in zip(pieces, starts, want.values())]


def test_exons_and_ends_of_lines():
    kind = pa.list_(pa.struct([("coding", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("skip", pa.int32())]))
    rows = [[(False, 31, 40, 0), (True, 15, 36, 1), (False, 11, 20, 0), (True, 15, 36, 2), (False, 18, 22, 0)],
            [], [(True, 31, 40, 1), (True, 11, 20, 2), (True, 31, 40, 0)], [(False, 5, 6, 0)]]
    names = ("coding", "start", "end", "skip")
    found = [c.to_pylist() for c in splice.exons_and_ends(pa.array([[dict(zip(names, r)) for r in own] for own in rows], kind))]
    assert [[(s["start"], s["end"]) for s in own] for own in found[0]] == [[(11, 22), (31, 40)], [], [(11, 20), (31, 40)], [(5, 6)]]
    assert found[1:] == [[15, None, 11, None], [1, None, 2, None], [36, None, 40, None], [1, None, 0, None]]
