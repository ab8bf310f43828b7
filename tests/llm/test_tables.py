"""Operators 1, 7 and 8, the queries and the pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from foldmill.llm.packing import CAPACITY, Encoder, best_fill, best_fit, pack, program, slots, solve
from foldmill.llm.queries import oracle_sql, queries
from foldmill.llm import raking
from foldmill.llm.raking import bounded, mix
from foldmill.llm.store import settle
from foldmill.llm.top_k import top_k, whole_numbers
from llm import brute
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# Operator 1

@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    assert differences(queries()[name](spark, SF_DIR), connect(SF_DIR), oracle_sql()[name]) == []


def test_raked_margins(spark):
    cells = spark.createDataFrame([("a", "x", "t", 10.0), ("a", "y", "u", 30.0), ("b", "x", "u", 40.0),
                                   ("b", "y", "t", 20.0)], "source string, lang string, topic string, tokens double")
    wishes = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.3, "y": 0.7}, "topic": {"t": 0.4, "u": 0.6}}
    tables = {n: spark.createDataFrame(list(w.items()), f"{n} string, target double") for n, w in wishes.items()}
    fitted = settle(bounded(settle(cells.coalesce(1)), {n: settle(t) for n, t in tables.items()}, keep=0.1))
    for name, wish in wishes.items():
        got = {r[0]: r[1] / 10 for r in fitted.groupBy(name).agg(F.sum(F.col("tokens") * F.col("probability"))).collect()}
        assert got == pytest.approx(wish, abs=1e-5)


def test_few_cells_are_fitted_like_many(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables = {"lang": spark.createDataFrame([("en", 0.7), ("de", 0.3)], "lang string, share double")}
    for targets in (None, tables):
        both = [{(r.source, r.lang, r.topic): r for r in raking._fitted(
            docs, None, targets, 0.7, 0.3, 3, in_one_task=alone)[1].collect()} for alone in (True, False)]
        assert set(both[0]) == set(both[1])
        for cell, row in both[0].items():
            assert row.probability == pytest.approx(both[1][cell].probability, abs=1e-4)
            assert row.target_lang == pytest.approx(both[1][cell].target_lang)


def test_mix_of_odd_tables(spark):
    rows = [(i, "w " * (i % 7), None if i % 3 else "en", "hot" if i % 2 else None, 0) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("mix_weight", F.lit("clash"))
    found = mix(docs).collect()
    assert 0 < len(found) < 300 and {r.doc_id for r in found} <= set(range(300))
    assert {r.doc_id: r.mix_probability for r in mix(docs).collect()} == {r.doc_id: r.mix_probability for r in found}
    assert mix(docs.limit(0)).count() == 0
    whole = spark.createDataFrame([("hot", 1.0)], "source string, share double")
    assert {r.source for r in mix(docs, targets={"source": whole}, keep=0.3).collect()} == {"hot"}
    bare = spark.createDataFrame([(None, None, None, None, None)] * 3, DOCS)
    assert mix(bare, keep=1.0).count() == 3


# Operator 7

def check_packing(rows, found, capacity=CAPACITY):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == capacity for r in own[1:])
        assert len(own) == -(-len(ids) // capacity)
        for r in own:
            part = np.array(ids[r.start:r.start + r.length], "<u4")
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert sum(r.length for r in own) == len(ids)
    filled = {}
    for r in found:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


def test_packing(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["the", "dog", "日本", "é\n", "x1"], k=rng.choice([0, 3, 50, 700, 4000]))))
            for i in range(150)]
    rows += [(-1, None), (-2, "a<|endoftext|>b"), (-3, "<|endoftext|>")]
    found = pack(spark.createDataFrame([(*r, "c", 1) for r in rows],
                                       "doc_id long, text string, piece string, rank int")).collect()
    used = check_packing(rows, found)
    counts = np.bincount([r.length for r in found], minlength=CAPACITY + 1)
    assert used <= sum(times for _, times in best_fit(counts, CAPACITY))
    repeated = spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], "doc_id long, text string")
    assert pack(repeated).count() == 3
    assert pack(repeated.limit(0)).count() == 0


def test_encoders_agree():
    rng = random.Random(4)
    encoder = Encoder(*map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")))
    letters = "abc  \n\t.,'s日é∑  　\U0001F600AB01 thein\x85​\x00²½<|endoftext|>"
    for _ in range(1500):
        text = "".join(rng.choices(letters, k=rng.randint(0, 60)))
        assert encoder.ids(text).tolist() == encoder.full.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(101, np.int64)
    counts[1:] = rng.integers(0, 30, 100) * (rng.random(100) < 0.5)
    plan = solve(counts, 100)
    held = np.zeros(101, np.int64)
    for pattern, times in plan:
        assert sum(n * k for n, k in pattern.items()) <= 100
        for n, k in pattern.items():
            held[n] += k * times
    assert (held == counts).all()
    bound = -(-int((counts * np.arange(101)).sum()) // 100)
    assert bound <= sum(t for _, t in plan) <= sum(t for _, t in best_fit(counts, 100))
    keys, _, _ = slots(plan)
    assert len(np.unique(keys)) == len(keys)


def test_patterns_of_the_program_hold_most_pieces():
    rng = np.random.default_rng(1)
    lengths = np.clip(np.exp(rng.normal(5.8, 0.9, 1_000_000)), 1, CAPACITY - 1).astype(int)
    counts = np.bincount(lengths, minlength=CAPACITY + 1)
    plan, left = program(counts)
    assert left.sum() < 0.1 * counts.sum()
    assert all(sum(n * k for n, k in pattern.items()) == CAPACITY and times > 0 for pattern, times in plan)
    alone = sum(times for _, times in best_fit(counts.copy(), CAPACITY))
    assert sum(times for _, times in plan + best_fit(left, CAPACITY)) <= alone


@pytest.mark.parametrize("lengths", [[60] * 9, [60, 45] * 5, [100], [], [1] * 250 + [99] * 3, [34, 33] * 7])
def test_never_more_sequences_than_best_fit(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=101)
    alone = sum(times for _, times in best_fit(counts.copy(), 100))
    assert sum(times for _, times in solve(counts, 100)) <= alone


def test_knapsack_keeps_within_what_is_there():
    prices, most = np.zeros(13), np.zeros(13, int)
    prices[[2, 5]], most[[2, 5]] = [2, 5.5], [3, 1]
    assert best_fill(prices, 12, most) == {5: 1, 2: 3}
    for room in range(1, 13):   # every choice of copies
        best = max(a * 2 + b * 5.5 for a in range(4) for b in range(2) if 2 * a + 5 * b <= room)
        assert sum(prices[n] * k for n, k in best_fill(prices, room, most).items()) == best


def test_knapsack():
    prices = np.zeros(11)
    prices[[3, 4, 7]] = 3, 5, 8.5
    assert best_fill(prices, 10) == {3: 1, 7: 1}
    assert best_fill(np.zeros(11), 10) == {}


# Operator 8

def test_top_k(spark):
    rng = random.Random(5)
    rows = {i: [rng.randint(-3, 3) for _ in range(6)] for i in range(300)}
    table = spark.createDataFrame([(i, v, "c") for i, v in rows.items()], "vec_id long, vector array<long>, block string")
    found = top_k(table, table.filter("vec_id % 20 = 0"), k=7, block=40, query_block=4).collect()
    want = brute.top_k(rows, {i: v for i, v in rows.items() if i % 20 == 0}, 7)
    assert sorted(map(tuple, found)) == sorted(want)


def test_top_k_of_odd_tables(spark):
    schema = "vec_id long, vector array<long>"
    rows = [(1, [1, 2]), (1, [1, 2]), (1, [3, 0]), (2, [1]), (3, None), (None, [1, 1]), (4, [None, 1]), (5, []),
            (6, [5, 5])]
    table = spark.createDataFrame(rows, schema)
    found = {(r.query_id, r.vec_id): r.score for r in top_k(table, table.filter("vec_id = 1")).collect()}
    assert found == {(1, 2): 3, (1, 5): 0, (1, 6): 15}
    assert top_k(table.limit(0), table).count() == 0 and top_k(table, table.limit(0)).count() == 0
    alone = spark.createDataFrame([(1, [1])], schema)
    assert top_k(alone, alone).count() == 0


def test_whole_numbers(spark):
    rows = [([0.5, -0.0001],), ([float("nan"), 1.0],), ([float("inf")],), ([None],), (None,), ([],)]
    found = spark.createDataFrame(rows, "embedding array<float>").select(whole_numbers(F.col("embedding"))).collect()
    assert [r[0] for r in found] == [[512, -1], None, None, None, None, []]


# The pipeline

def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.schema
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, kept[-1], SF_DIR)
        assert made.columns == columns and [f.dataType for f in made.schema] == [f.dataType for f in before]
        kept.append(spark.createDataFrame(made.collect(), made.schema))
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert all(after <= earlier for earlier, after in zip(ids, ids[1:]))
    bad = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 0").collect()}
    assert len(ids[1] & bad) <= 1 and len(ids[0] - ids[1]) <= 0.3 * len(ids[0])
    assert ids[2] == brute.kept_of_similar([(i, texts[i]) for i in ids[1]])
    want = brute.substring_dedup([(i, texts[i]) for i in ids[2]])
    for r in kept[3].collect():
        assert len(brute.words(r.text)) == want[r.doc_id][0] - want[r.doc_id][1] and r.n_chars == len(r.text)
    assert ids[3] == {i for i, (n, gone, _) in want.items() if not n or gone < n}
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[4], SF_DIR).collect()
    check_packing([(r.doc_id, r.text) for r in kept[4].collect()], packed)


def test_pipeline_of_odd_documents(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b", "en", "s", 3), (2, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    for start in (docs, docs.limit(0)):
        stage_docs = start
        for _, stage in corpus_pipeline.STAGES:
            stage_docs = stage(spark, stage_docs, SF_DIR)
            stage_docs.collect()


def test_every_operator_is_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{n}" for n in range(1, 14)}
