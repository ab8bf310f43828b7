"""Top-k of repeated ids."""

import random

import numpy as np
import pytest

from foldmill.llm.top_k import search_block, top_k


@pytest.mark.parametrize("many", [1, 2, 12, 60])
def test_top_k_of_many_vectors_of_one_id(spark, many):
    rng = random.Random(many)
    rows = [(i, [rng.randint(-3, 3) for _ in range(5)]) for i in range(80)]
    rows += [(7, [40 + n, 40, 40, 40, 40]) for n in range(many)]
    table = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    queries = spark.createDataFrame([(-1, [1, 1, 1, 1, 1]), (-2, [1, -1, 2, 0, 1])], table.schema)
    best = {}
    for q in queries.collect():
        for i, v in rows:
            score = sum(a * b for a, b in zip(q.vector, v))
            best[q.vec_id, i] = max(score, best.get((q.vec_id, i), score))
    want = []
    for q in (-1, -2):
        own = sorted((-s, i) for (p, i), s in best.items() if p == q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(own)]
    for block in (4096, 16):
        assert sorted(map(tuple, top_k(table, queries, block=block).collect())) == sorted(want)


def test_block_gives_different_ids():
    ids = np.array([5, 5, 5, 1, 2, 5])
    vectors = np.array([[9.0], [8], [7], [1], [2], [9]])
    query, candidate, score = search_block(ids, vectors, np.array([0]), np.array([[1.0]]), 2)
    assert ids[candidate].tolist() == [5, 2] and score.tolist() == [9, 2]
