"""Margins of the sample with its probabilities."""

import pytest
from pyspark.sql import functions as F

from foldmill.llm.raking import bounded, expected_margins
from foldmill.llm.store import settle

SF_DIR = "/root/testdata/sf0.001"
CELLS = "source string, lang string, topic string, tokens double"


def margin(fitted, name):
    rows = fitted.groupBy(name).agg(F.sum(F.col("tokens") * F.col("probability"))).collect()
    return {r[0]: r[1] for r in rows}


def test_margins_hold_with_probabilities_at_1(spark):
    cells = spark.createDataFrame([("a", "x", "t", 100.0), ("a", "y", "t", 20.0), ("b", "x", "u", 300.0),
                                   ("b", "y", "t", 40.0), ("c", "x", "u", 50.0), ("c", "y", "u", 490.0)], CELLS)
    # Targets that capped factors of the margins meet; two cells are cut off at 1.
    factor = {"a": 1.5, "b": 0.6, "c": 0.35, "x": 1.1, "y": 0.9, "t": 1.0, "u": 0.8}
    rows = [(r, r.tokens * min(1, factor[r.source] * factor[r.lang] * factor[r.topic])) for r in cells.collect()]
    total = sum(t for _, t in rows)
    wishes = {n: {c: sum(t for r, t in rows if r[n] == c) / total for c in cs}
              for n, cs in (("source", "abc"), ("lang", "xy"), ("topic", "tu"))}
    cells = settle(cells.coalesce(1))
    tables = {n: settle(spark.createDataFrame(list(w.items()), f"{n} string, target double").coalesce(1)) for n, w in wishes.items()}
    fitted = bounded(cells, tables, total / 1000)
    chances = [r.probability for r in fitted.collect()]
    assert sorted(chances)[-2:] == [1, 1] and min(chances) >= 0
    for name, wish in wishes.items():
        assert margin(fitted, name) == pytest.approx({c: total * s for c, s in wish.items()}, rel=1e-4)


def test_category_with_too_few_tokens_is_taken_whole(spark):
    cells = spark.createDataFrame([("a", "x", "t", 10.0), ("b", "x", "t", 60.0), ("c", "x", "t", 30.0)], CELLS)
    tables = {"source": {"a": 0.6, "b": 0.2, "c": 0.2}, "lang": {"x": 1.0}, "topic": {"t": 1.0}}
    cells = settle(cells.coalesce(1))
    tables = {n: settle(spark.createDataFrame(list(w.items()), f"{n} string, target double").coalesce(1)) for n, w in tables.items()}
    fitted = bounded(cells, tables, 0.5)
    assert margin(fitted, "source") == pytest.approx({"a": 10, "b": 20, "c": 20}, rel=1e-4)


def test_expected_margins_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = expected_margins(docs).collect()
    by_margin = {}
    for r in rows:
        by_margin.setdefault(r.margin, []).append(r)
    for own in by_margin.values():
        assert sum(r.expected for r in own) == pytest.approx(1)
    assert all(r.met for r in by_margin["source"] + by_margin["lang"])
    # A topic misses its target only if all of its tokens are taken, or others make up for that.
    assert all(r.met for r in by_margin["topic"]) or any(r.expected < r.target for r in by_margin["topic"])
