"""Operators 2, 3, 5 and 6."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from foldmill.llm.chat import escaped, format_conversations, render, spans, unescaped
from foldmill.llm.line_quality import keep_good, quality_scores
from foldmill.llm.order_minhash import BINS, EMPTY, fingerprint_edits
from foldmill.llm.token_counts import SPACE, Merges, token_counts, units

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
TURNS = "conv_id long, turn long, role string, text string"


# Operator 2

def edited_texts(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for n, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        third = len(text) // 3
        out[doc_id] = text[:len(text) - third] + after[:third]
    return out


def test_fingerprints_of_edits(spark):
    rng = random.Random(2)
    rows = [(i * 7 - 50, " ".join(f"é{rng.randint(0, 400)}" for _ in range(rng.choice([0, 1, 2, 3, 30, 400]))))
            for i in range(60)] + [(9999, None)]
    found = {r.doc_id: r for r in fingerprint_edits(spark.createDataFrame(rows, DOCS)).collect()}
    edits = edited_texts(rows)
    assert {i: (r.n_chars, r.edited_sha256) for i, r in found.items()} == {
        i: (len(t or ""), hashlib.sha256(edits[i].encode()).hexdigest()) for i, t in rows}
    again = {r.doc_id: r for r in fingerprint_edits(
        spark.createDataFrame(list(edits.items()), DOCS)).collect()}
    for i, r in found.items():
        assert len(r.fingerprint) == 8 * BINS and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.edited_fingerprint == again[i].fingerprint     # one text, one fingerprint
    long = [r for r in found.values() if r.n_chars > 1000]
    assert all(r.near_edited > r.near_next for r in long)


def test_fingerprints_see_order(spark):
    own = [f"w{i}" for i in range(600)]
    turned = own[300:] + own[:300]
    backward = own[::-1]
    rows = [(4, " ".join(own)), (3, " ".join(turned)), (2, " ".join(own)), (1, " ".join(backward))]
    near = {r.doc_id: r.near_next for r in fingerprint_edits(spark.createDataFrame(rows, DOCS)).collect()}
    assert 0.2 < near[4] < 1 and 0.2 < near[3] < 1 and near[2] == 0


def test_fingerprints_number_occurrences(spark):
    rows = [(2, "a b " * 40), (1, "a b " * 200)]
    found = {r.doc_id: r for r in fingerprint_edits(spark.createDataFrame(rows, DOCS)).collect()}
    assert found[1].fingerprint.count(EMPTY) == 0           # not just two k-mers
    assert found[2].near_next < 1


def test_fingerprints_of_odd_tables(spark):
    assert fingerprint_edits(spark.createDataFrame([], DOCS)).count() == 0
    alone = fingerprint_edits(spark.createDataFrame([(1, None)], DOCS)).first()
    assert (alone.near_edited, alone.near_next, alone.fingerprint) == (1.0, 1.0, EMPTY * BINS)
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "x"), (None, "n"), (None, None)]
    clash = spark.createDataFrame([(i, t, "a", 1, 2) for i, t in rows],
                                  DOCS + ", tie string, own int, n_chars int")
    assert fingerprint_edits(clash).count() == 5


def test_fingerprints_stay_in_the_jvm(spark):
    plan = fingerprint_edits(spark.createDataFrame([(1, "a")], DOCS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Operator 3

@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("\\#</turn>: a\n", max_size=12), st.text("\\#</turn>: é\n", max_size=30)),
                max_size=4))
def test_rendering_round_trip(turns):
    formatted = render(turns)
    assert [(role, unescaped(formatted[a:b])) for role, a, b in spans(formatted)] == turns


def test_escaped_texts_hold_no_control_string():
    for text in ("### x", "####", "</turn>\n", "\\### </turn>", "<</turn>"):
        assert "###" not in escaped(text) and "</turn>" not in escaped(text)
        assert unescaped(escaped(text)) == text


def test_conversations(spark):
    rows = [(1, 1, "assistant", "one\\### Assistant: </turn> ok"), (1, 0, "user", " hé\n"),
            (1, 2, "assistant", ""), (1, 3, None, None), (1, 4, "assistant", " 日本 \U0001F600."),
            (2, None, "assistant", "x"), (2, 0, "user", "y"), (2, 0, "user", "y"), (None, 0, "assistant", "z"),
            (3, 0, "user", "only")]
    table = spark.createDataFrame([(*r, "c", 5) for r in rows], TURNS + ", turns string, n_turns int")
    found = {r.conv_id: r for r in format_conversations(table).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        loss = "".join(t for _, role, t in turns if role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == len(r.formatted) and r.n_tokens == len(r.loss_mask)
        assert bool(r.n_loss_tokens) == bool(loss)
    assert format_conversations(spark.createDataFrame([], TURNS)).count() == 0


# Operator 5

@pytest.fixture(scope="module")
def documents(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]


def test_quality_on_held_out_documents(spark, documents):
    found = quality_scores(*documents).join(documents[1], "doc_id").collect()
    held = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert held and all(r.held_out for r in held)
    assert sum(r.held_out for r in found) == len(held)
    right = sum(r.predicted == r.quality for r in held) / len(held)
    assert right > 0.97
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in found)


def test_quality_depends_on_the_text_alone(spark, documents):
    docs, labels = documents
    changed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("s"), "n_chars": F.lit(0)})
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda d, l: {r.doc_id: r.score for r in quality_scores(d, l).collect()}
    assert score(docs, labels) == score(changed, flipped)


def test_quality_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (2, "a\nb\n\n", "s"), (None, "x", "s")],
                                 DOCS + ", score string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (3, None), (None, 1), (4, 7)],
                                   "doc_id long, quality int")
    none = labels.limit(0)
    assert {r.score for r in quality_scores(docs, none).collect()} == {0.5}
    assert quality_scores(docs, labels).count() == 4
    assert quality_scores(docs.limit(0), labels).count() == 0
    assert [r.n_lines for r in quality_scores(docs, none).collect() if r.doc_id == 2] == [1, 4]
    kept = keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == 4


# Operator 6

@pytest.fixture(scope="module")
def model():
    path = public_tokenizers.path("piece_bpe_32k.model")
    return Merges(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_token_counts(spark, model):
    rng = random.Random(1)
    letters = "abcdefg  \n\t.,;日本é∑▁  \U0001F600ABC0123 thein<s>"
    rows = [(i, "".join(rng.choices(letters, k=rng.randint(1, 200)))) for i in range(400)]
    rows += [(-1, None), (-1, ""), (-2, "<s> </s> <unk> <0x41>"), (-3, " "), (-4, "a" * 5000), (None, "abab" * 900)]
    table = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", n_tokens string")
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit)
                   for r in token_counts(table, limit=50).collect())
    want = []
    for i, t in rows:
        n = len(model[1].encode(t or ""))
        want.append((i is None, i or 0, len((t or "").encode()), n, n > 50))
    assert found == sorted(want)
    assert token_counts(table.limit(0)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_words_side_by_side_and_one_by_one(model, text):
    merges, library = model
    words = [u.replace(" ", SPACE) for u in units(text)]
    one_by_one = [merges.count(merges.symbols(w)[0]) + merges.symbols(w)[1] for w in words]
    assert merges.counts(words).tolist() == one_by_one
    assert sum(one_by_one) == len(library.encode(text))
