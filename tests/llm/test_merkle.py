"""Operator 13 against a plain tree, and the plain tree's proofs."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from foldmill.llm.merkle import manifest
from foldmill.llm.queries import op13_merkle_manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, add=0):
    n = None if row[4] is None else row[4] + add
    return digest(*map(field, (row[0], row[3], row[2], n, row[1])))


def tree(nodes, arity):
    """The root, and per node its siblings left and right, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for n, place in enumerate(at):
            start = place // arity * arity
            paths[n].append(("".join(nodes[start:place]), "".join(nodes[place + 1:start + arity])))
        nodes = [digest(*nodes[i:i + arity]) for i in range(0, len(nodes), arity)]
        at = [place // arity for place in at]
    return nodes[0], paths


def plain(rows, tampered, arity=2):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    below = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        below[lang] = own, *tree([leaf(r) for r in own], arity)
    root, upper = tree([below[lang][1] for lang in langs], arity)
    out = []
    for lang, above in zip(langs, upper):
        own, subroot, paths = below[lang]
        for r, path in zip(own, paths):
            folded = leaf(r, 1 if tampered(r[0]) else 0)
            for left, right in path + above:
                folded = digest(left, folded, right)
            proof = digest(*(x for level in path + above for x in level))
            out.append((r[0], leaf(r), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def documents(sizes):
    rng = random.Random(5)
    rows = [(i, rng.choice(["", None, "x" * rng.randrange(200), "ü€\n"]), lang, rng.choice(["s", None, ""]),
             rng.choice([None, 3, -1]), "clash") for i, lang in enumerate(lang for lang, n in sizes for _ in range(n))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("arity, depth, sizes", [
    (2, 8, [("en", 300), (None, 1), ("", 2), ("de", 257)]), (2, 2, [("en", 37), ("Z", 4), ("a", 16), ("é", 5)]),
    (3, 2, [("en", 100), ("de", 28), (None, 9)]), (2, 1, [("en", 21)]), (2, 3, [("a", 1)])])
def test_manifest(spark, arity, depth, sizes):
    rows = documents(sizes)
    changed = F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = manifest(spark.createDataFrame(rows, DOCS), {"n_chars": changed}, arity, depth).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    want = plain(rows, lambda i: i % 3 == 0, arity)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_manifest_of_odd_rows(spark):
    rows = [(None, None, None, None, None, "")] * 2 + [(4, "y" * 3_000_000, "en", "s", 1, ""), (4, "a", "en", "s", 1, ""),
                                                       (4, "a", "en", "s", 1, ""), (None, "b", "en", None, 2 ** 62, "")]
    found = manifest(spark.createDataFrame(rows, DOCS)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows, lambda i: False)
    assert manifest(spark.createDataFrame([], DOCS)).collect() == []


def test_query_tampers_with_every_seventh_checksum(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in
            spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    found = sorted((tuple(r) for r in op13_merkle_manifest(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert found == plain(rows, lambda i: crc32(str(i).encode()) % 7 == 0)
