"""Substring dedup by relative Lempel-Ziv parsing (operator 4)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foldmill.llm.arrays import slices, texts, words
from foldmill.llm.repeats import covered, repeated_spots, repeated_windows, word_symbols
from foldmill.llm.store import bucketed_texts, narrow

WINDOW = 20   # words of the shortest factor that counts
GRAM = 8      # words of a trigger

OUT = ("doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, "
       "spans array<struct<start:long,length:long>>")


def factors(removed: np.ndarray, begin: int) -> list[dict[str, int]]:
    """The runs of removed words, numbered from ``begin``."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], removed.astype(np.int8), [0]])))
    return [{"start": int(a) - begin, "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2])]


def duplicate_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                    carry: bool = False) -> DataFrame:
    """Words covered by a window of ``window`` words that also starts earlier.

    The reference of a document is all text before it (smaller ``doc_id``, or the same text
    further left). It is indexed in blocks, one per range of fingerprints, not per range of
    documents: a document is looked up only in blocks that can hold its phrases, and the work
    grows with the corpus instead of its square. Texts are not factored word by word: they are cut
    into phrases at triggers, phrases that are copies of a dictionary entry are repeated as a
    whole, and the windows of first entries at the edges of repeated passages are looked up one by one
    (``repeats``). Runs of words that such windows cover are the duplicate spans.

    Returns per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by
    one space), kept_text (the same words, or the text as it is if nothing is removed), and spans
    (start and length in words, in order). With ``carry`` the other columns come along in the
    struct ``rest``.

    Null, empty and shorter texts: nothing is removed. A null doc_id: the row is returned whole
    and is nobody's reference. Rows that share an id are parts of one document in order of their
    text's hash, so a repeated row loses what its twin keeps. Other columns are ignored.
    """
    def parse(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                yield _parsed(part, window, gram)

    judged = repeated_windows(bucketed_texts(docs, carry), word_symbols, window, gram)
    out = OUT
    if "rest" in judged.columns:
        out += f", rest {judged.schema['rest'].dataType.simpleString()}"
    empty = F.lit(None).cast("array<long>")
    nameless = narrow(docs, carry).filter("doc_id is null").withColumns(
        {"part": F.lit(0).cast("long"), "lone": empty, "entries": empty, "cores": empty,
         "windows": empty})
    return judged.mapInArrow(parse, out).unionByName(nameless.mapInArrow(parse, out))


def _parsed(part: pa.RecordBatch, window: int, gram: int) -> pa.RecordBatch:
    data, bounds = texts(part.column("text"))
    starts, ends, rows = words(data, bounds)
    ids = part.column("doc_id")
    removed = np.zeros(len(starts), bool)
    if ids.null_count < len(ids):
        spots, _ = repeated_spots(part, word_symbols, window, gram)
        removed = covered(spots, window, len(starts))
    raw = data.tobytes()
    kept_texts, digests, n_removed, spans = [], [], [], []
    for n, (a, b) in enumerate(zip(rows[:-1], rows[1:])):
        gone = removed[a:b]
        keep = np.flatnonzero(~gone) + a
        kept = b" ".join([raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist())])
        kept_texts.append((kept if gone.any() else raw[bounds[n]:bounds[n + 1]]).decode())
        digests.append(hashlib.sha256(kept).hexdigest())
        n_removed.append(int(gone.sum()))
        spans.append(factors(gone, 0))
    rest = [part.column("rest")] if "rest" in part.schema.names else []
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(rows), pa.int64()), pa.array(n_removed, pa.int64()),
         pa.array(digests), pa.array(kept_texts),
         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), *rest],
        ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "spans"] + ["rest"] * len(rest))
