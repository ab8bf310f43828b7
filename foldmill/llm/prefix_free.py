"""Exact byte-level dedup by prefix-free parsing (operator 10)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foldmill.llm.arrays import slices, texts
from foldmill.llm.repeats import covered, repeated_spots, repeated_windows, text_bytes
from foldmill.llm.store import bucketed_texts, narrow

WINDOW = 100   # bytes of the shortest repeated string
GRAM = 32      # bytes of a trigger

OUT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
       "spans array<struct<start:long,length:long>>")


def repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Bytes covered by a string of ``window`` bytes that also starts earlier.

    Rolling-hash triggers cut every text into phrases. The dictionary holds each distinct
    phrase once with its first place; the parse of a text is its row of phrases. Suffixes of
    the corpus are compared through both, as far as ``window`` bytes: two that start in equal
    phrases at one offset agree, and only suffixes of dictionary entries that share a trigger
    are compared further. What the order of suffixes is wanted for is which agree in
    ``window`` bytes, so a suffix is ranked by the 128-bit fingerprint of its prefix instead
    of letter by letter, and no array of all suffixes is ever built in one place.

    Returns per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the
    remaining bytes) and spans (start and length in bytes, in order).

    Null, empty and shorter texts: nothing is removed. A null doc_id: the row is returned whole
    and is nobody's reference. Rows that share an id are parts of one document in order of their
    text's hash. Other columns are ignored.
    """
    def parse(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                yield _parsed(part, window, gram)

    empty = F.lit(None).cast("array<long>")
    nameless = narrow(docs).filter("doc_id is null").withColumns(
        {"part": F.lit(0).cast("long"), "lone": empty, "entries": empty, "cores": empty,
         "windows": empty})
    judged = repeated_windows(bucketed_texts(docs), text_bytes, window, gram)
    return judged.mapInArrow(parse, OUT).unionByName(nameless.mapInArrow(parse, OUT))


def _parsed(part: pa.RecordBatch, window: int, gram: int) -> pa.RecordBatch:
    data, bounds = texts(part.column("text"))
    ids = part.column("doc_id")
    removed = np.zeros(len(data), bool)
    if ids.null_count < len(ids):
        removed = covered(repeated_spots(part, text_bytes, window, gram)[0], window, len(data))
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], removed[:-1]])
    begins = np.flatnonzero(removed & (~before | edge[:-1]))
    after = np.concatenate([removed[1:], [False]])
    stops = np.flatnonzero(removed & (~after | edge[1:])) + 1
    per_row = np.searchsorted(begins, bounds)
    digests, spans = [], []
    n_removed = np.diff(np.concatenate([[0], np.cumsum(removed)])[bounds])
    for a, b, lo, hi in zip(bounds[:-1], bounds[1:], per_row[:-1], per_row[1:]):
        text = data[a:b]
        kept = text if lo == hi else text[~removed[a:b]]
        digests.append(hashlib.sha256(kept.tobytes()).hexdigest())
        spans.append([{"start": s - int(a), "length": e - s}
                      for s, e in zip(begins[lo:hi].tolist(), stops[lo:hi].tolist())])
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(bounds), pa.int64()), pa.array(n_removed, pa.int64()),
         pa.array(np.diff(per_row), pa.int64()), pa.array(digests),
         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
