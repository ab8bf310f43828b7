"""Packing documents into few sequences by a configuration linear program (operator 7)."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from foldmill.llm.arrays import slices
from foldmill.llm.store import settle, shuffle_partitions
from foldmill.operators.keys import measured

CAPACITY = 2_048
END = 0               # id behind every document
WEIGHT = 4.0          # how fast the weight of a covered length falls
PRICED = 192          # lengths that the knapsack tries before it tries all

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
OUT = PIECES + ", sequence_id long, offset long"

# A pattern: lengths and how often each occurs in one sequence; and the number of sequences.
Pattern = tuple[dict[int, int], int]


class Encoder:
    """Ids of ``byte_bpe_50k.json``; the same ranks in the faster library wherever both agree.

    The vocabularies are one and the same. They differ only where a text holds the string of a
    special token, which ``tokenizers`` reads as that token; such texts go there.
    """

    def __init__(self, tokenizer_file: str, ranks_file: str):
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})
        self.full = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


def pieces(docs: DataFrame, tokenizer_file: str | None = None, ranks_file: str | None = None,
           capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each text's ids and the closing id. A longer document is cut into
    pieces of ``capacity``; its first piece is what is left over."""
    tokenizer_file = tokenizer_file or public_tokenizers.path("byte_bpe_50k.json")
    ranks_file = ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def cut(batches: Iterator[pa.RecordBatch]):
        encoder = Encoder(tokenizer_file, ranks_file)
        for batch in batches:
            for part in slices(batch):
                out: list[tuple] = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.append(encoder.ids(text or ""), np.uint32(END)).astype("<u4")
                    head = len(ids) % capacity or capacity
                    edges = [0, *range(head, len(ids) + 1, capacity)]
                    out += [(doc_id, n, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                            for n, (a, b) in enumerate(zip(edges[:-1], edges[1:]))]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)],
                    [field.split()[0] for field in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def best_fill(prices: np.ndarray, room: int, most: np.ndarray | None = None) -> dict[int, int]:
    """The multiset of lengths of greatest price that fits into ``room``, with at most ``most[n]``
    of length n: a bounded knapsack by dynamic programming over the room, where 1, 2, 4, ... copies
    of a length are one item. ``prices[n]`` belongs to length n; 0 means none."""
    best = np.zeros(room + 1)
    items: list[tuple[int, int, np.ndarray]] = []
    for length in np.flatnonzero(prices)[::-1].tolist():
        copies, take = room // length, 1
        if most is not None:
            copies = min(copies, int(most[length]))
        while copies > 0:
            take = min(take, copies)
            offers = best[:room + 1 - take * length] + take * prices[length]
            taken = offers > best[take * length:]
            np.maximum(best[take * length:], offers, out=best[take * length:])
            items.append((length, take, taken))
            copies, take = copies - take, 2 * take
    found: dict[int, int] = {}
    for length, take, taken in reversed(items):
        if room >= take * length and taken[room - take * length]:
            found[length] = found.get(length, 0) + take
            room -= take * length
    return found


def _size(pattern: dict[int, int]) -> int:
    return sum(length * copies for length, copies in pattern.items())


def _some(prices: np.ndarray, left: np.ndarray, turn: int) -> np.ndarray:
    """Prices of ``PRICED`` lengths or so: those with most tokens left, and every k-th of all."""
    there = np.flatnonzero(prices)
    if len(there) <= PRICED:
        return prices
    most = np.argpartition(left[there] * there, -(PRICED // 2))[-(PRICED // 2):]
    chosen = np.concatenate([there[most], there[turn % 7::2 * len(there) // PRICED]])
    return np.where(np.isin(np.arange(len(prices)), chosen), prices, 0)


def program(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[list[Pattern], np.ndarray]:
    """Full patterns that cover the lengths, and what they leave.

    The linear program has one variable per pattern and asks that every length be covered. Where
    sequences can be filled, a length's price in its dual is the length itself; multiplicative
    weights decide among full patterns. A weight starts in proportion to the length, as long
    pieces are the hardest to fill up, and falls exponentially as the length is covered; all
    weights together add less than one token to a sequence's price, so a full pattern always wins.

    Each round prices out the best pattern by the knapsack, over some lengths first and over all
    where those fill no sequence, and lays it out until its scarcest length ends. What a round lays
    out is whole, so the next one solves the residual program and no fraction is left to round. The
    rounds end when no full pattern is left; as each ends a length, there are about as many as lengths.
    """
    left = counts.astype(np.int64).copy()
    wanted = np.maximum(left, 1).astype(float)
    lengths = np.arange(capacity + 1, dtype=float)
    plan: list[Pattern] = []
    while True:
        weights = lengths / capacity * np.exp(-WEIGHT * (1 - left / wanted))
        prices = np.where(left > 0, lengths * (1 + weights / (capacity + 1)), 0)
        tried = _some(prices, left, len(plan))
        pattern = best_fill(tried, capacity, left)
        if _size(pattern) < capacity and tried is not prices:
            pattern = best_fill(prices, capacity, left)
        if _size(pattern) < capacity:
            return plan, left
        times = min(int(left[n]) // k for n, k in pattern.items())
        plan.append((pattern, times))
        for n, k in pattern.items():
            left[n] -= times * k


def solve(counts: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that together hold ``counts[n]`` pieces of each length n, in few sequences.

    The program's patterns, and best fit for what no full sequence can be made of. Where best fit
    alone needs fewer sequences, as when most pieces exceed half a sequence and few can be
    filled, its plan is taken: the result never has more sequences than best fit.
    """
    laid, left = program(counts, capacity)
    plans = [laid + best_fit(left, capacity), best_fit(counts.astype(np.int64).copy(), capacity)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit, longest first, for many equal pieces at a time: a group of sequences with equal
    contents takes equal pieces together, and is split where the pieces run out."""
    groups: dict[int, list[Pattern]] = {}          # by room left
    for length in np.flatnonzero(counts)[::-1].tolist():
        pieces_left = int(counts[length])
        while pieces_left:
            room = min((r for r in groups if r >= length), default=None)
            if room is None:
                copies = capacity // length
                pattern, times = {length: copies}, pieces_left // copies
                if not times:
                    pattern, times = {length: pieces_left}, 1
                used = pattern[length]
                room = capacity - used * length
            else:
                held, size = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                used, times = 1, min(size, pieces_left)
                if size > times:
                    groups.setdefault(room, []).append((held, size - times))
                pattern = held | {length: held.get(length, 0) + 1}
                room -= length
            pieces_left -= used * times
            groups.setdefault(room, []).append((pattern, times))
    return [group for same in groups.values() for group in same]


def slots(plan: list[Pattern]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the pieces of each length go, by their number within the length.

    Sorted keys (length and first number of a run of pieces), the run's first sequence and the
    offset in each: piece number first + i of the length lies in sequence base + i.
    """
    used: dict[int, int] = {}
    rows: list[tuple[int, int, int, int]] = []
    base = 0
    for pattern, times in plan:
        offset = 0
        for length, copies in sorted(pattern.items(), reverse=True):
            for _ in range(copies):
                first = used.get(length, 0)
                rows.append((length, first, base, offset))
                used[length] = first + times
                offset += length
        base += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[:, 0] * _RANKS + table[:, 1], table[:, 2], table[:, 3]


_RANKS = 1 << 48


def numbered(cut: DataFrame) -> DataFrame:
    """Adds ``rank``, the number of each piece among those of its length, from 0.

    Pieces of one length are numbered within hashed shares, so that a length that most pieces
    have does not meet in one task; the shares are then counted on.
    """
    shared = cut.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"),
                                            F.lit(shuffle_partitions(cut))).cast("int"))
    sizes = shared.groupBy("length", "share").agg(F.count("*").alias("size"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = measured(sizes.select("length", "share", F.coalesce(F.sum("size").over(before), F.lit(0))
                                   .alias("first")))
    inside = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids_crc32")
    return (shared.withColumn("inner", F.row_number().over(inside) - 1)
            .join(starts, ["length", "share"])
            .withColumn("rank", (F.col("first") + F.col("inner")).cast("long"))
            .drop("share", "first", "inner"))


def pack(docs: DataFrame, capacity: int = CAPACITY, **files: str) -> DataFrame:
    """Places every piece of every text in a sequence of at most ``capacity`` tokens.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset; offsets
    of a sequence run on without gaps from 0. Only the number of pieces of each length (at most
    ``capacity`` numbers) is known to the driver, where the program is solved.

    Null and empty texts are the closing id alone. Null ids and repeated rows are documents of
    their own. No rows: no pieces. Other columns are ignored.
    """
    cut = settle(pieces(docs, capacity=capacity, **files))
    counts = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").agg(F.count("*").alias("size")).collect():
        counts[row["length"]] = row["size"]
    keys, bases, offsets = slots(solve(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length * _RANKS + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.split()[0]) for f in PIECES.split(", ")),
                 pa.array(bases[at] + rank - keys[at] % _RANKS), pa.array(offsets[at])],
                [f.split()[0] for f in OUT.split(", ")])

    return numbered(cut).mapInArrow(place, OUT)
