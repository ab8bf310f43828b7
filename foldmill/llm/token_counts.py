"""Token counts by heap-and-linked-list byte-pair merging (operator 6)."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame

from foldmill.llm.arrays import slices

LIMIT = 4096
SPACE = "▁"
# Bytes of text whose distinct words are merged together.
CHUNK = 16_000_000
OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Merges:
    """The merges of a piece vocabulary: which adjacent pieces join, and how early."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ordinary = [i for i in range(model.get_piece_size())
                    if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
                            or model.is_unused(i))]
        self.pieces = {model.id_to_piece(i): i for i in ordinary}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece runs over a space: words can't be merged by themselves")
        # The best score is the lowest rank; equal scores keep the order of ids.
        order = sorted(ordinary, key=lambda i: (-model.get_score(i), i))
        rank = {piece: r for r, piece in enumerate(order)}
        self.size = model.get_piece_size()
        joins = {}
        for piece, i in self.pieces.items():
            for cut in range(1, len(piece)):
                left, right = self.pieces.get(piece[:cut]), self.pieces.get(piece[cut:])
                if left is not None and right is not None:
                    joins[left * self.size + right] = (rank[i], i)
        self.joins = joins
        self.keys = np.array(sorted(joins), np.int64)
        self.ranks = np.array([joins[k][0] for k in self.keys.tolist()], np.int64)
        self.joined = np.array([joins[k][1] for k in self.keys.tolist()], np.int64)

    def symbols(self, word: str) -> tuple[list[int], int]:
        """First symbols of a word: ids of its characters, -1 for one outside the vocabulary; and
        how many tokens such characters give beyond one, as each falls back to its bytes."""
        ids = [self.pieces.get(c, -1) for c in word]
        extra = sum(len(c.encode()) - 1 for c, i in zip(word, ids) if i < 0)
        return ids, extra

    def count(self, ids: list[int]) -> int:
        """Symbols left of one word, its merges done one at a time."""
        before = list(range(-1, len(ids) - 1))
        after = [*range(1, len(ids)), -1]
        ids = list(ids)
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and ids[i] >= 0 and ids[j] >= 0:
                found = self.joins.get(ids[i] * self.size + ids[j])
                if found:
                    heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(len(ids)):
            offer(i)
        merges = 0
        while heap:
            _, i, left, right, joined = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue  # one of the two is gone
            merges += 1
            ids[i], ids[j] = joined, -2
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return len(ids) - merges

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Entry of every pair in ``keys``; -1 where a pair doesn't join."""
        key = np.where((left >= 0) & (right >= 0), left * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of many words, their merges done side by side.

        One heap holds the ranks that wait, each with the places of its pairs. The lowest rank is
        popped with all its places, pairs that are still there are merged from left to right
        over the linked list, and the new pairs are put back under their ranks. Words don't
        touch each other, so the order is that of a heap of their own, but for one case: a
        merge makes a pair of a still lower rank in a word that had several pairs of one
        rank. Such words are done again one merge at a time.
        """
        firsts = [self.symbols(word) for word in words]
        lengths = np.array([len(ids) for ids, _ in firsts], np.int64)
        extra = np.array([e for _, e in firsts], np.int64)
        total = int(lengths.sum())
        if not total:
            return extra
        ids = np.fromiter((i for w, _ in firsts for i in w), np.int64, total)
        word = np.repeat(np.arange(len(words)), lengths)
        after = np.arange(1, total + 1)
        after[np.cumsum(lengths)[lengths > 0] - 1] = total      # the end of a word
        before = np.full(total + 1, total)
        inner = after < total
        before[after[inner]] = np.flatnonzero(inner)
        ids = np.append(ids, -1)                                # stands behind every word
        merges = np.zeros(len(words), np.int64)
        again = np.zeros(len(words), bool)
        waiting: dict[int, list] = {}
        heap: list[int] = []

        def offer(places: np.ndarray) -> np.ndarray:
            """Puts pairs that start at ``places`` under their ranks; returns the ranks."""
            entry = self.lookup(ids[places], ids[after[places]])
            places, entry = places[entry >= 0], entry[entry >= 0]
            ranks = self.ranks[entry]
            order = np.argsort(ranks, kind="stable")
            places, entry, sorted_ranks = places[order], entry[order], ranks[order]
            cuts = np.flatnonzero(np.diff(sorted_ranks)) + 1
            for rank, some, entries in zip(sorted_ranks[np.append(0, cuts)].tolist() if len(order) else (),
                                           np.split(places, cuts), np.split(entry, cuts)):
                if rank not in waiting:
                    waiting[rank] = []
                    heapq.heappush(heap, rank)
                waiting[rank].append((some, entries))
            return word[places[sorted_ranks < least]]

        least = -1
        offer(np.arange(total))
        while heap:
            least = heapq.heappop(heap)
            parts = waiting.pop(least)
            places = np.concatenate([p for p, _ in parts])
            entries = np.concatenate([e for _, e in parts])
            places, kept = np.unique(places, return_index=True)
            entries = entries[kept]
            nexts = after[places]
            there = self.keys[entries] == np.where(
                (ids[places] >= 0) & (ids[nexts] >= 0), ids[places] * self.size + ids[nexts], -1)
            places, entries, nexts = places[there], entries[there], nexts[there]
            # A pair that begins in the middle of the one before waits for nothing: it is broken.
            free = np.ones(len(places), bool)
            chained = np.flatnonzero(nexts[:-1] == places[1:]) + 1
            for i in chained.tolist():
                free[i] = not free[i - 1]
            places, entries, nexts = places[free], entries[free], nexts[free]
            if not len(places):
                continue
            own = word[places]
            merges += np.bincount(own, minlength=len(words)) if len(own) * 20 > len(words) else 0
            if len(own) * 20 <= len(words):
                np.add.at(merges, own, 1)
            ids[places] = self.joined[entries]
            ids[nexts] = -2
            beyond = after[nexts]
            after[places] = beyond
            before[beyond] = places
            left = before[places]
            lower = offer(np.unique(np.concatenate([places, left[left < total]])))
            if len(lower):
                several = own[1:][own[1:] == own[:-1]]
                again[np.intersect1d(lower, several)] = True
        left_over = lengths - merges
        for i in np.flatnonzero(again).tolist():
            left_over[i] = self.count(firsts[i][0])
        return left_over + extra


_WORDS = re.compile(" +[^ ]*")


def units(text: str) -> list[str]:
    """A text as runs of spaces, each with the word after it; one space is put before the text.
    No piece runs over such a border."""
    if not text:
        return []
    return _WORDS.findall(" " + text.replace(SPACE, " "))


def token_counts(docs: DataFrame, model_file: str | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every text, as the ``sentencepiece`` model counts them.

    No begin, end or added special tokens; their strings in a text are ordinary text. Words
    are merged once per distinct word of a chunk of texts; no identifiers are made. The model
    is a file that every executor has (default: ``piece_bpe_32k.model``).

    Null and empty texts have no bytes and no tokens. Each row gives one row, repeated rows
    and null ids too. Other columns are ignored.
    """
    model_file = model_file or public_tokenizers.path("piece_bpe_32k.model")

    def count(batches: Iterator[pa.RecordBatch]):
        merges = Merges(model_file)
        for batch in batches:
            for part in slices(batch, limit=CHUNK):
                yield _counted(part, merges, limit)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(count, OUT)


def _counted(part: pa.RecordBatch, merges: Merges, limit: int) -> pa.RecordBatch:
    number: dict[str, int] = {}
    seen: list[np.ndarray] = []
    sizes = np.zeros(part.num_rows, np.int64)
    n_bytes = np.zeros(part.num_rows, np.int64)
    for row, text in enumerate(part.column("text").to_pylist()):
        found = units(text or "")
        n_bytes[row] = len((text or "").encode())
        sizes[row] = len(found)
        seen.append(np.array([number.setdefault(u, len(number)) for u in found], np.int64))
    counts = merges.counts([u.replace(" ", SPACE) for u in number])
    running = np.concatenate([[0], np.cumsum(counts[np.concatenate(seen)])]) if number else np.zeros(1, np.int64)
    ends = np.cumsum(sizes)
    tokens = running[ends] - running[ends - sizes]
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(n_bytes), pa.array(tokens), pa.array(tokens > limit)],
        ["doc_id", "n_bytes", "n_tokens", "over_limit"])
