"""Which windows of a fixed number of symbols also start earlier in the corpus.

Symbols are the words or the bytes of a text. Every window has a trigger: the gram
with the least rolling hash, the leftmost of equal ones. Neighbouring windows with one trigger
form a phrase, so a text is parsed into phrases, and equal windows always lie in phrases of
equal trigger. The search narrows step by step, each step a partial aggregation by fingerprint, in
which a hot key shrinks before it is shuffled and no group is ever gathered:

1. triggers that occur once: their phrases hold no repeated window;
2. the dictionary: distinct phrases of the other triggers, each with its first place.
   Later copies are repeated as a whole; a first place whose trigger has no second entry
   holds no repeated window;
3. only where one trigger has several entries, at the edges of repeated passages, the entries'
   first places are looked into: cells of neighbouring windows whose common core occurs once
   go, the windows of the others are fingerprinted one by one.

A window is then repeated unless its own place was found to be the first. Phrases and
windows are compared by two 64-bit rolling hashes. They are of few symbols (40 words or 200 bytes), for
which such hashes are sound; long words, which are not, are hashed by themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from foldmill.llm.arrays import (Rolling, byte_symbols, list_values, longs, mix, ranges, slices,
                                 sliding_min, texts, words)
from foldmill.llm.store import PART, settle
from foldmill.operators.keys import measured

# (bytes, row offsets) -> symbols of two lanes, symbol offsets per row
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


# Words of more bytes are hashed one by one. A rolling hash modulo a power of two is weak for long
# ones: a Thue-Morse word of 1,024 letters and its complement agree whatever the base.
LONG_WORD = 32


def word_symbols(data: np.ndarray, bounds: np.ndarray):
    """Two 64-bit lanes per word that depend on its bytes alone."""
    starts, ends, rows = words(data, bounds)
    lanes = [Rolling(byte_symbols(lane)[data], lane).spans(starts, ends) for lane in (0, 1)]
    long = np.flatnonzero(ends - starts > LONG_WORD)
    if len(long):
        own = [xxhash.xxh3_128_intdigest(data[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
        lanes[0][long] = np.array([x >> 64 for x in own], np.uint64)
        lanes[1][long] = np.array([x & (1 << 64) - 1 for x in own], np.uint64)
    return *lanes, rows


def text_bytes(data: np.ndarray, bounds: np.ndarray):
    return byte_symbols(0)[data], byte_symbols(1)[data], bounds


_HIGH = np.uint64(0xFFFFFFFF00000000)


class Phrases:
    """The phrases of a chunk of texts, one array entry per phrase."""

    def __init__(self, batch: pa.RecordBatch, symbols: Symbols, window: int, gram: int):
        self.first, self.second, self.bounds = symbols(*texts(batch.column("text")))
        self.window = window
        self.rolling = Rolling(self.first, 0)
        grams = self.rolling.grams(gram)
        # The leftmost of the least: high halves are compared, places decide ties.
        least = grams & _HIGH
        least |= np.arange(len(grams), dtype=np.uint64)
        least = sliding_min(least, window - gram + 1)
        # Runs of windows with one trigger, and the last window of every row as an end.
        sizes = np.diff(self.bounds)
        full = np.flatnonzero(sizes >= window)
        opens, closes = self.bounds[full], self.bounds[full + 1] - window + 1
        change = np.flatnonzero(least[1:] != least[:-1]) + 1
        owner = np.searchsorted(opens, change, "right") - 1
        if not len(full):
            change = owner = change[:0]
        inside = (owner >= 0) & (change < closes[owner]) & (change > opens[owner])
        begin = np.concatenate([opens, change[inside]])
        order = np.argsort(begin, kind="stable")
        begin = begin[order]
        at = np.concatenate([np.arange(len(full)), owner[inside]])[order]
        self.row = full[at]
        self.start = begin
        self.count = np.minimum(np.append(begin[1:], len(least)), closes[at]) - begin
        self.at = (least[begin] & ~_HIGH).astype(np.int64)    # where the trigger starts
        self.trigger = grams[self.at].view(np.int64)
        self.doc_id = longs(batch.column("doc_id"))[self.row]
        self.part = longs(batch.column("part"))
        self.place = self.start - self.bounds[self.row] + self.part[self.row] * PART

    def listed(self, column: pa.Array, scale: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase: whether its place is in its row's list, and what the entry carries."""
        values, rows = list_values(column)
        inner = values // scale - self.part[rows] * PART
        own = (inner >= 0) & (inner < np.diff(self.bounds)[rows])
        carried = np.full(len(self.first), -1, np.int64)
        carried[self.bounds[rows[own]] + inner[own]] = values[own] % scale
        carried = carried[self.start]
        return carried >= 0, carried

    def pick(self, chosen: np.ndarray) -> None:
        for name in ("trigger", "at", "row", "start", "count", "doc_id", "place"):
            setattr(self, name, getattr(self, name)[chosen])

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        ends = self.start + self.count + self.window - 1
        return (self.rolling.spans(self.start, ends).view(np.int64),
                Rolling(self.second, 1).spans(self.start, ends).view(np.int64))

    def cells(self, width: int) -> Cells:
        low = (self.at - self.start - self.count + 1) // width
        number = (self.at - self.start) // width - low + 1
        phrase = np.repeat(np.arange(len(number)), number)
        return Cells(self, phrase, ranges(low, number), width)


class Cells:
    """The windows of each phrase in cells of ``width`` neighbours, counted from the trigger.

    Equal windows lie in cells of one number. All windows of a cell share its core, so a cell
    whose core occurs once holds no repeated window.
    """

    def __init__(self, phrases: Phrases, phrase: np.ndarray, number: np.ndarray, width: int):
        self.phrases, self.phrase, self.number, self.width = phrases, phrase, number, width
        first = phrases.at[phrase] - number * width
        self.core = first, first - width + 1 + phrases.window
        begin = np.maximum(phrases.start[phrase], first - width + 1)
        self.start = begin
        self.count = np.minimum((phrases.start + phrases.count)[phrase], first + 1) - begin

    def cores(self) -> np.ndarray:
        marks = self.phrases.rolling.spans(*self.core)
        return mix(marks + self.number.astype(np.uint64)).view(np.int64)

    def places(self) -> np.ndarray:
        return self.phrases.place[self.phrase] * CELLS + self.number

    def drop(self, column: pa.Array) -> None:
        """Takes out the cells that are in their row's list."""
        own = self.phrases
        values, rows = list_values(column)
        gone = own.bounds[rows] + values // CELLS - own.part[rows] * PART
        kept = ~np.isin(own.start[self.phrase] * CELLS + self.number, gone * CELLS + values % CELLS)
        for name in ("phrase", "number", "start", "count"):
            setattr(self, name, getattr(self, name)[kept])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of all cells, and the phrase of each."""
        return ranges(self.start, self.count), np.repeat(self.phrase, self.count)


def _batch(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)


# A phrase has fewer cells.
CELLS = 16

TRIGGERS = "trigger long, doc_id long, place long"
ENTRIES = "mark1 long, mark2 long, trigger long, doc_id long, place long"
WINDOWS = "mark1 long, mark2 long, doc_id long, place long"


def cell_width(window: int, gram: int) -> int:
    """Windows per cell, so that a phrase has some eight cells."""
    return max(1, -(-(window - gram + 1) // 8))


def repeated_windows(docs: DataFrame, symbols: Symbols, window: int, gram: int) -> DataFrame:
    """The texts of ``bucketed_texts`` with four lists per row that tell repeated windows.

    ``lone``: places of phrases whose trigger occurs once; ``entries``: places of first
    dictionary entries, doubled, plus 1 where windows decide; ``cores``: cells of those whose core
    occurs once; ``windows``: first places of the other windows. ``repeated_spots`` reads them.
    """
    width = cell_width(window, gram)

    def triggers(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                found = Phrases(part, symbols, window, gram)
                yield _batch(TRIGGERS, found.trigger, found.doc_id, found.place)

    def entries(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                found = Phrases(part, symbols, window, gram)
                found.pick(~found.listed(part.column("lone"))[0])
                yield _batch(ENTRIES, *found.fingerprints(), found.trigger, found.doc_id,
                             found.place)

    def edges(part: pa.RecordBatch) -> Phrases:
        found = Phrases(part, symbols, window, gram)
        listed, mixed = found.listed(part.column("entries"), 2)
        found.pick(listed & (mixed == 1))
        return found

    def cores(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                found = edges(part).cells(width)
                yield _batch(TRIGGERS, found.cores(), found.phrases.doc_id[found.phrase],
                             found.places())

    def inner(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                found = edges(part)
                cells = found.cells(width)
                cells.drop(part.column("cores"))
                spots, phrase = cells.windows()
                yield _batch(WINDOWS, found.rolling.spans(spots, spots + window).view(np.int64),
                             Rolling(found.second, 1).spans(spots, spots + window).view(np.int64),
                             found.doc_id[phrase],
                             found.place[phrase] + spots - found.start[phrase])

    first = F.min(F.struct("doc_id", "place")).alias("first")
    lone = settle(_occurring_once(docs.mapInArrow(triggers, TRIGGERS), "lone"))
    with_lone = docs.join(lone, "doc_id", "left")
    dictionary = settle(
        with_lone.mapInArrow(entries, ENTRIES).groupBy("mark1", "mark2")
        .agg(F.min("trigger").alias("trigger"), first)
        .select("trigger", "first.doc_id", "first.place"))
    # Stored first, so that the join deals out the dictionary anew and a common trigger is split.
    several = measured(dictionary.groupBy("trigger").agg(F.count("*").alias("entries"))
                       .filter("entries > 1").select("trigger", F.lit(1).alias("mixed")))
    firsts = settle(_by_document(
        dictionary.join(several, "trigger", "left"),
        F.col("place") * 2 + F.coalesce("mixed", F.lit(0)), "entries"))
    mixed = docs.join(firsts.filter(F.exists("entries", lambda e: e % 2 == 1)), "doc_id")
    unique = settle(_occurring_once(mixed.mapInArrow(cores, TRIGGERS), "cores"))
    shared = settle(_by_document(
        mixed.join(unique, "doc_id", "left").mapInArrow(inner, WINDOWS).groupBy("mark1", "mark2")
        .agg(first).select("first.doc_id", "first.place"), F.col("place"), "windows"))
    for lists in (firsts, unique, shared):
        with_lone = with_lone.join(lists, "doc_id", "left")
    return with_lone


def _occurring_once(marked: DataFrame, name: str) -> DataFrame:
    """Places whose mark, the first column, occurs once, as a list per document."""
    once = (marked.groupBy("trigger").agg(
        F.count("*").alias("times"), F.min("doc_id").alias("doc_id"), F.min("place").alias("place"))
        .filter("times = 1"))
    return _by_document(once, F.col("place"), name)


def _by_document(places: DataFrame, value, name: str) -> DataFrame:
    """One list per document; a list is no longer than the document."""
    return (places.select("doc_id", value.cast("long").alias("value"))
            .groupBy("doc_id").agg(F.collect_list("value").alias(name)))


def repeated_spots(part: pa.RecordBatch, symbols: Symbols, window: int,
                   gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the repeated windows of a chunk, as symbol numbers, and the symbol offsets of its
    rows. Rows without an id, and rows that were never searched, have none."""
    found = Phrases(part, symbols, window, gram)
    lone = found.listed(part.column("lone"))[0]
    listed, mixed = found.listed(part.column("entries"), 2)
    whole = ~lone & ~listed
    repeated = ranges(found.start[whole], found.count[whole])
    found.pick(listed & (mixed == 1))
    cells = found.cells(cell_width(window, gram))
    cells.drop(part.column("cores"))
    found.start = cells.windows()[0]
    inner = found.start[~found.listed(part.column("windows"))[0]]
    return np.sort(np.concatenate([repeated, inner])), found.bounds


def covered(spots: np.ndarray, window: int, size: int) -> np.ndarray:
    """Whether each of ``size`` symbols lies in a window that starts at one of ``spots``, each given once."""
    change = np.zeros(size + 1, np.int64)
    change[spots] += 1
    change[spots + window] -= 1
    return np.cumsum(change)[:size] > 0
