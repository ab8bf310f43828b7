"""SimHash near-duplicates by pigeonring filtering (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from foldmill.llm.arrays import ranges, slices, texts, words
from foldmill.llm.components import component_labels
from foldmill.llm.store import settle
from foldmill.operators.keys import measured

SHINGLE = 4    # words
DISTANCE = 4   # differing bits of linked fingerprints
SEED = 42
SEGMENTS = 8   # of eight bits, on a ring
CHAIN = 5      # segments of the chains that are required
BLOCK = 16_384  # fingerprints compared with each other in one task

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

PRINTS = "doc_id long, fingerprint long"
LINKS = "one long, other long"


def shingle_hashes(part: pa.RecordBatch, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts of a chunk, text by text, and their number per text.

    A text of fewer words has one shingle of them all, one without words has none.
    """
    data, bounds = texts(part.column("text"))
    starts, ends, rows = words(data, bounds)
    counts = np.diff(rows)
    # The words of all texts, lower-cased, each with one space behind it.
    sizes = ends - starts
    places = np.concatenate([[0], np.cumsum(sizes + 1)])
    joined = np.full(int(places[-1]), 32, np.uint8)
    joined[ranges(places[:-1], sizes)] = _LOWER[data[ranges(starts, sizes)]]
    raw = joined.tobytes()
    number = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    first = ranges(rows[:-1], number)
    last = first + np.repeat(np.minimum(counts, shingle), number) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in
                          zip(places[first].tolist(), (places[last] + sizes[last]).tolist())),
                         np.uint64, len(first))
    return hashes, number


def fingerprints(part: pa.RecordBatch, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of every text of a chunk, as unsigned 64-bit numbers."""
    return majority(*shingle_hashes(part, shingle))


def majority(hashes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Per run of ``number`` hashes the bits that over half of them have set."""
    row = np.repeat(np.arange(len(number)), number)
    out = np.zeros(len(number), np.uint64)
    bits = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)
    for byte in range(8):
        values = (hashes >> np.uint64(8 * byte)).astype(np.int64) & 255
        table = np.bincount(row * 256 + values, minlength=len(number) * 256)
        ones = table.reshape(-1, 256).astype(np.float64) @ bits
        over = (2 * ones > number[:, None]).astype(np.uint64)
        out |= (over << np.arange(8, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) << np.uint64(8 * byte)
    return out


def chain_patterns(distance: int = DISTANCE, segments: int = SEGMENTS,
                   chain: int = CHAIN) -> list[tuple[int, ...]]:
    """Which segments of a chain must be equal, as all ways to choose them.

    If two fingerprints differ in at most ``distance`` bits in all, some segment of the ring
    begins a chain whose first l segments together differ in at most l * distance / segments
    bits, for every l. So among the first l segments at least l minus that many are equal.
    Every such chain has one of the patterns returned: the smallest sets of equal segments
    that keep this rule for all l up to ``chain``. They are keys for exact lookup.
    """
    need = [max(0, n - n * distance // segments) for n in range(1, chain + 1)]
    found: list[tuple[int, ...]] = []
    for size in range(need[-1], chain + 1):
        for chosen in combinations(range(chain), size):
            if all(sum(c < n for c in chosen) >= need[n - 1] for n in range(1, chain + 1)):
                if not any(set(f) <= set(chosen) for f in found):
                    found.append(chosen)
    return found


def _masks(distance: int, segments: int, chain: int) -> list[tuple[int, int]]:
    """For each lookup key: the chain's first segment and the mask of the bits of the key."""
    width = 64 // segments
    out = []
    for start in range(segments):
        for pattern in chain_patterns(distance, segments, chain):
            mask = 0
            for offset in pattern:
                mask |= ((1 << width) - 1) << (width * ((start + offset) % segments))
            out.append((start, mask))
    return out


def _in_budget(difference: np.ndarray, start: int, distance: int, segments: int) -> np.ndarray:
    """Whether the chain from ``start`` stays within its budgets all around the ring."""
    width = 64 // segments
    turn = np.uint64(width * start)
    if start:
        difference = difference >> turn | difference << np.uint64(64 - width * start)
    able = np.ones(len(difference), bool)
    for length in range(1, segments + 1):
        low = difference if length == segments else difference & np.uint64((1 << width * length) - 1)
        able &= np.bitwise_count(low) <= length * distance // segments
    return able


def linked(values: np.ndarray, start: int, distance: int = DISTANCE,
           segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """A spanning forest of the links of one bucket whose chains begin at ``start``.

    Walks through the links from fingerprint to fingerprint, and compares each with those only
    that no walk has reached, so a dense group of near copies takes few comparisons per member.
    """
    left = np.arange(len(values))
    edges: list[tuple[int, int]] = []
    while len(left):
        walk, left = [int(left[0])], left[1:]
        while walk and len(left):
            at = walk.pop()
            difference = values[left] ^ values[at]
            near = _in_budget(difference, start, distance, segments)
            near[near] = np.bitwise_count(difference[near]) <= distance
            reached = left[near]
            edges += [(at, int(i)) for i in reached]
            walk += reached.tolist()
            left = left[~near]
    return edges


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Fingerprint and component of every document.

    Fingerprints of ``shingle``-word shingles are linked at up to ``distance`` differing bits.
    Distinct fingerprints only are compared. Pigeonring filtering finds candidates: lookup
    keys of segments that a chain within its budgets must have equal, then the budgets of the
    whole chain, then all bits. A bucket of more than ``BLOCK`` fingerprints is split into
    blocks, and each pair of blocks is compared in a task of its own.

    Returns a row per row of ``docs``: doc_id, fingerprint (long) and component_id, the
    smallest doc_id that links reach. Null, empty and wordless texts have fingerprint 0 and link
    like others. A null doc_id gets a fingerprint, but takes part in no component (null).
    Repeated rows and ids get a row each; all rows of an id share its component. Other
    columns are ignored.
    """
    def prints(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(fingerprints(part, shingle).view(np.int64))],
                    ["doc_id", "fingerprint"])

    marked = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                    .mapInArrow(prints, PRINTS))
    named = marked.filter("doc_id is not null")
    classes = settle(named.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    edges = near_links(classes.select("fingerprint"), distance)
    labels = component_labels(
        # One document of several fingerprints links them.
        edges.union(_shared_ids(named)), "one", "other")
    owned = classes.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left") \
        .withColumn("component", F.coalesce("component", "fingerprint"))
    least = owned.groupBy("component").agg(F.min("first").alias("component_id"))
    found = owned.join(least, "component").select("fingerprint", "component_id")
    return (marked.join(found, "fingerprint", "left")
            .select("doc_id", "fingerprint",
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay when of each component only its smallest doc_id does.

    All columns as they are. Rows with a null doc_id stay. Rows that share an id are one document
    and stay or go together.
    """
    gone = measured(simhash_components(docs, shingle, distance).filter("doc_id > component_id")
                    .select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")


def _shared_ids(named: DataFrame) -> DataFrame:
    several = named.groupBy("doc_id").agg(F.min("fingerprint").alias("one"),
                                          F.max("fingerprint").alias("top")).filter("one < top")
    return named.join(several, "doc_id").select("one", F.col("fingerprint").alias("other"))


def near_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs of distinct fingerprints that connect all that lie within ``distance`` bits."""
    masks = _masks(distance, SEGMENTS, CHAIN)
    keys = F.explode(F.array(*[
        F.struct(F.lit(n).alias("kind"), F.col("fingerprint").bitwiseAND(F.lit(_signed(mask))).alias("key"))
        for n, (_, mask) in enumerate(masks)]))
    keyed = prints.withColumn("bucket", keys).select("bucket.kind", "bucket.key", "fingerprint")
    # Large buckets are counted first; each of their members then meets every block of its bucket.
    large = measured(keyed.groupBy("kind", "key").agg(F.count("*").alias("members"))
                     .filter(F.col("members") > BLOCK))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    hot = keyed.join(large, ["kind", "key"]).withColumn("blocks", blocks)
    hot = (hot.withColumn("own", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"))
           .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("kind", "key", F.least("own", "met").alias("low"),
                   F.greatest("own", "met").alias("high"), "fingerprint"))
    cold = (keyed.join(large, ["kind", "key"], "left_anti")
            .select("kind", "key", F.lit(0).alias("low"), F.lit(0).alias("high"), "fingerprint"))
    group = ["kind", "key", "low", "high"]
    starts = np.array([start for start, _ in masks])

    def walk(batches: Iterator[pa.RecordBatch]):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([rest, batch] if rest is not None else [batch])
            table = table.combine_chunks()
            cuts = _cuts(table, group)
            if len(cuts) > 1:
                yield _walked(table.slice(0, int(cuts[-1])), cuts, starts, distance)
            rest = table.slice(int(cuts[-1])).combine_chunks().to_batches()[0]
        if rest is not None:
            yield _walked(pa.Table.from_batches([rest]), np.zeros(1, np.int64), starts, distance)

    dealt = cold.unionByName(hot).repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(walk, LINKS).distinct()


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _cuts(table: pa.Table, group: list[str]) -> np.ndarray:
    """First rows of the groups of a sorted table."""
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for name in group:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _walked(table: pa.Table, cuts: np.ndarray, starts: np.ndarray, distance: int) -> pa.RecordBatch:
    values = table.column("fingerprint").to_numpy().view(np.uint64)
    kinds = table.column("kind").to_numpy()
    cuts = cuts[cuts < len(values)]
    sizes = np.diff(np.append(cuts, len(values)))
    one: list[np.ndarray] = []
    other: list[np.ndarray] = []
    pairs = cuts[sizes == 2]
    for start in np.unique(starts):
        mine = pairs[starts[kinds[pairs]] == start]
        difference = values[mine] ^ values[mine + 1]
        near = _in_budget(difference, int(start), distance, SEGMENTS) & (np.bitwise_count(difference) <= distance)
        one.append(values[mine[near]])
        other.append(values[mine[near] + 1])
    for cut, size in zip(cuts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        own = values[cut:cut + size]
        edges = np.array(linked(own, int(starts[kinds[cut]]), distance), np.int64).reshape(-1, 2)
        one.append(own[edges[:, 0]])
        other.append(own[edges[:, 1]])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x).view(np.int64)) for x in (one, other)], ["one", "other"])
