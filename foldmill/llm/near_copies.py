"""Near copies by Jaccard similarity: SimHash by pigeonring filtering (operator 9) finds the close ones,
MinHash bands the links beyond its distance; whole sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foldmill.llm.arrays import mix, ranges, slices
from foldmill.llm.components import component_labels
from foldmill.llm.simhash import DISTANCE, SEED, majority, near_links, shingle_hashes
from foldmill.llm.store import settle
from foldmill.operators.keys import measured

SHINGLE = 5        # words
SIMILARITY = 0.8   # least Jaccard similarity of linked texts
# A pair of similarity 0.8 has no equal band with probability (1 - 0.8 ** ROWS) ** BANDS, 3e-10.
BANDS = 72
ROWS = 6           # least hashes of a band
BLOCK = 2_048      # texts compared with each other in one task

_EMPTY = np.uint64(0x9E3779B97F4A7C15)   # the one shingle of a text without words
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1)

MARKED = "doc_id long, print binary, fingerprint long, bands array<long>"
SETS = "print binary, shingles binary"
LINKS = "one binary, other binary"
BUCKET = ["band", "key"]


def shingle_sets(part: pa.RecordBatch, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts of a chunk, sorted per text, and their number."""
    hashes, number = shingle_hashes(part, shingle)
    hashes = np.insert(hashes, (np.cumsum(number) - number)[number == 0], _EMPTY)
    number = np.maximum(number, 1)
    row = np.repeat(np.arange(len(number)), number)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.bincount(row[new], minlength=len(number))


def set_prints(hashes: np.ndarray, number: np.ndarray) -> list[bytes]:
    """128-bit digests of sets; equal sets have equal ones."""
    starts = np.cumsum(number) - number
    sums = [mix(np.add.reduceat(mix(hashes ^ np.uint64(salt)), starts) + number.astype(np.uint64))
            for salt in (0x243F6A8885A308D3, 0x13198A2E03707344)]
    return [row.tobytes() for row in np.stack(sums, axis=1)]


def bands(hashes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """A key per band of every set: equal where the sets agree in all least hashes of the band."""
    starts = np.cumsum(number) - number
    low = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    out = np.zeros((len(number), BANDS), np.uint64)
    for n, factor in enumerate(_FACTORS):
        values = low * factor
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        values ^= values >> np.uint32(12)
        values *= factor
        band = n // ROWS
        out[:, band] = mix(out[:, band] * np.uint64(31) + np.minimum.reduceat(values, starts))
    return out


def similar(sets: list[np.ndarray], similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of at least ``similarity``.

    Walks from set to set and compares each with those only that no walk has reached.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    starts = np.cumsum(sizes) - sizes
    names, members = np.unique(np.concatenate(sets), return_inverse=True)
    left = np.arange(len(sets))
    edges: list[tuple[int, int]] = []
    while len(left):
        walk, left = [int(left[0])], left[1:]
        while walk and len(left):
            at = walk.pop()
            own = np.zeros(len(names), bool)
            own[members[starts[at]:starts[at] + sizes[at]]] = True
            shared = np.add.reduceat(own[members[ranges(starts[left], sizes[left])]].astype(np.int64),
                                     np.cumsum(sizes[left]) - sizes[left])
            near = shared / (sizes[left] + sizes[at] - shared) >= similarity
            reached = left[near]
            edges += [(at, int(i)) for i in reached]
            walk += reached.tolist()
            left = left[~near]
    return edges


def near_copies(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, component_id`` for every id: the smallest id that links reach.

    Texts link if the sets of their lower-cased ``shingle``-word shingles have a Jaccard
    similarity of at least ``similarity``, 0.8 or more. Sets that are equal are one node. Every set
    has a SimHash fingerprint; nodes of one fingerprint and the pairs that pigeonring filtering finds
    within ``DISTANCE`` bits are compared first. At 0.8 most fingerprints differ in more bits, so
    nodes that share a MinHash band are candidates too, but for bands whose members these links
    connect already. Of buckets with the same members one is taken, its sets are
    read from the texts again and compared as they are, by a walk. A bucket of more than ``BLOCK``
    members is split into blocks, and each pair of blocks is compared in a task of its own.

    A text of fewer words has one shingle; null, empty and wordless texts are equal. All rows
    of an id share its component. Null ids take no part. Other columns are ignored.
    """
    def marks(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part, shingle)
                keys = pa.FixedSizeListArray.from_arrays(pa.array(bands(*sets).view(np.int64).ravel()), BANDS)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(set_prints(*sets), pa.binary()),
                     pa.array(majority(*sets).view(np.int64)), keys.cast(pa.list_(pa.int64()))],
                    ["doc_id", "print", "fingerprint", "bands"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    marked = settle(texts.mapInArrow(marks, MARKED))
    nodes = settle(marked.groupBy("print").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"),
                                               F.first("fingerprint").alias("fingerprint")))
    names = nodes.select("print", "first")

    def compared(members: DataFrame) -> DataFrame:
        return _links(members, _sets(texts, members.join(names, "print"), shingle), similarity)

    ids = marked.select("doc_id", "print")
    close = settle(component_labels(compared(_close(nodes)).union(_shared_ids(ids)), "one", "other"))
    links = compared(_members(_grouped(nodes, close)))
    labels = component_labels(close.union(links), "node", "component")
    owned = names.join(labels.withColumnRenamed("node", "print"), "print", "left") \
        .withColumn("component", F.coalesce("component", "print"))
    least = owned.groupBy("component").agg(F.min("first").alias("component_id"))
    found = owned.join(least, "component").select("print", "component_id")
    return ids.join(found, "print").select("doc_id", "component_id").distinct()


def keep_one(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay when of each component only its smallest doc_id does.

    All columns as they are. Rows with a null doc_id stay. Rows that share an id are one document
    and stay or go together.
    """
    gone = measured(near_copies(docs, shingle, similarity).filter("doc_id > component_id")
                    .select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")


def _close(nodes: DataFrame) -> DataFrame:
    """``band, key, members, print`` of nodes of one fingerprint, and of pairs of fingerprints that
    connect all within ``DISTANCE`` bits, each by the least node it has."""
    kinds = settle(nodes.groupBy("fingerprint").agg(F.min("print").alias("print"), F.count("*").alias("members")))
    equal = kinds.filter("members > 1").select("fingerprint", "members").join(
        nodes.select("fingerprint", "print"), "fingerprint").select(
            F.lit(-1).alias("band"), F.col("fingerprint").alias("key"), "members", "print")
    # The number of a pair need not be its own: all that share one are compared.
    pairs = near_links(kinds.select("fingerprint"), DISTANCE).select(
        F.xxhash64("one", "other").alias("key"), F.explode(F.array("one", "other")).alias("fingerprint"))
    near = pairs.join(kinds, "fingerprint").select(
        F.lit(-2).alias("band"), "key", F.lit(2).cast("bigint").alias("members"), "print")
    return settle(equal.union(near))


def _grouped(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """The nodes with ``known``, the least id of those they are connected with so far."""
    linked = labels.withColumnRenamed("node", "print").join(nodes.select("print", "first"), "print")
    least = linked.groupBy("component").agg(F.min("first").alias("known"))
    known = labels.join(least, "component").select(F.col("node").alias("print"), "known")
    return nodes.join(known, "print", "left").withColumn("known", F.coalesce("known", "first"))


def _members(nodes: DataFrame) -> DataFrame:
    """``band, key, members, print`` of the buckets to compare, one of those with the same members.

    A bucket whose members are all connected already tells nothing new.
    """
    keyed = nodes.select("print", "known", F.posexplode("bands").alias("band", "key"))
    shared = (keyed.groupBy(*BUCKET)
              .agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("print")).alias("who"),
                   F.bit_xor(F.hash("print")).alias("also"), F.min("known").alias("least"), F.max("known").alias("most"))
              .filter("members > 1 and least < most"))
    once = shared.groupBy("members", "who", "also").agg(F.min(F.struct(*BUCKET)).alias("bucket"))
    once = measured(once.select("bucket.band", "bucket.key", "members"))
    return settle(keyed.join(once, BUCKET).select(*BUCKET, "members", "print"))


def _sets(texts: DataFrame, suspects: DataFrame, shingle: int) -> DataFrame:
    """``print, shingles`` of the suspects, from the texts of their smallest ids."""
    def sets(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                hashes, number = shingle_sets(part, shingle)
                ends = np.cumsum(number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_prints(hashes, number), pa.binary()),
                     pa.array([hashes[a:b].tobytes() for a, b in zip(ends - number, ends)], pa.binary())],
                    ["print", "shingles"])

    wanted = measured(suspects.select(F.col("first").alias("doc_id")).distinct())
    found = texts.join(wanted, "doc_id", "left_semi").mapInArrow(sets, SETS)
    return settle(found.dropDuplicates(["print"]))


def _shared_ids(ids: DataFrame) -> DataFrame:
    several = ids.groupBy("doc_id").agg(F.min("print").alias("one"),
                                        F.max("print").alias("top")).filter("one < top")
    return ids.join(several, "doc_id").select("one", F.col("print").alias("other"))


def _links(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links that connect all members of a bucket that lie within ``similarity``."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("print"), blocks).cast("int")
    dealt = (members.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select(*BUCKET, F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"), "print"))
    group = [*BUCKET, "low", "high"]

    def walk(batches: Iterator[pa.RecordBatch]):
        at, prints, held = None, [], []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in (*group, "print", "shingles")]
            for *bucket, name, shingles in zip(*columns):
                if bucket != at:
                    yield from linked(prints, held)
                    at, prints, held = bucket, [], []
                prints.append(name)
                held.append(np.frombuffer(shingles, np.uint64))
        yield from linked(prints, held)

    def linked(prints: list[bytes], held: list[np.ndarray]):
        if len(held) > 1:
            edges = similar(held, similarity)
            yield pa.RecordBatch.from_arrays(
                [pa.array([prints[e[side]] for e in edges], pa.binary()) for side in (0, 1)], ["one", "other"])

    whole = dealt.join(sets, "print").repartition(*group).sortWithinPartitions(*group)
    return whole.mapInArrow(walk, LINKS).distinct()
