"""Hard-negative mining over lists shared by clusters of anchors, after MAXIMUS (operator 11).

Abuzaid, Sethi, Bailis and Zaharia 2017: users are clustered, each cluster sorts all items once
by an upper bound that holds for all of its users, and every user walks that list until the
bound of the rest falls below what the user still needs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from foldmill.llm.store import settle
from foldmill.llm.top_k import _matrix
from foldmill.operators.keys import measured

POSITIVES = 5
NEGATIVES = 5
LOWEST, HIGHEST = 80, 100   # per cent of the positive's score that a negative must have
SAMPLE = 4_096              # anchors that the centroids are fitted on, at most
ANCHORS_PER_CLUSTER = 256   # on average
MAX_CLUSTERS = 256          # centroids; larger clusters are split into member blocks
MEMBERS = 1_024             # anchors of a member block, on average
BLOCK = 2_048               # candidates of a block of a list, on average
STEP = 512                  # candidates that are read at a time
HEAD = 64                   # candidates at the head of every list that are read first
# A bound's cosine is raised by so much, which covers the rounding of angles.
SLACK = 1e-6
SEED = 11

ROWS = "vec_id long, label string, vector array<long>"
BOUNDED = ROWS + ", length double, angles array<double>"
POSITIVE = "anchor_id long, vec_id long, score long"
NEGATIVE = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1, and the lengths; a zero row stays zero."""
    length = np.sqrt((vectors * vectors).sum(axis=1))
    return vectors / np.where(length > 0, length, 1.0)[:, None], length


def centroids(vectors: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Directions of ``clusters`` groups of similar direction, by spherical k-means."""
    unit, length = _unit(vectors)
    unit = unit[length > 0]
    if not len(unit):
        return np.zeros((1, vectors.shape[1]))
    rng = np.random.default_rng(SEED)
    centres = unit[rng.choice(len(unit), min(clusters, len(unit)), replace=False)]
    for _ in range(rounds):
        nearest = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        moved, size = _unit(sums)
        centres = np.where(size[:, None] > 0, moved, centres)
    return centres


def _angles(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centres.T, -1.0, 1.0))


def _with_angles(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """Adds the length of every vector and its angle to every centroid."""
    def measure(batches):
        for batch in batches:
            unit, length = _unit(_matrix(batch.column("vector"), centres.shape[1]))
            angles = _angles(unit, centres)
            offsets = np.arange(len(unit) + 1, dtype=np.int32) * len(centres)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label", "vector")), pa.array(length),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(angles.ravel()))],
                ["vec_id", "label", "vector", "length", "angles"])

    return rows.mapInArrow(measure, BOUNDED)


def walk(members: np.ndarray, length: np.ndarray, needed, bounds: np.ndarray,
         vectors: np.ndarray) -> np.ndarray:
    """Scores of the members of a cluster (rows) with the part of a list that each walks (columns).

    The list is ordered by falling ``bounds``: no score of a member with a later entry is above its
    own length times the next bound. ``needed(scores, members)`` tells which score the members
    given still need; a member stops, certified, where the bound of the rest is below. Entries that
    it has not reached are minus infinity.
    """
    scores = np.full((len(members), len(vectors)), -np.inf)
    walking = np.arange(len(members))
    for at in range(0, len(vectors), STEP):
        upper = length[walking] * bounds[at] + SLACK
        walking = walking[upper >= needed(scores[walking, :at], walking)]
        if not len(walking):
            break
        step = slice(at, at + STEP)
        scores[walking, step] = members[walking] @ vectors[step].T
    return scores


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest score of every row; minus infinity where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k highest scores of every row, ties by smaller id."""
    able = (scores >= _kth(scores, k)[:, None]) & (scores > -np.inf)
    row, column = np.nonzero(able)
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _list(listed: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block of a list in walking order: ids, labels, bounds, vectors."""
    order = np.argsort(-listed.column("bound").to_numpy(), kind="stable")
    return (listed.column("vec_id").to_numpy()[order],
            np.array(listed.column("label").to_pylist(), object)[order],
            listed.column("bound").to_numpy()[order], _matrix(listed.column("vector"), width)[order])


def _empty(schema: str) -> pa.Table:
    return pa.table({field.split()[0]: pa.array([], pa.int64()) for field in schema.split(", ")})


def _positives(width: int, k: int):
    def search(members: pa.Table, listed: pa.Table) -> pa.Table:
        if not members.num_rows or not listed.num_rows:
            return _empty(POSITIVE)
        own = members.column("vec_id").to_numpy()
        ids, _, bounds, vectors = _list(listed, width)
        floor = members.column("floor").to_numpy()
        itself = own[:, None] == ids[None, :]

        def needed(scores, at):
            return np.maximum(floor[at], _kth(np.where(itself[at, :scores.shape[1]], -np.inf, scores), k))

        scores = walk(_matrix(members.column("vector"), width), members.column("length").to_numpy(),
                      needed, bounds, vectors)
        scores[itself] = -np.inf
        row, column = _first(scores, ids, k)
        return pa.table({"anchor_id": own[row], "vec_id": ids[column],
                         "score": scores[row, column].astype(np.int64)})
    return search


def _negatives(width: int, k: int, lowest: int, highest: int):
    def search(members: pa.Table, listed: pa.Table) -> pa.Table:
        if not members.num_rows or not listed.num_rows:
            return _empty(NEGATIVE)
        own = members.column("vec_id").to_numpy()
        ids, labels, bounds, vectors = _list(listed, width)
        other = np.array(members.column("label").to_pylist(), object)[:, None] != labels[None, :]
        # One column per positive of an anchor; an anchor with fewer has windows that are empty.
        given = members.column("positives").to_pylist()
        most = max(map(len, given))
        positive = np.array([[p["vec_id"] for p in g] + [0] * (most - len(g)) for g in given], np.int64)
        top = np.array([[p["score"] for p in g] + [-1] * (most - len(g)) for g in given], float)
        low, high = lowest * top, highest * top

        def within(scores, at, j):
            scaled = 100 * scores
            fit = other[at, :scores.shape[1]] & (scaled >= low[at, j, None]) & (scaled <= high[at, j, None])
            return np.where(fit, scores, -np.inf)

        def needed(scores, at):
            per_window = [np.where(low[at, j] <= high[at, j],
                                   np.maximum(low[at, j] / 100, _kth(within(scores, at, j), k)), np.inf)
                          for j in range(most)]
            return np.min(per_window, axis=0)

        scores = walk(_matrix(members.column("vector"), width), members.column("length").to_numpy(),
                      needed, bounds, vectors)
        every = np.arange(len(own))
        out = []
        for j in range(most):
            row, column = _first(within(scores, every, j), ids, k)
            out.append((own[row], positive[row, j], top[row, j], ids[column], scores[row, column]))
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
        return pa.table(dict(zip((f.split()[0] for f in NEGATIVE.split(", ")), columns)))
    return search


def _valid(rows: DataFrame) -> DataFrame:
    """One row per id: of several different ones, that which sorts first by label and vector."""
    fit = (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                       F.col("vector").cast("array<long>").alias("vector"))
           .filter("vec_id is not null and label is not null and vector is not null")
           .filter(~F.exists("vector", lambda x: x.isNull())))
    return fit.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select(
        "vec_id", "row.label", "row.vector")


def _searched(members: DataFrame, listed: DataFrame, keys: list[str], blocks: int, search,
              schema: str) -> DataFrame:
    """Every list, dealt into ``blocks`` parts, searched by all member blocks of its ``keys``.

    A list's part is copied once per member block, a member block once per part.
    """
    number = F.greatest(F.ceil(F.count("*") / MEMBERS), F.lit(1)).cast("int").alias("parts")
    parts = measured(members.groupBy(*keys).agg(number))
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = (members.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
            .withColumn("block", spread(F.lit(blocks))))
    right = (listed.join(parts, keys).withColumn("part", spread(F.col("parts")))
             .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")))
    group = [*keys, "part", "block"]
    return (left.drop("parts").groupBy(*group).cogroup(
        right.select(*dict.fromkeys([*group, "vec_id", "label", "vector", "bound"]))
        .groupBy(*group)).applyInArrow(search, schema))


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
         lowest: int = LOWEST, highest: int = HIGHEST, clusters: int | None = None,
         sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """Hard negatives of every positive of every anchor.

    ``rows`` has ``vec_id``, ``label`` and ``vector``, an array of longs; ``anchors`` has the ``vec_id``
    of the rows that are anchors. Scores are inner products, higher ones come first, ties by smaller
    vec_id. An anchor's positives are its first ``positives`` other rows of the same label. Per
    anchor and positive, the first ``negatives`` rows of another label are returned whose score is
    ``lowest`` to ``highest`` per cent of the positive's.

    Centroids are fitted on at most ``sample`` anchors; all anchors and rows are assigned to
    them. A cluster has one list of the rows of a label, for positives, and one of all rows, for
    negatives. An entry's bound is its length times the cosine of its angle to the centroid less the
    widest angle of a member. The head of every list of positives is walked first; what
    the members then still need cuts the list where the bound certifies that no member needs the
    rest, before it is shuffled. Lists of negatives are cut by the lowest score that counts.
    What is left is walked in blocks of some ``block`` rows, each member until it is certified.

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.
    Rows with a null id, label, vector or element take no part; of several different rows
    of one id, one does (least label, then vector); repeated rows count once. Shorter vectors count
    as padded with zeros. A zero vector scores 0 with all. A positive with a negative score has no negatives.
    Scores times 100 must stay below 2**53. Empty tables give no rows. Other columns are ignored.
    """
    rows = settle(_valid(rows))
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    chosen = anchors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    asked = settle(rows.join(chosen, "vec_id", "left_semi"))
    # A bounded sample in the order of a hash of the id.
    learned = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow()
    if clusters is None:
        clusters = min(MAX_CLUSTERS, -(-asked.count() // ANCHORS_PER_CLUSTER))
    centres = centroids(_matrix(learned.column("vector"), width), max(1, clusters)) \
        if learned.num_rows else np.zeros((1, width))

    nearest = F.array_position("angles", F.array_min("angles")).cast("int")
    members = settle(_with_angles(asked, centres).select(
        "vec_id", "label", "vector", "length", nearest.alias("cluster"), F.array_min("angles").alias("angle")))
    measured_rows = _with_angles(rows, centres)

    # Positives. A list holds the rows of one label for one cluster.
    own = ["cluster", "label"]
    reach = measured(members.groupBy(*own).agg(F.max("angle").alias("reach")))
    angle = F.element_at("angles", F.col("cluster"))
    listed = measured_rows.join(reach, "label").withColumn("bound", _bound(angle))
    order = Window.partitionBy(*own).orderBy(F.desc("bound"), "vec_id")
    head = (listed.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= HEAD).drop("_place"))
    nothing = F.lit(float("-inf"))
    seen = _searched(members.withColumn("floor", nothing), head, own, 1, _positives(width, positives), POSITIVE)
    floors = seen.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.count("*").alias("_seen"), F.min("score").cast("double").alias("floor"))
    floored = settle(members.join(floors, "vec_id", "left").withColumn(
        "floor", F.when(F.col("_seen") >= positives, F.col("floor")).otherwise(nothing)).drop("_seen"))
    needs = measured(floored.groupBy(*own).agg(F.max("angle").alias("reach"), _least_bound("floor").alias("need")))
    rest = measured_rows.join(needs, "label").withColumn("bound", _bound(angle)).filter(_within_need())
    largest = rows.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    found = _searched(floored, rest, own, -(-largest // block), _positives(width, positives), POSITIVE)
    best = found.withColumn("_rank", F.row_number().over(
        Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("_rank") <= positives)

    # Negatives. A list holds the rows of all labels for one cluster.
    pairs = best.filter("score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("vec_id", "score"))).alias("positives"))
    asking = settle(members.join(pairs, "vec_id").withColumn(
        "floor", F.array_min(F.transform("positives", lambda p: p["score"])) * (lowest / 100)))
    # No more rows than centroids, of two numbers each.
    needs = F.broadcast(settle(asking.groupBy("cluster").agg(
        F.max("angle").alias("reach"), _least_bound("floor").alias("need"))))
    rest = (measured_rows.select("vec_id", "label", "vector", "length", F.posexplode("angles").alias("_n", "_angle"))
            .withColumn("cluster", F.col("_n") + 1).join(needs, "cluster")
            .withColumn("bound", _bound(F.col("_angle"))).filter(_within_need()))
    found = _searched(asking, rest, ["cluster"], -(-max(1, rows.count()) // block),
                      _negatives(width, negatives, lowest, highest), NEGATIVE)
    ranked = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _bound(angle: Column) -> Column:
    """No score of an entry with a member of the cluster is above this times the member's length."""
    return F.col("length") * (F.cos(F.greatest(F.lit(0.0), angle - F.col("reach"))) + F.lit(SLACK))


def _least_bound(floor: str) -> Column:
    """The least bound of an entry that some member needs. A member of length 0 needs all."""
    return F.min(F.when(F.col("length") > 0, F.col(floor) / F.col("length")).otherwise(F.lit(float("-inf"))))


def _within_need() -> Column:
    return F.col("bound") + F.lit(SLACK) >= F.col("need")
