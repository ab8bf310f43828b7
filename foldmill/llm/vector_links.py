"""Near-duplicate embeddings by a subspace pigeonhole join (operator 12)."""

from __future__ import annotations

from itertools import product
from math import ceil, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foldmill.llm.components import component_labels
from foldmill.llm.store import settle
from foldmill.operators.keys import measured

COSINE = 0.95
DIMS = 16             # of a subspace
BLOCK_VALUES = 1 << 21   # components of the vectors of a cell that are compared with as many in one task
STRIP = 512           # of them at a time
PAIRS = 65_536        # pairs that are verified at a time
# A budget is raised by so much, which covers the rounding of coordinates.
SLACK = 1e-9
# The same for squared distances in single precision, which only pick the pairs to verify.
COARSE = 1e-5
SEED = 12

KEYED = "space int, cell long, home boolean, id long, size long, vector {}"
FOUND = "one long, other long, links long"


def _rows(vectors: pa.Array, width: int) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = \
        vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The rows times a power of two each, which rounds nothing, so that squares stay in range."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -power)


def rotated(vectors: np.ndarray, width: int) -> np.ndarray:
    """The vectors at length 1 under a fixed rotation: twice random signs and a Hadamard transform.

    Only sums and products element by element are used, in one order, so a vector has the same
    coordinates in every task. ``width`` is a power of two.
    """
    rng = np.random.default_rng(SEED)
    out = np.zeros((len(vectors), width))
    out[:, :vectors.shape[1]] = _scaled(vectors)
    out /= np.sqrt((out * out).sum(axis=1, keepdims=True))
    for _ in range(2):
        out *= rng.choice([-1.0, 1.0], width)
        half = 1
        while half < width:
            pairs = out.reshape(len(out), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
            out = out.reshape(len(vectors), width)
            half *= 2
        out /= sqrt(width)
    return out


class Grid:
    """The subspaces of a rotated space, and cells over the leading axes of each.

    Two unit vectors of cosine c are sqrt(2 - 2 c) apart. The squared distance is the sum of those
    in the subspaces, so in one of them it is within the subspace's share of the whole budget.
    Cells are two budgets wide. A vector is at home in its cell and visits those cells behind it
    (in the order of their offsets) that a vector within the budget can be at home in. So two vectors within it meet in
    one cell of the subspace, and only there is one of them at home.
    """

    def __init__(self, width: int, cosine: float, dims: int, blocks: float):
        self.width = max(dims, 1 << max(0, width - 1).bit_length())
        self.spaces, self.dims = self.width // dims, dims
        self.budget = (2 - 2 * cosine) / self.spaces * (1 + SLACK) + SLACK
        self.reach = sqrt(self.budget)
        self.side = 2 * self.reach
        # The largest cells halve with each axis: most coordinates are in the middle two.
        self.axes = min(dims, max(1, ceil(log2(max(1, blocks)))))
        self.radix = 2 * ceil(1 / self.side) + 5
        self.offsets = [o for o in product((-1, 0, 1), repeat=self.axes) if o > (0,) * self.axes]

    def places(self, points: np.ndarray):
        """Per subspace: its number, rows, cells and whether the rows are at home there."""
        powers = self.radix ** np.arange(self.axes)
        for space in range(self.spaces):
            lead = points[:, space * self.dims:space * self.dims + self.axes] / self.side
            corner = np.floor(lead)
            inner = (lead - corner) * self.side
            code = ((corner.astype(np.int64) + self.radix // 2) * powers).sum(axis=1)
            yield space, np.arange(len(points)), code, True
            for offset in self.offsets:
                apart = np.where(np.array(offset) > 0, self.side - inner,
                                 np.where(np.array(offset) < 0, inner, 0.0))
                near = np.flatnonzero((apart * apart).sum(axis=1) <= self.budget + SLACK)
                yield space, near, code[near] + int((np.array(offset) * powers).sum()), False

    def first_space(self, difference: np.ndarray) -> np.ndarray:
        """The first subspace in which pairs are within the budget."""
        squares = (difference * difference).reshape(len(difference), self.spaces, self.dims)
        total = squares[:, :, 0]
        for axis in range(1, self.dims):
            total = total + squares[:, :, axis]
        return np.argmax(total <= self.budget, axis=1)


def _forest(one: np.ndarray, other: np.ndarray, nodes: int) -> np.ndarray:
    """For each node the least node that the links lead to from it."""
    label = np.arange(nodes)
    while True:
        least = label.copy()
        np.minimum.at(least, one, label[other])
        np.minimum.at(least, other, label[one])
        least = least[least]
        if np.array_equal(least, label):
            return label
        label = least


def _compared(grid: Grid, cosine: float, width: int):
    def compare(group: pa.Table) -> pa.Table:
        """Verified links of one part of a cell: number of vectors per vector, and a forest."""
        group = group.combine_chunks()
        space = group.column("space")[0].as_py()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        vectors = _scaled(_rows(group.column("vector"), width))
        points = rotated(vectors, grid.width)
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        home = group.column("home").to_numpy(zero_copy_only=False)
        size, ids = group.column("size").to_numpy(), group.column("id").to_numpy()
        own = group.column("own").to_numpy()
        # Products of these are squared distances in the subspace.
        sub = points[:, space * grid.dims:(space + 1) * grid.dims].astype(np.float32)
        square, one = (sub * sub).sum(axis=1, keepdims=True), np.ones((len(sub), 1), np.float32)
        first, second = np.hstack([-2 * sub, square, one]), np.hstack([sub, one, square])
        links = np.zeros(len(ids), np.int64)
        label = np.arange(len(ids))

        def near(left: np.ndarray, right: np.ndarray, twice: bool):
            """Pairs that may be within the budget, a strip of ``left`` at a time."""
            for at in range(0, len(left), STRIP):
                rows = left[at:at + STRIP]
                found = np.flatnonzero(first[rows] @ second[right].T <= grid.budget + COARSE)
                i, j = rows[found // max(1, len(right))], right[found % max(1, len(right))]
                yield (i[i < j], j[i < j]) if twice else (i, j)

        def verified(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            # A pair that meets in several subspaces counts in the first.
            here = grid.first_space(points[i] - points[j]) == space
            i, j = i[here], j[here]
            good = (vectors[i] * vectors[j]).sum(axis=1) / (norms[i] * norms[j]) >= cosine
            return i[good], j[good]

        at_low, at_high = own == low, own == high
        halves = [(np.flatnonzero(at_low & home), np.flatnonzero(at_high & home), low == high),
                  (np.flatnonzero(at_low & home), np.flatnonzero(at_high & ~home), False)]
        if low < high:
            halves.append((np.flatnonzero(at_low & ~home), np.flatnonzero(at_high & home), False))
        for left, right, twice in halves:
            for i, j in near(left, right, twice):
                pairs = [verified(i[n:n + PAIRS], j[n:n + PAIRS]) for n in range(0, len(i), PAIRS)]
                if pairs:
                    i, j = (np.concatenate(p) for p in zip(*pairs))
                    np.add.at(links, i, size[j])
                    np.add.at(links, j, size[i])
                    label = _forest(np.concatenate([i, np.arange(len(ids))]), np.concatenate([j, label]), len(ids))
        linked = np.flatnonzero(links)
        return pa.table({"one": ids[linked], "other": ids[label[linked]], "links": links[linked]})
    return compare


def _cells(classes: DataFrame, grid: Grid, width: int) -> DataFrame:
    def place(batches):
        for batch in batches:
            points = rotated(_rows(batch.column("vector"), width), grid.width)
            for space, rows, code, home in grid.places(points):
                if len(rows):
                    own = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), space, np.int32)), pa.array(code),
                         pa.array(np.full(len(rows), home)), own.column("id"), own.column("size"), own.column("vector")],
                        ["space", "cell", "home", "id", "size", "vector"])

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("id", "size", "vector").mapInArrow(place, KEYED.format(kind))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, dims: int = DIMS,
                 block: int | None = None) -> DataFrame:
    """Links and components of vectors whose cosine is ``cosine`` or more.

    Equal vectors are compared once, as one class. Classes are rotated and split into subspaces of
    ``dims`` axes; each subspace is joined by range under its share of the squared distance that
    the cosine allows (``Grid``), and every pair within it is verified in double precision over
    all components. A pair is counted in the first subspace in which it is within the share, so
    nothing is counted twice and pairs never leave their task: a task returns numbers of links and
    a spanning forest. Cells of more than ``block`` rows (of ``BLOCK_VALUES`` components in all, unless
    given) are split, and each two parts meet in a task of their own. The number of axes of a grid
    grows with the number of classes.

    ``vectors`` has ``vec_id`` and ``embedding``, an array of floats or doubles. Returns one row per
    vec_id: vec_id, n_links (other vec_ids linked directly), component_id (least vec_id that links
    reach) and kept (whether that is its own). A null, zero or empty vector, and one with a null or
    non-finite component, links with nothing. Rows with a null vec_id are left out. Repeated rows
    count once; of several different vectors under one vec_id, that which sorts first counts.
    Shorter vectors count as padded with zeros. An empty table gives no rows. Other columns are ignored.
    """
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    value = F.col("embedding").cast(f"array<{kind}>")
    fit = F.coalesce(F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                     & F.exists(value, lambda x: x != 0), F.lit(False))
    members = settle(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fit, value).alias("vector"))
                     .filter("vec_id is not null").groupBy("vec_id").agg(F.min("vector").alias("vector")))
    classes = settle(members.filter("vector is not null").groupBy("vector").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("size")))
    found = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = found[1] or 1
    block = block or max(64, BLOCK_VALUES // width)
    grid = Grid(width, cosine, dims, found[0] / block)

    keyed = _cells(classes, grid, width)
    large = measured(keyed.groupBy("space", "cell").agg(F.count("*").alias("rows")).filter(F.col("rows") > block))
    parts = F.coalesce(F.ceil(F.col("rows") / block), F.lit(1)).cast("int")
    dealt = (keyed.join(large, ["space", "cell"], "left").withColumn("parts", parts)
             .withColumn("own", F.pmod(F.xxhash64("id", "space"), F.col("parts")).cast("int"))
             .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("low", F.least("own", "met")).withColumn("high", F.greatest("own", "met"))
             .select("space", "cell", "low", "high", "own", "home", "id", "size", "vector"))
    pairs = settle(dealt.groupBy("space", "cell", "low", "high").applyInArrow(
        _compared(grid, cosine, width), FOUND))
    links = pairs.groupBy(F.col("one").alias("id")).agg(F.sum("links").alias("links"))
    labels = component_labels(pairs.select("one", "other"), "one", "other").withColumnRenamed("node", "id")
    of_class = (classes.join(links, "id", "left").join(labels, "id", "left")
                .select("vector", F.coalesce("component", "id").alias("component"),
                        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")))
    own = F.coalesce("component", "vec_id")
    return members.join(of_class, "vector", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"), (own == F.col("vec_id")).alias("kept"))
