"""Document quality by a linear-chain conditional random field over lines (operator 5)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foldmill.llm.arrays import Rolling, byte_symbols, slices, texts, words

SAMPLE_PER_LABEL = 1_500   # labelled documents to learn from, of each label, at most
FOLDS, HELD_OUT = 5, 0     # crc32(doc_id) mod FOLDS == HELD_OUT is never learned from
SAMPLE_LINES = 5_000       # a document of more lines is scored, but not learned from
THRESHOLD = 0.3
STEPS = 150
LINES = "label double, features array<double>, weights array<double>"
OUT = "doc_id long, score double, predicted int, n_lines long, n_bad_lines long"

_BYTES = np.arange(256)
_UPPER = ((_BYTES >= 65) & (_BYTES <= 90)).astype(np.int64)
_LETTER = (((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) | (_BYTES >= 128)).astype(np.int64)
_DIGIT = ((_BYTES >= 48) & (_BYTES <= 57)).astype(np.int64)
_STOP = np.isin(_BYTES, list(b".,;:?'\"-()")).astype(np.int64)
_SIGN = ((_LETTER + _DIGIT + _STOP == 0) & (_BYTES > 32)).astype(np.int64)
OWN = 13                   # features of a line by itself


def line_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line, weights (bytes) of the lines, and line offsets per row.

    A line has its own features and those of the lines before and after it; at an end of a
    text these are zero, and an indicator is set. An empty text is one empty line.
    """
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.sort(np.concatenate([bounds[:-1], breaks]))
    # A break that ends a text opens one more empty line of that text, before the next text.
    rows = np.searchsorted(breaks, bounds, "right") + np.arange(len(bounds))
    ends = np.append(starts[1:], len(data))
    last = rows[1:] - 1
    broken = np.ones(len(starts), bool)
    broken[last] = False
    size = (ends - starts - broken).astype(float)
    # Borders of words at the borders of lines.
    w_start, w_end, w_rows = words(data, np.append(starts, len(data)))
    n_words = np.diff(w_rows).astype(float)

    def total(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[at]).astype(float)

    byte_at = np.append(starts, len(data))
    length = np.maximum(size, 1)
    count = np.maximum(n_words, 1)
    letters = np.maximum(total(_LETTER[data], byte_at), 1)
    upper = total(_UPPER[data], byte_at) / letters
    signs = total(_SIGN[data], byte_at) / count
    w_size = w_end - w_start
    lettered = np.concatenate([[0], np.cumsum(_LETTER[data])])
    bare = (lettered[w_end] == lettered[w_start]).astype(np.int64)
    hashed = Rolling(byte_symbols(0)[data], 0).spans(w_start, w_end)
    same = np.zeros(len(hashed), np.int64)
    same[1:] = hashed[1:] == hashed[:-1]
    same[w_rows[:-1][n_words > 0]] = 0
    repeats = total(same, w_rows) / count
    only_signs = total(bare, w_rows) / count
    short = total((w_size <= 3).astype(np.int64), w_rows) / count
    own = np.column_stack([
        np.log1p(size), np.log1p(n_words), upper, np.minimum(signs, 4), total(_STOP[data], byte_at) / count,
        total(_DIGIT[data], byte_at) / length, repeats, only_signs, short,
        np.minimum(total(w_size, w_rows) / count, 30),
        upper > 0.5, signs > 0.5, repeats > 0.3])
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    is_first = np.zeros(len(own))
    is_first[rows[:-1]] = 1
    is_last = np.zeros(len(own))
    is_last[last] = 1
    before[is_first > 0] = 0
    after[is_last > 0] = 0
    return np.column_stack([own, before, after, is_first, is_last]), size + 1, rows


class Chain:
    """Two labels, 0 bad and 1 good; scores of a good line are linear in its features."""

    def __init__(self, width: int):
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.weights = np.zeros(width + 1)
        self.steps = np.zeros((2, 2))       # from label to label
        self.slope, self.shift = 6.0, -3.0  # from mean marginal to score

    def scores(self, features: np.ndarray) -> np.ndarray:
        scaled = np.clip((features - self.mean) / self.scale, -5, 5)
        return scaled @ self.weights[:-1] + self.weights[-1]

    def marginals(self, scores: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over all texts at once: P(good) per line, and expected label steps."""
        sizes = np.diff(rows)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = rows[:-1][order], sizes[order]
        emit = np.column_stack([np.zeros(len(scores)), np.clip(scores, -30, 30)])
        emit = np.exp(emit - emit.max(axis=1, keepdims=True))
        step = np.exp(self.steps - self.steps.max())
        forward = np.empty_like(emit)
        backward = np.ones_like(emit)
        depth = int(sizes[0]) if len(sizes) else 0
        live = np.searchsorted(-sizes, -np.arange(depth), "left")   # texts longer than t
        for t in range(depth):
            at = starts[:live[t]] + t
            now = emit[at] if t == 0 else (forward[at - 1] @ step) * emit[at]
            forward[at] = now / now.sum(axis=1, keepdims=True)
        pairs = np.zeros((2, 2))
        for t in range(depth - 2, -1, -1):
            at = starts[:live[t + 1]] + t
            ahead = emit[at + 1] * backward[at + 1]
            joint = forward[at][:, :, None] * step * ahead[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            now = ahead @ step.T
            backward[at] = now / now.sum(axis=1, keepdims=True)
        both = forward * backward
        return both[:, 1] / both.sum(axis=1), pairs

    def fit(self, features: np.ndarray, weights: np.ndarray, rows: np.ndarray, labels: np.ndarray,
            steps: int = STEPS) -> Chain:
        """Maximum likelihood by Adam; a document's label stands for each of its lines at first.

        A bad document also has good lines, so in a second pass a line of a bad document counts as
        bad only as far as the first model, or nothing else in the text, says so.
        """
        self.mean, self.scale = features.mean(axis=0), features.std(axis=0) + 1e-3
        scaled = np.clip((features - self.mean) / self.scale, -5, 5)
        scaled = np.column_stack([scaled, np.ones(len(scaled))])
        sizes = np.diff(rows)
        target = np.repeat(labels, sizes).astype(float)
        inner = np.ones(len(target), bool)
        inner[rows[1:] - 1] = False
        text = np.repeat(np.arange(len(sizes)), sizes)
        for attempt in range(2):
            following = np.append(target[1:], 0)
            observed = np.array([[((1 - target) * (1 - following))[inner].sum(), ((1 - target) * following)[inner].sum()],
                                 [(target * (1 - following))[inner].sum(), (target * following)[inner].sum()]])
            state = np.concatenate([self.weights, self.steps.ravel()])
            first, second = np.zeros_like(state), np.zeros_like(state)
            for i in range(1, steps + 1):
                self.weights, self.steps = state[:-4], state[-4:].reshape(2, 2)
                good, pairs = self.marginals(scaled @ self.weights, rows)
                slope = np.concatenate([scaled.T @ (target - good), (observed - pairs).ravel()]) / len(target)
                slope -= 1e-4 * state
                first = 0.9 * first + 0.1 * slope
                second = 0.99 * second + 0.01 * slope ** 2
                state = state + 0.1 * (first / (1 - 0.9 ** i)) / (np.sqrt(second / (1 - 0.99 ** i)) + 1e-8)
            self.weights, self.steps = state[:-4], state[-4:].reshape(2, 2)
            if attempt == 0:
                alone = 1 / (1 + np.exp(-np.clip(scaled @ self.weights, -30, 30)))
                worst = np.ones(len(sizes))
                np.minimum.at(worst, text, alone)
                doubtful = (target < 1) & (alone > 0.5) & (worst[text] < 0.5)
                target = np.where(doubtful, 1.0, target)
        self._calibrate(self.document_means(features, weights, rows), labels)
        return self

    def _calibrate(self, means: np.ndarray, labels: np.ndarray) -> None:
        """Logistic curve from mean marginal to score, increasing; both labels weigh the same."""
        weight = np.where(labels > 0, 0.5 / max(1, (labels > 0).sum()), 0.5 / max(1, (labels < 1).sum()))
        for _ in range(3_000):
            fitted = 1 / (1 + np.exp(-(self.slope * means + self.shift)))
            miss = weight * (labels - fitted)
            self.slope = max(1.0, self.slope + 20 * float((miss * means).sum()) - 0.001 * self.slope)
            self.shift += 20 * float(miss.sum())

    def document_means(self, features: np.ndarray, weights: np.ndarray, rows: np.ndarray,
                       good: np.ndarray | None = None) -> np.ndarray:
        if good is None:
            good, _ = self.marginals(self.scores(features), rows)
        return np.add.reduceat(good * weights, rows[:-1]) / np.add.reduceat(weights, rows[:-1])

    def document_scores(self, means: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * means + self.shift, -30, 30)))


def held_out(doc_id) -> F.Column:
    """Whether a row is kept from learning. A null id is not learned from, nor held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Chain | float:
    """Fits the chain to at most ``per_label`` documents of each label, chosen by a hash of the id,
    and of those to the ones of at most ``SAMPLE_LINES`` lines.

    Lines are measured in Spark; only their features come to the driver, for the sample alone.
    If only one label or none is there to learn from, the result is that label (or 0.5).
    """
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
             .filter("doc_id is not null and quality in (0, 1)")
             .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality")))
    order = F.xxhash64("doc_id")
    chosen = [marks.filter(F.col("quality") == label).orderBy(order, "doc_id").limit(per_label)
              for label in (0, 1)]
    sample = chosen[0].union(chosen[1])

    def measure(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                features, weights, rows = line_features(*texts(part.column("text")))
                usable = np.diff(rows) <= SAMPLE_LINES
                yield pa.RecordBatch.from_arrays(
                    [part.column("quality").cast(pa.float64()),
                     pa.array([features[a:b].ravel() for a, b in zip(rows[:-1], rows[1:])],
                              pa.list_(pa.float64())),
                     pa.array([weights[a:b] for a, b in zip(rows[:-1], rows[1:])], pa.list_(pa.float64()))],
                    ["label", "features", "weights"]).filter(pa.array(usable))

    # The sample is bounded, so it is broadcast to the texts.
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
             .select("quality", "text").mapInArrow(measure, LINES).toArrow())
    known = found.column("label").to_numpy()
    if len(np.unique(known)) < 2:
        return float(known[0]) if len(known) else 0.5
    weights = found.column("weights").combine_chunks()
    rows = np.concatenate([[0], np.cumsum(weights.value_lengths().to_numpy())])
    weights = weights.flatten().to_numpy()
    features = found.column("features").combine_chunks().flatten().to_numpy().reshape(len(weights), -1)
    return Chain(features.shape[1]).fit(features, weights, rows, known)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                   per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """Quality of every text between 0 and 1.

    A conditional random field labels lines from the features of the line and its neighbours; the
    forward-backward marginals of good, weighted by the lines' lengths, are averaged and mapped
    to a score by an increasing curve. The text is all a score depends on.

    Returns per row of ``docs``: doc_id, held_out, score, predicted (1 from ``threshold`` on),
    n_lines and n_bad_lines.

    Null and empty texts are one empty line. Null ids and repeated rows get a row each. Labels that
    are null, neither 0 nor 1, or without an id are left out; of several labels of one id the
    lowest counts. With one label only to learn from, every score is that label; with none, 0.5.
    Other columns are ignored.
    """
    model = learn(docs, labels, per_label)

    def score(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                found = _scored(part, model, threshold)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *found.columns],
                                                 ["doc_id", *found.schema.names])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(score, OUT).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_lines",
        "n_bad_lines")


def _scored(part: pa.RecordBatch, model: Chain | float, threshold: float) -> pa.RecordBatch:
    features, weights, rows = line_features(*texts(part.column("text")))
    if isinstance(model, float):
        scores, bad = np.full(part.num_rows, model), np.zeros(len(features))
    else:
        good, _ = model.marginals(model.scores(features), rows)
        scores = model.document_scores(model.document_means(features, weights, rows, good))
        bad = (good < 0.5).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(scores), pa.array((scores >= threshold).astype(np.int32)),
         pa.array(np.diff(rows)), pa.array(np.add.reduceat(bad, rows[:-1]).astype(np.int64))],
        ["score", "predicted", "n_lines", "n_bad_lines"])


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
              per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns as they are."""
    model = learn(docs, labels, per_label)

    def choose(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                good = _scored(part, model, threshold).column("predicted").to_numpy() == 1
                yield part.filter(pa.array(good))

    return docs.mapInArrow(choose, docs.schema)
