"""Folding every sequence and its shuffles.

The unit of work is a block of iterations of one sequence. Iteration 0 is the
sequence itself, iterations 1..N are its shuffles. Blocks are made before the
shuffle that spreads them, and a block's size falls with the sequence's cost, so
no task has all shuffles of a long sequence.
"""

from __future__ import annotations

import subprocess
import time
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, Window, functions as F

from foldmill.fixed_values import MIN_VALID_PERCENT
from foldmill.operators import robust
from foldmill.operators.ranking import with_index
from foldmill.operators.scorers import fold_alone, walk_seed
from foldmill.operators.walks import shuffle_all

# Table cells one block may fill; keeps a block's memory near 100 MB.
BLOCK_CELLS = 16_000_000
MAX_BLOCK = 256
# Letters of shuffles that are walked side by side.
WALK_LETTERS = 6_000_000
# Letters of one frame of shuffles.
PORTION_LETTERS = 4_000_000
# Cells one task should fill, some ten seconds of work.
TASK_CELLS = 200_000_000


def sequence_cells(length: Column, max_span: int | None) -> Column:
    """Table cells one fold of a sequence fills."""
    length = length.cast("double")
    return length * (F.least(length, F.lit(float(max_span))) if max_span else length)


def work_blocks(sequences: DataFrame, max_span: int | None = None,
                block_cells: int = BLOCK_CELLS) -> DataFrame:
    """``seqname, seq, n_shuffles, cells, first, count``: blocks of iterations."""
    cells = F.greatest(sequence_cells(F.length("seq"), max_span), F.lit(1.0))
    fit = F.floor(F.lit(float(block_cells)) / cells)
    block = F.least(F.greatest(fit, F.lit(1)), F.lit(MAX_BLOCK)).cast("int")
    return (sequences.select("seqname", "seq", F.col("n_shuffles").cast("int"))
            .withColumn("_block", block).withColumn("cells", cells)
            .withColumn("first", F.explode(F.sequence(F.lit(0), F.col("n_shuffles"), F.col("_block"))))
            .withColumn("count", F.least(F.col("_block"), F.col("n_shuffles") + 1 - F.col("first")))
            .drop("_block"))


def task_count(sequences: DataFrame, max_span: int | None = None) -> int:
    """Number of tasks for the total work, ``TASK_CELLS`` each, and at least four per core."""
    length = F.col("length") if "length" in sequences.columns else F.length("seq")
    work = sequences.agg(F.sum(sequence_cells(length, max_span)
                               * (F.col("n_shuffles") + 1)).alias("cells")).first().cells or 0
    cores = sequences.sparkSession.sparkContext.defaultParallelism
    return max(4 * cores, int(work / TASK_CELLS) + 1)


def spread(blocks: DataFrame, tasks: int) -> DataFrame:
    """Blocks dealt out evenly to tasks, whatever their sequence; in a task those of a size follow one another."""
    return blocks.repartition(tasks).sortWithinPartitions("cells")


def _portions(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows in lists of limited text, so a frame is neither tiny nor huge."""
    portion, letters = [], 0
    for row in rows:
        portion.append(row)
        letters += len(row[-1])
        if letters > PORTION_LETTERS:
            yield portion
            portion, letters = [], 0
    if portion:
        yield portion


def _shuffles(rows: Iterator, seed: int) -> Iterator[tuple]:
    """``seqname, n_shuffles, iteration, seq`` of the shuffles of work blocks.

    Blocks are taken together until they have some ``WALK_LETTERS`` letters, and walked side by side.
    """
    held, letters = [], 0

    def drawn() -> Iterator[tuple]:
        own = [(n, i) for n, row in enumerate(held) for i in range(max(row.first, 1), row.first + row.count)]
        seqs = shuffle_all([row.seq for row in held], [n for n, _ in own],
                           [walk_seed(seed, held[n].seqname, i) for n, i in own])
        for (n, i), seq in zip(own, seqs):
            yield held[n].seqname, held[n].n_shuffles, i, seq

    for row in rows:
        held.append(row)
        letters += len(row.seq) * row.count
        if letters > WALK_LETTERS:
            yield from drawn()
            held, letters = [], 0
    if held:
        yield from drawn()


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator:
    for batch in batches:
        yield from batch.itertuples(index=False)


def shuffled(sequences: DataFrame, seed: int = 0, tasks: int | None = None,
             reduce_to: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
             schema: str = "seqname string, iteration int, seq string") -> DataFrame:
    """``seqname, iteration, seq``: the shuffles themselves, iterations 1..N.

    ``reduce_to`` makes rows of ``schema`` from a frame of them in the task that draws them, where only
    something about the shuffles is wanted.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drawn = ((name, i, seq) for name, _, i, seq in _shuffles(_rows(batches), seed))
        for rows in _portions(drawn):
            frame = pd.DataFrame(rows, columns=["seqname", "iteration", "seq"])
            yield reduce_to(frame) if reduce_to else frame

    blocks = spread(work_blocks(sequences, max_span=1), tasks or task_count(sequences, 1))
    return blocks.mapInPandas(run, schema)


def _similar(folds: Iterator[tuple], max_span: int | None) -> Iterator[list[tuple]]:
    """Folds in groups of similar length whose tables fit in one block."""
    group, shortest, used = [], 0, 0
    for row in folds:
        size = len(row[-1])
        cells = size * min(size, max_span or size)
        if group and (used + cells > BLOCK_CELLS or not shortest <= size <= 1.2 * shortest + 16):
            yield group
            group, used = [], 0
        if not group:
            shortest = size
        group.append(row)
        used += cells
    if group:
        yield group


def _energies(scorer, seqs: list[str]) -> tuple[list, list]:
    """Energies and error texts; after a failure each sequence is tried alone.

    Only what a sequence brings about becomes a row. A program that cannot be run fails the task.
    """
    try:
        return scorer.fold(seqs), [None] * len(seqs)
    except (FileNotFoundError, PermissionError):
        raise
    except (MemoryError, OSError, ValueError, RuntimeError, subprocess.SubprocessError) as problem:
        if len(seqs) == 1:
            return [None], [f"{type(problem).__name__}: {problem}"]
    values, problems = zip(*[_energies(scorer, [seq]) for seq in seqs])
    return [v[0] for v in values], [p[0] for p in problems]


def fold_all(sequences: DataFrame, scorer, seed: int = 0, tasks: int | None = None,
             profile: ResourceProfile | None = None) -> DataFrame:
    """``seqname, n_shuffles, iteration, mfe``: energies of sequences and shuffles.

    ``sequences`` has ``seqname, seq, n_shuffles``. A fold that gives no energy has
    a null ``mfe``; one failing fold does not end the job. ``profile`` says what its tasks need.
    """
    max_span = getattr(scorer, "max_span", None)

    def folds(batch: pd.DataFrame) -> Iterator[tuple]:
        for row in batch[batch["first"] == 0].itertuples(index=False):
            yield row.seqname, row.n_shuffles, 0, row.seq
        yield from _shuffles(batch.itertuples(index=False), seed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group in _similar(folds(batch.sort_values("cells")), max_span):
                values, problems = _energies(scorer, [seq for *_, seq in group])
                frame = pd.DataFrame([row[:3] for row in group],
                                     columns=["seqname", "n_shuffles", "iteration"])
                yield frame.assign(mfe=pd.array(values, "Float64"),
                                   problem=pd.array(problems, "string"))

    blocks = spread(work_blocks(sequences, max_span), tasks or task_count(sequences, max_span))
    return blocks.mapInPandas(
        run, "seqname string, n_shuffles int, iteration int, mfe double, problem string", profile=profile)


def fold_by_tier(sequences: DataFrame, scorer, profiles: Mapping[int, ResourceProfile], seed: int = 0,
                 tasks: int | None = None) -> DataFrame:
    """The same for ``sequences`` with ``tier``: the tiers of a profile are folded under it, all
    others together under the session's own resources. There are at most ten tiers."""
    if not profiles:
        return fold_all(sequences, scorer, seed, tasks)
    rest = fold_all(sequences.filter(~F.col("tier").isin(list(profiles))), scorer, seed, tasks)
    return reduce(DataFrame.unionByName, (
        fold_all(sequences.filter(F.col("tier") == tier), scorer, seed, tasks, profile)
        for tier, profile in profiles.items()), rest)


def score_folds(folds: DataFrame, min_valid_percent: int = MIN_VALID_PERCENT,
                bounded: bool = True) -> DataFrame:
    """Result columns and ``error``, one row per folded sequence.

    A sequence has ``n_shuffles + 1`` folds, a number the tier policy sets and the
    data cannot raise, so one shuffle by sequence gathers all of them. ``bounded=False`` is for groups
    whose size no policy limits: their energies are counted and summarised like any background.
    More valid shuffles than were asked for, as two sequences of one name give,
    are an error and get no score.
    """
    own = F.col("iteration") == 0
    value = F.col("mfe")
    facts = [F.max("n_shuffles").alias("n_shuffles"), F.max(F.when(own, value)).alias("orig_mfe"),
             F.max("problem").alias("problem")]
    if bounded:
        summary = robust.summarise_arrays(folds.groupBy("seqname").agg(
            *facts, F.sort_array(F.collect_list(F.when(~own, value))).alias("_values")))
    else:
        summary = robust.summarise(folds.groupBy("seqname").agg(*facts), folds.filter(~own), ["seqname"])
    scored = robust.with_error(robust.score(summary), min_valid_percent)
    surplus = F.col("n_valid") > F.col("n_shuffles_requested")
    scored = (scored.withColumn("error", F.when(surplus, F.lit("more shuffles than requested"))
                                .otherwise(F.col("error")))
              .withColumn("pvalue", F.when(~surplus, F.col("pvalue")))
              .withColumn("zscore", F.when(~surplus, F.col("zscore")))
              .withColumn("n_missing", F.greatest(F.col("n_missing"), F.lit(0))))
    return scored.select(
        F.col("seqname").alias("seq_name"), "orig_mfe", "median_mfe", "pvalue", "zscore",
        "n_valid", "n_missing", "n_shuffles_requested",
        F.when(F.col("error").isNotNull(), F.concat_ws("; ", "error", "problem")).alias("error"))


def results(scored: DataFrame) -> DataFrame:
    """Scores of the sequences that have one."""
    return scored.filter(F.col("error").isNull()).drop("error")


def errors(scored: DataFrame) -> DataFrame:
    """``seqname, error`` of the sequences that have no score."""
    return scored.filter(F.col("error").isNotNull()).select(
        F.col("seq_name").alias("seqname"), "error")


def raw_shuffles(folds: DataFrame, bounded: bool = True) -> DataFrame:
    """Valid shuffle energies, numbered 1..n without gaps within each sequence.

    ``bounded=False`` is for groups whose size the tier policy does not limit.
    """
    valid = folds.filter((F.col("iteration") > 0) & F.col("mfe").isNotNull())
    if bounded:
        place = F.row_number().over(Window.partitionBy("seqname").orderBy("iteration"))
        numbered = valid.withColumn("_place", place)
    else:
        numbered = with_index(valid, ["seqname"], ["iteration"], "_place").withColumn(
            "_place", F.col("_place") + 1)
    return numbered.select(F.col("seqname").alias("transcript_id"),
                           F.col("_place").cast("int").alias("iteration"),
                           F.col("mfe").alias("shuffled_mfe"))


def time_samples(samples: DataFrame, scorer, seed: int = 0) -> DataFrame:
    """Runs each sample, the sequence and all its shuffles, in a process of its own and measures it.

    ``samples`` has ``tier, seqname, length, n_shuffles, seq``; the result has
    ``wall`` in seconds and ``rss_kb``, the peak memory of that process alone, both null where the run failed.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                began = time.perf_counter()
                wall = rss = None
                try:
                    wanted = range(1, row.n_shuffles + 1)
                    drawn = shuffle_all([row.seq], [0] * len(wanted),
                                        [walk_seed(seed, row.seqname, i) for i in wanted])
                    energies, memory = fold_alone(scorer, [row.seq, *drawn])
                    if energies[0] is not None:
                        wall, rss = time.perf_counter() - began, memory
                except (FileNotFoundError, PermissionError):
                    raise
                except (MemoryError, OSError, ValueError, RuntimeError, subprocess.SubprocessError):
                    pass
                yield pd.DataFrame({
                    "tier": [row.tier], "seqname": [row.seqname], "length": [row.length],
                    "n_shuffles": [row.n_shuffles], "wall": pd.array([wall], "Float64"),
                    "rss_kb": pd.array([rss], "Int64")})

    return (samples.repartition(samples.sparkSession.sparkContext.defaultParallelism, "seqname")
            .select("tier", "seqname", "length", "n_shuffles", "seq")
            .mapInPandas(run, "tier int, seqname string, length int, n_shuffles int, "
                              "wall double, rss_kb bigint"))
