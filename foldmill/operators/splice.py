"""Spliced transcripts from annotation features and a genome kept in pieces.

A chromosome is never one row. ``pieces`` has ``seqid, bin, piece_start, seq``:
every piece lies in one bin of ``BIN_SIZE`` positions and starts at the 1-based
``piece_start``. A transcript meets the pieces it covers in an equi-join on
``(seqid, bin)``, with one row for all its exons in a bin.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from foldmill.functions.attributes import attribute
from foldmill.functions.sequences import reverse_complement
from foldmill.operators.keys import measured_if_small
from foldmill.operators.transcripts import feature_lines, with_ids
from foldmill.session import settle

BIN_SIZE = 32_768
SPANS = "array<struct<start:bigint,end:bigint>>"
LINES = "array<struct<coding:boolean,start:bigint,end:bigint,skip:int>>"


def bin_of(position: Column, bin_size: int = BIN_SIZE) -> Column:
    """Bin of a 1-based position."""
    return F.floor((position - 1) / bin_size)


def cut_into_bins(segments: DataFrame, bin_size: int = BIN_SIZE,
                  keep: Sequence[str] = ("seqid",)) -> DataFrame:
    """Cuts ``seq``, which starts at the 1-based ``seq_start``, at the bin borders."""
    last = F.col("seq_start") + F.length("seq") - 1
    first_in_bin = F.greatest(F.col("bin") * bin_size + 1, F.col("seq_start"))
    last_in_bin = F.least((F.col("bin") + 1) * bin_size, last)
    return (_cut_long(segments.filter(F.length("seq") > 0), bin_size)
            .withColumn("bin", F.explode(F.sequence(bin_of(F.col("seq_start"), bin_size),
                                                    bin_of(last, bin_size))))
            .select(*keep, "bin", first_in_bin.alias("piece_start"),
                    F.substring("seq", (first_in_bin - F.col("seq_start") + 1).cast("int"),
                                (last_in_bin - first_in_bin + 1).cast("int")).alias("seq")))


def _cut_long(segments: DataFrame, bin_size: int) -> DataFrame:
    """Cuts very long segments in one pass; ``substring`` would walk them once per bin."""
    cut = F.when(F.length("seq") > 4 * bin_size,
                 F.regexp_extract_all("seq", F.lit("(?s).{1,%d}" % bin_size), F.lit(0))
                 ).otherwise(F.array("seq"))
    others = [c for c in segments.columns if c not in ("seq", "seq_start")]
    return (segments.select(*others, "seq_start", F.posexplode(cut).alias("_n", "seq"))
            .withColumn("seq_start", F.col("seq_start") + F.col("_n") * bin_size).drop("_n"))


def features(lines: DataFrame, anchored: bool = False) -> DataFrame:
    """Exon and coding lines as ``tx_id, orig_id, type, seqid, start, end, strand, phase``.

    The phase is 0, 1 or 2, and null where the line has none.
    """
    raw = F.col("raw")
    # One value out of explode, since Spark would read the line anew for each filter on what it holds.
    read = F.struct(attribute(raw, "Parent", anchored).alias("_parent"), F.split(raw, "\t").alias("fields"))

    def field(number: int) -> Column:    # the last one of a shorter line, like ``tab_field``
        return F.element_at("fields", F.least(F.lit(number + 1), F.size("fields")))

    return (with_ids(feature_lines(lines, ["exon", "CDS"]).select(
                F.explode(F.array(read)).alias("line")).select("line.*"), anchored)
            .select("tx_id", "orig_id", field(2).alias("type"), field(0).alias("seqid"),
                    field(3).try_cast("bigint").alias("start"),
                    field(4).try_cast("bigint").alias("end"), field(6).alias("strand"),
                    F.when(field(7).isin("0", "1", "2"), field(7).cast("int")).alias("phase"))
            .filter(F.col("start").isNotNull() & F.col("end").isNotNull()))


def on_transcript(exons: Column, reverse: Column, position: Column, last: bool = False) -> Column:
    """Place on the spliced transcript of a genome position, both counted from 1.

    ``exons`` are sorted and apart, ``reverse`` says that the transcript is read backwards. A position
    between exons has no place of its own: it is lifted to the next exon base upwards on the
    genome, or with ``last`` to the one before, so that a range keeps just the bases it has in exons.
    Beyond the outermost exons the result lies outside 1 .. transcript length.
    """
    reached = position if last else position - 1
    before = _bases(exons, lambda e: F.greatest(
        F.least(e["end"], reached) - e["start"] + 1, F.lit(0).cast("bigint")))
    place = before if last else before + 1
    return F.when(reverse, _bases(exons, _width) - place + 1).otherwise(place)


def on_genome(exons: Column, reverse: Column, place: Column) -> Column:
    """Genome position of a place on the spliced transcript, null outside the transcript."""
    size = _bases(exons, _width)
    forward = F.when(reverse, size - place + 1).otherwise(place)
    state = F.struct(forward.cast("bigint").alias("left"), F.lit(None).cast("bigint").alias("at"))

    def step(done: Column, exon: Column) -> Column:
        inside = done["at"].isNull() & (done["left"] > 0) & (done["left"] <= _width(exon))
        return F.struct((done["left"] - _width(exon)).alias("left"),
                        F.when(inside, exon["start"] + done["left"] - 1).otherwise(done["at"]).alias("at"))

    return F.aggregate(exons, state, step)["at"]


def _width(exon: Column) -> Column:
    return exon["end"] - exon["start"] + 1


def _bases(exons: Column, measure) -> Column:
    return F.aggregate(exons, F.lit(0).cast("bigint"), lambda sum_, e: sum_ + measure(e))


def transcript_models(features_df: DataFrame) -> DataFrame:
    """One row per transcript and locus: exons and the coding range on the transcript.

    Lines belong together if their parent's id as written (``orig_id``, where there is one),
    sequence and strand agree. Exons are sorted, and exons that overlap are one. Exons without a start or an end are none.

    A transcript without exon lines is spliced from its coding lines. The coding range runs from the
    first to the last coding base that lies in an exon, counted along the spliced transcript in
    reading direction. Where there is a ``phase``, that of the coding line read first (the least, if
    several begin there; none is 0) says how many bases belong to a codon that begins before the
    transcript; they are counted along the transcript, so over an exon's end if it is short, and cut
    off. A partial codon at the other end stays. The range is null without coding lines, and if no
    coding base lies in an exon or none is left.
    """
    coding = F.col("type") == "CDS"
    phase = F.coalesce("phase", F.lit(0)) if "phase" in features_df.columns else F.lit(0)
    locus = [c for c in ("tx_id", "orig_id", "seqid", "strand") if c in features_df.columns]
    line = F.struct(coding.alias("coding"), "start", "end", phase.alias("skip"))
    whole = F.col("type").isin("exon", "CDS") & F.col("start").isNotNull() & F.col("end").isNotNull()
    reverse = F.coalesce(F.col("strand") == "-", F.lit(False))
    low = on_transcript(F.col("exons"), F.lit(False), F.col("first"))
    high = on_transcript(F.col("exons"), F.lit(False), F.col("last"), last=True)
    size = F.col("length")
    # In any order and with copies: joining sorts the lines, and a copy overlaps its original.
    ranged = (_with_exons(features_df.groupBy(*locus).agg(F.collect_list(F.when(whole, line)).cast(LINES).alias("lines")))
              .withColumn("length", _bases(F.col("exons"), _width))
              .withColumn("_from", F.when(reverse, size - high + 1 + F.col("last_skip"))
                          .otherwise(low + F.col("first_skip")))
              .withColumn("_to", F.when(reverse, size - low + 1).otherwise(high)))
    found = F.col("_from") <= F.col("_to")
    return ranged.select(*locus, "exons", "length",
                         F.when(found, F.col("_from")).cast("int").alias("cds_start"),
                         F.when(found, F.col("_to")).cast("int").alias("cds_end"))


def _with_exons(df: DataFrame) -> DataFrame:
    """Instead of ``lines``, in any order, ``exons`` and the ends of the coding lines.

    A growing array would be copied at every step, so all lines of a batch of rows are joined side by side.
    """
    def model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *exons_and_ends(batch.column("lines"))], [*kept, *added])

    kept = [c for c in df.columns if c != "lines"]
    added = {"exons": SPANS, "first": "bigint", "first_skip": "int", "last": "bigint", "last_skip": "int"}
    return df.mapInArrow(model, df.select(*kept, *(F.lit(None).cast(t).alias(n) for n, t in added.items())).schema)


def exons_and_ends(lists: pa.ListArray) -> list[pa.Array]:
    """The exons, joined, of every list of lines, its coding lines if there are no others; then the least
    coding ``start`` with its least ``skip``, the largest coding ``end`` with its least.
    """
    row, start, end, _ = _flat(lists)
    lines, size = lists.flatten(), len(lists)
    coding = lines.field("coding").to_numpy(zero_copy_only=False).astype(bool)
    skip = lines.field("skip").to_numpy(zero_copy_only=False)
    own = ~coding | (np.bincount(row[~coding], minlength=size) == 0)[row]
    offsets = np.append(0, np.cumsum(np.bincount(row[own], minlength=size))).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(start[own]), pa.array(end[own])], ["start", "end"])
    columns = [merged_spans(pa.ListArray.from_arrays(pa.array(offsets), spans))]
    row, skip = row[coding], skip[coding]
    for value, order in ((start[coding], 1), (end[coding], -1)):
        by_value = np.lexsort((skip, order * value, row))
        rows, at = np.unique(row[by_value], return_index=True)
        none = np.ones(size, bool)
        none[rows] = False
        for found in (value, skip):
            filled = np.zeros(size, found.dtype)
            filled[rows] = found[by_value][at]
            columns.append(pa.array(filled, mask=none))
    return columns


def merged_spans(lists: pa.ListArray) -> pa.ListArray:
    """The same rows with their spans sorted and those that overlap joined; a null list is empty."""
    row, start, end, kind = _flat(lists)
    if len(end) == 0:
        return pa.array([[]] * len(lists), lists.type)
    step = int(end.max()) - int(end.min()) + 1
    if step * len(lists) >= 1 << 62:    # positions too far apart to lie side by side
        half = len(lists) // 2
        if half:
            return pa.concat_arrays([merged_spans(lists[:half]), merged_spans(lists[half:])])
    order = np.lexsort((start, row))
    start, end = start[order], end[order]
    shift = row * step - int(end.min()) if len(lists) > 1 else 0
    reach = np.maximum.accumulate(end + shift) - shift
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(row) - 1)
    offsets = np.zeros(len(lists) + 1, np.int32)
    offsets[1:] = np.cumsum(np.bincount(row[new], minlength=len(lists)))
    joined = pa.StructArray.from_arrays([pa.array(start[new]), pa.array(reach[last])], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(offsets), joined)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.StructType]:
    """Row number, start and end of every span, and the type of a span."""
    spans = lists.flatten()
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, end = (spans.field(n).to_numpy(zero_copy_only=False) for n in ("start", "end"))
    return np.repeat(np.arange(len(lists)), sizes), start, end, spans.type


def _by_bin(models: DataFrame, place: Sequence[str], bin_size: int) -> DataFrame:
    """``place``, ``bin`` and ``parts``: one row per model and bin, with what its exons have there."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, bins, parts = binned_spans(batch.column("exons"), bin_size)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in place), bins, parts],
                                             [*place, "bin", "parts"])

    models = models.select(*place, F.col("exons").cast(SPANS))
    kind = models.select(*place, F.lit(0).cast("bigint").alias("bin"), F.col("exons").alias("parts")).schema
    return models.mapInArrow(cut, kind)


def binned_spans(lists: pa.ListArray, bin_size: int) -> tuple[pa.Array, pa.Array, pa.ListArray]:
    """Sorted spans cut at the bin borders: for every row and bin the row's number, the bin, the parts."""
    row, start, end, kind = _flat(lists)
    first = (start - 1) // bin_size
    reached = np.maximum((end - 1) // bin_size - first + 1, 1)
    span = np.repeat(np.arange(len(row)), reached)
    row = row[span]
    bins = first[span] + np.arange(len(span)) - np.repeat(np.cumsum(reached) - reached, reached)
    parts = pa.StructArray.from_arrays([pa.array(np.maximum(start[span], bins * bin_size + 1)),
                                        pa.array(np.minimum(end[span], (bins + 1) * bin_size))], fields=list(kind))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (bins[1:] != bins[:-1])
    offsets = np.append(np.flatnonzero(new), len(row)).astype(np.int32)
    return pa.array(row[new]), pa.array(bins[new]), pa.ListArray.from_arrays(pa.array(offsets), parts)


def _with_bases(df: DataFrame) -> DataFrame:
    """Instead of ``seq`` and ``parts`` the ``bases`` that the piece has of the parts.

    ``substring`` would walk the piece from its start for every part.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept),
                 cut_bases(batch.column("seq"), batch.column("piece_start"), batch.column("parts"))],
                [*kept, "bases"])

    kept = [c for c in df.columns if c not in ("seq", "parts")]
    return df.mapInArrow(cut, df.select(*kept, F.col("seq").alias("bases")).schema)


def cut_bases(seqs: pa.StringArray, starts: pa.Int64Array, parts: pa.ListArray) -> pa.StringArray:
    """Of every piece what it has of its row's parts, in their order."""
    row, first, last, _ = _flat(parts)
    zero = starts.to_numpy()[row]
    begin, stop = np.maximum(first - zero, 0), np.maximum(last - zero + 1, 0)
    texts = seqs.to_pylist()
    found = [texts[r][a:b] for r, a, b in zip(row.tolist(), begin.tolist(), stop.tolist())]
    ends = np.cumsum(np.bincount(row, minlength=len(texts))).tolist()
    return pa.array(["".join(found[a:b]) for a, b in zip([0, *ends], ends)], pa.string())


def splice(models: DataFrame, pieces: DataFrame, bin_size: int = BIN_SIZE) -> DataFrame:
    """``tx_id, seq, cds_start, cds_end`` of every transcript the genome covers, and ``orig_id`` if
    the models have it. A transcript is left out when part of an exon lies outside the genome.

    If few bins are needed, only their pieces are shuffled.
    """
    names = [c for c in ("tx_id", "orig_id") if c in models.columns]
    model = [*names, "strand", "length", "cds_start", "cds_end"]
    exons = settle(_by_bin(models, [*model, "seqid"], bin_size))
    wanted = measured_if_small(exons.select("seqid", "bin").distinct())
    if wanted is not None:
        pieces = pieces.join(wanted, ["seqid", "bin"], "left_semi")
    piece_end = F.col("piece_start") + F.length("seq") - 1
    # The parts of a model outgrow what Spark estimates for them, and so does the genome, so neither
    # may be broadcast on that estimate. A crowded bin is split by the skew-join rule.
    met = (exons.join(pieces.hint("merge"), ["seqid", "bin"])
           .filter((F.col("piece_start") <= F.element_at("parts", -1)["end"])
                   & (piece_end >= F.element_at("parts", 1)["start"])))
    fragments = _with_bases(met.select(*model, "seqid", "piece_start", "seq", "parts"))
    joined = fragments.groupBy(*model, "seqid").agg(F.array_join(
        F.sort_array(F.collect_list(F.struct("piece_start", "bases")))["bases"], "").alias("_plus"))
    return (joined.filter(F.length("_plus") == F.col("length"))
            .select(*names,
                    F.when(F.col("strand") == "-", reverse_complement(F.col("_plus")))
                     .otherwise(F.col("_plus")).alias("seq"), "cds_start", "cds_end"))
