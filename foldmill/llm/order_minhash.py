"""Document fingerprints by Order MinHash, in DataFrame functions only (operator 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foldmill.llm.store import settle, shuffle_partitions

GRAM = 3       # words of a k-mer
BINS = 32      # tuples of a fingerprint, a power of two
TUPLE = 2      # k-mers of a tuple
EMPTY = "-" * 8

# A k-mer is one long: a hash above, its place in the text below.
_PLACE_BITS = 26
_PLACE = (1 << _PLACE_BITS) - 1


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _packed(digest: Column, place: Column) -> Column:
    return digest.bitwiseAND(_long(~_PLACE)).bitwiseOR(place.cast("long"))


def _up_to(last: Column) -> Column:
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def with_fingerprints(df: DataFrame, columns: dict[str, str], gram: int = GRAM, bins: int = BINS,
                      size: int = TUPLE) -> DataFrame:
    """Adds the fingerprint, ``bins`` strings, of each text column under the name given for it.

    Every k-mer of ``gram`` words gets its occurrence number among the equal k-mers of the text,
    and both are hashed. The top bits of the hash choose a bin; the ``size`` smallest of a bin
    are put back into text order and hashed as a tuple. One hash per k-mer thus serves all bins.
    A bin without k-mers is ``EMPTY``; a text of fewer words is one k-mer; one without words
    has empty bins only.

    Steps are columns of their own, and a later step names an array twice at least: Spark then
    keeps it as a column instead of computing it anew inside a lambda.
    """
    def step(prefix: str, make) -> None:
        nonlocal df
        df = df.withColumns({f"_{prefix}_{out}": make(out) for out in columns.values()})

    def at(prefix: str, out: str) -> Column:
        return F.col(f"_{prefix}_{out}")

    texts = {out: text for text, out in columns.items()}
    step("words", lambda out: F.filter(F.split(texts[out], r"[ \t-\r]+"), lambda w: w != ""))

    def grams(out: str) -> Column:
        words = at("words", out)
        many = F.transform(F.sequence(F.lit(0), F.size(words) - gram), lambda i: _packed(
            F.xxhash64(*(F.get(words, i + n) for n in range(gram))), i))
        one = F.array(_packed(F.xxhash64(words), F.lit(0)))
        return F.sort_array(F.when(F.size(words) >= gram, many).when(F.size(words) > 0, one)
                            .otherwise(F.array().cast("array<bigint>")))

    step("grams", grams)
    key = lambda array, i: F.shiftright(F.get(array, i), _PLACE_BITS)
    # First of each run of equal k-mers; the first keeps its hash, so these stay sorted.
    step("runs", lambda out: F.filter(_up_to(F.size(at("grams", out)) - 1), lambda i: (i == 0) | (
        key(at("grams", out), i) != key(at("grams", out), F.greatest(i - 1, F.lit(0))))))

    def numbered(out: str) -> Column:
        array, runs = at("grams", out), at("runs", out)
        end = lambda n: F.coalesce(F.get(runs, n + 1), F.size(array))
        firsts = F.transform(runs, lambda start: F.get(array, start))
        long_runs = F.filter(_up_to(F.size(runs) - 1), lambda n: end(n) - F.get(runs, n) > 1)
        later = F.flatten(F.transform(long_runs, lambda n: F.transform(
            F.sequence(F.get(runs, n) + 1, end(n) - 1), lambda i: _packed(
                F.xxhash64(key(array, i), i - F.get(runs, n)),
                F.get(array, i).bitwiseAND(_long(_PLACE))))))
        return F.when(F.size(runs) == F.size(array), array).otherwise(
            F.sort_array(F.concat(firsts, later)))

    step("kmers", numbered)
    shift = 64 - (bins - 1).bit_length()
    bin_of = lambda array, i: F.shiftright(F.get(array, i), shift)
    step("starts", lambda out: F.filter(_up_to(F.size(at("kmers", out)) - 1), lambda i: (i == 0) | (
        bin_of(at("kmers", out), i) != bin_of(at("kmers", out), F.greatest(i - 1, F.lit(0))))))

    def tuples(out: str) -> Column:
        array, starts = at("kmers", out), at("starts", out)

        def one(start: Column, n: Column) -> Column:
            end = F.coalesce(F.get(starts, n + 1), F.size(array))
            least = F.slice(array, start + 1, F.least(F.lit(size), end - start))
            placed = F.sort_array(F.transform(least, lambda x: F.struct(
                x.bitwiseAND(_long(_PLACE)).alias("place"),
                F.shiftright(x, _PLACE_BITS).alias("kmer"))))
            digest = F.xxhash64(F.transform(placed, lambda p: p["kmer"]))
            return F.struct((bin_of(array, start) + bins // 2).cast("int").alias("bin"),
                            F.lower(F.substring(F.lpad(F.hex(digest), 16, "0"), 9, 8)).alias("tuple"))

        return F.map_from_entries(F.transform(starts, one))

    step("tuples", tuples)


    def filled(out: str) -> Column:
        found = at("tuples", out)
        return F.when(F.size(found) == 0, F.array_repeat(F.lit(EMPTY), bins)).otherwise(F.transform(
            F.sequence(F.lit(0), F.lit(bins - 1)),
            lambda b: F.coalesce(F.element_at(found, b), F.lit(EMPTY))))

    df = df.withColumns({out: filled(out) for out in columns.values()})
    return df.drop(*(f"_{p}_{out}" for out in columns.values()
                     for p in ("words", "grams", "runs", "kmers", "starts", "tuples")))


def likeness(one: Column, other: Column) -> Column:
    """Share of equal tuples among the bins that are not empty in both; 1 if all are."""
    pairs = F.arrays_zip(one.alias("a"), other.alias("b"))
    held = F.filter(pairs, lambda p: (p["a"] != EMPTY) | (p["b"] != EMPTY))
    same = F.size(F.filter(pairs, lambda p: (p["a"] == p["b"]) & (p["a"] != EMPTY)))
    return F.when(F.size(held) == 0, 1.0).otherwise(same / F.greatest(F.size(held), F.lit(1)))


def following(texts: DataFrame) -> DataFrame:
    """``doc_id, tie, n_chars, next_id, next_tie``: the next text by descending doc_id (ties by hash).

    Ids are range-partitioned and each range is looked over by itself; between ranges only
    their first rows meet, one row per partition. After the last text comes the first.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    ids = texts.groupBy("doc_id", "tie").agg(F.max(F.length("text")).alias("n_chars"))
    ranged = settle(ids.repartitionByRange(shuffle_partitions(texts), *order)
                    .withColumn("range", F.spark_partition_id()))
    row = F.struct(F.col("doc_id").alias("id"), F.col("tie").alias("tie"))
    inside = Window.partitionBy("range").orderBy(*order)
    placed = ranged.withColumn("next", F.lead(row).over(inside)).withColumn("at", F.row_number().over(inside))
    heads = placed.filter("at = 1").select("range", row.alias("head"))
    every = Window.orderBy("range")
    heads = heads.select("range", F.coalesce(F.lead("head").over(every), F.first("head").over(
        every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    return settle(placed.join(F.broadcast(heads), "range").withColumn(
        "next", F.coalesce("next", "after")).select(
            "doc_id", "tie", "n_chars", F.col("next.id").alias("next_id"), F.col("next.tie").alias("next_tie")))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints every text and the text with its last third taken from the next document.

    Returns per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint and edited_fingerprint
    (``BINS`` times eight characters), near_edited and near_next (likeness to the edited text's
    and the next text's fingerprint).

    Null texts are empty. A null doc_id comes last in the order. Rows of one id and text are
    one document in the order and get equal rows; different texts of one id follow in order
    of their hash. A document that is alone comes after itself. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    order = following(texts)
    third = F.floor(F.col("n_chars") / 3).cast("int")
    p, d = order.alias("p"), texts.alias("d")
    heads = (d.join(p.hint("merge"), F.col("d.doc_id").eqNullSafe(F.col("p.next_id"))
                    & (F.col("d.tie") == F.col("p.next_tie")))
             .select("p.doc_id", "p.tie", third.alias("third"),
                     F.substring(F.col("d.text"), F.lit(1), third).alias("head"))
             .dropDuplicates(["doc_id", "tie"]))
    h = heads.alias("h")
    both = (d.join(h.hint("merge"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id"))
                   & (F.col("d.tie") == F.col("h.tie")))
            .select("d.doc_id", "d.tie", "d.text", F.concat(
                F.substring(F.col("d.text"), F.lit(1), F.length("d.text") - F.col("h.third")),
                F.col("h.head")).alias("edited")))
    marked = settle(with_fingerprints(both, {"text": "own", "edited": "changed"}).select(
        "doc_id", "tie", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "own", "changed"))
    nexts = order.alias("p").join(
        marked.select("doc_id", "tie", F.col("own").alias("next_own"))
        .dropDuplicates(["doc_id", "tie"]).alias("n"),
        F.col("p.next_id").eqNullSafe(F.col("n.doc_id")) & (F.col("p.next_tie") == F.col("n.tie"))
    ).select("p.doc_id", "p.tie", "n.next_own").alias("x")
    m = marked.alias("m")
    return (m.join(nexts, F.col("m.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.col("m.tie") == F.col("x.tie")))
            .select("m.doc_id", "n_chars", "edited_sha256",
                    F.concat_ws("", "own").alias("fingerprint"),
                    F.concat_ws("", "changed").alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("changed")).alias("near_edited"),
                    likeness(F.col("own"), F.col("next_own")).alias("near_next")))
