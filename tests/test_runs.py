"""Runs that go wrong: repeated names, failing programs, stops, files in another order."""

import subprocess
import sys

import pytest
from pyspark.sql import Row, functions as F

from foldmill.__main__ import main
from foldmill.config import RunConfig
from foldmill.operators import extraction, resources, robust, scoring, splice
from foldmill.operators.scorers import (
    CommandScorer, LetterGraph, NeighbourScorer, fold_alone, iteration_rng)
from foldmill.plans import score
from foldmill.plans.collate import run_collate
from foldmill.sources import sinks, tables

FOLD = """#!/bin/sh
while read -r line; do case "$line" in
'>'*) echo "$line" ;;
*XXX*) exit 3 ;;
*) echo "$line"; echo ".... (-${#line}.50)" ;; esac; done
"""


@pytest.fixture
def run(spark, tmp_path):
    columns = "seqname\tgene_id\ttranscript_id\tregion\tlength\tselection_reason\tshort_utrs\r\n"
    (tmp_path / "manifest.tsv").write_text(columns + "a\tG\tT\tCDS\t9\tx\ttrue\r\n")
    rows = [("a", "ACGUACGUACGUAA"), ("a", "CCGUACGUACGU"), ("b", "ACXXXUACGU"), ("c", "AAAACCCCGGGG")]
    (spark.createDataFrame([(n, s, "CDS") for n, s in rows] + [("z", "AC", "mRNA")],
                           "seqname string, seq string, region string")
     .write.partitionBy("region").parquet(f"{tmp_path}/out/regions"))
    made = RunConfig(multifasta_dir=f"{tmp_path}/out", manifest_tsv=f"{tmp_path}/manifest.tsv",
                     tier_root=f"{tmp_path}/lists", results_dir=f"{tmp_path}/res",
                     raw_shuffles_dir=f"{tmp_path}/raw", errors_dir=f"{tmp_path}/err",
                     tier_shuffles=(4,) * 10)
    score.run_stratify(spark, made)
    return made


def program(tmp_path, text=FOLD):
    path = tmp_path / "fold.sh"
    path.write_text(text)
    path.chmod(0o755)
    return CommandScorer((str(path),))


def test_one_row_per_name(spark, run):
    assert {r.seqname: r.seq for r in score.read_sequences(spark, run).collect()} == {
        "a": "CCGUACGUACGU", "b": "ACXXXUACGU", "c": "AAAACCCCGGGG"}


def test_surplus_folds_are_an_error(spark):
    folds = spark.createDataFrame([("a", 2, i, -1.0, None) for i in (0, 0, 1, 1, 2, 2)],
                                  "seqname string, n_shuffles int, iteration int, mfe double, problem string")
    row = scoring.score_folds(folds).first()
    assert (row.pvalue, row.n_missing) == (None, 0) and "more shuffles" in row.error


def test_a_program_that_dies_costs_only_its_sequence(spark, run, tmp_path):
    scored = {r.seq_name: r for r in score.run_scoring(spark, run, program(tmp_path)).collect()}
    assert {n for n, r in scored.items() if r.error is None} == {"a", "c"}
    assert "code 3" in scored["b"].error
    for name in ("a", "c"):
        assert 0 < scored[name].pvalue <= 1 and scored[name].n_missing == 0 and scored[name].n_valid == 4


def test_a_silent_program_is_tried_again_alone(tmp_path):
    only_one = program(tmp_path, "#!/bin/sh\nread -r a; read -r b; echo \"$a\"; echo \". (-2.00)\"; cat > /dev/null\n")
    with pytest.raises(RuntimeError):
        only_one.fold(["ACGU", "ACGU"])
    assert scoring._energies(only_one, ["ACGU", "ACGU"]) == ([-2.0, -2.0], [None, None])


def test_a_missing_program_fails_the_run(spark, run):
    class Gone(CommandScorer):
        def available(self):
            return True

    with pytest.raises(Exception, match="FileNotFoundError"):
        score.run_scoring(spark, run, Gone(("no-such-program",)))
    assert score.find_missing(spark, run).count() == 3


def test_a_stopped_run_is_resumed(spark, run, monkeypatch):
    scorer = NeighbourScorer()
    writer = scoring.errors

    def stop(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(scoring, "errors", stop)
    with pytest.raises(KeyboardInterrupt):
        score.run_scoring(spark, run, scorer)
    assert score.find_missing(spark, run).count() == 3
    monkeypatch.setattr(scoring, "errors", writer)
    scored = score.run_scoring(spark, run, scorer, batch_sequences=1)
    assert {r.seq_name for r in scored.collect()} == {"a", "b", "c"}
    assert score.find_missing(spark, run).count() == 0
    raw = score.read_finished(spark, run, run.raw_shuffles_dir)
    assert raw.groupBy("transcript_id").count().agg(F.min("count"), F.max("count")).first() == (4, 4)
    assert score.read_finished(spark, run, run.results_dir).count() == 3
    assert spark.read.parquet(f"{run.results_dir}_finished").count() >= 2


def test_lists_by_path_and_published_files(spark, run, tmp_path, monkeypatch, caplog, capsys):
    for name in ("multifasta_dir", "manifest_tsv", "tier_root", "results_dir", "raw_shuffles_dir", "errors_dir"):
        monkeypatch.setenv(name.upper(), getattr(run, name))
    monkeypatch.setenv("TIER_SHUFFLES", "4 4 4 4 4 4 4 4 4 4")
    paths = tmp_path / "redo.txt"
    paths.write_text("lists/tier_1/a.fa\r\n  /data/c.fa \n\nb\nunknown.fa\n")
    assert {r.seqname for r in score.read_names(spark, str(paths)).collect()} == {"a", "b", "c", "unknown"}
    published = tmp_path / "published"
    published.mkdir()
    (published / "results_a.csv").write_text("seq_name,orig_mfe\na,-1\n")
    assert main(["missing", "--list", str(paths), "--result-files", str(published)]) == 0
    assert {r.value for r in spark.read.text(f"{run.tier_root}/missing").collect()} == {"b", "c"}
    assert "1 listed names match no sequence" in caplog.text
    assert main(["score", "--stand-in", "--list", str(paths)]) == 0
    assert main(["export", f"{tmp_path}/export"]) == 0
    back = tables.read_results(spark, f"{tmp_path}/export/results", "part-*")
    assert {r.seq_name for r in back.collect()} == {"a", "b", "c"}
    assert tables.read_raw_shuffles(spark, f"{tmp_path}/export/raw_shuffles", "part-*").count() == 12


def test_files_are_read_by_their_headers(spark, tmp_path):
    (tmp_path / "x_raw_shuffles.csv").write_text("shuffled_mfe,note,transcript_id,iteration\n-2.5,n,t,7\n")
    assert tables.read_raw_shuffles(spark, str(tmp_path)).first() == ("t", 7, -2.5)
    (tmp_path / "results_x.csv").write_text("extra,orig_mfe,seq_name\nhello,-3.5,s\n")
    row = tables.read_results(spark, str(tmp_path), standard=False).first()
    assert (row.seq_name, row.orig_mfe, row.n_valid, row.extra) == ("s", -3.5, None, "hello")
    (tmp_path / "manifest.tsv").write_text("region\tseqname\tnew\nCDS\ts\tx\n")
    row = tables.read_manifest(spark, f"{tmp_path}/manifest.tsv").first()
    assert (row.seqname, row.region, row.gene_id) == ("s", "CDS", None)


def test_rows_of_a_null_key_are_not_gathered(spark):
    observed = spark.createDataFrame([("a", -1.0, 2), (None, -1.0, 2)], "k string, orig_mfe double, n_shuffles int")
    hot = spark.range(5000).select(F.lit(None).cast("string").alias("k"), (-F.col("id")).cast("double").alias("mfe"))
    background = hot.union(spark.createDataFrame([("a", -1.0), ("a", -3.0)], "k string, mfe double"))
    for limit in (1_000_000, 100):
        got = {r.k: r for r in robust.score(robust.summarise(observed, background, ["k"], final_rows=limit)).collect()}
        assert (got["a"].n_valid, got["a"].median_mfe) == (2, -2.0) and got[None].n_valid == 0


def test_two_loci_of_one_id(spark):
    features = spark.createDataFrame(
        [("T1", "T1.1", "exon", "x", 1, 4, "+"), ("T1", "T1.1", "exon", "x", 3, 6, "+"),
         ("T1", "T1.1_PAR_Y", "exon", "y", 2, 5, "-")],
        "tx_id string, orig_id string, type string, seqid string, start long, end long, strand string")
    genome = spark.createDataFrame([("x", 1, "ACGTTTGG"), ("y", 1, "CCAAAACC")],
                                   "seqid string, seq_start long, seq string")
    spliced = splice.splice(splice.transcript_models(features), splice.cut_into_bins(genome, 4), 4)
    assert {(r.orig_id, r.seq) for r in spliced.collect()} == {("T1.1", "ACGTTT"), ("T1.1_PAR_Y", "TTTG")}
    selected = spark.createDataFrame([("G", "T1", "T1.1", "r")], "gene_id string, stripped_id string, "
                                     "orig_id string, reason string")
    assert [r.seq for r in extraction.attach_selection(spliced, selected).collect()] == ["ACGTTT"]


def _models(spark, rows):
    kind = "tx_id string, type string, seqid string, start long, end long, strand string, phase int"
    return {r.tx_id: r for r in splice.transcript_models(spark.createDataFrame(rows, kind)).collect()}


def test_phase_and_broken_coding_lines(spark):
    """Exons 11-20, 31-40 and 51-60 are the places 1-10, 11-20 and 21-30, backwards 30-21, 20-11 and 10-1."""
    exons = [("exon", 11, 20, None), ("exon", 31, 40, None), ("exon", 51, 60, None)]
    cases = {   # coding lines, then the range forwards and backwards
        "whole": ([("CDS", 15, 20, 0), ("CDS", 31, 36, 0)], (5, 16), (15, 26)),
        "phase": ([("CDS", 15, 20, 2), ("CDS", 31, 36, 1)], (7, 16), (16, 26)),
        "no phase": ([("CDS", 15, 20, None), ("CDS", 31, 36, None)], (5, 16), (15, 26)),
        "over an exon's end": ([("CDS", 20, 20, 2), ("CDS", 31, 31, 2), ("CDS", 51, 60, 0)], (12, 30), (1, 21)),
        "from between exons": ([("CDS", 25, 36, 1)], (12, 16), (16, 20)),
        "into between exons": ([("CDS", 15, 25, 1)], (6, 10), (22, 26)),
        "beyond both ends": ([("CDS", 1, 99, 0)], (1, 30), (1, 30)),
        "all between exons": ([("CDS", 21, 30, 0)], (None, None), (None, None)),
        "all outside": ([("CDS", 1, 5, 0)], (None, None), (None, None)),
        "nothing left": ([("CDS", 15, 16, 2)], (None, None), (None, None)),
        "two of one start": ([("CDS", 15, 20, 2), ("CDS", 15, 36, 1)], (6, 16), (16, 26)),
        "no coding lines": ([], (None, None), (None, None)),
    }
    rows = [(f"{name}{strand}", kind, "x", start, end, strand, phase) for name, (coding, _, _) in cases.items()
            for strand in "+-" for kind, start, end, phase in exons + coding]
    got = _models(spark, rows)
    for name, (_, forwards, backwards) in cases.items():
        assert (got[f"{name}+"].cds_start, got[f"{name}+"].cds_end) == forwards, name
        assert (got[f"{name}-"].cds_start, got[f"{name}-"].cds_end) == backwards, name
    alone = _models(spark, [("T", "CDS", "x", 11, 20, "-", 0), ("T", "CDS", "x", 31, 40, "-", 1)])["T"]
    assert (alone.length, alone.cds_start, alone.cds_end) == (20, 2, 20)


def test_places_and_positions_are_each_others_inverse(spark):
    spans = [(11, 20), (31, 31), (51, 60)]
    inside = [p for a, b in spans for p in range(a, b + 1)]
    df = spark.createDataFrame([(spans, back, p) for back in (False, True) for p in range(5, 70)],
                               "exons array<struct<start:bigint,end:bigint>>, back boolean, at long")
    up, down = (splice.on_transcript(F.col("exons"), F.col("back"), F.col("at"), last) for last in (False, True))
    for r in df.select("back", "at", up.alias("up"), down.alias("down")).withColumn(
            "again", splice.on_genome(F.lit(None).cast("array<struct<start:bigint,end:bigint>>"),
                                      F.col("back"), F.col("up"))).collect():
        assert r.again is None
        above, below = sum(p < r.at for p in inside) + 1, sum(p <= r.at for p in inside)
        assert (r.up, r.down) == ((22 - above, 22 - below) if r.back else (above, below))
    lifted = df.withColumn("place", F.col("at") - 10).withColumn(
        "found", splice.on_genome(F.col("exons"), F.col("back"), F.col("place"))).collect()
    for r in lifted:
        order = inside[::-1] if r.back else inside
        assert r.found == (order[r.place - 1] if 1 <= r.place <= 21 else None)


def test_many_shuffles_equal_single_ones():
    graph = LetterGraph("ACGUUGCAACGGUAéA" * 5)
    streams = lambda: [iteration_rng(1, "s", i) for i in range(100)]
    assert list(graph.shuffles(streams())) == [graph.shuffle(r) for r in streams()]


def test_files_of_different_headers_are_read_together(spark, tmp_path, caplog):
    (tmp_path / "results_b.csv").write_text("zscore,seq_name,orig_mfe,program\nNA,b,-2.5,\"v2, new\"\n")
    (tmp_path / "results_a.csv").write_text("seq_name,orig_mfe,n_valid\r\na,-1.0,7\r\na2,-1.5\r\n")
    (tmp_path / "results_c.csv").write_text("note,seq_name,orig_mfe\n\"say \"\"c\"\"\",c,-3.5\n\nx,c2,-4.5,9,9\n")
    (tmp_path / "results_d.csv").write_text("seq_name,orig_mfe\n")
    rows = {r.seq_name: r for r in tables.read_results(spark, str(tmp_path), standard=False).collect()}
    assert {n: r.orig_mfe for n, r in rows.items()} == {"a": -1.0, "a2": -1.5, "b": -2.5, "c": -3.5, "c2": -4.5}
    assert (rows["a"].n_valid, rows["a2"].n_valid, rows["b"].n_valid, rows["b"].zscore) == (7, None, None, None)
    assert (rows["b"].program, rows["a"].program, rows["c"].note) == ("v2, new", None, 'say "c"')
    assert list(tables.read_results(spark, str(tmp_path)).columns) == list(rows["a"].__fields__)[:8]
    manifest = tmp_path / "manifest.tsv"
    manifest.write_text("region\tseqname\nCDS\tc\n")
    for name, text in (("z", "transcript_id,iteration,shuffled_mfe\nc,2,-1\nc,1,-2\n"), ("y", "shuffled_mfe,transcript_id,iteration\n-7,b,1\n")):
        (tmp_path / f"{name}_raw_shuffles.csv").write_text(text)
    combined = run_collate(spark, str(tmp_path), str(manifest), f"{tmp_path}/out", str(tmp_path), text_results=True)
    assert {r.seqname: r.region for r in combined.collect()}["c"] == "CDS" and "program" in combined.columns
    lines = [r.value.split("\t") for r in spark.read.text(f"{tmp_path}/out/combined_rnafold.tsv").collect()]
    assert [line[0] for line in lines if line[0] != "seqname"] == ["a", "a2", "b", "c", "c2"]
    raw = [r.value.split("\t") for r in spark.read.text(f"{tmp_path}/out/combined_rnafold_raw_shuffles.tsv").collect()]
    assert [(r[0], r[4]) for r in raw if r[0] != "seqname"] == [("b", "1"), ("c", "2"), ("c", "1")]
    for name in ("e", "f"):
        (tmp_path / name).mkdir()
    assert tables.read_raw_shuffles(spark, str(tmp_path / "e")) is None
    with pytest.raises(FileNotFoundError):
        tables.read_results(spark, str(tmp_path / "f"))


def test_a_batch_reads_its_own_partition_only(spark, run):
    todo = score.find_missing(spark, run)
    number, stage = score.store_todo(run, todo, "r", 1)
    assert number == 3
    read = [score.read_batch(spark, stage, n) for n in range(number)]
    assert sorted(r.seqname for df in read for r in df.collect()) == ["a", "b", "c"]
    plan = read[1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan and "PushedFilters: []" in plan


def test_a_batch_written_again_replaces_itself_alone(spark, run):
    rows = spark.createDataFrame([("a", 1)], "seq_name string, n int")
    for name, number in (("x_0", 1), ("x_1", 2), ("x_0", 3)):
        score._write_batch(rows.withColumn("n", F.lit(number)), run.results_dir, name)
    assert {(r.batch, r.n) for r in spark.read.parquet(run.results_dir).collect()} == {("x_0", 3), ("x_1", 2)}


def test_stopped_batches_are_removed(spark, run, monkeypatch):
    score.run_scoring(spark, run, NeighbourScorer(), names=spark.createDataFrame([("a",)], "seqname string"))
    monkeypatch.setattr(scoring, "errors", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        score.run_scoring(spark, run, NeighbourScorer())
    assert spark.read.parquet(run.raw_shuffles_dir).select("batch").distinct().count() == 2
    assert len(score.remove_unfinished(spark, run)) == 1 and score.remove_unfinished(spark, run) == []
    assert {r.transcript_id for r in spark.read.parquet(run.raw_shuffles_dir).collect()} == {"a"}
    assert score.read_finished(spark, run, run.results_dir).count() == 1


GREEDY = """#!{python}
import sys
for line in sys.stdin:
    if line.startswith(">"):
        print(line, end="")
    else:
        held = b"x" * (1000 * len(line.strip()))
        print("." * 5, "(-1.00)")
"""


def test_memory_of_a_sample_is_its_own(spark, tmp_path):
    """In one worker, a sample that needs 300 MB comes before one that needs next to nothing."""
    greedy = program(tmp_path, GREEDY.format(python=sys.executable))
    rows = [(1, "large", 300_000, 1, "ACGU" * 75_000), (1, "small", 40, 1, "ACGU" * 10)]
    samples = spark.createDataFrame(rows, "tier int, seqname string, length int, n_shuffles int, seq string").coalesce(1)
    for scorer in (greedy, NeighbourScorer()):
        timed = {r.seqname: r for r in _in_order(samples, scorer)}
        assert timed["small"].rss_kb < timed["large"].rss_kb and timed["large"].wall > 0
    timed = {r.seqname: r.rss_kb for r in _in_order(samples, greedy)}
    assert timed["large"] > 300_000 and timed["small"] < 100_000


def _in_order(samples, scorer):
    made = []
    for row in samples.orderBy("seqname").collect():
        energies, memory = fold_alone(scorer, [row.seq, row.seq])
        assert len(energies) == 2 and None not in energies
        made.append((row.seqname, memory))
    first = {n: m for n, m in made}
    timed = scoring.time_samples(samples, scorer).collect()
    assert {r.seqname for r in timed} == set(first)
    return timed


def test_a_program_that_hangs_or_dies(tmp_path):
    hangs = CommandScorer(("sleep", "60"), timeout=0.5)
    with pytest.raises(subprocess.TimeoutExpired):
        hangs.fold(["ACGU"])
    assert scoring._energies(hangs, ["ACGU"])[0] == [None]
    deaf = program(tmp_path, "#!/bin/sh\nexit 7\n")
    with pytest.raises(RuntimeError, match="code 7"):
        deaf.fold(["ACGU" * 100_000])


def test_unbounded_folds_score_like_bounded_ones(spark):
    rows = [(n, 30, i, None if i % 11 == 5 else -float((i * 7 + k) % 13), "p" if i == 2 else None)
            for k, n in enumerate("abc") for i in range(31)]
    folds = spark.createDataFrame(rows, "seqname string, n_shuffles int, iteration int, mfe double, problem string")
    assert sorted(scoring.score_folds(folds).collect()) == sorted(scoring.score_folds(folds, bounded=False).collect())


def test_rows_are_counted_as_they_are_written(spark, tmp_path, caplog):
    rows = spark.range(0, 500, 1, 5).selectExpr("cast(id as string) as seqname", "-1.0D as orig_mfe")
    path = f"{tmp_path}/combined.tsv"
    assert sinks.write_collated(rows.limit(0), path) == 0 and not (tmp_path / "combined.tsv").exists()
    assert sinks.write_collated(rows, path, ["seqname"]) == 500
    assert spark.read.option("header", True).csv(path, sep="\t").count() == 500
    assert sinks.write_collated(rows.limit(0), path) == 0 and spark.read.option("header", True).csv(path).count() == 0


def test_profiles_of_tiers(spark, monkeypatch):
    advice = [Row(tier=1, max_rss_mb=60, rec_mem="200MB"), Row(tier=2, max_rss_mb=70, rec_mem="200MB"),
              Row(tier=9, max_rss_mb=900, rec_mem="1800MB"), Row(tier=10, max_rss_mb=None, rec_mem=None)]
    assert not resources.supported(spark) and resources.tier_profiles(spark, advice) == {}
    monkeypatch.setattr(resources, "supported", lambda spark: True)
    made = resources.tier_profiles(spark, advice, cores=2)
    assert list(made) == [1, 2, 9] and made[1] is made[2]
    asked = {t: p.executorResources["pyspark.memory"].amount for t, p in made.items()}
    assert asked == {1: 2 * (200 + 512), 2: 2 * (200 + 512), 9: 2 * (1800 + 512)}
    assert made[9].executorResources["cores"].amount == 2 and made[9].taskResources["cpus"].amount == 1


def test_tiers_are_folded_under_their_profiles(spark, monkeypatch):
    rows = [(f"s{i}", "ACGUACGU" * (i + 1), 3, i % 3) for i in range(9)]
    df = spark.createDataFrame(rows, "seqname string, seq string, n_shuffles int, tier int")
    asked, fold = [], scoring.fold_all

    def recorded(sequences, scorer, seed=0, tasks=None, profile=None):
        asked.append((sorted(r.seqname for r in sequences.collect()), profile))
        return fold(sequences, scorer, seed, tasks)     # local mode has no profiles

    want = sorted(map(tuple, fold(df, NeighbourScorer(), 1).collect()))
    monkeypatch.setattr(scoring, "fold_all", recorded)
    found = scoring.fold_by_tier(df, NeighbourScorer(), {1: "one", 2: "two"}, 1)
    assert sorted(map(tuple, found.collect())) == want
    assert asked == [(["s0", "s3", "s6"], None), (["s1", "s4", "s7"], "one"), (["s2", "s5", "s8"], "two")]
