"""Whole steps on a small invented genome, and the text formats at the edges."""

import json
import random

import pytest

from foldmill.__main__ import main
from foldmill.config import ConfigError, ExtractConfig, RunConfig
from foldmill.operators import collate, resume, transcripts
from foldmill.operators.scorers import PairingScorer
from foldmill.plans import score
from foldmill.plans.collate import run_collate
from foldmill.plans.extract import run_extraction
from foldmill.sources import fasta, gff, sinks, tables
from foldmill.sources.text import ordered_lines, read_whole_files
from foldmill.streaming.results import collate_stream

RNG = random.Random(11)
CHR1 = "".join(RNG.choice("ACGT") for _ in range(400))
CHR2 = "".join(RNG.choice("acgtACGT") for _ in range(333))
SWAP = str.maketrans("ACGTacgt", "TGCAtgca")


def line(seqid, kind, start, end, strand, attrs):
    return "\t".join([seqid, "src", kind, str(start), str(end), ".", strand, ".", attrs])


GFF = [
    "##gff-version 3",
    line("chr1", "gene", 1, 200, "+", "ID=gene:G1.4"),
    line("chr1", "mRNA", 11, 120, "+", "ID=transcript:T1;Parent=gene:G1.4;transcript_id=T1.1;tag=basic,MANE_Select"),
    line("chr1", "exon", 11, 40, "+", "Parent=transcript:T1"),
    line("chr1", "exon", 61, 120, "+", "Parent=transcript:T1"),
    line("chr1", "CDS", 21, 40, "+", "Parent=transcript:T1"),
    line("chr1", "CDS", 61, 90, "+", "Parent=transcript:T1"),
    line("chr1", "transcript", 11, 200, "+", "transcript_id=T2.1;gene_id=G1"),
    line("chr1", "exon", 11, 200, "+", "Parent=T2"),
    line("chr1", "CDS", 12, 190, "+", "Parent=T2"),
    line("chr2", "transcript", 31, 160, "-", "transcript_id=transcript:T3.2;Parent=gene:G2"),
    line("chr2", "exon", 101, 160, "-", "Parent=transcript:T3.2"),
    line("chr2", "exon", 31, 60, "-", "Parent=transcript:T3.2"),
    line("chr2", "CDS", 101, 130, "-", "Parent=transcript:T3.2"),
    line("chr2", "CDS", 41, 60, "-", "Parent=transcript:T3.2"),
    line("chr1", "transcript", 300, 350, "+", "transcript_id=T4;gene_id=G3"),
    line("chr1", "exon", 300, 350, "+", "Parent=T4"),
    line("chr1", "transcript", 5, 50, "+", "transcript_id=T5;gene_id=G4"),
    line("chr1", "CDS", 5, 50, "+", "Parent=T5"),
    line("chr1", "transcript", 380, 460, "+", "transcript_id=T6;gene_id=G6"),
    line("chr1", "CDS", 380, 460, "+", "Parent=T6"),
    line("chr1", "transcript", 1, 400, "+", "transcript_id=T7;gene_id=G7"),
    line("chr1", "CDS", 101, 200, "+", "Parent=T7"),
]
T1 = CHR1[10:40] + CHR1[60:120]
T3 = (CHR2[30:60] + CHR2[100:160]).translate(SWAP)[::-1]
T7 = CHR1[100:200]


@pytest.fixture
def inputs(tmp_path):
    (tmp_path / "genes.txt").write_text("gene:G1.9\n\n G2 \nG3\nG5\nG6\nG1\nG7\n")
    (tmp_path / "anno.gff3").write_text("\n".join(GFF) + "\n")
    wrapped = [CHR1[i:i + 60] for i in range(0, 400, 60)]
    (tmp_path / "genome.fa").write_bytes(
        (">chr1 first\n" + "\n".join(wrapped) + "\n>chr2\r\n" + CHR2[:200] + "\r\n" + CHR2[200:] + "\r\n").encode())
    return {"inputs": {"genome_fasta": f"{tmp_path}/genome.fa", "annotation_gff": f"{tmp_path}/anno.gff3",
                       "gene_list": f"{tmp_path}/genes.txt"},
            "outputs": {"output_dir": f"{tmp_path}/out", "min_utr_length": 10, "codon_flank_length": 5,
                        "tail_length": 25},
            "processing": {"isoform_priority": ["appris_principal_1", "MANE_Select"],
                           "regions_to_extract": ["mRNA", "CDS", "5UTR", "3UTR", "start_codon_region",
                                                  "stop_codon_region", "tail_region"]}}


def test_extraction(spark, inputs):
    config = ExtractConfig.from_mapping(inputs)
    counts = {r.Status: r["count"] for r in run_extraction(spark, config).collect()}
    assert counts == {"Missing": 1, "No_CDS": 1, "No_CDS_in_FASTA": 1, "Short_or_Missing_UTRs": 1, "Success": 2}
    out = config.output_dir
    regions = {r.name: r.seq for r in fasta.read_records(spark, f"{out}/fasta").collect()}
    # Coding 21-40 and 61-90 are 11..60 of the spliced 90; T3 reads backwards.
    assert regions["G1_T1.1_mRNA"] == T1 and regions["G1_T1.1_CDS"] == T1[10:60]
    assert regions["G1_T1.1_5UTR"] == T1[:10] and regions["G1_T1.1_3UTR"] == T1[60:]
    assert regions["G1_T1.1_start_codon_region"] == T1[5:18]
    assert regions["G1_T1.1_tail_region"] == T1[-25:]
    assert regions["G2_T3.2_mRNA"] == T3 and regions["G2_T3.2_CDS"] == T3[30:80]
    assert regions["G2_T3.2_stop_codon_region"] == T3[72:85]
    assert regions["G7_T7_CDS"] == T7 and "G7_T7_5UTR" not in regions and "G3_T4_mRNA" not in regions
    manifest = {r.seqname: r for r in tables.read_manifest(spark, f"{out}/manifest.tsv").collect()}
    assert {n: len(s) for n, s in regions.items()} == {n: r.length for n, r in manifest.items()}
    assert manifest["G1_T1.1_CDS"].selection_reason == "MANE_Select"
    assert manifest["G7_T7_CDS"].short_utrs and manifest["G2_T3.2_CDS"].selection_reason == "longest_cds"
    summary = {r.Gene_ID: r for r in spark.read.csv(f"{out}/extraction_summary.csv", header=True).collect()}
    assert summary["G5"].Transcript_ID == "None" and summary["G6"].Status == "No_CDS_in_FASTA"
    assert (summary["G1"].CDS_Length, summary["G1"]["5UTR_Length"], summary["G1"]["3UTR_Length"]) == ("50", "10", "30")


def test_given_transcripts_replace_splicing(spark, inputs, tmp_path):
    (tmp_path / "mrna.fa").write_text(f">transcript:T1.1 CDS=11-60\n{T1}\n>T3.2 CDS=31-80\n{T3}\n>T9\nACGT\n")
    config = ExtractConfig.from_mapping(inputs)
    counts = {r.Status: r["count"] for r in run_extraction(
        spark, config, mrna_fasta=f"{tmp_path}/mrna.fa").collect()}
    assert counts == {"Missing": 1, "No_CDS_in_FASTA": 3, "Success": 2}
    regions = {r.name: r.seq for r in fasta.read_records(spark, f"{config.output_dir}/fasta").collect()}
    assert regions["G1_T1.1_CDS"] == T1[10:60] and regions["G2_T3.2_3UTR"] == T3[80:]


def test_extraction_skips_current_outputs(spark, inputs, tmp_path):
    config = ExtractConfig.from_mapping(inputs)
    assert run_extraction(spark, config) is not None
    assert run_extraction(spark, config) is None
    assert run_extraction(spark, config, force=True) is not None
    changed = {**inputs, "outputs": {**inputs["outputs"], "tail_length": 30}}
    assert run_extraction(spark, ExtractConfig.from_mapping(changed)) is not None
    (tmp_path / "genes.txt").write_text("G1\n")
    assert run_extraction(spark, ExtractConfig.from_mapping(changed)) is not None


def test_filtering_and_missing_region_folders(spark, inputs):
    inputs["outputs"]["filter_short_utrs"] = True
    inputs["outputs"]["min_utr_length"] = 1000
    out = ExtractConfig.from_mapping(inputs).output_dir
    run_extraction(spark, ExtractConfig.from_mapping(inputs))
    assert spark.read.text(f"{out}/fasta/region=mRNA").count() == 0
    assert not __import__("os").path.exists(f"{out}/manifest.tsv")


def test_single_record_mode(spark, inputs):
    inputs["outputs"]["output_mode"] = "individual"
    inputs["processing"]["regions_to_extract"] = ["CDS"]
    out = ExtractConfig.from_mapping(inputs).output_dir
    run_extraction(spark, ExtractConfig.from_mapping(inputs))
    assert spark.read.text(f"{out}/fasta/seqname=G7_T7_CDS").collect()[1].value == T7


def test_genome_in_small_splits(spark, inputs):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    try:
        for bin_size in (7, 50, 1000):
            pieces = fasta.read_genome(spark, inputs["inputs"]["genome_fasta"], bin_size).collect()
            for name, want in (("chr1", CHR1), ("chr2", CHR2)):
                own = sorted((p for p in pieces if p.seqid == name), key=lambda p: p.piece_start)
                assert "".join(p.seq for p in own) == want
                at = 1
                for p in own:
                    assert p.piece_start == at and p.bin == (at - 1) // bin_size
                    assert len(p.seq) <= bin_size and (at + len(p.seq) - 2) // bin_size == p.bin
                    at += len(p.seq)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_line_order_survives_splits(spark, tmp_path):
    (tmp_path / "many.txt").write_text("".join(f"line{i}\n" for i in range(2000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "501")
    try:
        rows = ordered_lines(spark, f"{tmp_path}/many.txt").orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.raw for r in rows] == [f"line{i}" for i in range(2000)]


def test_short_records_with_angle_brackets(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">a x>y CDS=2-4\nAC\nGT\n>\nTTTT\n>b.1\nAAA")
    rows = {r.name: (r.header, r.seq) for r in fasta.read_records(spark, f"{tmp_path}/a.fa").collect()}
    assert rows == {"a": ("a x>y CDS=2-4", "ACGT"), "b.1": ("b.1", "AAA")}
    mrna = {r.tx_id: (r.cds_start, r.cds_end) for r in fasta.read_mrna(spark, f"{tmp_path}/a.fa").collect()}
    assert mrna == {"a": (2, 4), "b": (None, None)}


def reference_choice(rows, tags):
    """rows: (gene, tx, held tags, cds length) in file order."""
    chosen = {}
    for gene in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == gene]
        for tag in tags:
            held = [r for r in own if tag in r[2]]
            if held:
                chosen[gene] = (max(held, key=lambda r: r[3])[1], tag)
                break
        else:
            chosen[gene] = (max(own, key=lambda r: r[3])[1], "longest_cds")
    return chosen


def test_choice_on_random_genes(spark):
    rng, tags = random.Random(3), ["A", "B", "C"]
    rows = [(f"g{rng.randint(0, 60)}", f"t{i}", [t for t in tags if rng.random() < 0.3], rng.randint(0, 4))
            for i in range(400)]
    table = spark.createDataFrame(
        [(g, t, min([tags.index(x) for x in held], default=3), n, i)
         for i, (g, t, held, n) in enumerate(rows)],
        "gene_id string, tx_id string, tag_rank int, cds_len int, pos int").repartition(5)
    got = {r.gene_id: (r.tx_id, r.reason) for r in transcripts.best_per_gene(table, tags).collect()}
    assert got == reference_choice(rows, tags)


def test_anchored_reading(spark):
    raw = [(line("c", "mRNA", 1, 9, "+", "xgene_id=wrong;transcript_id=T1;gene_id=G1"), 0),
           (line("c", "CDS", 1, 9, "+", "Parent=transcript:T1,transcript:T2"), 1)]
    lines = spark.createDataFrame(raw, "raw string, pos int")
    assert transcripts.transcript_lines(lines).first().gene_id == "wrong"
    assert transcripts.transcript_lines(lines, anchored=True).first().gene_id == "G1"
    valid = spark.createDataFrame([("T1",), ("T2",)], "tx_id string")
    assert [r.tx_id for r in transcripts.coding_lengths(lines, valid).collect()] == ["T2"]
    assert {r.tx_id for r in transcripts.coding_lengths(lines, valid, True).collect()} == {"T1", "T2"}


def test_parsed_columns(spark):
    row = gff.parse_columns(spark.createDataFrame(
        [("c\ts\tCDS\tx\t9\t.\t-\t0\tParent=T",), ("short",)], "raw string")).collect()
    assert (row[0].start, row[0].end, row[0].strand, row[1].attrs) == (None, 9, "-", None)


def test_steps_from_regions_to_tables(spark, inputs, tmp_path):
    run_extraction(spark, ExtractConfig.from_mapping(inputs))
    run = RunConfig.from_env({}, multifasta_dir=f"{tmp_path}/out", manifest_tsv=f"{tmp_path}/out/manifest.tsv",
                             tier_root=f"{tmp_path}/lists", results_dir=f"{tmp_path}/res",
                             raw_shuffles_dir=f"{tmp_path}/raw", errors_dir=f"{tmp_path}/err",
                             calibration_root=f"{tmp_path}/cal", tier_shuffles=(5,) * 9 + (0,))
    counts = {r.range: r["count"] for r in score.run_stratify(spark, run).collect()}
    total = counts["total"]
    assert total == tables.read_manifest(spark, run.manifest_tsv).count() and counts[">10000"] == 0
    assert tables.read_lengths(spark, f"{run.tier_root}/lengths.tsv", 1).count() == counts["0-80"]
    advice = score.run_calibrate(spark, run, PairingScorer())
    assert [(r.tier, r.n_shuffles, r.n_samples, r.rec_mem != "") for r in advice.collect()][0] == (1, 5, 3, True)
    plan = {r.tag: r for r in score.plan_submission(spark, run).collect()}
    assert plan["t1"].n_tasks == counts["0-80"] and plan["t1"].array_range == f"0-{counts['0-80'] - 1}%10"
    some = spark.createDataFrame([("G1_T1.1_CDS",), ("G7_T7_mRNA",)], "seqname string")
    assert [r.array_range for r in score.plan_submission(spark, run, some).collect()] == ["0-1%10"]

    assert score.find_missing(spark, run).count() == total
    first = score.run_scoring(spark, run, PairingScorer(), names=some)
    assert {r.seq_name for r in first.collect()} == {"G1_T1.1_CDS", "G7_T7_mRNA"}
    assert score.find_missing(spark, run).count() == total - 2
    score.run_scoring(spark, run, PairingScorer(), tiers=[1])
    score.run_scoring(spark, run, PairingScorer(), n_shuffles=3)
    assert score.find_missing(spark, run).count() == 0
    assert spark.read.parquet(run.results_dir).count() == total

    run_collate(spark, run.results_dir, run.manifest_tsv, f"{tmp_path}/final", run.raw_shuffles_dir)
    combined = spark.read.csv(f"{tmp_path}/final/combined_rnafold.tsv", sep="\t", header=True)
    assert combined.columns == ["seqname", *collate.MANIFEST_COLUMNS, "orig_mfe", "median_mfe", "pvalue",
                                "zscore", "n_valid", "n_missing", "n_shuffles_requested"]
    assert combined.filter("gene_id = 'G1'").count() == 7
    parts = sorted((tmp_path / "final" / "combined_rnafold.tsv").glob("part-*"))
    names = [row.split("\t")[0] for part in parts for row in part.read_text().splitlines()[1:]]
    assert names == sorted(names) and len(names) == total
    raw = spark.read.csv(f"{tmp_path}/final/combined_rnafold_raw_shuffles.tsv", sep="\t", header=True)
    assert raw.count() == spark.read.parquet(run.raw_shuffles_dir).count() > 0
    with pytest.raises(RuntimeError):
        from foldmill.operators.scorers import CommandScorer
        score.run_scoring(spark, run, CommandScorer(("no-such-program",)))


HEADER = "seq_name,orig_mfe,median_mfe,pvalue,zscore,n_valid,n_missing,n_shuffles_requested\n"


@pytest.fixture
def result_files(tmp_path):
    folder = tmp_path / "results"
    folder.mkdir()
    (folder / "results_a.csv").write_text(HEADER + "a,-1.5000,-1.0000,0.2500,NA,3,0,3\n")
    (folder / "results_b.csv").write_text(HEADER + "b,-2.5000,NA,NA,NA,0,0,0\n")
    (folder / "results_cut.csv").write_text(HEADER + "cut,-1.0,-1.0")
    (folder / "results_empty.csv").write_text("")
    (folder / "other.csv").write_text("x\n1\n")
    manifest = tmp_path / "manifest.tsv"
    columns = "seqname\tgene_id\ttranscript_id\tregion\tlength\tselection_reason\tshort_utrs\r\n"
    manifest.write_text(columns + "a\tG0\tT0\tCDS\t9\tx\ttrue\r\n" + "a\tG1\tT1\tCDS\t10\tx\tfalse\r\n")
    return folder, manifest


def test_result_files(spark, result_files, tmp_path):
    folder, manifest = result_files
    files = read_whole_files(spark, str(folder), "results_*.csv")
    assert {r.seqname for r in resume.completed_files(files).collect()} == {"a", "b"}
    done = tables.read_results(spark, str(folder), "results_[ab].csv")
    assert {r.seq_name: (r.median_mfe, r.n_valid) for r in done.collect()} == {"a": (-1.0, 3), "b": (None, 0)}
    joined = {r.seqname: r for r in collate.printed(collate.collate_results(
        done, tables.read_manifest(spark, str(manifest)))).collect()}
    assert (joined["a"].gene_id, joined["a"].short_utrs, joined["a"].zscore) == ("G1", "false", "NA")
    assert (joined["b"].gene_id, joined["b"].length, joined["b"].orig_mfe) == ("", "", "-2.5000")
    with pytest.raises(FileNotFoundError):
        tables.read_results(spark, str(folder), "nothing_*.csv")
    assert tables.read_raw_shuffles(spark, str(folder)) is None
    bare = collate.collate_results(done, None)
    assert bare.columns[:7] == ["seqname", *collate.MANIFEST_COLUMNS] and bare.first().gene_id is None
    plain = tables.read_results(spark, str(folder), "results_[ab].csv", standard=False)
    assert plain.columns == HEADER.strip().split(",")


def test_result_text_reads_back(spark, result_files, tmp_path):
    rows = tables.read_results(spark, str(result_files[0]), "results_[ab].csv")
    sinks.write_results(rows.coalesce(1), f"{tmp_path}/text")
    again = tables.read_results(spark, f"{tmp_path}/text", "part-*")
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))
    raw = spark.createDataFrame([("a", 1, -2.5)], "transcript_id string, iteration int, shuffled_mfe double")
    sinks.write_raw_shuffles(raw, f"{tmp_path}/raw")
    assert tables.read_raw_shuffles(spark, f"{tmp_path}/raw", "part-*").collect() == raw.collect()


def test_last_record_of_a_name_wins(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">a\nAC\n>b\nGG\n>a again\nTTT\n")
    rows = fasta.read_latest_records(spark, f"{tmp_path}/a.fa").collect()
    assert {r.name: r.seq for r in rows} == {"a": "TTT", "b": "GG"}


def test_printed_tables_end_lines_with_crlf(spark, tmp_path):
    sinks.write_table(spark.createDataFrame([("a", None), ("", "b\tc")], "x string, y string").coalesce(1),
                      f"{tmp_path}/t")
    part = next((tmp_path / "t").glob("part-*"))
    assert part.read_bytes() == b'x\ty\r\na\t\r\n\t"b\tc"\r\n'


def test_stream_equals_batch(spark, result_files, tmp_path):
    folder, path = result_files
    for name in ("results_cut.csv", "results_empty.csv"):
        (folder / name).rename(tmp_path / name)
    manifest = tables.read_manifest(spark, str(path))
    out, mark = f"{tmp_path}/stream", f"{tmp_path}/mark"
    collate_stream(spark, str(folder), manifest, out, mark).awaitTermination(120)
    (folder / "results_d.csv").write_text(HEADER + "d,-3.0000,-1.0000,0.2500,NA,3,0,3\n")
    collate_stream(spark, str(folder), manifest, out, mark).awaitTermination(120)
    batch = collate.collate_results(tables.read_results(spark, str(folder)), manifest)
    assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(map(str, batch.collect()))


def test_settings(tmp_path):
    with pytest.raises(ConfigError):
        ExtractConfig.from_mapping({"inputs": {"genome_fasta": "x"}})
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"inputs": {"genome_fasta": "g", "annotation_gff": "a", "gene_list": "l"}}))
    config = ExtractConfig.load(str(path))
    assert (config.min_utr_length, config.tail_length, config.regions_to_extract) == (30, 100, ())
    run = RunConfig.from_env({"TIER_BOUNDS": "1 2 3 4 5 6 7 8 9", "N_SHUFFLES": "7", "SLURM_TIME": "",
                              "MULTIFASTA_DIR": "x"})
    assert run.tier_bounds[8] == 9 and run.n_shuffles == 7 and run.slurm_time == "03:00:00"
    assert run.manifest_tsv == "x/manifest.tsv"
    with pytest.raises(ValueError):
        RunConfig.from_env({"TIER_SHUFFLES": "1 2"})


def test_command_line(spark, inputs, tmp_path, monkeypatch, capsys):
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "config.yaml"
    path.write_text(yaml.safe_dump(inputs))
    for name, value in {"MULTIFASTA_DIR": "out", "TIER_ROOT": "lists", "RESULTS_DIR": "res",
                        "RAW_SHUFFLES_DIR": "raw", "ERRORS_DIR": "err"}.items():
        monkeypatch.setenv(name, f"{tmp_path}/{value}")
    monkeypatch.setenv("TIER_SHUFFLES", "2 2 2 2 2 2 2 2 2 0")
    assert main(["extract", str(path)]) == 0 and main(["stratify"]) == 0
    assert main(["missing"]) == 0
    assert "G1_T1.1_CDS" in [r.value for r in spark.read.text(f"{tmp_path}/lists/missing").collect()]
    assert main(["score"]) == 1  # no folding program here
    assert main(["score", "--stand-in", "--max-span", "20"]) == 0
    capsys.readouterr()
    assert main(["missing"]) == 0 and capsys.readouterr().out.startswith("0 unfinished")
    assert main(["collate", "--manifest", f"{tmp_path}/out/manifest.tsv", "--out-dir", f"{tmp_path}/final",
                 "--include-raw-shuffles"]) == 0
