"""Column functions on hand-worked cases."""

import re

import pytest
from pyspark.sql import functions as F

from foldmill.functions import attributes, durations, energies, ids, sequences, stats, tiers


def values(spark, inputs, expression, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]


def test_normalise_id(spark):
    cases = {"gene:ENSG1.5": "ENSG1", "transcript:T1.2,transcript:T2.3": "T2", "a:b:c.d.e": "c",
             "ENST1.2_PAR_Y": "ENST1", ".x": "", "": "", "plain": "plain"}
    assert values(spark, cases, ids.normalise_id) == list(cases.values())
    assert values(spark, ["gene:E1.5", "E1.5"], ids.original_id) == ["E1.5", "E1.5"]


def test_file_key(spark):
    assert values(spark, ["a/b/x.fa", "x.fa.gz", "y"], lambda c: ids.file_key(c, ".fa")) == \
        ["x", "x.fa.gz", "y"]


def test_attributes(spark):
    lines = ["a\tb\tgene_id=g1;Parent=p1", "xxgene_id=g2", "Parent=p3 gene_id=g3", "none", "gene_id=;x"]
    assert values(spark, lines, lambda c: attributes.attribute(c, "gene_id")) == \
        ["g1", "g2", "g3", None, None]
    assert values(spark, lines, lambda c: attributes.attribute(c, "gene_id", True)) == \
        ["g1", None, None, None, None]
    assert values(spark, lines, lambda c: attributes.first_attribute(c, ["gene_id", "Parent"])) == \
        ["g1", "g2", "g3", None, None]
    assert values(spark, lines, lambda c: attributes.leftmost_attribute(c, ["gene_id", "Parent"])) == \
        ["g1", "g2", "p3", None, None]


def test_tags(spark):
    tags = ["appris_principal_1", "MANE_Select"]
    lines = ["tag=appris_principal_10", "tag=basic,MANE_Select", "xMANE_Select", "",
             "MANE_Select;appris_principal_1"]
    assert values(spark, lines, lambda c: attributes.tags_held(c, tags)) == \
        [[], ["MANE_Select"], [], [], tags]
    assert values(spark, lines, lambda c: attributes.tag_rank(c, tags)) == [2, 1, 2, 2, 0]
    assert values(spark, ["x"], lambda c: attributes.tags_held(c, [])) == [[]]


def test_tag_with_pattern_letters(spark):
    assert values(spark, ["tag=a.b", "tag=axb"], lambda c: attributes.has_tag(c, "a.b")) == [True, False]


def test_tiers(spark):
    lengths = [0, 79, 80, 149, 150, 500, 9999, 10000, 10001]
    assert values(spark, lengths, tiers.tier_of, "int") == [1, 1, 2, 2, 3, 5, 9, 10, 10]
    assert values(spark, range(1, 12), tiers.tier_range, "int") == [
        "0-80", "80-150", "150-280", "280-500", "500-900", "900-1600", "1600-2800", "2800-5000",
        "5000-10000", ">10000", None]
    assert values(spark, [7, 8, 9, 10], tiers.tier_shuffles, "int") == [1000, 100, 10, 0]


@pytest.mark.parametrize("bounds, shuffles", [
    ((1, 2), range(10)), (range(9), (1,)), ((9, 8, 7, 6, 5, 4, 3, 2, 1), range(10))])
def test_tier_policy_is_checked(bounds, shuffles):
    with pytest.raises(ValueError):
        tiers.check_policy(tuple(bounds), tuple(shuffles))


def test_durations(spark):
    assert values(spark, ["1:02:03.5", "2:03.25", "7.5", "1:2:3:4", "x"], durations.elapsed_seconds) == \
        [3723.5, 123.25, 7.5, None, None]
    assert values(spark, [0, 1, 60, 61, 3600, 360000], durations.clock_minutes, "int") == \
        ["00:00:00", "00:01:00", "00:01:00", "00:02:00", "01:00:00", "100:00:00"]
    assert values(spark, [0.49, 0.5, 1.5], durations.whole_seconds, "double") == [0, 1, 2]
    assert values(spark, [1023, 1024, 4097], durations.kb_to_mb, "int") == [0, 1, 4]


def test_energy_lines(spark):
    lines = {"....((..)) (-12.30)": "-12.30", "... ( -1.20)": "-1.20", "..... (.5)": ".5", "... (5.)": None,
             "((.)) (  0.00) ": None, "ACGU": None, ">s (3)": "3"}
    assert values(spark, lines, energies.energy_text) == list(lines.values())
    assert values(spark, ["-12.30", ".5", "5.", "x", "+1"], energies.valid_energy) == \
        [-12.3, 0.5, None, None, 1.0]
    output = ">s\nACGU\n.... (-1.50)\n>t\n.... (-2.00)\n"
    assert values(spark, [output, "nothing"], energies.first_energy) == [-1.5, None]


def test_fixed_format(spark):
    assert values(spark, [1.0, -0.12344, None], energies.fixed4_or_na, "double") == \
        ["1.0000", "-0.1234", "NA"]


def test_hand_worked_regions(spark):
    seq = "GGGGGATGAAACCCTAATTTTT"
    want = {"mRNA": seq, "CDS": "ATGAAACCCTAA", "5UTR": "GGGGG", "3UTR": "TTTTT",
            "start_codon_region": "GGGATGAAA", "stop_codon_region": "CCCTAATTT",
            "tail_region": "TAATTTTT"}
    for region, text in want.items():
        cut = values(spark, [seq], lambda c: sequences.region_slice(
            region, c, F.lit(6), F.lit(17), 3, 8))
        assert cut == [text], region


def test_regions_equal_python_slices(spark):
    cases = [(seq, start, end) for seq in ("ACGTACGTAC", "GGGATGAAATTTCCC") for start in (1, 3, 7)
             for end in (start, len(seq) - 1, len(seq))]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, seq string, s int, e int")
    for flank in (0, 3, 30):
        for tail in (0, 1, 10, 100):
            columns = [sequences.region_slice(r, F.col("seq"), F.col("s"), F.col("e"), flank, tail).alias(r)
                       for r in ("start_codon_region", "stop_codon_region", "tail_region", "3UTR", "5UTR")]
            for row, (seq, start, end) in zip(df.orderBy("i").select(*columns).collect(), cases):
                first, size = start - 1, len(seq)
                assert row.start_codon_region == seq[max(0, first - flank):min(size, first + 3 + flank)]
                assert row.stop_codon_region == seq[max(0, end - 3 - flank):min(size, end + flank)]
                assert row.tail_region == (seq[-tail:] if size >= tail else seq)
                assert (row["5UTR"], row["3UTR"]) == (seq[:first], seq[end:])


def test_reverse_complement(spark):
    assert values(spark, ["ACGTN", "aCgt", "U"], sequences.reverse_complement) == ["NACGT", "acGt", "A"]


def test_fasta_record(spark):
    record = ">tx1 some CDS=3-8\r\nACG\r\nTTT\r\n"
    assert values(spark, [record], sequences.fasta_header) == ["tx1 some CDS=3-8"]
    assert values(spark, [record, ">only"], sequences.fasta_body) == ["ACGTTT", ""]
    assert values(spark, ["tx1 some", " x"], sequences.fasta_name) == ["tx1", ""]


def test_cds_bounds(spark):
    first, last = sequences.cds_bounds(F.col("h"))
    rows = spark.createDataFrame([("t CDS=6-17",), ("t",)], "h string").select(first, last).collect()
    assert [tuple(r) for r in rows] == [(6, 17), (None, None)]


def test_required_valid(spark):
    assert values(spark, [1, 2, 10, 100, 1000], lambda c: stats.required_valid(c, 90), "int") == \
        [int(n * 90 // 100) for n in (1, 2, 10, 100, 1000)]


def test_fixed_patterns_are_java_and_python_equal():
    from foldmill.fixed_values import MFE_LINE_PATTERN
    assert re.search(MFE_LINE_PATTERN, "... ( -1.20)").group(1) == "-1.20"
