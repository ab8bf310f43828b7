"""Command line: ``python -m foldmill <step> ...``."""

from __future__ import annotations

import argparse
import logging
import sys

from foldmill.config import ConfigError, ExtractConfig, RunConfig
from foldmill.operators.scorers import CommandScorer, PairingScorer
from foldmill.plans.collate import run_collate
from foldmill.plans.extract import run_extraction
from foldmill.plans import score
from foldmill.session import builder


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="foldmill", description=__doc__)
    steps = top.add_subparsers(dest="step", required=True)

    extract = steps.add_parser("extract", help="cut regions from genome and annotation")
    extract.add_argument("config", help="YAML or JSON settings")
    extract.add_argument("-v", "--verbose", action="store_true")
    extract.add_argument("--force", action="store_true", help="run even if outputs are current")

    extract.add_argument("--mrna-fasta", help="spliced transcripts to use instead of splicing")
    extract.add_argument("--strict-attributes", action="store_true",
                         help="read annotation attributes only where they start")

    steps.add_parser("stratify", help="assign length tiers")
    for name, text in (("calibrate", "time samples and recommend resources"),
                       ("score", "fold and score unfinished sequences")):
        step = steps.add_parser(name, help=text)
        step.add_argument("--stand-in", action="store_true",
                          help="use the built-in pairing model instead of the folding program")
        step.add_argument("--max-span", type=int, help="pair distance limit of the built-in model")
        if name == "score":
            step.add_argument("--tiers", type=int, nargs="*")
            step.add_argument("--list", help="file with one sequence name or path per line")
            step.add_argument("--result-files", help="folder of published result files that count as done")
            step.add_argument("--n-shuffles", type=int)
            step.add_argument("--skip-failed", action="store_true")

    plan = steps.add_parser("submit", help="show what would be run")
    plan.add_argument("--list", help="file with one sequence name or path per line")
    missing = steps.add_parser("missing", help="list sequences without a result")
    missing.add_argument("tiers", type=int, nargs="*")
    missing.add_argument("--list", help="file with one sequence name or path per line")
    missing.add_argument("--result-files", help="folder of published result files that count as done")
    missing.add_argument("--out", help="folder for the names, by default TIER_ROOT/missing")

    steps.add_parser("clean", help="remove what stopped runs left; not while another run scores")
    export = steps.add_parser("export", help="write results and raw shuffles in the published form")
    export.add_argument("out", help="folder to write to")

    collate = steps.add_parser("collate", help="combine results with the manifest")
    for name in ("--results-dir", "--raw-dir", "--manifest"):
        collate.add_argument(name, help="by default as the environment says")
    collate.add_argument("--out-dir", default="results")
    collate.add_argument("--include-raw-shuffles", action="store_true")
    collate.add_argument("--text-results", action="store_true",
                         help="results are one CSV file per sequence")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if getattr(args, "verbose", False) else logging.INFO)
    spark = builder(f"foldmill-{args.step}").getOrCreate()
    try:
        _run(spark, args)
    except (ConfigError, FileNotFoundError, RuntimeError) as problem:
        logging.error("%s", problem)
        return 1
    return 0


def _run(spark, args) -> None:
    if args.step == "extract":
        counts = run_extraction(spark, ExtractConfig.load(args.config), args.force,
                                args.strict_attributes, args.mrna_fasta)
        if counts is not None:
            counts.show(truncate=False)
        return
    run = RunConfig.from_env()
    if args.step == "collate":
        raw_dir = args.raw_dir or run.raw_shuffles_dir
        run_collate(spark, args.results_dir or run.results_dir, args.manifest or run.manifest_tsv, args.out_dir,
                    raw_dir if args.include_raw_shuffles else None, args.text_results)
        return
    names = None
    if getattr(args, "list", None):
        names = score.read_names(spark, args.list)
    if args.step == "stratify":
        score.run_stratify(spark, run).show(truncate=False)
    elif args.step == "calibrate":
        score.run_calibrate(spark, run, _scorer(args, run)).show(truncate=False)
    elif args.step == "submit":
        score.plan_submission(spark, run, names).show(truncate=False)
    elif args.step == "missing":
        out = args.out or f"{run.tier_root}/missing"
        score.find_missing(spark, run, args.tiers or None, names=names,
                           result_files=args.result_files).select("seqname") \
            .write.mode("overwrite").text(out)
        print(f"{spark.read.text(out).count()} unfinished sequences listed in {out}")
    elif args.step == "clean":
        removed = score.remove_unfinished(spark, run)
        print(f"{len(removed)} unfinished batches removed")
    elif args.step == "export":
        score.export_text(spark, run, args.out)
    else:
        scored = score.run_scoring(spark, run, _scorer(args, run), names, args.tiers,
                                   args.n_shuffles, not args.skip_failed,
                                   result_files=args.result_files)
        scored.groupBy(scored.error.isNull().alias("scored")).count().show()


def _scorer(args, run: RunConfig):
    if args.stand_in:
        return PairingScorer(args.max_span)
    return CommandScorer((run.rnafold_bin, "--noPS"))


if __name__ == "__main__":
    sys.exit(main())
