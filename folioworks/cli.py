"""Command line: ``python -m folioworks.cli lines|metadata|mismatch|check|profile|fetch|verify``."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .errors import EngineError
from .functions import ids
from .logs import configure
from .operators import lines as L
from .operators import metadata as M
from .operators import mismatch as X
from .operators import quality as Q
from .operators import verification as V
from .sources import sinks, tables
from .sources.ivtff import read_lines


def _lines(spark: SparkSession, args: argparse.Namespace) -> int:
    table, report = L.build_lines(spark, args.source, args.source_name, args.sha256)
    out = args.output_dir
    if args.format in ("jsonl", "both"):
        digest = sinks.write_canonical_jsonl(table, f"{out}/lines.jsonl", ids.reading_order(F.col("page_id"), F.col("line_index")))
        sinks.write_sums({"lines.jsonl": digest}, f"{out}/SHA256SUMS")
        sinks.write_json(sinks.manifest(report, "lines", args.version, "lines.jsonl", digest, {"lines.parquet": "the same rows, written by Spark", "lines_build_report.json": "holds the time of the build"}, args.source_name), f"{out}/release_manifest.json")
    if args.format in ("parquet", "both"):
        sinks.write_parquet(table, f"{out}/lines.parquet")
    sinks.write_json(report, f"{out}/lines_build_report.json")
    return int(args.smoke_test and not L.run_smoke_test(table, report))


def _metadata(spark: SparkSession, args: argparse.Namespace) -> int:
    pages, folios, quires, report = M.build_metadata(spark, args.source)
    for name, frame in (("pages", pages), ("folios", folios), ("quires", quires)):
        sinks.write_jsonl(frame, f"{args.output_dir}/{name}.jsonl")
        if args.parquet:
            flat = {"pages": sinks.flatten_section, "folios": sinks.flatten_folios}.get(name, lambda f: f)
            sinks.write_parquet(flat(frame), f"{args.output_dir}/{name}.parquet")
    sinks.write_json(report, f"{args.output_dir}/metadata_report.json")
    return 0


def _mismatch(spark: SparkSession, args: argparse.Namespace) -> int:
    rows, summary = X.build_mismatch_index(spark, dict(s.split("=", 1) for s in args.sources))
    sinks.write_jsonl(rows, f"{args.output_dir}/mismatch_index.jsonl")
    sinks.write_json(summary, f"{args.output_dir}/mismatch_report.json", sort_keys=False)
    return 0


def _check(spark: SparkSession, args: argparse.Namespace) -> int:
    path = f"{args.output_dir}/lines.jsonl"
    if not os.path.exists(path):
        print(json.dumps({"passed": False, "checks_run": 0, "failures": ["OUTPUT_EXISTS"]}))
        return 1
    try:
        rows = tables.read_jsonl(spark, path)
    except EngineError as error:
        print(json.dumps({"passed": False, "checks_run": 0, "failures": [str(error)]}))
        return 1
    lacking = Q.missing_fields(tables.read_raw_jsonl(spark, path))
    errors = Q.shown_first(lacking, F.concat(F.coalesce(F.get_json_object("json", "$.line_id"), F.lit("?")), F.lit(" lacks "), F.array_join("missing", ", ")))
    # The file's own order is part of what is checked.
    numbered = read_lines(spark, path).where(F.col("line").rlike(r"\S")).select(F.from_json("line", rows.schema).alias("r"), F.col("line_no").alias("_line_no")).select("r.*", "_line_no")
    found = Q.verify_invariants(numbered, "_line_no", args.lines, args.pages) if not errors else {"passed": False, "checks_run": 0, "failures": [], "n_failures": 0}
    report = f"{args.output_dir}/lines_build_report.json"
    if os.path.exists(report):
        with open(report, encoding="utf-8") as file:
            built = json.load(file)
        errors += Q.report_errors(built)
        errors += [] if errors else [f"report and table differ in {k}" for k, same in Q.reconcile(rows, built).items() if not same]
    more = found["n_failures"] - len(found["failures"])
    said = errors + [f"[{f['invariant']}] {f['record_id']}: {f['message']}" for f in found["failures"]] + ([f"... and {more} more"] if more > 0 else [])
    passed = found["passed"] and not errors
    print(json.dumps({"passed": passed, "checks_run": found["checks_run"], "failures": said}, indent=None if args.json else 2, ensure_ascii=False))
    return int(not passed)


def _profile(spark: SparkSession, args: argparse.Namespace) -> int:
    texts = spark.read.text(args.files, wholetext=True).select(F.input_file_name().alias("file"), "value")
    rows = [r.asDict(True) for r in V.profile(texts).collect()]
    if args.save:
        sinks.write_json({r["file"]: r for r in rows}, args.save)
    print(json.dumps(rows, indent=2, ensure_ascii=False))
    return int(any(r["errors"] for r in rows))


def _fetch(spark: SparkSession, args: argparse.Namespace) -> int:
    """Fetch all sources of a registry and lock their hashes in it."""
    found = tables.fetch_all(tables.read_registry(args.registry), args.cache)
    tables.write_registry(found, args.registry)
    print(json.dumps({name: s.status for name, s in found.items()}, indent=2))
    return int(any(s.status != "verified" for s in found.values()))


def _verify(spark: SparkSession, args: argparse.Namespace) -> int:
    keywords = {name: tuple(words.split(",")) for name, words in (k.split("=", 1) for k in args.keywords)}
    results = V.verify_all(spark, tables.read_registry(args.registry), keywords, args.save)
    print(json.dumps(results, indent=2, ensure_ascii=False))
    return int(not results["_run"]["all_passed"])


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="folioworks")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("lines", help="build the table of lines")
    one.add_argument("--source", required=True)
    one.add_argument("--output-dir", required=True)
    one.add_argument("--source-name", default="primary")
    one.add_argument("--sha256")
    one.add_argument("--version", default="0.1.0")
    one.add_argument("--smoke-test", action="store_true")
    one.add_argument("--format", choices=["jsonl", "parquet", "both"], default="both")
    two = commands.add_parser("metadata", help="build pages, folios and quires")
    two.add_argument("source")
    two.add_argument("-o", "--output-dir", required=True)
    two.add_argument("--parquet", action="store_true")
    three = commands.add_parser("mismatch", help="align sources")
    three.add_argument("sources", nargs="+", metavar="ID=PATH")
    three.add_argument("-o", "--output-dir", required=True)
    four = commands.add_parser("check", help="check a build")
    four.add_argument("--output-dir", required=True)
    four.add_argument("--lines", type=int)
    four.add_argument("--pages", type=int)
    four.add_argument("--json", action="store_true")
    five = commands.add_parser("profile", help="profile source files")
    five.add_argument("files", nargs="+")
    five.add_argument("--save")
    six = commands.add_parser("fetch", help="fetch registered sources and lock their hashes")
    six.add_argument("registry")
    six.add_argument("--cache", default="cache")
    seven = commands.add_parser("verify", help="verify what registered sources give")
    seven.add_argument("registry")
    seven.add_argument("--keywords", nargs="*", default=[], metavar="NAME=WORD,WORD")
    seven.add_argument("--save")
    args = parser.parse_args(argv)
    configure()
    run = {"lines": _lines, "metadata": _metadata, "mismatch": _mismatch, "check": _check, "profile": _profile, "fetch": _fetch, "verify": _verify}[args.command]
    return run(spark or SparkSession.builder.appName("folioworks").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())
