"""Job entry point: `python -m marketlake <command>` or `spark-submit marketlake/__main__.py`.

Commands
  ingest  --landing DIR --bronze DIR          land every CSV source as a bronze table (manifest)
  land    --landing DIR --bronze DIR          append only new CSV files (incremental, exactly once)
  build   --landing DIR --out DIR [--bronze]  staging -> core -> gold, written layer by layer,
                                              then the quality checks (fails when a check fails
                                              unless --no-gate)
  check   --out DIR                           quality report over tables already written in DIR
  vacuum  --out DIR [--keep 2]                remove old versions that no kept commit names
  scenario --out DIR [--states SP RJ ...] [--max-days 30]
                                              the what-if analytics over the written gold tables:
                                              KPIs, lead-time histogram, hub load, top corridors,
                                              map centre (all states unless some are named)

On a cluster the session comes from spark-submit; `--local N` starts a local
session instead.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from marketlake.plans.build import CORE, GOLD, run_pipeline
from marketlake.plans.quality import assert_passed, run_checks
from marketlake.plans.staging import STAGING
from marketlake.session import configure, local_session
from marketlake.sources.catalog import SOURCES
from marketlake.sources.csv import read_bronze_all
from marketlake.sources.lake import Lake
from marketlake.sources.ledger import land_changed
from marketlake.sources.sinks import default_format, ingest_bronze, read_bronze_tables


def _session(args) -> SparkSession:
    if args.local:
        return local_session(args.local)
    return configure(SparkSession.builder.getOrCreate())


def _files(args) -> dict[str, str]:
    """`--file orders=my_orders.csv` pairs -> {source: file name}."""
    out = {}
    for pair in getattr(args, "file", None) or []:
        name, _, file_name = pair.partition("=")
        if name not in SOURCES or not file_name:
            raise SystemExit(f"--file expects SOURCE=FILE with SOURCE in {sorted(SOURCES)}: {pair!r}")
        out[name] = file_name
    return out


def _bronze(spark: SparkSession, args):
    if args.bronze:  # previously landed bronze tables
        return read_bronze_tables(spark, args.bronze)
    return read_bronze_all(spark, args.landing, _files(args))


def _published(spark: SparkSession, out: str, names: list[str]):
    """Tables of the latest build, all of one and the same commit."""
    fmt = default_format(spark)
    if fmt == "delta":
        return {n: spark.read.format(fmt).load(f"{out.rstrip('/')}/{n}") for n in names}
    return Lake(spark, out, fmt).read_all(names)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="marketlake")
    parser.add_argument("--local", type=int, default=0, help="start a local session with N cores")
    sub = parser.add_subparsers(dest="command", required=True)
    file_help = "landing file name of a source, e.g. orders=my_orders.csv (repeatable)"
    p = sub.add_parser("ingest")
    p.add_argument("--landing", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--file", action="append", help=file_help)
    p = sub.add_parser("land")
    p.add_argument("--landing", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--file", action="append", help=file_help + "; used as a glob pattern")
    p = sub.add_parser("sync", help="make the bronze tables equal to the landing folder; only new and changed files are read")
    p.add_argument("--landing", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--file", action="append", help=file_help)
    p = sub.add_parser("build")
    p.add_argument("--landing")
    p.add_argument("--file", action="append", help=file_help)
    p.add_argument("--bronze", help="read landed bronze tables instead of the CSV landing folder")
    p.add_argument("--out", required=True)
    p.add_argument("--buckets", type=int, default=0,
                   help="bucket order-grain tables by order_key (off by default: see run_pipeline)")
    p.add_argument("--no-gate", action="store_true")
    p.add_argument("--parallel", type=int, default=4, help="write jobs of one layer submitted at once")
    p = sub.add_parser("check")
    p.add_argument("--out", required=True)
    p = sub.add_parser("vacuum")
    p.add_argument("--out", required=True)
    p.add_argument("--keep", type=int, default=2, help="commits whose tables stay")
    p = sub.add_parser("scenario")
    p.add_argument("--out", required=True)
    p.add_argument("--states", nargs="*", default=None)
    p.add_argument("--max-days", type=int, default=30)
    p.add_argument("--top", type=int, default=5)
    args = parser.parse_args(argv)

    spark = _session(args)
    if args.command == "ingest":
        manifest = ingest_bronze(spark, args.landing, args.bronze, _files(args))
        manifest.show(truncate=False)
        return 0 if manifest.filter("status != 'succeeded'").isEmpty() else 1
    if args.command == "land":
        from marketlake.streaming import land_new_files
        files = _files(args)
        for name in SOURCES:
            print(name, land_new_files(spark, args.landing, args.bronze, name, pattern=files.get(name)))
        return 0
    if args.command == "sync":
        report = land_changed(spark, args.landing, args.bronze, _files(args)).cache()
        report.groupBy("source", "state").count().orderBy("source", "state").show(100, truncate=False)
        report.where("error is not null").show(100, truncate=False)
        return 0 if report.where("state = 'failed'").isEmpty() else 1
    if args.command == "build":
        if not (args.landing or args.bronze):
            parser.error("build needs --landing or --bronze")
        tables = run_pipeline(spark, _bronze(spark, args), args.out, buckets=args.buckets,
                              gate=not args.no_gate, parallel=args.parallel)
        tables["quality_report"].filter("violations > 0").show(100, truncate=False)
        return 0
    if args.command == "check":
        names = [*STAGING, *CORE, *GOLD]
        tables = _published(spark, args.out, names)
        report = run_checks(tables)
        report.filter("violations > 0").show(100, truncate=False)
        assert_passed(report)
        return 0
    if args.command == "vacuum":
        for name in Lake(spark, args.out).vacuum(args.keep):
            print(name)
        return 0
    if args.command == "scenario":
        from marketlake.plans import scenario
        executive, routes = _published(spark, args.out, ["gold_executive_overview", "gold_spatial_routing"]).values()
        filtered = scenario.scenario_filter(executive, args.states, args.max_days)
        selected = scenario.filter_routes(routes, args.states)
        for title, df in (("kpis", scenario.scenario_kpis(filtered)),
                          ("lead time histogram", scenario.lead_time_histogram(filtered)
                           .orderBy("series", "bin_index")),
                          ("hub load", scenario.hub_load(filtered)),
                          ("top corridors", scenario.corridor_display(
                              scenario.corridor_top_k(filtered, selected, args.top))),
                          ("map centre", scenario.route_centroid(
                              selected, selected_states=len(args.states) if args.states else None))):
            print(f"== {title}")
            df.show(max(args.top, 100), truncate=False)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
