"""Command line: ``python -m pricelake.cli <job> ...`` (or through spark-submit).

Jobs
  process   landed raw CSV -> cleaned Parquet table partitioned by year/state
  analyze   processed table -> one result table per market question
  ingest    incremental version of ``process`` (Structured Streaming, availableNow)
  pages     API page files (JSON) -> landed raw CSV by state, resumable through a manifest
  map       regional map from written results and region shapes
  sql       one SQL query over the processed table (view price_records)
  inventory file count and bytes per landing partition, optionally against another root
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from pyspark.sql import SparkSession

from pricelake.constants import MSP_2024
from pricelake.plans.analyze import run_analyze, run_region_map, run_sql
from pricelake.plans.landing import land_pages
from pricelake.plans.process import run_process
from pricelake.schema import Config
from pricelake.session import build_session, clear_scratch, scale_conf
from pricelake.sources.inventory import compare_inventories, inventory_totals, landing_inventory
from pricelake.sources.pages import dry_run, read_pages
from pricelake.sources.parquet import read_processed, sample_records, write_processed
from pricelake.sources.results import read_result_csv, write_result_csv
from pricelake.streaming.landing import run_clean_stream


def _config(args) -> Config:
    kw = {}
    if args.min_year is not None:
        kw["min_year"] = args.min_year
    if args.max_year is not None:
        kw["max_year"] = args.max_year
    return Config(**kw)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="pricelake")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit / environment)")
    p.add_argument("--min-year", type=int, default=None)
    p.add_argument("--max-year", type=int, default=None)
    p.add_argument("--input-gb", type=float, default=None, help="input size; sizes scan splits and shuffle width")
    sub = p.add_subparsers(dest="job", required=True)

    pr = sub.add_parser("process")
    pr.add_argument("--raw", required=True)
    pr.add_argument("--out", required=True)
    pr.add_argument("--quarantine", default=None)
    pr.add_argument("--sample", type=float, default=None, help="seeded random share of the raw rows (0 to 1); written to <out>_sample")
    pr.add_argument("--dynamic-overwrite", action="store_true")

    an = sub.add_parser("analyze")
    an.add_argument("--processed", required=True)
    an.add_argument("--results", required=True)
    an.add_argument("--geojson", default=None)
    an.add_argument("--msp", action="store_true", help="also run the minimum-support-price reports")
    an.add_argument("--sample", action="store_true", help="1%% Bernoulli sample (seed 42); results to <results>_sample")

    ig = sub.add_parser("ingest")
    ig.add_argument("--landing", required=True)
    ig.add_argument("--out", required=True)
    ig.add_argument("--checkpoint", required=True)
    ig.add_argument("--max-files-per-trigger", type=int, default=None)
    ig.add_argument("--quarantine", default=None)

    pg = sub.add_parser("pages")
    pg.add_argument("--pages", required=True)
    pg.add_argument("--landing", default=None)
    pg.add_argument("--manifest", default=None, help="table of finished partitions (default: <landing>_manifest)")
    pg.add_argument("--quarantine", default=None, help="pages that do not parse (default: <landing>_bad_pages)")
    pg.add_argument("--state", default=None, help="land this state only")
    pg.add_argument("--lines", action="store_true", help="a file holds one page per line (default: a file is one page)")
    pg.add_argument("--dry-run", action="store_true", help="print the first record's fields, write nothing")

    mp = sub.add_parser("map")
    mp.add_argument("--results", required=True)
    mp.add_argument("--geojson", required=True)

    sq = sub.add_parser("sql")
    sq.add_argument("--processed", required=True)
    sq.add_argument("--query", required=True)
    sq.add_argument("--out", required=True)

    iv = sub.add_parser("inventory")
    iv.add_argument("--root", required=True)
    iv.add_argument("--against", default=None, help="another root; the table then has both sides and whether they match")
    iv.add_argument("--out", required=True, help="CSV table with every partition")

    args = p.parse_args(argv)
    owns_session = SparkSession.getActiveSession() is None
    extra = None
    if args.input_gb:
        read = int(args.input_gb * (1 << 30))
        # The market questions shuffle rows aggregated before the shuffle, far fewer than they read.
        extra = scale_conf(read, read // 100 if args.job in ("analyze", "map", "sql") else read)
    spark = build_session(args.master, app_name=f"pricelake-{args.job}", extra_conf=extra)
    cfg = _config(args)

    if args.job == "process":
        out = args.out + "_sample" if args.sample else args.out  # a smoke run never replaces the full table
        res = run_process(spark, args.raw, out, cfg, args.quarantine, args.sample, dynamic_overwrite=args.dynamic_overwrite)
        print(json.dumps({"processed": out, **res.metrics, "dropped_pct": round(res.dropped_pct, 1)}))
    elif args.job == "analyze":
        processed, results = args.processed, args.results
        if args.sample:
            full = read_processed(spark, processed)
            processed = processed.rstrip("/") + "_analyze_sample"
            write_processed(sample_records(full), processed)
            results = results.rstrip("/") + "_sample"
        out = run_analyze(spark, processed, results, cfg, args.geojson, MSP_2024 if args.msp else None)
        print(json.dumps(out))
    elif args.job == "map":
        print(json.dumps(run_region_map(spark, args.results, args.geojson)))
    elif args.job == "sql":
        run_sql(spark, args.processed, args.query, args.out)
    elif args.job == "ingest":
        audit = run_clean_stream(
            spark, args.landing, args.out, args.checkpoint, cfg, max_files_per_trigger=args.max_files_per_trigger, quarantine=args.quarantine
        )
        print(json.dumps({"processed": args.out, **audit}))
    elif args.job == "pages" and (args.dry_run or not args.landing):
        dry_run(read_pages(spark, args.pages, args.lines)).show(truncate=False)
    elif args.job == "pages":
        base = args.landing.rstrip("/")
        landed = land_pages(
            spark,
            args.pages,
            base,
            args.manifest or f"{base}_manifest",
            args.quarantine or f"{base}_bad_pages",
            only=args.state,
            one_per_line=args.lines,
        )
        print(json.dumps(asdict(landed)))
    elif args.job == "inventory":
        found = landing_inventory(spark, args.root)
        if args.against:
            found = compare_inventories(landing_inventory(spark, args.against), found)
        write_result_csv(found, args.out)
        totals = inventory_totals(landing_inventory(spark, args.root)).first().asDict()
        if args.against:
            totals["mismatches"] = read_result_csv(spark, args.out).filter("not matches").count()
        print(json.dumps(totals))
    if owns_session:
        clear_scratch(spark)
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
