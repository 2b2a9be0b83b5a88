"""Command-line entry for ``spark-submit``.

    spark-submit -m dealhouse.cli refresh            # full: land CSVs, core, all fact years
    spark-submit -m dealhouse.cli incremental        # only when landing files changed
    spark-submit -m dealhouse.cli fact --years 2019 2020
    spark-submit -m dealhouse.cli stream --checkpoint <dir>
    spark-submit -m dealhouse.cli checks | export <dir> | reset

Reference tables of the checks are CSV sources in the landing folder's ``reference``; checks whose table
is not there are named as not run, and the exit status is 1.

Paths come from ``dealhouse.plans.config`` (profile and environment).
"""
from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from dealhouse.operators import staging as stg
from dealhouse.operators.quality import run_checks
from dealhouse.operators.rules import ALL_CHECKS
from dealhouse.plans import pipeline
from dealhouse.plans.config import open_warehouse
from dealhouse.session import apply_conf
from dealhouse.sources.csv import export_csv_with_manifest, scan_csv_strings, source_path


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="dealhouse")
    p.add_argument("command", choices=["refresh", "incremental", "fact", "stream", "checks", "export", "reset"])
    p.add_argument("target", nargs="?")
    p.add_argument("--years", type=int, nargs="*")
    p.add_argument("--checkpoint")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName("dealhouse").getOrCreate()
    apply_conf(spark)
    wh, cfg = open_warehouse(spark)
    run_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if args.command == "refresh":
        out = pipeline.land_csv_sources(wh, cfg.data_dir, list(stg.STAGERS))
        out.update(pipeline.refresh(wh, None, run_ts, args.years))
    elif args.command == "incremental":
        out = pipeline.incremental_refresh(wh, cfg.data_dir, run_ts, args.years)
    elif args.command == "fact":
        out = pipeline.refresh_fact(wh, run_ts, args.years)
    elif args.command == "stream":
        from dealhouse.streaming.ingest import stream_ingest
        out = {"batches": stream_ingest(wh, f"{cfg.data_dir}/transactions_incoming", args.checkpoint, run_ts)}
    elif args.command == "checks":
        tables = {n: wh.read("staging", n) for n in stg.STAGERS}
        for name in {c.ref_table for c in ALL_CHECKS.checks if getattr(c, "ref_table", None)} - set(tables):
            path = source_path(spark, f"{cfg.data_dir}/reference", name)
            if wh.exists_path(path):
                tables[name] = scan_csv_strings(spark, path)
        needed = lambda c: {c.table, getattr(c, "ref_table", None) or c.table}
        run = [c for c in ALL_CHECKS.checks if needed(c) <= set(tables)]
        out = {r["check_name"]: r["violations"] for r in run_checks(tables, run).collect()}
        # A check whose reference table is not loaded is an error that shows, not a check that passed.
        not_run = {c.name: f"not run: no table {', '.join(sorted(needed(c) - set(tables)))}"
                   for c in ALL_CHECKS.checks if c not in run}
        print(json.dumps({**out, **not_run}, default=str))
        return 1 if not_run else 0
    elif args.command == "export":
        tables = {"fct_transactions": pipeline.read_fact(wh),
                  "dim_acquirer_activity": wh.read("analytics", "dim_acquirer_activity"),
                  "rpt_sector_trend_summary": wh.read("analytics", "rpt_sector_trend_summary")
                  .orderBy("sector", "deal_year")}
        out = {r["table_name"]: r["row_count"] for r in
               export_csv_with_manifest(spark, tables, args.target).collect()}
    else:
        out = {"dropped": wh.reset_layers()}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
