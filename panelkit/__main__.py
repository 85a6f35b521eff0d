"""Command line: the reference's runnable jobs.

    python -m panelkit pipeline RAW_CSV OUT_DIR [--on-fail warn|raise] [--indicators 'raw/worldbank_*.csv']
    python -m panelkit ingest LANDING_DIR OUT_DIR [CODE=NAME ...]   (default: the reference's 4; run
        again, it takes in what has landed since)
    python -m panelkit catalog FOLDER [--pattern '*.csv']

Run under spark-submit on a cluster (``spark.checkpoint.dir`` must name a
shared folder there), or locally with ``--master local[*]``.
"""

from __future__ import annotations

import argparse
import json

from panelkit.session import get_spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="panelkit")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("pipeline", help="extract, transform, check, publish (X5)")
    p.add_argument("raw_csv")
    p.add_argument("out_dir")
    p.add_argument("--on-fail", default="warn", choices=["warn", "raise"])
    p.add_argument("--indicators", help="pattern of downloaded indicator CSVs to load and report")
    i = sub.add_parser("ingest", help="payload landing folder -> tidy table + catalog (X13)")
    i.add_argument("landing_dir")
    i.add_argument("out_dir")
    i.add_argument("names", nargs="*", help="indicator CODE=name pairs (default: the "
                   "reference's four indicators)")
    i.add_argument("--lines", action="store_true",
                   help="one payload per line instead of one per file")
    i.add_argument("--skip-broken", action="store_true", help="set unreadable payloads and rows aside instead of failing")
    c = sub.add_parser("catalog", help="file catalog of a folder (S12) with totals (A19)")
    c.add_argument("folder")
    c.add_argument("--pattern", default="*.csv")
    args = ap.parse_args(argv)

    spark = get_spark(args.master)
    if args.cmd == "pipeline":
        from panelkit.plans.pipeline import run_pipeline
        res = run_pipeline(spark, args.raw_csv, args.out_dir, on_fail=args.on_fail, indicators=args.indicators)
        print(json.dumps(res, default=str))
        return 0 if res["success"] else 1
    if args.cmd == "ingest":
        from panelkit.plans.pipeline import ingest_indicators
        from panelkit.spec import REFERENCE_INDICATORS
        names = dict(x.split("=", 1) for x in args.names) or REFERENCE_INDICATORS
        catalog = ingest_indicators(spark, args.landing_dir, args.out_dir, names,
                                    wholetext=not args.lines, on_broken="skip" if args.skip_broken else "fail")
        print(f"catalogued {catalog.count()} files under {args.out_dir}")
        return 0
    from panelkit.sources.catalog import catalog_totals, data_catalog
    cat = data_catalog(spark, args.folder, args.pattern)
    cat.drop("path").orderBy("filename").show(truncate=False)  # a listing: one row per file
    catalog_totals(cat).show()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
