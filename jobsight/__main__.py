"""Command line: run the daily load, or write the marts.

    python -m jobsight load  --pages <landing dir> [--as-of 2023-11-01] [--root <dir>] [--search] [--lenient]
                             [--multiline] [--landing-date date] [--allow-duplicates]
    python -m jobsight marts --out <dir> [--root <dir>]
    python -m jobsight sql "SELECT * FROM data_mart.de_region" [--out <dir>] [--root <dir>]
    python -m jobsight verify [--root <dir>]
    python -m jobsight stream --landing <dir> [--root <dir>] [--max-files 100] [--lenient] [--search]
                             [--as-of-now]

``--root`` defaults to the setting ``spark.jobsight.warehouse``. Submit with ``spark-submit -m jobsight`` or run under a
configured ``SPARK_HOME``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from jobsight.functions.classify import SEARCH_PHRASES
from jobsight.plans import daily_load
from jobsight.session import build_session
from jobsight.sources.pages import read_pages


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="jobsight")
    sub = parser.add_subparsers(dest="cmd", required=True)
    load = sub.add_parser("load", help="load landed pages into staging, dimensions and fact")
    load.add_argument("--pages", required=True)
    load.add_argument("--as-of", default=None, help="run date ending the lookback window (default: none)")
    load.add_argument("--root", default=None)
    load.add_argument("--search", action="store_true", help="repeat the source's title search on the landed items")
    load.add_argument("--landing-date", default=None, help="folder column of the landing dates, to skip old folders")
    load.add_argument("--allow-duplicates", action="store_true", help="accept differing rows of one key")
    load.add_argument("--lenient", action="store_true", help="load items that lack required keys")
    load.add_argument("--multiline", action="store_true", help="one JSON document per file (not JSON lines)")
    marts = sub.add_parser("marts", help="write the seven marts as Parquet")
    marts.add_argument("--out", required=True)
    marts.add_argument("--root", default=None)
    sql = sub.add_parser("sql", help="run SQL over staging.*, settings.*, core.* and data_mart.* tables")
    sql.add_argument("statement")
    sql.add_argument("--out", default=None, help="write the result as Parquet (default: show the first rows)")
    sql.add_argument("--root", default=None)
    verify = sub.add_parser("verify", help="unique and foreign-key checks over the stored star (JSON report)")
    verify.add_argument("--root", default=None)
    stream = sub.add_parser("stream", help="load every page landed since the last run (AvailableNow), then stop")
    stream.add_argument("--landing", required=True)
    stream.add_argument("--root", default=None)
    stream.add_argument("--max-files", type=int, default=None, help="files per micro-batch (bounds one load)")
    stream.add_argument("--as-of-now", action="store_true", help="end each load's lookback window at its start")
    stream.add_argument("--search", action="store_true")
    stream.add_argument("--lenient", action="store_true")
    args = parser.parse_args(argv)

    spark = build_session()
    if args.cmd == "load":
        daily_load.load(
            spark,
            read_pages(spark, args.pages, multiline=args.multiline),
            root=args.root,
            as_of=args.as_of,
            phrases=SEARCH_PHRASES if args.search else None,
            landing_date=args.landing_date,
            strict=not args.lenient,
            on_duplicate="allow" if args.allow_duplicates else "error",
        )
    elif args.cmd == "stream":
        from jobsight.streaming.landing import start_landing_ingest

        query = start_landing_ingest(
            spark,
            args.landing,
            root=args.root,
            max_files_per_trigger=args.max_files,
            as_of=(lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) if args.as_of_now else None,
            phrases=SEARCH_PHRASES if args.search else None,
            strict=not args.lenient,
        )
        query.awaitTermination()
        if query.exception() is not None:
            raise SystemExit(str(query.exception()))
    elif args.cmd == "verify":
        report = daily_load.verify(spark, args.root)
        print(json.dumps(report))
        if any(report.values()):
            raise SystemExit(1)
    elif args.cmd == "marts":
        for view, df in daily_load.marts(spark, args.root).items():
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{view}")
    else:
        daily_load.register_tables(spark, args.root, with_marts="data_mart." in args.statement)
        result = spark.sql(args.statement)
        if args.out:
            result.write.mode("overwrite").parquet(args.out)
        else:
            result.show(truncate=False)


if __name__ == "__main__":
    main()
