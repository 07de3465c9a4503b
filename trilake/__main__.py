"""Command line for the lake jobs (same parameters as the reference's jobs).

    python -m trilake raw-to-trusted   --raw-prefix R --trusted-prefix T [--code COP] [--buckets N]
    python -m trilake trusted-to-curated --trusted-prefix T --curated-prefix C
                                       [--sample-size 2000] [--decade-from 1980] [--min-dir-movies 3]
    python -m trilake sql-questions    --trusted-prefix T [--code COP] [--out-prefix O]
    python -m trilake incremental      --raw-prefix R --table movies --out-prefix O
    python -m trilake land             --source FILE --raw-prefix R --name exchange [--format json]

On a cluster run it through spark-submit; the session settings of the submitter win
(no master is forced unless ``--master`` is given).
"""

from __future__ import annotations

import argparse
import json

from trilake.plans import questions as Q
from trilake.session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m trilake")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    a = sub.add_parser("raw-to-trusted")
    a.add_argument("--raw-prefix", required=True)
    a.add_argument("--trusted-prefix", required=True)
    a.add_argument("--code", default="COP")
    a.add_argument("--fx-mode", choices=("highest", "latest"), default="highest")
    a.add_argument("--on-missing", choices=("identity", "null"), default="identity")
    a.add_argument("--buckets", type=int, default=None)
    a.add_argument("--no-header-safe", action="store_true")
    a.add_argument("--quarantine", action="store_true", help="keep refused rows with their reasons")

    c = sub.add_parser("trusted-to-curated")
    c.add_argument("--trusted-prefix", required=True)
    c.add_argument("--curated-prefix", required=True)
    c.add_argument("--sample-size", type=int, default=Q.SAMPLE_SIZE)
    c.add_argument("--decade-from", type=int, default=Q.DECADE_FROM)
    c.add_argument("--min-dir-movies", type=int, default=Q.MIN_DIR_MOVIES)
    c.add_argument("--sample-mode", choices=("bernoulli", "hash"), default="bernoulli")
    c.add_argument("--preview", action="store_true")

    s = sub.add_parser("sql-questions")
    s.add_argument("--trusted-prefix", required=True)
    s.add_argument("--code", default="COP")
    s.add_argument("--out-prefix", default=None, help="write each answer as Parquet; else show it")

    i = sub.add_parser("incremental")
    i.add_argument("--raw-prefix", required=True)
    i.add_argument("--table", choices=("movies", "tv_shows", "people", "movie_reviews", "exchange"), required=True)
    i.add_argument("--out-prefix", required=True, help="the keyed current table and the checkpoint go here")
    i.add_argument("--buckets", type=int, default=64)
    i.add_argument("--no-export", dest="export", action="store_false", help="do not write a plain copy of the current table")

    g = sub.add_parser("land")
    g.add_argument("--source", required=True)
    g.add_argument("--raw-prefix", required=True)
    g.add_argument("--name", required=True)
    g.add_argument("--format", choices=("csv", "json"), default="csv",
                   help="json: a rates document {base, date, rates}")
    g.add_argument("--run-ts", default=None)
    return p


def main(argv=None, stop: bool = True) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(args.master)
    if args.cmd == "raw-to-trusted":
        from trilake.plans.trusted import raw_to_trusted
        out = raw_to_trusted(spark, args.raw_prefix, args.trusted_prefix, code=args.code,
                             fx_mode=args.fx_mode, on_missing=args.on_missing,
                             header_safe=not args.no_header_safe, buckets=args.buckets,
                             quarantine=args.quarantine)
    elif args.cmd == "trusted-to-curated":
        from trilake.plans.curated import trusted_to_curated
        out = trusted_to_curated(spark, args.trusted_prefix, args.curated_prefix, preview=args.preview,
                                 sample_size=args.sample_size, decade_from=args.decade_from,
                                 min_dir_movies=args.min_dir_movies, sample_mode=args.sample_mode)
    elif args.cmd == "sql-questions":
        from trilake.plans.curated import sql_questions
        from trilake.sources.parquet import show_top, write_table
        answers = sql_questions(spark, args.trusted_prefix, code=args.code)
        out = {}
        for name, df in answers.items():
            if args.out_prefix:
                out[name] = write_table(df, args.out_prefix, name)
            else:
                show_top(df, 25, name)
    elif args.cmd == "incremental":
        from trilake.sources.parquet import write_table
        from trilake.streaming.incremental import incremental_trusted, lake_table
        base = args.out_prefix.rstrip("/")
        table = incremental_trusted(spark, f"{args.raw_prefix.rstrip('/')}/{args.table}", args.table,
                                    f"{base}/keyed", f"{base}/checkpoint", buckets=args.buckets)
        out = {args.table: write_table(table, base, "current") if args.export else table.count(),
               "version": lake_table(spark, args.table, f"{base}/keyed").version().number}
    else:
        from trilake.sources.raw_csv import CSV_OPTIONS, land_raw
        from trilake.sources.rates import read_rates_json
        if args.format == "json":
            df = read_rates_json(spark, args.source)
        else:
            df = spark.read.options(**CSV_OPTIONS).csv(args.source)
        out = {args.name: land_raw(df, args.raw_prefix, args.name, args.run_ts)}
    print(json.dumps(out, default=str))
    if stop:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
