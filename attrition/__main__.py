"""Command line for the three jobs (spark-submit or `python -m attrition`).

    python -m attrition prepare --attribution db.events --hits db.hits --customers db.customers \
        --month 2023-09 --start 2023-09-01 --end 2023-09-15 --table db.features
    python -m attrition train --features db.features --model /shared/models/v1
    python -m attrition score --features db.features --model /shared/models/v1 --day 2023-09-15 \
        --table db.predictions

    python -m attrition prepare ... --trailing-days 2 --end 2023-09-15    # instead of --month and --start

The session comes from `SparkSession.builder.getOrCreate()`, so cluster
settings (including `spark.checkpoint.dir`) are the deployment's; the runtime
settings the plans rely on (`session.RECOMMENDED_CONF`) are applied to it.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="attrition")
    sub = ap.add_subparsers(dest="cmd", required=True)
    prep = sub.add_parser("prepare", help="build (or reuse) the feature partition of --end")
    prep.add_argument("--attribution", required=True)
    prep.add_argument("--hits", required=True)
    prep.add_argument("--customers", required=True)
    prep.add_argument("--month", default=None, help="install month, yyyy-MM")
    prep.add_argument("--start", default=None, help="first sampled install day")
    prep.add_argument("--end", default=None, help="last sampled install day, also the partition date (default with "
                                                  "--trailing-days: today)")
    prep.add_argument("--trailing-days", type=int, default=None, help="sample the last days up to --end")
    prep.add_argument("--as-of", default=None, help="day that ages are reckoned at (default: the day of the run)")
    prep.add_argument("--outliers", choices=("approx", "exact", "off"), default="approx")
    prep.add_argument("--vocab-table", default=None, help="table of the one-hot vocabulary (default: <table>_vocab)")
    prep.add_argument("--sketch-table", default=None, help="table of the sessions' quantile sketches by date; with it, outliers are "
                                                           "judged by the last --sketch-days dates")
    prep.add_argument("--sketch-days", type=int, default=30)
    prep.add_argument("--period-start", default=None, help="install period start (default: first day of --month)")
    prep.add_argument("--period-end", default=None, help="install period end (default: last day of --month)")
    prep.add_argument("--brand", required=True)
    prep.add_argument("--table", required=True)
    prep.add_argument("--path", default=None)
    tr = sub.add_parser("train", help="fit and save the model on a feature table")
    tr.add_argument("--features", required=True)
    tr.add_argument("--model", required=True)
    tr.add_argument("--trees", type=int, default=None)
    sc = sub.add_parser("score", help="score a feature table into a date partition")
    sc.add_argument("--features", required=True)
    sc.add_argument("--model", required=True)
    sc.add_argument("--day", required=True)
    sc.add_argument("--table", required=True)
    sc.add_argument("--path", default=None)
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    from attrition.config import ModelConfig, Params
    from attrition.plans import jobs
    from attrition.session import apply_recommended

    ap = parser()
    args = ap.parse_args(argv)
    if args.cmd == "prepare" and args.trailing_days is None and not (args.month and args.start and args.end):
        ap.error("prepare needs --month, --start and --end, or --trailing-days")
    spark = spark or SparkSession.builder.getOrCreate()
    apply_recommended(spark)
    if args.cmd == "prepare":
        kw = {"brand": args.brand, "as_of": args.as_of, "outliers": args.outliers}
        if args.trailing_days is not None:
            p = Params.for_trailing_days(args.end, args.trailing_days, **kw)
        else:
            p = Params.for_month(args.month, sample_start=args.start, sample_end=args.end, **kw)
        if args.period_start or args.period_end:
            p = p.with_(period_start=args.period_start or p.period_start, period_end=args.period_end or p.period_end)
        src = jobs.load_sources(spark, args.attribution, args.hits, args.customers)
        out = jobs.data_preparation(spark, src, p, table=args.table, path=args.path,
                                    vocab_table=args.vocab_table or f"{args.table}_vocab",
                                    sketch_table=args.sketch_table, sketch_days=args.sketch_days)
        print(f"{args.table}: {out.count()} feature rows for {p.sample_end}")
    elif args.cmd == "train":
        cfg = ModelConfig() if args.trees is None else ModelConfig(max_iter=args.trees)
        _, metrics = jobs.train_job(spark.table(args.features), cfg, model_path=args.model)
        print(metrics.first().asDict())
    else:
        out = jobs.score_job(spark.table(args.features), args.model, day=args.day, table=args.table, path=args.path)
        print(f"{args.table}: {out.count()} scores for {args.day}")


if __name__ == "__main__":
    main(sys.argv[1:])
