"""Jobs from the command line: ``python -m tierline <job> --root <folder>``.

Also runs under ``spark-submit``. Without ``--root`` the root is taken from LAKEHOUSE_ROOT,
else ``data``.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from tierline.operators import forecast, retrieval
from tierline.plans import jobs, steps
from tierline.sources import snapshot_table
from tierline.sources.layout import Layout
from tierline.streaming import ingest


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tierline", description="Retail lakehouse jobs.")
    parser.add_argument("--root", help="folder that holds the tables")
    job = parser.add_subparsers(dest="job", required=True)
    bronze = job.add_parser("bronze", help="append raw CSV to Bronze")
    bronze.add_argument("--source", help="CSV file or folder")
    bronze.add_argument("--check-header", action="store_true", help="refuse unexpected columns")
    bronze.add_argument("--by-header", action="store_true", help="read each file by its own header")
    stream = job.add_parser("stream", help="append new CSV files to Bronze")
    stream.add_argument("--source", help="folder to watch")
    stream.add_argument("--continuous", action="store_true", help="run until stopped")
    silver = job.add_parser("silver", help="clean Bronze into Silver")
    silver.add_argument("--full", action="store_true", help="read all of Bronze again")
    job.add_parser("gold", help="rebuild the marts")
    job.add_parser("declared", help="build the layers by declared rules")
    upkeep = job.add_parser("maintain", help="compact, cluster and vacuum Silver")
    upkeep.add_argument("--retain-hours", type=float, default=168)
    train = job.add_parser("train", help="train the forecaster and record the run")
    train.add_argument("--trees", type=int, default=forecast.TREES)
    train.add_argument("--max-depth", type=int, default=forecast.MAX_DEPTH)
    train.add_argument("--cut", help="train on days before this date, test on the others")
    job.add_parser("register", help="make the best run the champion")
    job.add_parser("index", help="rebuild the customer index")
    ask = job.add_parser("ask", help="answer a question from the customer index")
    ask.add_argument("--question", default=retrieval.DEFAULT_QUESTION)
    ask.add_argument("-k", type=int, default=retrieval.TOP_K)
    return parser


def main(argv: list[str] | None = None) -> object:
    args = _parser().parse_args(argv)
    lake = Layout(args.root) if args.root else Layout.from_environment()
    spark = SparkSession.builder.appName(f"tierline-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if args.job == "bronze":
        return jobs.bronze_job(spark, lake, args.source, args.check_header, by_header=args.by_header)
    if args.job == "stream":
        stream = ingest.raw_stream(spark, args.source or lake.raw)
        query = ingest.start(stream, lake.bronze, lake.checkpoint("bronze"), not args.continuous)
        return query.awaitTermination()
    if args.job == "silver":
        return jobs.silver_job(spark, lake, args.full)
    if args.job == "gold":
        return jobs.gold_job(spark, lake)
    if args.job == "declared":
        return steps.declarative_job(spark, lake)
    if args.job == "maintain":
        return jobs.maintenance_job(spark, lake, args.retain_hours)
    if args.job == "train":
        daily = snapshot_table.read(spark, lake.daily_revenue)
        return forecast.train(daily, lake, args.trees, args.max_depth, args.cut)
    if args.job == "register":
        return forecast.register(spark, lake)
    if args.job == "index":
        ltv = snapshot_table.read(spark, lake.customer_ltv)
        return retrieval.build_index(ltv, lake.customer_index)
    return retrieval.ask(spark, lake.customer_index, args.question, args.k).first()["answer"]


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    result = main()
    if result is not None:
        print(result)
    sys.exit(0)
