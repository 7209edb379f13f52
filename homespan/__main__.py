"""Run the pipeline on landed files and show its reports: ``spark-submit`` or ``python -m homespan``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from homespan.config import MarketSettings, PipelinePaths
from homespan.plans.pipeline import run_pipeline
from homespan.plans.standard import REPORT_ORDERS, market_reports, place_reports
from homespan.sources.versions import replace_table


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="homespan", description=__doc__)
    parser.add_argument("--feeds", required=True, help="folder of the delimited market feeds")
    parser.add_argument("--census", required=True, help="folder of the place payloads")
    parser.add_argument("--labour", required=True, help="folder of the labour payloads")
    parser.add_argument("--warehouse", required=True, help="folder for the layer tables")
    parser.add_argument("--format", default="parquet", help="table format, such as parquet or delta")
    parser.add_argument("--report", action="append", default=[], help="report to show; may be repeated")
    parser.add_argument("--rows", type=int, default=50, help="rows of each report to show")
    parser.add_argument("--report-tables", help="folder to write the named reports to, whole, as tables")
    parser.add_argument("--allowed-rejects", type=int, help="unusable payloads allowed in each landing folder; any number if not given")
    parser.add_argument("--gold-view", help="name of a catalog view over gold")
    parser.add_argument("--resume", action="store_true", help="take over the finished stages of a run that failed")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("homespan").config("spark.scheduler.mode", "FAIR").getOrCreate()
    settings = MarketSettings(allowed_rejects=args.allowed_rejects, gold_view=args.gold_view)
    paths = PipelinePaths(args.feeds, args.census, args.labour, args.warehouse, args.format)
    done = run_pipeline(spark, settings, paths, args.resume)
    for name, stage in done.items():
        print(f"{name}: {stage.written.rows} rows in {stage.written.path}")
    gold, labour = done["gold"].table, done["labour"].table
    reports = market_reports(gold, labour, settings)
    reports |= place_reports(done["census"].table, done["ranking"].table, settings)
    for name in args.report:
        reports[name].show(args.rows, truncate=False)
        if args.report_tables:
            replace_table(reports[name], f"{args.report_tables}/{name}", args.format, order_by=REPORT_ORDERS.get(name, ()))


if __name__ == "__main__":
    main()
