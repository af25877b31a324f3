"""``spark-submit`` entry: run the layers of one data type for a range of days."""

import argparse

from pyspark.sql import SparkSession

from viewstats.operators.search import MONTH_LABELS, MONTHS
from viewstats.plans.chain import Roots, retry, run


def main(argv=None):
    parser = argparse.ArgumentParser(prog="viewstats", description=__doc__)
    parser.add_argument("data_type", choices=["content", "search"])
    parser.add_argument("--mode", default="incremental", choices=["incremental", "date_range", "full"])
    parser.add_argument("--start")
    parser.add_argument("--end")
    parser.add_argument("--drop", help="folder with new day files to land first")
    parser.add_argument("--new-only", action="store_true",
                        help="land only days with dropped files that are new or changed")
    for layer in ("raw", "bronze", "silver", "gold"):
        parser.add_argument(f"--{layer}", required=True)
    parser.add_argument("--on-exceeded", default="raise", choices=["raise", "hold"])
    parser.add_argument("--on-failure", default="raise", choices=["raise", "hold"])
    parser.add_argument("--retry", action="store_true", help="run the days that the ledger has as failed")
    parser.add_argument("--ledger", help="table of failed days")
    parser.add_argument("--database", help="catalog database for views of the gold models")
    parser.add_argument("--activeness", default="as_of", choices=["as_of", "prior", "snapshot"])
    parser.add_argument("--months", nargs=2, default=MONTHS, metavar="yyyy-MM")
    parser.add_argument("--labels", nargs=2, default=MONTH_LABELS, help="names of the two months in columns")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"viewstats-{args.data_type}").getOrCreate()
    roots = Roots(args.raw, args.bronze, args.silver, args.gold, args.drop, args.ledger)
    options = {"on_exceeded": args.on_exceeded, "activeness": args.activeness, "months": tuple(args.months),
               "labels": tuple(args.labels), "database": args.database, "new_only": args.new_only}
    if args.retry:
        view = retry(spark, roots, args.data_type, **options)
    else:
        view = run(spark, roots, args.data_type, args.mode, args.start, args.end, on_failure=args.on_failure, **options)
    if view is None:
        print("no data for this range")
    else:
        view.show()


if __name__ == "__main__":
    main()
