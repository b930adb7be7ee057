"""``spark-submit``-able entry point of the batch job."""

import argparse

from pyspark.sql import SparkSession

from incidentlens.operators.features import top_lines
from incidentlens.plans.job import AGGREGATED, run


def main() -> None:
    parser = argparse.ArgumentParser(prog="incidentlens", description=__doc__)
    parser.add_argument("--csv", required=True, nargs="+", help="delivered files or folders")
    parser.add_argument("--out", required=True, help="folder for all datasets")
    parser.add_argument(
        "--any-header", action="store_true", help="go by column position, whatever the header says"
    )
    parser.add_argument(
        "--resume", action="store_true", help="leave out the steps that a failed run has finished"
    )
    args = parser.parse_args()

    spark = SparkSession.builder.appName("incidentlens").getOrCreate()
    for name, report in run(
        spark, args.csv, args.out, not args.any_header, resume=args.resume
    ).items():
        print(name)
        report.show(truncate=False)
    top = spark.read.parquet(f"{args.out}/{AGGREGATED}/top10_precincts.parquet")
    top_lines(top).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
