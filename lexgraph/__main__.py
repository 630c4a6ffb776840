"""Run a job: ``python -m lexgraph JOB name=value ...`` (or through spark-submit)."""

import sys

from pyspark.sql import SparkSession

from lexgraph.plans.jobs import JOBS


def main(args: list[str]) -> None:
    if not args or args[0] not in JOBS:
        sys.exit(f"usage: python -m lexgraph JOB name=value ...\njobs: {' '.join(JOBS)}")
    spark = SparkSession.builder.appName(f"lexgraph-{args[0]}").getOrCreate()
    JOBS[args[0]](spark, **dict(arg.split("=", 1) for arg in args[1:]))


if __name__ == "__main__":
    main(sys.argv[1:])
