"""Command line of the batch jobs: ``python -m vacancia <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from vacancia.plans import jobs


def main() -> None:
    parser = argparse.ArgumentParser(prog="vacancia")
    commands = parser.add_subparsers(dest="job", required=True)

    def add(name, *arguments):
        command = commands.add_parser(name)
        for argument in arguments:
            command.add_argument(f"--{argument}", required=True)

    add("silver", "raw", "out", "stamp")
    add("master", "raw", "sources", "out")
    add("portal", "raw", "source", "out")
    add("gold", "silver", "out", "stamp")
    add("bi", "gold", "out")
    add("roles", "gold", "out")
    add("recommender", "gold", "out")
    add("advise", "gold", "models", "profiles", "out")
    for job in ("silver", "master", "portal"):
        commands.choices[job].add_argument(
            "--one-line-records", action="store_true", help="no field holds a line end: split large files")
    a = parser.parse_args()
    spark = SparkSession.builder.appName(f"vacancia-{a.job}").getOrCreate()
    if a.job == "silver":
        jobs.build_silver(spark, a.raw, a.out, a.stamp, not a.one_line_records)
    elif a.job == "master":
        jobs.build_master(spark, a.raw, a.sources.split(","), a.out, not a.one_line_records)
    elif a.job == "portal":
        jobs.build_portal_master(spark, a.raw, a.source, a.out, not a.one_line_records)
    elif a.job == "gold":
        jobs.build_gold(spark, a.silver, a.out, a.stamp)
    elif a.job == "bi":
        jobs.export_bi(spark, a.gold, a.out)
    elif a.job == "roles":
        jobs.train_roles(spark, a.gold, a.out)
    elif a.job == "recommender":
        jobs.train_recommender(spark, a.gold, a.out)
    else:
        jobs.advise(spark, a.gold, a.models, spark.read.parquet(a.profiles), a.out)


if __name__ == "__main__":
    main()
