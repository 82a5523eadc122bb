"""Run a build as a Spark job: ``spark-submit ... starwright/__main__.py lake ...``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from starwright.plans import incremental, lake, lookups, reviews, upserts, warehouse
from starwright.session import prepare
from starwright.sinks.tables import create_database


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starwright")
    parser.add_argument("--input-bytes", type=int, help="size of the input, to size shuffles")
    builds = parser.add_subparsers(dest="build", required=True)

    def build(name: str, *paths: str) -> argparse.ArgumentParser:
        options = builds.add_parser(name)
        for path in paths:
            options.add_argument(f"--{path}", required=True)
        return options

    build("lake", "songs", "log", "output")
    build("warehouse", "songs", "log", "database").add_argument("--location")
    build("upserts", "songs", "log", "database").add_argument("--location")
    scheduled = build("incremental", "songs", "log", "database")
    scheduled.add_argument("--location")
    scheduled.add_argument("--execution-date", type=date.fromisoformat, required=True)
    scheduled.add_argument("--repeatable", action="store_true")
    build("lookups", "csv", "output")
    documents = build("reviews", "source", "output", "since")
    documents.add_argument("--as-of-year", type=int, default=date.today().year)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = prepare(SparkSession.builder.getOrCreate(), args.input_bytes)
    if getattr(args, "database", None):
        create_database(spark, args.database, args.location)
    if args.build == "lake":
        lake.build(spark, args.songs, args.log, args.output)
    elif args.build == "warehouse":
        warehouse.build(spark, args.database, args.songs, args.log)
    elif args.build == "upserts":
        upserts.build(spark, args.database, args.songs, args.log)
    elif args.build == "incremental":
        incremental.run(
            spark, args.database, args.songs, args.log, args.execution_date,
            repeatable=args.repeatable,
        )
    elif args.build == "lookups":
        lookups.build(spark, args.csv, args.output)
    else:
        reviews.build(spark, args.source, args.output, since=args.since, as_of_year=args.as_of_year)


if __name__ == "__main__":
    main()
