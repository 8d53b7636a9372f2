"""Command line: ``python -m tallyloom JOB ...`` (or ``spark-submit``); prints the results."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tallyloom.plans import jobs
from tallyloom.session import configure


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyloom")
    sub = top.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        made = sub.add_parser(name)
        for path in paths:
            made.add_argument(f"--{path}", required=True)
        return made

    job("top-lists", "ratings", "users")
    popular = job("popular", "ratings", "users", "movies")
    popular.add_argument("--gender", default="M")
    popular.add_argument("--age", type=int, default=18)
    audience = job("audience", "ratings", "users", "movies", "title")
    audience.add_argument("--distinct", action="store_true")
    job("words", "path")
    channel = job("channel-log", "path", "store")
    channel.add_argument("--batch", help="id of the new files; by default the files name it")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    if args.job == "top-lists":
        return jobs.top_lists(spark, args.ratings, args.users)
    if args.job == "popular":
        found = jobs.popular_movies(
            spark, args.ratings, args.users, args.movies, args.gender, args.age
        )
        return {"popular": found}
    if args.job == "audience":
        found = jobs.audience(
            spark, args.ratings, args.users, args.movies, args.title, args.distinct
        )
        return {"audience": found}
    if args.job == "words":
        return {"words": jobs.words(spark, args.path)}
    return jobs.channel_log(spark, args.path, args.store, args.batch)


def main() -> None:
    args = parser().parse_args()
    spark = configure(SparkSession.builder.appName(f"tallyloom {args.job}").getOrCreate())
    for name, df in run(spark, args).items():
        print(name)
        df.printSchema()
        df.show(truncate=False)


if __name__ == "__main__":
    main()
