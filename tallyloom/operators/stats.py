"""Channel statistics: counters kept per statistic id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.keys import statistic_key
from tallyloom.functions.numbers import add_counts
from tallyloom.functions.times import iso_utc


def with_statistic_id(rows: DataFrame, delimiter: str = "") -> DataFrame:
    """Log rows with the id of the statistic they count towards."""
    key = statistic_key(F.col("pn"), F.col("ch"), F.col("c"), F.col("appkey"), delimiter)
    return rows.withColumn("id", key)


def increments(rows: DataFrame, once: bool = False) -> DataFrame:
    """``id, news, starts`` to add: one per row, or one per id with ``once``.

    ``once`` is what a writer gets that reads the stored counter, adds one and lets the last
    write of an id win.
    """
    n = F.max(F.lit(1)).cast("long") if once else F.count("*")
    return rows.groupBy("id").agg(n.alias("news"), n.alias("starts"))


def incremented(rows: DataFrame, stored: DataFrame, once: bool = False) -> DataFrame:
    """New counter values ``id, news, starts`` for the ids in ``rows``, on top of stored ones."""
    old = stored.select("id", F.col("news").alias("_news"), F.col("starts").alias("_starts"))
    return (
        increments(rows, once)
        .join(old, "id", "left")
        .select(
            "id",
            add_counts(F.col("_news"), F.col("news")).alias("news"),
            add_counts(F.col("_starts"), F.col("starts")).alias("starts"),
        )
    )


# What a new statistic row holds apart from the fields of its first log row.
SEED_ZERO_COUNTS = ["actives", "day", "keep1", "keep3", "keep7", "keep30"]
SEED_ZERO_RATIOS = ["startAvg", "keep1Ratio", "keep3Ratio", "keep7Ratio", "keep30Ratio"]
SEED_ONES = ["news", "starts"]
SEED_EMPTY = ["agent", "channel_id", "source", "type"]


def seeds(rows: DataFrame) -> DataFrame:
    """The first statistic row of every id in ``rows``, described by its earliest log row."""
    fields = ["timestamp", "appkey", "ch", "c", "pn"]
    first = rows.groupBy("id").agg(F.min(F.struct(*fields)).alias("f")).select("id", "f.*")
    return first.select(
        "id",
        iso_utc(F.col("timestamp")).alias("@timestamp"),
        iso_utc(F.col("timestamp")).alias("create_time"),
        F.col("appkey").alias("app_id"),
        F.col("appkey").alias("app_key"),
        F.col("ch").alias("channel"),
        F.col("c").alias("country"),
        F.col("pn").alias("pkg_name"),
        *[F.lit(0).cast("long").alias(c) for c in SEED_ZERO_COUNTS],
        *[F.lit(0).cast("float").alias(c) for c in SEED_ZERO_RATIOS],
        *[F.lit(1).cast("long").alias(c) for c in SEED_ONES],
        *[F.lit("").alias(c) for c in SEED_EMPTY],
    )


def new_seeds(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Seed rows for the ids the statistics table does not have yet."""
    return seeds(rows).join(stored.select("id"), "id", "left_anti")
