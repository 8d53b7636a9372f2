"""Whole jobs over files: what a user runs from the command line or a notebook."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.keys import app_device_key
from tallyloom.operators import basics, devices, logs, ratings, stats
from tallyloom.session import scratch_scope, stage
from tallyloom.sources import files, schemas
from tallyloom.sources.keyed import KeyedTable
from tallyloom.sources.ledger import FileLedger, digest, list_files


def channel_tables(spark: SparkSession, store: str) -> dict[str, KeyedTable]:
    """The keyed tables of the channel log, kept below the folder ``store``."""
    return {
        "devices": KeyedTable(
            spark, "devices", schemas.DEVICES, f"{store}/devices", key="device_id",
            indexes=("imei", "mac"),
        ),
        "app_devices": KeyedTable(
            spark, "app_devices", schemas.APP_DEVICES, f"{store}/app_devices"
        ),
        "channel_statistics": KeyedTable(
            spark, "channel_statistics", schemas.CHANNEL_STATISTICS, f"{store}/channel_statistics"
        ),
    }


def channel_log(
    spark: SparkSession, path: str, store: str, batch: str | None = None
) -> dict[str, DataFrame]:
    """Load the log files of a folder that no batch has read yet: resolve devices, keep the three
    tables up to date, set aside bad lines.

    Every file belongs to one batch (see ``FileLedger``) and is counted once, however often the
    job is run and wherever it failed; a batch that was begun and not finished is taken up first.
    Without a ``batch`` id the new files name it. A known id that comes with new files, and a file
    that has changed since it was read, raise. Returns the tables and the malformed lines of the
    files read; only their parsed lines stay behind.
    """
    tables = channel_tables(spark, store)
    ledger = FileLedger(spark, f"{store}/files")
    for begun in ledger.unfinished(tables["channel_statistics"].batches()):
        _load_batch(spark, tables, ledger, begun)
    name = ledger.begin(list_files(spark, path), batch)
    malformed = _load_batch(spark, tables, ledger, name)
    return {"malformed": malformed, **{n: table.read() for n, table in tables.items()}}


def _load_batch(
    spark: SparkSession, tables: dict[str, KeyedTable], ledger: FileLedger, batch: str | None
) -> DataFrame:
    """Load the files of a begun batch and return its malformed lines (none without a batch).

    Lines are parsed once. Devices and app devices can be written again without harm.
    """
    mine = ledger.files_of(batch) if batch else ledger.read().limit(0)
    # The paths alone come to the driver, which lists them in any case to plan a scan.
    paths = [re.sub(r"([{}\[\]*?\\])", r"\\\1", row.path) for row in mine.select("path").collect()]
    lines = spark.read.text(paths) if paths else spark.createDataFrame([], "value string")
    parsed = stage(logs.parse_lines(lines), "parsed")
    if not paths:
        return logs.malformed(parsed)
    with scratch_scope(spark):
        rows = (
            logs.device_rows(logs.good_records(parsed))
            .withColumnsRenamed({"im": "imei", "ai": "android_id"})
            .withColumn("uuid", F.sha2(F.concat_ws("|", "imei", "mac", "timestamp", "ip"), 256))
        )
        # Only stored devices that share an identifier with the batch can matter to it.
        known = tables["devices"].matching("imei", rows).unionByName(
            tables["devices"].matching("mac", rows)
        )
        resolved = stage(devices.resolve_devices(rows, known), "resolved")
        attached = devices.attach_device(rows, resolved)
        attached = attached.withColumnsRenamed({"device_id": "deviceId"})
        counted = stats.increments(stats.with_statistic_id(rows))
        tables["devices"].upsert(devices.device_table_update(rows, resolved))
        tables["app_devices"].upsert(devices.app_devices(attached))
        tables["channel_statistics"].add(counted, batch, digest(mine))
    return logs.malformed(parsed)


def seed_new_devices(rows: DataFrame, apps: KeyedTable, statistics: KeyedTable) -> DataFrame:
    """Insert the app devices that are missing, then seed the statistics of those alone.

    ``rows`` are log rows with ``deviceId``. A statistic is seeded from the rows whose app device
    was new, and only if it has no row yet. Returns the statistics.
    """
    with scratch_scope(apps.spark):
        found = devices.app_devices(rows)
        new = stage(found.join(apps.read().select("id"), "id", "left_anti"), "new-apps")
        own = app_device_key(F.col("pn"), F.col("deviceId"))
        named = rows.withColumn("_app", own).join(
            new.select(F.col("id").alias("_app")).distinct(), "_app", "left_semi"
        )
        seeds = stage(stats.seeds(stats.with_statistic_id(named)), "seeds")
        statistics.insert_missing(seeds)
        # Last, so that a run that fails before it finds the same devices new again.
        apps.insert_missing(new)
        return statistics.read()


def top_lists(spark: SparkSession, ratings_path: str, users_path: str) -> dict[str, DataFrame]:
    """Best movies by mean rating, and the most active users overall and by gender."""
    rated, people = files.read_ratings(spark, ratings_path), files.read_users(spark, users_path)
    return {
        "movies_by_mean": ratings.top_movies_by_mean(rated),
        "users": ratings.top_users(rated),
        "users_by_gender": ratings.top_users_by_group(rated, people, ["F", "M"]),
    }


def popular_movies(
    spark: SparkSession, ratings_path: str, users_path: str, movies_path: str, gender: str, age: int
) -> DataFrame:
    """Movies rated most often by one gender and age code, with titles."""
    return ratings.top_movies_for_named(
        files.read_ratings(spark, ratings_path),
        files.read_users(spark, users_path),
        files.read_movies(spark, movies_path),
        gender,
        age,
    )


def audience(
    spark: SparkSession,
    ratings_path: str,
    users_path: str,
    movies_path: str,
    title: str,
    distinct: bool = False,
) -> DataFrame:
    """Who rated a movie, by gender and age."""
    profile = ratings.audience_profile_distinct if distinct else ratings.audience_profile
    return profile(
        files.read_ratings(spark, ratings_path),
        files.read_users(spark, users_path),
        files.read_movies(spark, movies_path),
        title,
    )


def words(spark: SparkSession, path: str) -> DataFrame:
    """Word counts of text files."""
    return basics.word_count(files.read_lines(spark, path))
