"""New devices, launches, activity and retention.

Input rows have ``device_id`` and ``ts`` (a clock reading); ``by`` names more columns that the
measures are split by, such as app or channel. Every measure first reduces rows to one per device
and period with map-side combining, so a busy device or app costs no more than a quiet one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions.numbers import float_ratio
from tallyloom.operators.prefix import running_sum

# Days after which a device counts as kept.
KEEP_DAYS = (1, 3, 7, 30)


def _day(column: Column) -> Column:
    return column.cast("date")


def news(rows: DataFrame, by: list[str] = (), hourly: bool = False) -> DataFrame:
    """Devices seen for the first time, per day (and hour)."""
    first = rows.groupBy(*by, "device_id").agg(F.min("ts").alias("ts"))
    first = first.withColumn("day", _day(F.col("ts"))).withColumn("hour", F.hour("ts"))
    period = ["day", "hour"] if hourly else ["day"]
    return first.groupBy(*by, *period).agg(F.count("*").alias("news"))


def activity(rows: DataFrame, by: list[str] = (), hourly: bool = False) -> DataFrame:
    """Active devices and launches (rows), per day (and hour)."""
    periods = rows.withColumn("day", _day(F.col("ts"))).withColumn("hour", F.hour("ts"))
    period = ["day", "hour"] if hourly else ["day"]
    per_device = periods.groupBy(*by, *period, "device_id").agg(F.count("*").alias("_n"))
    return per_device.groupBy(*by, *period).agg(
        F.count("device_id").alias("actives"), F.sum("_n").alias("starts")
    )


def start_average(rows: DataFrame, by: list[str] = ()) -> DataFrame:
    """Launches per active device and day."""
    return activity(rows, by).withColumn(
        "start_avg", float_ratio(F.col("starts"), F.col("actives"))
    )


def running_total(rows: DataFrame, by: list[str] = ()) -> DataFrame:
    """Devices known by the end of each day. Day counts are added up, not rows: in a window per
    group, or without groups over ranges of days in many tasks."""
    counts = news(rows, by)
    if not by:
        return running_sum(counts, ["day"], F.col("news"), "total")
    order = W.partitionBy(*by).orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    return counts.withColumn("total", F.sum("news").over(order))


def retention(
    rows: DataFrame, by: list[str] = (), days: tuple[int, ...] = KEEP_DAYS
) -> DataFrame:
    """Per install day: new devices, those active again n days later, and the shares of both.

    A device's install day is the least of its active days, found in a window over its distinct
    days (as many rows as days, however many log rows it has).
    """
    active = rows.select(*by, "device_id", _day(F.col("ts")).alias("day")).distinct()
    device = W.partitionBy(*by, "device_id")
    aged = active.withColumn("install_day", F.min("day").over(device)).withColumn(
        "age", F.date_diff("day", "install_day")
    )
    kept = aged.groupBy(*by, "install_day").agg(
        F.count_if(F.col("age") == 0).alias("news"),
        *[F.count_if(F.col("age") == n).alias(f"keep_{n}") for n in days],
    )
    return kept.select(
        "*",
        *[float_ratio(F.col(f"keep_{n}"), F.col("news")).alias(f"keep_{n}_ratio") for n in days],
    )
