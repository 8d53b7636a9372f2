"""Running sums and numbering in many tasks: sums of ranges, then of rows within a range."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stage


def running_sum(df: DataFrame, order: list[str], value: Column, made: str) -> DataFrame:
    """The rows with ``made``: the sum of ``value``, a long, over all rows up to each in the order.

    Rows are dealt into ranges of the order and written. Each range is summed; the sums, one per
    range, come to the driver and go back as what lies before it; within a range a window adds up.
    So no task sees more than a range. Rows that are equal in the order are in no certain order
    among themselves; a null value counts as 0.
    """
    spark = df.sparkSession
    ranged = stage(
        df.withColumn("_value", F.coalesce(value.cast("long"), F.lit(0)))
        .repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    sums = ranged.groupBy("_range").agg(F.sum("_value").alias("s")).orderBy("_range").collect()
    before = [0, *accumulate(row.s for row in sums)]
    ahead = spark.createDataFrame(
        [(row["_range"], b) for row, b in zip(sums, before)], "_range int, _ahead long"
    )
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.col("_ahead") + F.sum("_value").over(within)
    # One short row per range.
    return ranged.join(F.broadcast(ahead), "_range").select(*df.columns, total.alias(made))


def numbered(df: DataFrame, order: list[str], made: str = "number", start: int = 0) -> DataFrame:
    """The rows with consecutive numbers in the order, from ``start``."""
    counted = running_sum(df, order, F.lit(1), made)
    return counted.withColumn(made, F.col(made) - 1 + start)
