"""Distinct devices over stored days, as exact bitmaps of numbered devices.

Each device of a group (an app, a channel) gets a number once. A day is stored as bitmaps of the
numbers active on it, and as bitmaps of those first seen on it; one row holds 32,768 numbers. Any
span of days is counted by or-ing stored days, retention by and-ing two, and a new day reads no
log row of an older one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.numbers import float_ratio
from tallyloom.operators.activity import KEEP_DAYS
from tallyloom.operators.prefix import numbered
from tallyloom.session import scratch_scope, stage
from tallyloom.sources.keyed import KeyedTable


class DeviceDays:
    """Days of activity in a folder: ``numbers`` of the devices and ``days`` of bitmaps.

    ``by`` are text columns that the measures are split by. Days are added in order, each once or
    again as a whole; adding the newest day again gives the same.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, by: list[str] = ()):
        self.spark = spark
        self.by = list(by)
        self.folder = folder.rstrip("/")
        self.numbers = KeyedTable(
            spark, f"{name}_numbers", "id string, number long, first_day date", f"{folder}/numbers"
        )

    def _days(self) -> DataFrame:
        columns = ", ".join(f"`{c}` string" for c in self.by)
        schema = f"{columns + ', ' if columns else ''}kind string, bucket long, bits binary, starts long, day date"
        return self.spark.read.schema(schema).parquet(f"{self.folder}/days")

    def add_days(self, rows: DataFrame) -> None:
        """Add the days in ``rows`` (``device_id, ts`` and the ``by`` columns). Of older days only
        the numbers of the devices that are active now are looked up."""
        day = F.col("ts").cast("date").alias("day")
        # A device of a group by one text in which nothing can run together.
        whole = F.to_json(F.struct(*[F.col(c) for c in self.by], "device_id")).alias("id")
        with scratch_scope(self.spark):
            active = stage(
                rows.groupBy(*self.by, day, whole).agg(F.count("*").alias("starts")), "active"
            )
            first = active.groupBy("id").agg(F.min("day").alias("first_day"))
            held = stage(self.numbers.with_keys(stage(first.select("id"), "active-ids")), "numbers")
            new = first.join(held, "id", "left_anti")
            # Numbers are never given twice: the table grows by rows with consecutive numbers.
            start = self.numbers.read().agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0] + 1
            fresh = stage(numbered(new, ["first_day", "id"], start=start), "new-numbers")
            self.numbers.insert_missing(fresh)
            known = held.unionByName(fresh.select(*held.columns))
            at = active.join(known, "id")
            marked = at.select("*", F.lit("active").alias("kind")).unionByName(
                at.filter("day = first_day").select("*", F.lit("new").alias("kind"))
            )
            (
                marked.groupBy(
                    *self.by, "kind", "day", F.bitmap_bucket_number("number").alias("bucket")
                )
                .agg(
                    F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"),
                    F.sum("starts").alias("starts"),
                )
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("day")
                .parquet(f"{self.folder}/days")
            )

    def activity(self) -> DataFrame:
        """Active devices and launches per day."""
        return (
            self._days()
            .filter("kind = 'active'")
            .groupBy(*self.by, "day")
            .agg(
                F.sum(F.bitmap_count("bits")).alias("actives"), F.sum("starts").alias("starts")
            )
        )

    def active_between(self, first: str, last: str) -> DataFrame:
        """Distinct devices of a span of days, from the bitmaps of these days alone."""
        span = self._days().filter((F.col("kind") == "active") & F.col("day").between(first, last))
        joined = span.groupBy(*self.by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return joined.groupBy(*self.by).agg(F.sum(F.bitmap_count("bits")).alias("actives"))

    def retention(self, days: tuple[int, ...] = KEEP_DAYS) -> DataFrame:
        """Per install day: new devices, those active again n days later, and the shares of both."""
        stored = self._days()
        new = stored.filter("kind = 'new'").withColumnRenamed("day", "install_day")
        aged = new.select(
            *self.by, "bucket", "install_day", "bits",
            F.explode(F.array(*[F.lit(n) for n in (0, *days)])).alias("age"),
        ).withColumn("day", F.date_add("install_day", F.col("age")))
        later = stored.filter("kind = 'active'").select(
            *self.by, "bucket", "day", F.col("bits").alias("later")
        )
        keys = [*self.by, "bucket", "day"]
        same = [aged[c].eqNullSafe(later[c]) for c in keys]
        pairs = aged.join(later, same).select(
            *[aged[c] for c in self.by], "install_day", "age", aged["bucket"],
            F.explode(F.array("bits", "later")).alias("bits"),
        )
        both = pairs.groupBy(*self.by, "install_day", "age", "bucket").agg(
            F.bitmap_and_agg("bits").alias("bits")
        )
        n = F.bitmap_count("bits")

        def kept(age: int):
            return F.coalesce(F.sum(F.when(F.col("age") == age, n)), F.lit(0))

        counts = both.groupBy(*self.by, "install_day").agg(
            kept(0).alias("news"), *[kept(d).alias(f"keep_{d}") for d in days]
        )
        return counts.select(
            "*",
            *[float_ratio(F.col(f"keep_{d}"), F.col("news")).alias(f"keep_{d}_ratio") for d in days],
        )
