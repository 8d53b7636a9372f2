"""Pages of a long sorted table by the last key seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows that one range of the layout is planned for, and rows that one file is. Dealing rows into files
# brings sampled keys of each to the driver, so short ranges share a file.
RANGE_ROWS = 1_000_000
FILE_ROWS = 1_000_000


class Pages:
    """Rows laid out in ranges of the sort columns, each sorted, beside a table of the ranges.

    A page after a key reads the range the key lies in and as many more as the page needs. Sort
    columns are ascending, not null, and name a row together. A file holds ranges one after the
    other, and their numbers tell its row groups apart.
    """

    def __init__(self, spark: SparkSession, folder: str, order: list[str], rows_per_range: int = RANGE_ROWS):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.order = order
        self.rows_per_range = rows_per_range

    def write(self, df: DataFrame) -> None:
        """Lay out the rows, in place of any that were there."""
        files = -(-max(1, df.count()) // max(self.rows_per_range, FILE_ROWS))
        # The lower bits of these ids number the rows of a partition in its order.
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        (
            df.repartitionByRange(files, *self.order)
            .withColumn("_file", F.spark_partition_id())
            .sortWithinPartitions("_file", *self.order)
            .withColumn("_range", F.floor(place / self.rows_per_range))
            .write.mode("overwrite")
            .partitionBy("_file")
            .parquet(f"{self.folder}/rows")
        )
        key = F.struct(*self.order)
        rows = self.spark.read.parquet(f"{self.folder}/rows")
        rows.groupBy("_file", "_range").agg(F.max(key).alias("most"), F.count("*").alias("n")).write.mode(
            "overwrite"
        ).parquet(f"{self.folder}/ranges")

    def _after(self, last: tuple) -> Column:
        """Whether a row lies after a key: later in the first column, or equal there and so on."""
        later = F.lit(False)
        for column, value in reversed(list(zip(self.order, last))):
            later = (F.col(column) > F.lit(value)) | ((F.col(column) == F.lit(value)) & later)
        return later & (F.col(self.order[0]) >= F.lit(last[0]))

    def page(self, size: int = 10, after: tuple | None = None) -> DataFrame:
        """The next rows in order: the first ones, or those after the key of the last row seen."""
        ranges = self.spark.read.parquet(f"{self.folder}/ranges").orderBy("_file", "_range")
        if after is not None:
            key = F.struct(*[F.lit(v).alias(c) for c, v in zip(self.order, after)])
            ranges = ranges.filter(F.col("most") > key)
        # The first of them may have been shown but for a row, so its rows are not counted on.
        picked, held = [], 0
        for row in ranges.limit(size + 1).collect():
            picked.append(row)
            held += row["n"] if picked[1:] or after is None else 1
            if held >= size:
                break
        there = F.lit(False)
        for file in sorted({row["_file"] for row in picked}):
            numbers = [row["_range"] for row in picked if row["_file"] == file]
            there |= (F.col("_file") == file) & F.col("_range").between(min(numbers), max(numbers))
        rows = self.spark.read.parquet(f"{self.folder}/rows").filter(there)
        if after is not None:
            rows = rows.filter(self._after(after))
        return rows.drop("_file", "_range").orderBy(*self.order).limit(size)
