"""Which files belong to which batch: a Parquet table, so that every file is counted once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "path string, length long, modified long"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modified`` of the files below a path; their contents are not read."""
    found = spark.read.format("binaryFile").load(path)
    return found.select("path", "length", F.unix_millis("modificationTime").alias("modified"))


def digest(files: DataFrame) -> str:
    """A text that names a set of files by place, length and time, in any order."""
    h = F.xxhash64("path", "length", "modified")
    found = files.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 24)).alias("s"))
    n, x, s = found.first()
    return f"{n} files {(x or 0) & (1 << 64) - 1:016x} {(s or 0) & (1 << 64) - 1:016x}"


class FileLedger:
    """Rows ``batch, path, length, modified``, written when a batch begins.

    Whether a batch is done is known where its counters are kept, so a job that failed between the
    two finds the batch begun and takes the same files up again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def read(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], f"batch string, {FILES}")
        return self.spark.read.schema(f"batch string, {FILES}").parquet(self.folder)

    def unfinished(self, done: DataFrame) -> list[str]:
        """Batches that were begun and are not among the ``batch`` rows of ``done``: one at most
        per run that failed."""
        left = self.read().join(done, "batch", "left_anti").select("batch").distinct()
        return sorted(row.batch for row in left.collect())

    def files_of(self, batch: str) -> DataFrame:
        return self.read().filter(F.col("batch") == batch).select("path", "length", "modified")

    def begin(self, listing: DataFrame, batch: str | None = None) -> str | None:
        """Enter the files of ``listing`` that belong to no batch yet, and return the batch.

        Without a name the batch is named by its files, and None is returned if there are no new
        ones. A named batch that was begun before must come with the same files, and a file that
        belongs to a batch must not have changed; either is an error, since counting it again or
        leaving it out would be wrong.
        """
        known = self.read()
        now = listing.withColumnsRenamed({"length": "_length", "modified": "_modified"})
        changed = known.join(now, "path").filter("length != _length OR modified != _modified")
        if (row := changed.first()) is not None:
            raise ValueError(f"{row.path} has changed since batch {row.batch!r} read it")
        fresh = listing.join(known, "path", "left_anti")
        if batch is None:
            if fresh.isEmpty():
                return None
            batch = digest(fresh)
        elif not known.filter(F.col("batch") == batch).isEmpty():
            if not fresh.isEmpty():
                raise ValueError(f"batch {batch!r} was begun without {fresh.first().path}")
            return batch
        fresh.select(F.lit(batch).alias("batch"), "path", "length", "modified").coalesce(1).write.mode(
            "append"
        ).parquet(self.folder)
        return batch
