"""Small files of an append-only folder put together."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyloom.session import drop_staged, stage


def compact(spark: SparkSession, folder: str, schema: str, target_bytes: int = 128 << 20) -> int:
    """Put the small files of an append-only Parquet folder together; returns their number.

    Files below the target are read together and written as a few, rows as they are, generated ids
    among them. The new files are written and known to be whole before the old ones go: a run that
    fails between leaves a marker that names what is to be deleted, and the next run deletes it.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    marker = f"{folder}/_merged"

    def clear() -> None:
        if fs.exists(fs_path(f"{marker}/_SUCCESS")):
            for row in spark.read.schema("value string").text(marker).collect():
                fs.delete(fs_path(row.value), False)
            held = f"{folder}/_held"
            if fs.exists(fs_path(held)):
                for status in fs.listStatus(fs_path(held)):
                    name = status.getPath().getName()
                    if name.endswith(".parquet"):
                        fs.rename(status.getPath(), fs_path(f"{folder}/merged-{name}"))
        for left in (marker, f"{folder}/_held"):
            fs.delete(fs_path(left), True)

    clear()
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    small = stage(listed.filter(F.col("length") < target_bytes).select("path", "length"), "small-files")
    n, size = small.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    if n < 2:
        return 0
    paths = [row.path for row in small.select("path").collect()]
    rows = spark.read.schema(schema).parquet(*paths)
    rows.repartition(max(1, -(-size // target_bytes))).write.mode("overwrite").parquet(f"{folder}/_held")
    small.select("path").coalesce(1).write.mode("overwrite").text(marker)
    clear()
    drop_staged(small)
    return n
