"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import configure

# Blanks between words, for Java, RE2 and Python patterns alike.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# Documents per Arrow batch: a batch of long texts must fit in a worker.
BATCH_ROWS = "256"


def session(spark: SparkSession) -> SparkSession:
    """The library's session settings, with small Arrow batches for whole texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; null counts as empty."""
    pieces = F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK + "+"), "")
    return F.size(pieces).cast("long")


def hash60(value: Column, seed: str) -> Column:
    """A 60-bit number from the md5 of ``seed:value``; null counts as the empty text.

    md5 is not the fastest choice, but any SQL engine has it, so results can be held against SQL.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
