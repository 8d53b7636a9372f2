"""The corpus pipeline: documents through five operators, each stage a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, lines, mixing, quality, simhash
from tallyloom.llm.common import session, table
from tallyloom.session import stage

# The stages share nothing but their tables, and SQL can express neither divergences nor the
# encoder. Tests hold each operator against brute force, and run() against its stages one by one.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    session(spark)
    judged = quality.quality_rules(docs)
    return judged.filter("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines; those that lose all their words go. ``n_chars``
    follows the text."""
    session(spark)
    freed = lines.delete_repeated_lines(docs)
    changed = F.col("n_deleted") > 0
    empty = F.length(F.translate("text", " \t\n\x0b\f\r", "")) == 0
    length = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return freed.filter(~(changed & empty)).withColumn("n_chars", length).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: fingerprints a few bits apart, or texts that
    share most of their word runs."""
    session(spark)
    return simhash.drop_near_duplicates(docs, threshold=simhash.BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: documents repeated or left out to meet the target weights."""
    session(spark)
    return mixing.mixed_rows(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their packed token ids, the decoded text, and the number of tokens."""
    session(spark)
    path = bpe.default_path()
    both = bpe.decode(bpe.encode(docs, path), path)
    return both.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix_sources),
    ("bpe", bpe_encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes its result and the next reads it."""
    docs = table(session(spark), sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
