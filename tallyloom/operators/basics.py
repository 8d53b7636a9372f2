"""Words, distinct rows, counts, pages and side counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.functions.numbers import indicator, squared_norm
from tallyloom.functions.text import words


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """How often each space-separated word occurs. A text of several lines counts line by line."""
    single = lines.select(F.explode(F.split(F.col(column), "\n")).alias("line"))
    return (
        single.select(F.explode(words(F.col("line"))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def split_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Each row with its array of words and the number one."""
    return lines.withColumn("words", words(F.col(column))).withColumn("one", F.lit(1))


def distinct_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and distinct values of a column (null is one value), as one row.

    Values are counted after a grouping on the value, so a frequent value is merged map-side.
    """
    return (
        df.groupBy(column)
        .agg(F.count("*").alias("_rows"))
        .agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("rows"),
            F.count("*").alias("distinct_values"),
        )
    )


def distinct_on(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest remaining columns, so the choice is repeatable."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*keys, "_first.*")


def count_by(df: DataFrame, *keys: str, present: list[str] | None = None) -> DataFrame:
    """Rows per key combination, leaving out rows where a ``present`` column is null."""
    for column in present or []:
        df = df.filter(F.col(column).isNotNull())
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def page(df: DataFrame, order: list[Column], start: int = 0, size: int = 10) -> DataFrame:
    """Rows ``start .. start+size`` in the given order, planned as a bounded top list."""
    return df.orderBy(*order).offset(start).limit(size)


def positive_norms(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """How many rows have ``a*a + b*b > 0``, as one row."""
    hit = indicator(squared_norm(a, b) > 0)
    return df.agg(F.coalesce(F.sum(hit), F.lit(0)).cast("long").alias("hits"))


def with_counters(
    df: DataFrame, counters: dict[str, Column | None], name: str
) -> tuple[DataFrame, Observation]:
    """The unchanged rows, plus named counters filled while an action reads them.

    A counter is a condition (rows for which it holds) or None (all rows). Put it last before the
    action: results of the final stage are counted once even if a task is run again.
    """
    seen = Observation(name)
    exprs = [
        (F.count(F.lit(1)) if cond is None else F.count_if(cond)).alias(label)
        for label, cond in counters.items()
    ]
    return df.observe(seen, *exprs), seen
