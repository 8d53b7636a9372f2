"""File readers. Every reader takes a schema, so none runs an inference pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import split_drop_trailing
from tallyloom.sources import schemas


def as_schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Lines of text files as one ``value`` column.

    ``min_partitions`` is a lower bound: only a scan with fewer splits is redistributed.
    """
    lines = spark.read.text(path)
    if min_partitions and lines.rdd.getNumPartitions() < min_partitions:
        lines = lines.repartition(min_partitions, F.xxhash64("value"))
    return lines


def read_delimited(
    spark: SparkSession, path: str, schema: str | T.StructType, separator: str = "::"
) -> DataFrame:
    """Records with a (multi-character) separator and no quoting."""
    return (
        spark.read.schema(as_schema(schema))
        .option("sep", separator)
        .option("quote", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.RATINGS)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.USERS)


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.MOVIES)


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON-lines files with a known schema."""
    return spark.read.schema(as_schema(schema)).json(path)


def rows(spark: SparkSession, values: list, schema: str | T.StructType, slices: int | None = None):
    """A small literal collection as a DataFrame, optionally spread over ``slices`` partitions."""
    df = spark.createDataFrame(values, as_schema(schema))
    return df.repartition(slices) if slices else df


def integer_range(spark: SparkSession, n: int, slices: int | None = None) -> DataFrame:
    """The integers 1..n as column ``id``."""
    return spark.range(1, n + 1, 1, slices)


def parse_people(lines: DataFrame) -> DataFrame:
    """``username;password;mail`` lines as person rows."""
    parts = split_drop_trailing(F.col("value"), ";")
    names = as_schema(schemas.PERSON).names
    return lines.select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_season_stats(
    spark: SparkSession, path: str, season_pattern: str = r"(\d{4})[^/]*$"
) -> DataFrame:
    """Per-season CSV files whose header repeats through the file.

    Only lines that start with a rank number are data; the season comes from the file path by the
    first group of ``season_pattern``.
    """
    schema = as_schema(schemas.SEASON_STATS)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.schema(texts).csv(path)
    typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema]
    return raw.filter(F.col("Rk").rlike("^[0-9]+$")).select(
        F.regexp_extract(F.input_file_name(), season_pattern, 1).cast("int").alias("season"),
        *typed,
    )


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated numeric vectors, one per line."""
    return spark.read.text(path).select(
        F.split("value", " ").cast("array<double>").alias("features")
    )
