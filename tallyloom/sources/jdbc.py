"""JDBC tables. Drivers and servers come with the cluster; none is bundled."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    """Address of a table, and how to read it in parallel.

    Without a partition column a JDBC scan is a single task, so name one for a table of any size.
    """

    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    lower: int | None = None
    upper: int | None = None
    partitions: int | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        """The whole table; filters and column choices made on the result reach the database."""
        reader = spark.read.format("jdbc").options(
            url=self.url, dbtable=self.table, **self.properties
        )
        if self.partition_column:
            reader = reader.options(
                partitionColumn=self.partition_column,
                lowerBound=str(self.lower),
                upperBound=str(self.upper),
                numPartitions=str(self.partitions),
            )
        return reader.load()

    def append(self, df: DataFrame, batch: int = 5000) -> None:
        """Insert the rows of ``df``, batched, one connection per partition."""
        writer = df.write.format("jdbc").mode("append")
        writer.options(
            url=self.url, dbtable=self.table, batchsize=str(batch), **self.properties
        ).save()
