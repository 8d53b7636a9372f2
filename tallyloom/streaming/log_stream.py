"""Log files arriving in a folder, kept up to date as keyed tables.

The batch operators run unchanged on every micro-batch. Each sink is safe to replay: a batch that
is run again after a failure writes the same rows under the same keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators import devices, logs, stats
from tallyloom.session import scratch_scope, stage
from tallyloom.sources.keyed import KeyedTable


def read_parsed_stream(
    spark: SparkSession, folder: str, max_files: int | None = None
) -> DataFrame:
    """The parsed lines of the log files in a folder, good and bad, as a stream."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return logs.parse_lines(reader.text(folder))


def read_log_stream(
    spark: SparkSession, folder: str, max_files: int | None = None
) -> DataFrame:
    """The good records alone; run ``keep_malformed`` next to it, or bad lines leave no trace."""
    return logs.good_records(read_parsed_stream(spark, folder, max_files))


def keep_malformed(parsed: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write the bad lines, whole, as text files to a folder: each exactly once."""
    bad = logs.malformed(parsed).toDF("value")
    return (
        bad.writeStream.format("text")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def keep_statistics(records: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Keep ``news`` and ``starts`` per statistic id.

    The running counts are the stream's own state and are written as totals, so a replayed batch
    cannot count twice.
    """
    counts = stats.increments(stats.with_statistic_id(logs.device_rows(records)))

    def write(batch: DataFrame, _: int) -> None:
        table.on(batch.sparkSession).upsert(batch)

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def keep_devices(
    records: DataFrame, device_table: KeyedTable, app_table: KeyedTable, checkpoint: str
) -> StreamingQuery:
    """Keep the device table and the app-device table."""
    rows = logs.device_rows(records)

    def write(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        known, apps = device_table.on(session), app_table.on(session)
        named = batch.withColumnsRenamed({"im": "imei", "ai": "android_id"}).withColumn(
            "uuid", F.sha2(F.concat_ws("|", "imei", "mac", "timestamp", "ip"), 256)
        )
        with scratch_scope(session):
            named = stage(named, "batch")
            resolved = stage(devices.resolve_devices(named, known.read()), "resolved")
            attached = devices.attach_device(named, resolved).withColumnsRenamed(
                {"device_id": "deviceId"}
            )
            apps.upsert(devices.app_devices(attached))
            known.upsert(devices.device_table_update(named, resolved))

    return (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
