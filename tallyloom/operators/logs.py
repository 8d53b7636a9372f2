"""Channel-log lines ``epochMillis|ip|json``: parsing, quarantine and session rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.schemas import CORRUPT, LOG_RECORD

ENVELOPE_SEPARATOR = "[|]"


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines (column ``value``) as ``timestamp, ip, us, se`` and the corrupt-record text.

    A line that is no log record is kept whole in the corrupt column: broken JSON, a missing part
    (also a record without its ``us``), or a timestamp that is no number. Naming the corrupt column as a parser option also keeps the
    optimizer from narrowing the JSON schema, which would let half-read records pass as good.

    Each line is parsed by a generator of exactly one row: filters on the result stay above it, so
    no line is parsed a second time to evaluate them.
    """
    split = lines.select("value", F.split(F.col("value"), ENVELOPE_SEPARATOR, 3).alias("_p"))
    record = F.from_json(
        F.get("_p", F.lit(2)),
        LOG_RECORD,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    parsed = split.select(
        F.inline(
            F.array(
                F.struct(
                    F.get("_p", F.lit(0)).try_cast("long").alias("timestamp"),
                    F.get("_p", F.lit(1)).alias("ip"),
                    record.alias("_r"),
                    F.col("value").alias("_line"),
                )
            )
        )
    )
    broken = (
        F.col("timestamp").isNull()
        | F.col("_r").isNull()
        | F.col("_r.us").isNull()
        | F.col(f"_r.{CORRUPT}").isNotNull()
    )
    return parsed.select(
        "timestamp",
        "ip",
        F.col("_r.us").alias("us"),
        F.col("_r.se").alias("se"),
        F.when(broken, F.col("_line")).alias(CORRUPT),
    )


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed(parsed: DataFrame) -> DataFrame:
    """The quarantined lines."""
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def malformed_with_null_field(parsed: DataFrame, column: str = "se.e") -> DataFrame:
    """Quarantined lines with a typed null under a *top-level* name that contains a dot."""
    return malformed(parsed).withColumn(column, F.lit(None).cast("bigint"))


def device_rows(records: DataFrame) -> DataFrame:
    """One flat row per record: the device fields, then timestamp and ip."""
    return records.select("us.*", "timestamp", "ip")


def session_rows(records: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One flat row per session: device fields, timestamp, ip, and the session's ``e`` and ``s``.

    Records without sessions give no row, or one row of null sessions with ``keep_empty``.
    """
    explode = F.explode_outer if keep_empty else F.explode
    return records.select("us.*", "timestamp", "ip", explode("se").alias("_s")).select(
        "*", "_s.e", "_s.s"
    ).drop("_s")


def sessions(records: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns with one row per session end; records without sessions give none."""
    return records.select(*columns, F.explode("se.e").alias("e"))


def sessions_or_null(records: DataFrame, *columns: str) -> DataFrame:
    """Same, keeping a record without sessions as one row of null."""
    return records.select(*columns, F.explode_outer("se.e").alias("e"))
