"""Device identity, and the table of app devices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.keys import app_device_key, device_hash
from tallyloom.functions.times import iso_utc
from tallyloom.operators.components import component_roots
from tallyloom.operators.latest import latest_rows
from tallyloom.session import bounded_broadcast, drop_staged, stage

_PAIR = ["imei", "mac"]


def _nodes(df: DataFrame, *keep: str) -> DataFrame:
    """One row per identifier a row carries: ``node`` is the imei or mac, marked by kind."""
    return df.select(
        F.explode(
            F.filter(
                F.array(
                    F.concat(F.lit("i:"), F.col("imei")), F.concat(F.lit("m:"), F.col("mac"))
                ),
                lambda n: n.isNotNull(),
            )
        ).alias("node"),
        *keep,
    )


def _stored_by(stored: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """The device stored under each identifier of the batch; of several, the one seen first.

    The stored side is reduced to the batch's identifiers before anything of it is exchanged, as
    long as they measure small enough to be sent along.
    """
    wanted = pairs.filter(F.col(column).isNotNull()).select(column).distinct()
    return (
        stored.join(bounded_broadcast(wanted), column, "left_semi")
        .groupBy(column)
        .agg(F.min(F.struct("first_time", "device_id")).alias(f"_{column}"))
    )


def resolve_devices(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``imei, mac, device_id, first_time`` for each identifier pair in a batch of log rows.

    ``rows`` has ``imei, mac, timestamp`` (epoch milliseconds); ``stored`` has ``device_id, imei,
    mac, first_time`` (ISO text). A pair belongs to the stored device with its imei, else to the
    one with its mac. Pairs without either are linked through identifiers they share inside the
    batch; a linked group takes the device of a pair it touches (the one seen first), else it
    becomes a new device named by a digest of its earliest pair.

    The answer does not depend on row order. It can join chains that a row-by-row lookup with a
    lag would have kept apart. A pair with neither identifier has no device.
    """
    pairs = stage(rows.groupBy(*_PAIR).agg(F.min("timestamp").alias("since")), "pairs")
    known = (
        pairs.join(_stored_by(stored, pairs, "imei"), "imei", "left")
        .join(_stored_by(stored, pairs, "mac"), "mac", "left")
        .select(*_PAIR, "since", F.coalesce("_imei", "_mac").alias("device"))
    )
    known = stage(known, "known-pairs")
    drop_staged(pairs)
    resolved = known.filter(F.col("device").isNotNull())
    open_pairs = known.filter(
        F.col("device").isNull() & (F.col("imei").isNotNull() | F.col("mac").isNotNull())
    )
    neither = known.filter(F.col("imei").isNull() & F.col("mac").isNull())
    linked = open_pairs.filter(F.lit(False))
    for column in _PAIR:
        # Identifiers of several pairs; all other pairs are devices by themselves.
        shared = known.groupBy(column).count().filter("count > 1").select(column)
        linked = linked.unionByName(open_pairs.join(shared, column, "left_semi").select(*known.columns))
    linked = stage(linked.distinct(), "linked-pairs")
    alone = open_pairs.join(
        linked.select(*[F.col(c).alias(f"_{c}") for c in _PAIR]),
        F.col("imei").eqNullSafe(F.col("_imei")) & F.col("mac").eqNullSafe(F.col("_mac")),
        "left_anti",
    ).withColumn("device", _new_device(F.col("since"), F.col("imei"), F.col("mac")))
    found = resolved.unionByName(alone).unionByName(neither).select(*_PAIR, "device")
    if not linked.isEmpty():
        found = found.unionByName(_linked_devices(linked, resolved))
    return found.select(*_PAIR, "device.device_id", "device.first_time")


def _new_device(since: Column, imei: Column, mac: Column) -> Column:
    """A device that is named by its earliest pair."""
    return F.struct(iso_utc(since).alias("first_time"), device_hash(imei, mac).alias("device_id"))


def _linked_devices(open_pairs: DataFrame, resolved: DataFrame) -> DataFrame:
    """``imei, mac, device`` of open pairs that share an identifier with another pair."""
    # A pair with one identifier is a loop: a node that nothing links by itself.
    i, m = F.concat(F.lit("i:"), F.col("imei")), F.concat(F.lit("m:"), F.col("mac"))
    edges = open_pairs.select(F.coalesce(i, m).alias("a"), F.coalesce(m, i).alias("b"))
    roots = component_roots(edges)

    touched = _nodes(resolved, "device").groupBy("node").agg(F.min("device").alias("device"))
    groups = (
        roots.join(touched, "node", "left").groupBy("root").agg(F.min("device").alias("linked"))
    )
    rooted = open_pairs.drop("device").withColumn("node", F.coalesce(i, m)).join(roots, "node")
    named = (
        rooted.groupBy("root")
        .agg(F.min(F.struct("since", *_PAIR)).alias("first"))
        .join(groups, "root")
        .select(
            "root",
            F.coalesce(
                F.col("linked"),
                _new_device(F.col("first.since"), F.col("first.imei"), F.col("first.mac")),
            ).alias("device"),
        )
    )
    return rooted.join(named, "root").select(*_PAIR, "device")


def attach_device(rows: DataFrame, resolved: DataFrame) -> DataFrame:
    """The rows with the ``device_id`` of their identifier pair."""
    pairs = resolved.select(
        F.col("imei").alias("_imei"), F.col("mac").alias("_mac"), "device_id"
    )
    on = F.col("imei").eqNullSafe(F.col("_imei")) & F.col("mac").eqNullSafe(F.col("_mac"))
    return rows.join(pairs, on).drop("_imei", "_mac")


def device_table_update(rows: DataFrame, resolved: DataFrame) -> DataFrame:
    """Rows for the device table: each device with the identifiers of its latest log row.

    ``rows`` has ``imei, mac, android_id, uuid, timestamp``. The first time is the stored or first
    seen one. Ties in time go to the greatest identifiers. Rows are reduced per pair before they
    are grouped by device.
    """
    per_pair = rows.groupBy(*_PAIR).agg(
        F.max(F.struct("timestamp", "android_id", "uuid")).alias("last")
    )
    joined = per_pair.select(
        F.col("imei").alias("_imei"), F.col("mac").alias("_mac"), "last"
    ).join(
        resolved,
        F.col("imei").eqNullSafe(F.col("_imei")) & F.col("mac").eqNullSafe(F.col("_mac")),
    )
    newest = F.max(F.struct("last.timestamp", "imei", "mac", "last.android_id", "last.uuid"))
    return (
        joined.filter(F.col("device_id").isNotNull())
        .groupBy("device_id")
        .agg(newest.alias("n"), F.min("first_time").alias("first_time"))
        .select("device_id", "n.imei", "n.mac", "n.android_id", "n.uuid", "first_time")
    )


# Names the device table gives to log fields.
APP_DEVICE_NAMES = {
    "appkey": "app_key",
    "ch": "channel",
    "c": "country",
    "pn": "pkg_name",
    "deviceId": "device_id",
    "la": "language",
    "t": "model",
}


def app_devices(rows: DataFrame, first_seen: bool = False) -> DataFrame:
    """App-device rows from log rows with ``deviceId``: the latest row of each device, renamed.

    ``first_time`` is the time of that latest row; with ``first_seen`` it is the earliest time of
    the device and package instead. Rows are chosen per device alone, so of a device's packages
    only those of its latest time remain.
    """
    latest = latest_rows(rows, ["deviceId"], "timestamp")
    if first_seen:
        since = rows.groupBy("deviceId", "pn").agg(F.min("timestamp").alias("_since"))
        latest = latest.join(since, ["deviceId", "pn"], "left")
    else:
        latest = latest.withColumn("_since", F.col("timestamp"))
    return latest.select(
        iso_utc(F.col("_since")).alias("first_time"),
        *APP_DEVICE_NAMES,
        app_device_key(F.col("pn"), F.col("deviceId")).alias("id"),
    ).withColumnsRenamed(APP_DEVICE_NAMES)
