"""Session defaults, the shared scratch area, staged tables and measured broadcasts."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest measured payload that is sent to every executor; above it joins shuffle.
BROADCAST_LIMIT = 64 * 1024 * 1024


# Keys a join may bring to the scan of its other side as a Bloom filter, and the filter's bits (at
# most 64 MiB). Spark adds one where a filtered side is too large to broadcast and the other side
# scans 10 GB or more.
BLOOM_KEYS = 50_000_000
BLOOM_BITS = 1 << 29
BLOOM_SIDE = "2g"


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings whose value changes results, skew handling or pruned joins."""
    bloom = "spark.sql.optimizer.runtime.bloomFilter"
    spark.conf.set(f"{bloom}.enabled", "true")
    spark.conf.set(f"{bloom}.maxNumItems", str(BLOOM_KEYS))
    spark.conf.set(f"{bloom}.maxNumBits", str(BLOOM_BITS))
    spark.conf.set(f"{bloom}.creationSideThreshold", BLOOM_SIDE)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master without that setting (unit tests) gets a folder of its own; a cluster
    without one is an error, because a machine-local folder is lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tallyloom-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tallyloom"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that no other run uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


# The staged tables of the innermost open scope, if there is one.
_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scope", default=None)


def stage(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the scratch area and return the written table, in a folder
    per value of the column ``by`` if one is given.

    Cuts the lineage: what follows restarts from the files when an executor is lost, and a table
    used several times is computed once. The table belongs to the scope around it (see
    ``scratch_scope``); without one it stays until ``drop_staged`` or the cluster's own clean-up.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, partitionBy=by)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    owned = _scope.get()
    if owned is not None:
        owned.append(path)
    return staged


def _delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(staged: DataFrame) -> None:
    """Delete the files of a table that ``stage`` returned and that nothing reads any more."""
    path = getattr(staged, "_staged_path", None)
    if path is None:
        raise ValueError("only a table that stage() returned can be dropped")
    _delete_folder(staged.sparkSession, path)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Own every table staged inside: all are deleted at the end, whether or not the work failed.

    For work that leaves its result elsewhere, such as a keyed table. A DataFrame that still reads
    a staged table must not leave the scope.
    """
    owned: list[str] = []
    token = _scope.set(owned)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in owned:
            _delete_folder(spark, path)


def measured_bytes(df: DataFrame) -> int:
    """Payload size of a DataFrame, found by one aggregation over its rows.

    Numbers count 16 bytes, texts their bytes, nested values twice their JSON text.
    """
    width = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + F.lit(16)
        elif isinstance(field.dataType, T.AtomicType):
            width = width + F.lit(16)
        else:
            text = F.to_json(F.struct(F.col(f"`{field.name}`")))
            width = width + F.octet_length(text) * F.lit(2) + F.lit(16)
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()["b"]


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint ``df`` for broadcast if it measures at most ``limit`` bytes.

    Beyond the limit it comes back without a hint, and the join shuffles both sides on its key.
    Meant for sides that are cheap to scan twice: filtered dimensions and staged tables.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df
