"""Keyed document tables: Parquet partitioned by a stored bucket of the key, behind a named view.

A change reads and rewrites the buckets its keys fall into and leaves the others alone. The new
rows of those buckets are first written to the side; from then on the change is settled, and it is
carried out by moving the written buckets into place, which can be repeated until it is whole. A job that
fails before leaves the table as it was; one that fails after is finished by the next call. One
process at a time is assumed, and a DataFrame read before a change must be read anew after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.numbers import add_counts
from tallyloom.session import bounded_broadcast, scratch_scope, stage
from tallyloom.sources.files import as_schema

# Stored bytes one bucket is planned for, and the most buckets a table gets. A task merges a whole
# bucket, and sorted rows in memory are some thirty times as large as packed ones in a file.
BUCKET_BYTES = 16 * 1024 * 1024
MAX_BUCKETS = 65536

BUCKET = "_bucket"
BATCHES = "batch string, digest string"
NOTE = f"buckets int, {BATCHES}"
ENTRIES = "entry string, value string, id string"


class KeyedTable:
    """``buckets`` fixes their number, a power of two; by default it follows the stored size.

    ``indexes`` names columns that rows can be looked up by. Each has a table of entries (value and
    key) beside the rows, bucketed by value. Entries are added and never taken away, and a lookup
    holds them against the rows, so an entry of a former value does no harm.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        schema: str | T.StructType,
        folder: str,
        key: str = "id",
        buckets: int | None = None,
        indexes: tuple[str, ...] = (),
        bucket_by: str | None = None,
    ):
        self.spark = spark
        self.name = name
        self.schema = as_schema(schema)
        self.folder = folder.rstrip("/")
        self.key = key
        self.buckets = buckets
        self.bucket_by = bucket_by or key
        self.indexes = {
            c: KeyedTable(
                spark, f"{name}_by_{c}", ENTRIES, f"{self.folder}/index={c}", "entry", buckets,
                bucket_by="value",
            )
            for c in indexes
        }

    def on(self, spark: SparkSession) -> KeyedTable:
        """The same table through another session, such as that of a micro-batch."""
        return KeyedTable(
            spark, self.name, self.schema, self.folder, self.key, self.buckets,
            tuple(self.indexes), self.bucket_by,
        )

    # files -------------------------------------------------------------------------------

    def _at(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{folder}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, folder: str) -> bool:
        fs, path = self._at(folder)
        return fs.exists(path)

    def _delete(self, folder: str) -> None:
        fs, path = self._at(folder)
        fs.delete(path, True)

    def _bytes(self, folder: str) -> int:
        fs, path = self._at(folder)
        return fs.getContentSummary(path).getLength() if fs.exists(path) else 0

    def _layouts(self) -> list[int]:
        """Numbers of buckets that rows are stored in: one, or two while the table grows."""
        fs, path = self._at("")
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n.removeprefix("buckets=")) for n in names if n.startswith("buckets="))

    def _rows(self, folder: str) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{folder}")

    def _bucket(self, value: Column, buckets: int) -> Column:
        return F.pmod(F.hash(value.cast(self.schema[self.bucket_by].dataType)), F.lit(buckets))

    def _buckets_for(self, incoming_bytes: int, now: int | None) -> int:
        """Buckets of the changed table: a power of two by stored size, never fewer than now."""
        if self.buckets:
            return self.buckets
        stored = self._bytes(f"buckets={now}") if now else 0
        power = 1 << int((stored + incoming_bytes) // BUCKET_BYTES).bit_length()
        return max(min(power, MAX_BUCKETS), now or 1)

    # changes -----------------------------------------------------------------------------

    def _settled(self) -> Row | None:
        """The note of a change that is written to the side as a whole, if there is one."""
        if not self._exists("pending/note/_SUCCESS"):
            return None
        return self.spark.read.schema(NOTE).parquet(f"{self.folder}/pending/note").first()

    def _finish(self, change: Row | None = None) -> None:
        """Carry out a settled change; every step can be repeated. What was not settled goes."""
        change = change or self._settled()
        if change is not None:
            self._move_buckets("pending/rows", f"buckets={change.buckets}")
            for former in self._layouts():
                if former != change.buckets:
                    self._delete(f"buckets={former}")
            if change.batch is not None:
                # A repeated row says the same again.
                applied = self.spark.createDataFrame([(change.batch, change.digest)], BATCHES)
                applied.coalesce(1).write.mode("append").parquet(f"{self.folder}/batches")
        if self._exists("pending"):
            self._delete("pending")

    def _move_buckets(self, source: str, target: str) -> None:
        """Put the buckets of a folder in the place of those of another. Moved ones are gone from the
        source, so a move that was broken off goes on where it stopped."""
        fs, path = self._at(target)
        fs.mkdirs(path)
        for status in fs.listStatus(self._at(source)[1]):
            name = status.getPath().getName()
            if name.startswith(f"{BUCKET}="):
                _, place = self._at(f"{target}/{name}")
                fs.delete(place, True)
                if not fs.rename(status.getPath(), place):
                    raise OSError(f"{status.getPath()} could not be moved to {place}")

    def batches(self) -> DataFrame:
        """``batch, digest`` of the batches that were added, as a table."""
        if not self._exists("batches"):
            return self.spark.createDataFrame([], BATCHES)
        return self.spark.read.schema(BATCHES).parquet(f"{self.folder}/batches").distinct()

    def _applied(self, batch: str, digest: str | None) -> bool:
        """Whether a batch was added before; one that comes with other input is an error."""
        known = self.batches().filter(F.col("batch") == batch)
        same = F.col("digest").eqNullSafe(F.lit(digest)).alias("same")
        found = [row.same for row in known.select(same).distinct().collect()]
        if not all(found):
            raise ValueError(f"batch {batch!r} of {self.name} was added with other input")
        return bool(found)

    def _shaped(self, df: DataFrame) -> DataFrame:
        """Rows with every column of the table, in its order; columns not given are null."""
        return df.select(
            *[
                (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in self.schema
            ]
        )

    # reading -----------------------------------------------------------------------------

    def _stored(self) -> DataFrame:
        """All rows with their bucket; finishes a settled change first."""
        if self._exists("pending/note/_SUCCESS"):
            self._finish()
        layouts = self._layouts()
        if layouts:
            return self._rows(f"buckets={layouts[-1]}")
        return self.spark.createDataFrame([], self.schema).withColumn(BUCKET, F.lit(None).cast("int"))

    def read(self) -> DataFrame:
        """The rows; also points the view at them."""
        current = self._stored().drop(BUCKET)
        current.createOrReplaceTempView(self.name)
        return current

    def scan(self, *columns: str, metadata: bool = False) -> DataFrame:
        """Chosen columns, with the document id as a ``_metadata`` map if asked for."""
        out = [F.col(f"`{c}`") for c in columns]
        if metadata:
            out.append(F.create_map(F.lit("_id"), F.col(self.key)).alias("_metadata"))
        return self.read().select(*out)

    def lookup(self, value: object) -> DataFrame:
        """The row with this key: the folder of one bucket is read, with Parquet filters."""
        return self._in_bucket_of(value, self.key)

    def _in_bucket_of(self, value: object, column: str) -> DataFrame:
        stored = self._stored()
        there = F.col(column) == F.lit(value)
        if layouts := self._layouts():
            there &= F.col(BUCKET) == self._bucket(F.lit(value), layouts[-1])
        return stored.filter(there).drop(BUCKET)

    def _touched(self, keys: DataFrame, buckets: int) -> list[int]:
        """Numbers of the buckets the keys fall into: at most as many as there are buckets."""
        number = self._bucket(F.col(self.bucket_by), buckets).alias("b")
        return sorted(row.b for row in keys.select(number).distinct().collect())

    def with_keys(self, keys: DataFrame) -> DataFrame:
        """Stored rows with one of the keys, read from the buckets of these alone."""
        stored, layouts = self._stored(), self._layouts()
        if layouts:
            stored = stored.filter(F.col(BUCKET).isin(self._touched(keys, layouts[-1])))
        return stored.drop(BUCKET).join(bounded_broadcast(keys), keys.columns, "left_semi")

    def lookup_by(self, column: str, value: object) -> DataFrame:
        """The rows with this value in an indexed column: one bucket of the index is read, and of
        the rows the buckets of the keys found there."""
        entries = self.indexes[column]._in_bucket_of(str(value), "value")
        return self._of_entries(entries).filter(F.col(column) == F.lit(value))

    def matching(self, column: str, values: DataFrame) -> DataFrame:
        """The rows whose indexed column holds one of ``values`` (a DataFrame with that column):
        only the buckets that these values and the keys found with them fall into are read."""
        wanted = stage(values.select(column).filter(F.col(column).isNotNull()).distinct(), "wanted")
        texts = wanted.select(F.col(column).cast("string").alias("value"))
        return self._of_entries(self.indexes[column].with_keys(texts)).join(
            bounded_broadcast(wanted), column, "left_semi"
        ).select(*self.schema.names)

    def _of_entries(self, entries: DataFrame) -> DataFrame:
        kind = self.schema[self.key].dataType
        keys = stage(entries.select(F.col("id").cast(kind).alias(self.key)).distinct(), "entries")
        return self.with_keys(keys)

    # writing -----------------------------------------------------------------------------

    def one_per_key(self, incoming: DataFrame, order: str | None = None) -> DataFrame:
        """One incoming row per key: the last by ``order``, then the greatest row. A null key is
        refused with an error: no stored row could ever be found again under it."""
        rest = [c for c in incoming.columns if c != self.key]
        first = [F.col(order).alias("_order")] if order else []
        best = F.max(F.struct(*first, *[F.col(f"`{c}`") for c in rest])).alias("_row")
        picked = incoming.groupBy(self.key).agg(best)
        return self._keys_known(
            picked.select(self.key, *[F.col(f"_row.`{c}`").alias(c) for c in rest])
        )

    def _keys_known(self, incoming: DataFrame) -> DataFrame:
        key = F.when(
            F.col(self.key).isNull(), F.raise_error(F.lit(f"null key for table {self.name}"))
        ).otherwise(F.col(self.key))
        return incoming.withColumn(self.key, key)

    def _merge(
        self,
        incoming: DataFrame,
        order: str | None,
        new_value,
        batch: str | None = None,
        digest: str | None = None,
        unique: bool = False,
    ) -> DataFrame:
        """Merge incoming rows into their buckets; ``unique`` says that no key comes twice, which
        saves a grouping.

        ``new_value(old, new, stored)`` is what a column of a supplied row becomes; ``new`` is None
        for a column that is not supplied, and ``stored`` tells whether the key was known. A
        ``batch`` that was applied before changes nothing.
        """
        self._finish()
        if batch is not None and self._applied(batch, digest):
            return self.read()
        with scratch_scope(self.spark):
            picked = self._keys_known(incoming) if unique else self.one_per_key(incoming, order)
            incoming = stage(picked, "incoming")
            self._enter(incoming)
            now = (self._layouts() or [None])[-1]
            size = self.spark._jvm.org.apache.hadoop.fs.Path(incoming._staged_path)
            fs = size.getFileSystem(self.spark._jsc.hadoopConfiguration())
            buckets = self._buckets_for(fs.getContentSummary(size).getLength(), now)
            stored, tasks = self._stored(), buckets
            if now == buckets:
                touched = self._touched(incoming, buckets)
                stored = stored.filter(F.col(BUCKET).isin(touched))
                # Tasks divide the buckets, so that none of them is written by two.
                tasks = min(buckets, 1 << max(0, len(touched) - 1).bit_length())
            names = [f.name for f in self.schema if f.name != self.key]
            given = [n for n in names if n in incoming.columns]
            tagged = incoming.select(
                self.key,
                F.lit(True).alias("_hit"),
                *[F.col(f"`{n}`").alias(f"_new_{n}") for n in given],
            )
            stored = stored.drop(BUCKET).withColumn("_stored", F.lit(True))
            merged = stored.repartition(tasks, self.key).join(
                tagged.repartition(tasks, self.key), self.key, "full_outer"
            )
            known = F.col("_stored").isNotNull()

            def column(name: str) -> Column:
                old = F.col(f"`{name}`")
                new = F.col(f"`_new_{name}`") if name in given else None
                return (
                    F.when(F.col("_hit"), new_value(old, new, known)).otherwise(old).alias(name)
                )

            rows = self._shaped(merged.select(self.key, *[column(n) for n in names]))
            if self.bucket_by != self.key:
                rows = rows.repartition(tasks, self.bucket_by)
            (
                rows.withColumn(BUCKET, self._bucket(F.col(self.bucket_by), buckets))
                .sortWithinPartitions(BUCKET, self.key)
                .write.partitionBy(BUCKET)
                .parquet(f"{self.folder}/pending/rows")
            )
        change = Row(buckets=buckets, batch=batch, digest=digest)
        note = self.spark.createDataFrame([change], NOTE).coalesce(1)
        note.write.parquet(f"{self.folder}/pending/note")
        self._finish(change)
        return self.read()

    def _enter(self, incoming: DataFrame) -> None:
        """Add the entries of incoming rows to the indexes, before the rows themselves."""
        for column, index in self.indexes.items():
            if column in incoming.columns:
                value, key = F.col(column).cast("string"), F.col(self.key).cast("string")
                entry = F.concat_ws("#", F.length(value), value, key)
                # Rows have a key each, and so have entries.
                index.insert_missing(
                    incoming.filter(F.col(column).isNotNull()).select(
                        entry.alias("entry"), value.alias("value"), key.alias("id")
                    ),
                    unique=True,
                )

    def replace(self, incoming: DataFrame, order: str | None = None) -> DataFrame:
        """Index by id: an incoming row takes the place of the whole stored row."""
        return self._merge(
            incoming, order, lambda old, new, stored: F.lit(None) if new is None else new
        )

    def upsert(
        self,
        incoming: DataFrame,
        order: str | None = None,
        skip_nulls: bool = False,
        unique: bool = False,
    ) -> DataFrame:
        """Update by id: supplied columns win, other columns stay, unknown ids are added.

        ``skip_nulls`` keeps the stored value where a supplied one is null, as a document store
        that does not write null fields would.
        """

        def value(old, new, stored):
            if new is None:
                return old
            return F.coalesce(new, old) if skip_nulls else new

        return self._merge(incoming, order, value, unique=unique)

    def add(
        self, incoming: DataFrame, batch: str | None = None, digest: str | None = None
    ) -> DataFrame:
        """Add the supplied counters to the stored ones, in one join; a missing value counts as 0.

        ``incoming`` has one row per key. With ``batch`` a repeated call changes nothing, so a job
        that failed anywhere can be run again: the batch and the counters are settled together.
        The same batch with another ``digest`` of its input raises.
        """
        return self._merge(
            incoming,
            None,
            lambda old, new, stored: old if new is None else add_counts(old, new),
            batch,
            digest,
        )

    def insert_missing(
        self, incoming: DataFrame, order: str | None = None, unique: bool = False
    ) -> DataFrame:
        """Add the rows whose id is unknown; stored rows stay as they are."""

        def value(old, new, stored):
            return F.when(stored, old).otherwise(F.lit(None) if new is None else new)

        return self._merge(incoming, order, value, unique=unique)


def append_generated(df: DataFrame, folder: str, id_column: str = "id") -> None:
    """Append rows under random ids, in one write."""
    df.withColumn(id_column, F.uuid()).write.mode("append").parquet(folder)
