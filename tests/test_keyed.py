import re

import pytest
from pyspark.sql import functions as F

from tallyloom.session import new_folder
from tallyloom.sources import keyed
from tallyloom.sources.keyed import KeyedTable, append_generated

SCHEMA = "id string, n bigint, note string"


@pytest.fixture
def table(spark):
    made = KeyedTable(spark, "things", SCHEMA, new_folder(spark, "things"), buckets=4)
    made.replace(spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], SCHEMA))
    return made


def incoming(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, n bigint")


def test_empty_table(spark):
    empty = KeyedTable(spark, "none", SCHEMA, new_folder(spark, "none"))
    assert empty.read().count() == 0 and empty.read().columns == ["id", "n", "note"]


def test_replace_upsert_insert(spark, table, rows_of):
    assert rows_of(table.upsert(incoming(spark, ("b", 5), ("c", 6)))) == [
        ("a", 1, "old"), ("b", 5, "old"), ("c", 6, None)]
    assert rows_of(table.replace(incoming(spark, ("a", 9), ("d", 7)))) == [
        ("a", 9, None), ("b", 5, "old"), ("c", 6, None), ("d", 7, None)]
    assert rows_of(table.insert_missing(incoming(spark, ("a", 0), ("e", 8)))) == [
        ("a", 9, None), ("b", 5, "old"), ("c", 6, None), ("d", 7, None), ("e", 8, None)]
    assert spark.table("things").count() == 5


def test_upsert_is_idempotent(spark, table, rows_of):
    batch = incoming(spark, ("b", 5), ("c", 6))
    once = rows_of(table.upsert(batch))
    assert rows_of(table.upsert(batch)) == once


def test_upsert_nulls(spark, table, rows_of):
    batch = spark.createDataFrame([("a", None, "new")], SCHEMA)
    assert rows_of(table.upsert(batch, skip_nulls=True))[0] == ("a", 1, "new")
    assert rows_of(table.upsert(batch))[0] == ("a", None, "new")


def test_incoming_duplicates_collapse_to_the_latest(spark, table, rows_of):
    batch = spark.createDataFrame([("a", 5, "x"), ("a", 7, "b"), ("a", 7, "c")], SCHEMA)
    assert rows_of(table.upsert(batch, order="n"))[0] == ("a", 7, "c")
    assert rows_of(table.insert_missing(batch)).count(("a", 7, "c")) == 1


def stored_files(table):
    found = {}
    for file in table._stored().inputFiles():
        found.setdefault(int(file.split("_bucket=")[1].split("/")[0]), set()).add(file)
    return found


def many(spark, n):
    return spark.range(n).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("n"))


@pytest.mark.parametrize("change", ["upsert", "replace", "insert_missing", "add"])
def test_a_change_of_one_row_writes_one_bucket(spark, table, rows_of, change):
    table.upsert(many(spark, 60))
    before = stored_files(table)
    assert len(before) == 4
    getattr(table, change)(incoming(spark, ("fresh", 5)))
    after = stored_files(table)
    assert sum(before[b] != after[b] for b in before) == 1
    assert rows_of(table.lookup("fresh"), "id", "n") == [("fresh", 5)] and table.read().count() == 63


def test_a_failed_write_leaves_the_table(spark, table, rows_of):
    broken = incoming(spark, ("a", 1)).withColumn("n", F.raise_error(F.lit("stop")).cast("bigint"))
    with pytest.raises(Exception):
        table.upsert(broken)
    # Rows that were written to the side without a note are not settled.
    table._shaped(incoming(spark, ("a", 7))).withColumn("_bucket", F.lit(0)).write.partitionBy(
        "_bucket").parquet(f"{table.folder}/pending/rows")
    assert rows_of(table.read()) == [("a", 1, "old"), ("b", 2, "old")]
    assert rows_of(table.upsert(incoming(spark, ("c", 3))))[-1] == ("c", 3, None)


def test_a_settled_change_is_finished_by_the_next_call(spark, table, rows_of, monkeypatch):
    finish, calls = KeyedTable._finish, []

    def stopped(self, change=None):
        calls.append(1)
        if len(calls) == 1:
            return finish(self)
        raise KeyboardInterrupt

    monkeypatch.setattr(KeyedTable, "_finish", stopped)
    with pytest.raises(KeyboardInterrupt):
        table.add(incoming(spark, ("a", 5), ("n", 7)), batch="first", digest="x")
    monkeypatch.setattr(KeyedTable, "_finish", finish)
    want = [("a", 6, "old"), ("b", 2, "old"), ("n", 7, None)]
    assert rows_of(table.on(spark).read()) == want
    assert rows_of(table.add(incoming(spark, ("a", 5), ("n", 7)), batch="first", digest="x")) == want


def test_a_batch_with_other_input_raises(spark, table, rows_of):
    table.add(incoming(spark, ("a", 5)), batch="first", digest="x")
    with pytest.raises(ValueError, match="other input"):
        table.add(incoming(spark, ("a", 6)), batch="first", digest="y")
    assert rows_of(table.batches()) == [("first", "x")]
    assert rows_of(table.read())[0] == ("a", 6, "old")


def test_scan_and_lookup(spark, table, rows_of):
    got = table.scan("n", metadata=True)
    assert rows_of(got.select("n", F.col("_metadata")["_id"])) == [(1, "a"), (2, "b")]
    found = table.lookup("b")
    assert rows_of(found) == [("b", 2, "old")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,b)" in plan


def test_lookup_reads_one_bucket(spark, table):
    table.upsert(many(spark, 50))
    found = table.lookup("k7")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan and found.count() == 1
    assert len(files_read(found)) == 1


def files_read(df):
    rows = df.select(F.input_file_name().alias("f")).distinct().collect()
    return {row.f for row in rows}


@pytest.fixture
def indexed(spark):
    made = KeyedTable(
        spark, "people", "id string, imei string, mac string, n bigint", new_folder(spark, "people"),
        buckets=8, indexes=("imei", "mac"),
    )
    made.replace(spark.range(40).selectExpr(
        "'d' || id AS id", "'i' || id AS imei", "'m' || (id DIV 2) AS mac", "id AS n"))
    return made


def test_lookup_by_another_column_reads_one_bucket_of_index_and_rows(spark, indexed, rows_of):
    found = indexed.lookup_by("imei", "i7")
    assert rows_of(found, "id") == [("d7",)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*_bucket#\d+ (= |IN \()\d+\)", plan)
    entries = indexed.indexes["imei"]._in_bucket_of("i7", "value")
    assert len(files_read(entries)) == 1
    assert rows_of(indexed.lookup_by("mac", "m3"), "id") == [("d6",), ("d7",)]
    assert indexed.lookup_by("mac", "none").count() == 0


def test_a_former_value_is_not_found(spark, indexed, rows_of):
    indexed.upsert(spark.createDataFrame([("d7", "moved")], "id string, imei string"))
    assert indexed.lookup_by("imei", "i7").count() == 0
    assert rows_of(indexed.lookup_by("imei", "moved"), "id", "mac") == [("d7", "m3")]
    wanted = spark.createDataFrame([("i7",), ("moved",), ("i9",), (None,), ("i9",)], "imei string")
    assert rows_of(indexed.matching("imei", wanted), "id") == [("d7",), ("d9",)]
    assert indexed.matching("mac", spark.createDataFrame([], "mac string")).count() == 0


def merge_plan(spark, table, batch, monkeypatch):
    """The plan of the rows that a merge writes to the side."""
    found = []
    shaped = table._shaped

    def seen(df):
        out = shaped(df)
        found.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(table, "_shaped", seen)
    table.upsert(batch)
    return found[-1]


def test_merge_reads_touched_buckets_and_exchanges_each_side_once(spark, table, monkeypatch):
    table.upsert(many(spark, 60))
    batch = incoming(spark, *[(f"k{n}", 5) for n in range(12)])
    plan = merge_plan(spark, table, batch, monkeypatch)
    assert "FullOuter" in plan and plan.count("Exchange hashpartitioning") == 2
    assert "PartitionFilters: [_bucket" in plan


def test_buckets_follow_the_size(spark, rows_of, monkeypatch):
    grown = KeyedTable(spark, "grown", SCHEMA, new_folder(spark, "grown"))
    grown.replace(incoming(spark, ("a", 1)))
    assert grown._layouts() == [1]
    monkeypatch.setattr(keyed, "BUCKET_BYTES", 1000)
    noted = many(spark, 500).withColumn("note", F.lit("x"))
    assert grown.upsert(noted).count() == 501
    (buckets,) = grown._layouts()
    assert buckets >= 4 and buckets & (buckets - 1) == 0
    assert grown.upsert(incoming(spark, ("k3", 0))).filter("id = 'k3' and note = 'x' and n = 0").count() == 1
    assert grown.read().count() == 501
    monkeypatch.setattr(keyed, "BUCKET_BYTES", 1 << 30)
    grown.upsert(incoming(spark, ("z", 0)))
    assert grown._layouts()[0] >= buckets


def test_another_session_reads_the_same_table(spark, table, rows_of):
    other = KeyedTable(spark.newSession(), "elsewhere", SCHEMA, table.folder)
    assert rows_of(other.read()) == rows_of(table.read())


def test_append_with_generated_ids(spark):
    folder = new_folder(spark, "people")
    people = spark.createDataFrame([("ann",), ("ann",)], "username string")
    append_generated(people, folder)
    append_generated(people, folder)
    saved = spark.read.parquet(folder)
    assert saved.count() == 4 and saved.select("id").distinct().count() == 4


def test_inserting_grows_the_buckets(spark, monkeypatch):
    grown = KeyedTable(spark, "inserted", SCHEMA, new_folder(spark, "inserted"))
    grown.replace(incoming(spark, ("a", 1)))
    monkeypatch.setattr(keyed, "BUCKET_BYTES", 500)
    assert grown.insert_missing(many(spark, 500)).count() == 501
    assert grown._layouts()[0] > 1


def test_null_keys_are_refused(spark, table, rows_of):
    before = rows_of(table.read())
    for _ in range(2):
        with pytest.raises(Exception, match="null key"):
            table.upsert(incoming(spark, (None, 5), ("z", 1)))
    assert rows_of(table.read()) == before


def test_counters_add_once_per_batch(spark, table, rows_of):
    batch = incoming(spark, ("a", 5), ("n", 7))
    want = [("a", 6, "old"), ("b", 2, "old"), ("n", 7, None)]
    assert rows_of(table.add(batch, batch="first")) == want
    assert rows_of(table.add(batch, batch="first")) == want
    assert rows_of(table.add(batch, batch="second"))[0] == ("a", 11, "old")


def test_a_task_merges_a_few_megabytes_of_stored_rows(spark, table):
    free = KeyedTable(spark, "free", SCHEMA, new_folder(spark, "free"))
    assert [free._buckets_for(n << 20, None) for n in (1, 100, 1000)] == [1, 8, 64]


def test_a_settled_change_is_moved_and_not_written_again(spark, table, rows_of, monkeypatch):
    finish, written = KeyedTable._finish, []

    def seen(self, change=None):
        if change is not None:
            written.extend(f.split("/")[-1] for f in self._rows("pending/rows").inputFiles())
        return finish(self, change)

    monkeypatch.setattr(KeyedTable, "_finish", seen)
    table.upsert(many(spark, 60))
    assert written and set(written) <= {f.split("/")[-1] for f in table._stored().inputFiles()}
    assert table.read().count() == 62


def test_a_move_that_was_broken_off_goes_on(spark, table, rows_of, monkeypatch):
    move = KeyedTable._move_buckets

    def broken(self, source, target):
        name = sorted(s.getPath().getName() for s in self._at(source)[0].listStatus(self._at(source)[1]) if "=" in s.getPath().getName())[0]
        fs, place = self._at(f"{target}/{name}")
        fs.delete(place, True)
        assert fs.rename(self._at(f"{source}/{name}")[1], place)
        raise KeyboardInterrupt

    monkeypatch.setattr(KeyedTable, "_move_buckets", broken)
    with pytest.raises(KeyboardInterrupt):
        table.upsert(many(spark, 60))
    monkeypatch.setattr(KeyedTable, "_move_buckets", move)
    assert rows_of(table.read(), "id") == sorted([("a",), ("b",), *[(f"k{i}",) for i in range(60)]], key=repr)
