"""Kept identities, bitmaps of days, running sums, pages by key and compaction."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import activity
from tallyloom.operators.bitmaps import DeviceDays
from tallyloom.operators.identity import Identities
from tallyloom.operators.prefix import numbered, running_sum
from tallyloom.session import new_folder
from tallyloom.sources import compaction
from tallyloom.sources.keyed import KeyedTable, append_generated
from tallyloom.sources.pages import Pages


def roots_of(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return sorted((x, find(x)) for x in parent)


def test_batches_of_links_equal_one_batch(spark, rows_of):
    draw = random.Random(3)
    links = [(f"i{draw.randrange(40)}", f"m{draw.randrange(40)}") for _ in range(45)]
    links += [("alone", "alone")]
    kept = Identities(spark, "kept", new_folder(spark, "kept"), buckets=4)
    for low in range(0, len(links), 16):
        batch = [*links[low : low + 16], (None, "m1"), ("i1", None)]
        kept.absorb(spark.createDataFrame(batch, "a string, b string"))
    assert rows_of(kept.read()) == roots_of(links)
    again = rows_of(kept.absorb(spark.createDataFrame(links[:5], "a string, b string")))
    assert again == roots_of(links)


def test_a_batch_writes_only_buckets_of_its_nodes(spark):
    kept = Identities(spark, "few", new_folder(spark, "few"), buckets=16)
    kept.absorb(spark.range(200).selectExpr("'a' || id AS a", "'b' || id AS b"))
    before = set(kept.table._stored().inputFiles())
    kept.absorb(spark.createDataFrame([("a7", "c7")], "a string, b string"))
    assert len(before - set(kept.table._stored().inputFiles())) <= 1


@pytest.mark.parametrize("n", [0, 1, 500])
def test_running_sums(spark, rows_of, n):
    rows = spark.range(n).select("id", (F.col("id") * 37 % 101).alias("k"))
    rows = rows.withColumn("v", F.when(F.col("id") % 5 != 0, F.col("id") % 7))
    got = running_sum(rows, ["k", "id"], F.col("v"), "total").collect()
    total = 0
    for row in sorted(got, key=lambda r: (r.k, r.id)):
        total += row.v or 0
        assert row.total == total
    numbers = numbered(rows, ["k", "id"], start=10).orderBy("k", "id").collect()
    assert [r.number for r in numbers] == list(range(10, 10 + n))


def test_a_running_total_has_no_window_over_everything(spark):
    visits = spark.range(60).selectExpr("id AS device_id", "timestamp_seconds(id * 40000) AS ts")
    total = activity.running_total(visits)
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan
    assert total.agg(F.max("total")).first()[0] == 60


def visits(spark):
    draw = random.Random(6)
    day = datetime.datetime(2024, 1, 1)
    rows = [
        (draw.choice(["a", "b", None]), f"d{draw.randrange(30)}", day + datetime.timedelta(hours=draw.randrange(24 * 9)))
        for _ in range(400)
    ]
    return rows, spark.createDataFrame(rows, "app string, device_id string, ts timestamp_ntz")


def test_bitmaps_count_what_log_rows_do(spark, rows_of):
    rows, df = visits(spark)
    days = DeviceDays(spark, "seen", new_folder(spark, "seen"), ["app"])
    for first, last in ((1, 3), (4, 4), (5, 9), (9, 9)):
        between = F.dayofmonth("ts").between(first, last)
        days.add_days(df.filter(between))
    got = rows_of(days.activity().withColumn("day", F.col("day").cast("string")))
    starts = Counter((app, str(ts.date())) for app, _, ts in rows)
    actives = {k: len({d for a, d, ts in rows if (a, str(ts.date())) == k}) for k in starts}
    assert got == sorted([(*k, actives[k], n) for k, n in starts.items()], key=repr)
    want = activity.retention(df, ["app"], (1, 3))
    assert rows_of(days.retention((1, 3))) == rows_of(want)
    span = rows_of(days.active_between("2024-01-02", "2024-01-05"))
    assert span == sorted(
        [(a, len({d for app, d, ts in rows if app == a and 2 <= ts.day <= 5})) for a in ("a", "b", None)], key=repr
    )


def test_a_new_day_leaves_stored_days_alone(spark):
    _, df = visits(spark)
    days = DeviceDays(spark, "alone", new_folder(spark, "alone"), ["app"])
    days.add_days(df.filter(F.dayofmonth("ts") < 9))
    before = set(days._days().inputFiles())
    days.add_days(df.filter(F.dayofmonth("ts") == 9))
    assert before < set(days._days().inputFiles())


def test_pages_by_the_last_key(spark):
    rows = spark.range(1000).select((F.col("id") % 50).alias("a"), F.col("id").alias("b"), F.lit("x").alias("c"))
    pages = Pages(spark, new_folder(spark, "paged"), ["a", "b"], rows_per_range=100)
    pages.write(rows)
    want = sorted((i % 50, i) for i in range(1000))
    seen, last = [], None
    for _ in range(40):
        page = [(r.a, r.b) for r in pages.page(30, last).collect()]
        seen += page
        if not page:
            break
        last = page[-1]
    assert seen == want
    files = pages.page(10, (25, 500)).select("a").distinct()
    deep = pages.page(10, (25, 500))
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_range" in plan and files.count() >= 1
    assert [(r.a, r.b) for r in deep.collect()] == [w for w in want if w > (25, 500)][:10]
    assert pages.page(10, (99, 0)).count() == 0


def test_short_ranges_share_a_file(spark, rows_of):
    rows = spark.range(1000).select((F.col("id") % 50).alias("a"), F.col("id").alias("b"))
    pages = Pages(spark, new_folder(spark, "shared"), ["a", "b"], rows_per_range=100)
    pages.write(rows.repartition(3))
    assert len(spark.read.parquet(f"{pages.folder}/rows").inputFiles()) == 1
    ranges = spark.read.parquet(f"{pages.folder}/ranges").orderBy("most")
    order = sorted((i % 50, i) for i in range(1000))
    assert [(r["n"], tuple(r["most"])) for r in ranges.collect()] == [(100, order[k]) for k in range(99, 1000, 100)]
    assert [tuple(r) for r in pages.page(250, order[149]).collect()] == order[150:400]


def test_small_files_are_put_together(spark, rows_of):
    folder = new_folder(spark, "written")
    schema = "name string, id string"
    for n in range(12):
        append_generated(spark.createDataFrame([(f"{n}-{k}",) for k in range(3)], "name string").coalesce(1), folder)
    before = rows_of(spark.read.schema(schema).parquet(folder))
    assert compaction.compact(spark, folder, schema) == 12
    kept = spark.read.schema(schema).parquet(folder)
    assert rows_of(kept) == before and len(kept.inputFiles()) == 1
    assert compaction.compact(spark, folder, schema) == 0
    append_generated(spark.createDataFrame([("last",)], "name string").coalesce(1), folder)
    assert compaction.compact(spark, folder, schema, target_bytes=10) == 0
    assert compaction.compact(spark, folder, schema) == 2
    assert spark.read.schema(schema).parquet(folder).count() == 37


def test_identities_are_merged_without_a_grouping(spark, monkeypatch):
    """Their rows have a key each, and so have the entries of the index; null keys stay refused."""
    grouped = []
    one_per_key = KeyedTable.one_per_key

    def noted(self, *args):
        grouped.append(self.name)
        return one_per_key(self, *args)

    monkeypatch.setattr(KeyedTable, "one_per_key", noted)
    kept = Identities(spark, "lean", new_folder(spark, "lean"), buckets=2)
    kept.absorb(spark.createDataFrame([("b", "c"), ("d", "e")], "a string, b string"))
    rows = kept.absorb(spark.createDataFrame([("a", "c"), ("e", "f")], "a string, b string"))
    assert sorted(map(tuple, rows.collect())) == [*zip("abc", "aaa"), *zip("def", "ddd")]
    assert grouped == []
    with pytest.raises(Exception, match="null key"):
        kept.table.upsert(spark.createDataFrame([(None, "a")], "node string, root string"), unique=True)
