import json

from pyspark.sql import functions as F

from tallyloom.operators import devices, logs, stats
from tallyloom.session import new_folder
from tallyloom.sources import schemas
from tallyloom.sources.files import as_schema
from tallyloom.sources.keyed import KeyedTable
from tallyloom.streaming import log_stream


def put(folder, name, rows):
    lines = []
    for ts, im, pn in rows:
        us = {"ai": "a", "appkey": "4", "c": "usa", "ch": "ch1", "im": im, "mac": "m" + im, "pn": pn}
        lines.append(f"{ts}|127.0.0.1|" + json.dumps({"us": us, "se": []}))
    (folder / name).write_text("\n".join(lines) + "\nbroken\n")


FIRST = [(1612137600001, "i1", "app.one"), (1612137600002, "i1", "app.one")]
SECOND = [(1612137600005, "i1", "app.two"), (1612137600003, "i2", "app.one")]


def test_statistics_follow_the_files_and_survive_a_restart(spark, tmp_path, rows_of):
    source = tmp_path / "in"
    source.mkdir()
    checkpoint = str(tmp_path / "cp")
    table = KeyedTable(
        spark, "live_stats", schemas.CHANNEL_STATISTICS, new_folder(spark, "live-stats")
    )

    def run():
        records = log_stream.read_log_stream(spark, str(source), max_files=1)
        log_stream.keep_statistics(records, table, checkpoint).awaitTermination()
        return rows_of(table.read(), "id", "news", "starts")

    put(source, "one", FIRST)
    assert run() == [("app.one#ch1#usa4", 2, 2)]
    put(source, "two", SECOND)
    want = [("app.one#ch1#usa4", 3, 3), ("app.two#ch1#usa4", 1, 1)]
    assert run() == want
    assert run() == want

    lines = spark.read.text(str(source))
    batch = stats.with_statistic_id(logs.device_rows(logs.good_records(logs.parse_lines(lines))))
    assert rows_of(stats.increments(batch)) == want


def test_devices_follow_the_files(spark, tmp_path, rows_of):
    source = tmp_path / "in"
    source.mkdir()
    known = KeyedTable(
        spark, "live_devices", schemas.DEVICES, new_folder(spark, "live-devices"), key="device_id"
    )
    apps = KeyedTable(spark, "live_apps", schemas.APP_DEVICES, new_folder(spark, "live-apps"))
    for name, rows in (("one", FIRST), ("two", SECOND)):
        put(source, name, rows)
        records = log_stream.read_log_stream(spark, str(source))
        log_stream.keep_devices(records, known, apps, str(tmp_path / "cp")).awaitTermination()
    table = known.read()
    assert rows_of(table, "imei", "mac", "first_time") == [
        ("i1", "mi1", "2021-02-01T00:00:00.001Z"), ("i2", "mi2", "2021-02-01T00:00:00.003Z")]
    got = rows_of(apps.read(), "pkg_name", "first_time")
    assert got == [("app.one", "2021-02-01T00:00:00.002Z"), ("app.one", "2021-02-01T00:00:00.003Z"),
                   ("app.two", "2021-02-01T00:00:00.005Z")]
    lines = spark.read.text(str(source))
    rows = logs.device_rows(logs.good_records(logs.parse_lines(lines)))
    named = rows.withColumnsRenamed({"im": "imei"})
    none = spark.createDataFrame([], as_schema(schemas.DEVICES))
    at_once = devices.resolve_devices(named, none)
    assert rows_of(at_once.select("device_id").distinct()) == rows_of(table.select("device_id"))
    assert at_once.filter(F.col("device_id").isNull()).isEmpty()


def test_bad_lines_of_a_stream_are_kept(spark, tmp_path, rows_of):
    source = tmp_path / "in"
    source.mkdir()
    put(source, "one", FIRST)
    for _ in range(2):
        parsed = log_stream.read_parsed_stream(spark, str(source))
        log_stream.keep_malformed(parsed, str(tmp_path / "bad"), str(tmp_path / "cp")).awaitTermination()
    assert rows_of(spark.read.text(str(tmp_path / "bad"))) == [("broken",)]


def test_micro_batches_leave_no_scratch_tables(spark, tmp_path):
    from test_jobs import scratch_tables

    source = tmp_path / "in"
    source.mkdir()
    known = KeyedTable(spark, "scoped_devices", schemas.DEVICES, str(tmp_path / "d"), key="device_id")
    apps = KeyedTable(spark, "scoped_apps", schemas.APP_DEVICES, str(tmp_path / "a"))
    before = scratch_tables(spark)
    for name, rows in (("one", FIRST), ("two", SECOND)):
        put(source, name, rows)
        records = log_stream.read_log_stream(spark, str(source))
        log_stream.keep_devices(records, known, apps, str(tmp_path / "cp")).awaitTermination()
    assert scratch_tables(spark) == before
