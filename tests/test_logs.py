import json

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import latest, logs
from tallyloom.sources.schemas import CORRUPT


def line(ts, im="im1", mac="mac1", se=None, text=None, **us):
    device = {"ai": "ai1", "am": 0, "appkey": "4", "c": "usa", "ch": "ch1", "im": im, "ir": False,
              "mac": mac, "pn": "app.one", "t": "model", "la": "en", "w": 0, **us}
    record = text or json.dumps({"us": device, "se": se if se is not None else []})
    return f"{ts}|127.0.0.1|{record}"


def frame(spark, *lines):
    return logs.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))


GOOD = line(5, se=[{"e": 9, "s": 1}, {"e": 8, "s": 2}])
HALF_BROKEN = line(6, text='{"us":{"ai":"ai1","pn":"app.one"},"se":[{"e":7,"s":1},{"e":,"s":2}]}')
BROKEN = line(7, text='{"us":{"ai":"ai2","pn":"app.one"},"se":[{"e":,"s":1}]}')


def test_malformed_lines_are_kept_whole(spark, rows_of):
    parsed = frame(spark, GOOD, HALF_BROKEN, BROKEN)
    assert rows_of(logs.malformed(parsed)) == sorted([(HALF_BROKEN,), (BROKEN,)])
    assert logs.good_records(parsed).count() == 1
    with_null = logs.malformed_with_null_field(parsed)
    assert with_null.columns == [CORRUPT, "se.e"] and with_null.dtypes[1][1] == "bigint"


def test_sessions_of_one_good_and_two_broken_lines(spark):
    parsed = frame(spark, GOOD, HALF_BROKEN, BROKEN)
    good = logs.good_records(parsed)
    assert logs.sessions(good, "us.ai").count() == 2
    assert logs.malformed(parsed).count() == 2
    kept = logs.good_records(parsed).unionByName(
        parsed.filter(F.col(CORRUPT).isNotNull())
        .withColumn("se", F.lit(None).cast(parsed.schema["se"].dataType))
        .drop(CORRUPT)
    )
    assert logs.sessions_or_null(kept, "us.ai").count() == 4


@pytest.mark.parametrize("pruning", ["true", "false"])
def test_the_split_does_not_depend_on_the_columns_read(spark, pruning):
    lines = [line(i) for i in range(51)]
    lines.insert(1, BROKEN)
    spark.conf.set("spark.sql.optimizer.enableJsonExpressionOptimization", pruning)
    try:
        parsed = frame(spark, *lines)
        good = logs.good_records(parsed)
        assert good.filter("us.pn is not null").count() == 51
        assert good.select("us.pn").count() == 51
        assert logs.malformed(parsed).count() == 1
    finally:
        spark.conf.unset("spark.sql.optimizer.enableJsonExpressionOptimization")


@pytest.mark.parametrize("text", ["", "no envelope", "x|ip|{}", "5|ip", "5|ip|[1", "|ip|{}"])
def test_lines_that_are_no_records(spark, text):
    parsed = frame(spark, text)
    assert logs.malformed(parsed).collect()[0][0] == text


def test_unknown_fields_are_ignored_and_pipes_may_occur_in_text(spark):
    row = logs.good_records(frame(spark, line(5, pn="a|b", extra=1))).first()
    assert row.us.pn == "a|b" and row.timestamp == 5 and row.ip == "127.0.0.1"


def test_flat_rows(spark):
    good = logs.good_records(frame(spark, line(5, se=[{"s": 1}, {"e": 2}]), line(6)))
    device = logs.device_rows(good)
    assert device.columns[-2:] == ["timestamp", "ip"] and device.count() == 2
    flat = logs.session_rows(good)
    got = sorted((r.timestamp, r.e, r.s) for r in flat.collect() if r.e)
    assert got == [(5, 2, None)] and flat.count() == 2
    assert logs.session_rows(good, keep_empty=True).count() == 3


def brute_latest(rows, keys):
    top = {}
    for r in rows:
        k = tuple(r[i] for i in keys)
        if None not in k and r[2] is not None:
            top[k] = max(top.get(k, r[2]), r[2])
    # A null key or time equals nothing, as in a join.
    return sorted(
        r for r in rows if r[2] is not None and top.get(tuple(r[i] for i in keys)) == r[2]
    )


@pytest.mark.parametrize("limit", [None, 0])
def test_latest_rows_keeps_ties_on_both_join_paths(spark, rows_of, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(latest, "bounded_broadcast", lambda df: df)
    rows = [("a", "x", 1, 1), ("a", "x", 3, 2), ("a", "y", 3, 3), ("b", "x", 2, 4),
            ("b", None, 9, 5), (None, "x", 9, 6), ("a", "x", 3, 2), ("c", "x", None, 7)]
    df = spark.createDataFrame(rows, "k string, l string, ts int, n int")
    for names, positions in ((["k"], [0]), (["k", "l"], [0, 1])):
        got = sorted(tuple(r[c] for c in df.columns)
                     for r in latest.latest_rows(df, names, "ts").collect())
        assert got == brute_latest([r for r in rows], positions)


def test_latest_rows_of_a_key_with_most_rows(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 100).alias("ts"),
        "id",
    )
    got = latest.latest_rows(df, ["k"], "ts")
    want = df.groupBy("k").agg(F.max("ts").alias("ts")).join(df, ["k", "ts"])
    assert got.count() == want.count()
    assert got.filter("k = 0").count() == df.filter("k = 0 and ts = 99").count()


@pytest.mark.parametrize("text", ["{}", '{"se":[]}', '{"us":null,"se":[]}'])
def test_records_without_their_device_are_quarantined(spark, text):
    parsed = frame(spark, GOOD, line(8, text=text))
    assert logs.good_records(parsed).count() == 1
    assert [r[0] for r in logs.malformed(parsed).collect()] == [line(8, text=text)]
