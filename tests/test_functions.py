from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import keys, numbers, records, sql_names, text, times
from tallyloom.session import stage


def jvm_split(value: str, sep: str) -> list[str]:
    pieces = value.split(sep)
    if len(pieces) == 1:
        return pieces
    while pieces and pieces[-1] == "":
        pieces.pop()
    return pieces


@pytest.mark.parametrize("sep", [" ", "::", ";", "|"])
def test_split_matches_the_jvm(spark, sep):
    values = ["", sep, sep * 3, f"a{sep}b", f"{sep}a", f"a{sep}{sep}b", f"a{sep}{sep}", "a"]
    values += ["a:::", "::a", "a: :b", f"x{sep}y{sep}z{sep}"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r.v: r.p for r in df.select("v", text.split_drop_trailing(F.col("v"), sep).alias("p")).collect()}
    assert got == {v: jvm_split(v, sep) for v in values}


def test_split_null(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert df.select(text.words(F.col("v")).alias("p")).first().p is None


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab: ", max_size=8), min_size=1, max_size=20))
def test_split_any_text(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for sep in (" ", "::"):
        got = df.select("v", text.split_drop_trailing(F.col("v"), sep).alias("p")).collect()
        assert all(r.p == jvm_split(r.v, sep) for r in got)


def one(spark, column, value, dtype="bigint"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "seconds,bucket",
    [(-5, 3600), (0, 3600), (3599, 3600), (3600, 7200), (86399, 86400), (86400, 172800),
     (172799, 172800), (172800, 259200)],
)
def test_duration_bucket(spark, seconds, bucket):
    assert one(spark, times.duration_bucket, seconds) == bucket


def test_iso_text(spark):
    assert one(spark, times.iso_utc, 1612137600002) == "2021-02-01T00:00:00.002Z"
    assert one(spark, times.iso_utc, 0) == "1970-01-01T00:00:00.000Z"
    assert one(spark, times.iso_utc, -1) == "1969-12-31T23:59:59.999Z"
    for value in ("2021-02-01T00:00:00.002Z", "2021-02-01T08:00:00.002+08:00"):
        assert one(spark, times.millis_from_iso, value, "string") == 1612137600002


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    samples = [1612137600002, 1457852400000, 1478412000000, 1704067199999, 0, -86400001]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(m,) for m in samples], "ms bigint")
        got = df.select(
            "ms",
            times.iso_utc(F.col("ms")).alias("iso"),
            times.millis_from_iso(times.iso_utc(F.col("ms"))).alias("back"),
            times.day_text(F.col("ms")).alias("home"),
            times.day_text(F.col("ms"), "UTC").alias("utc"),
            times.day_start_millis(times.day_text(F.col("ms"))).alias("start"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for r in got:
        at = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=r.ms)
        home = at.astimezone(timezone(timedelta(hours=8)))
        assert r.iso == at.strftime("%Y-%m-%dT%H:%M:%S.") + f"{at.microsecond // 1000:03d}Z"
        assert r.back == r.ms
        assert (r.home, r.utc) == (home.strftime("%Y-%m-%d"), at.strftime("%Y-%m-%d"))
        midnight = home.replace(hour=0, minute=0, second=0, microsecond=0)
        assert r.start == round(midnight.timestamp() * 1000)


@pytest.mark.parametrize(
    "value", ["20210201T000000.002+0000", "20210201T000000.002Z", "20210201T080000.002+0800"]
)
def test_basic_date(spark, value):
    got = one(spark, lambda c: F.unix_millis(times.instant_from_basic(c)), value, "string")
    assert got == 1612137600002


def test_numbers(spark):
    assert one(spark, numbers.strict_number, "12", "string") == 12
    assert one(spark, numbers.lenient_number, "12x", "string") is None
    with pytest.raises(Exception):
        one(spark, numbers.strict_number, "12x", "string")
    assert one(spark, numbers.wrap_int32, 2147483648) == -2147483648
    assert one(spark, numbers.wrap_int32, -2147483649) == 2147483647
    assert one(spark, numbers.wrap_int32, 7) == 7
    big = spark.createDataFrame([(2147483647,)], "v int")
    norm = big.select(numbers.squared_norm(F.col("v"), F.col("v")).alias("n")).first().n
    assert norm == 2 * 2147483647**2
    ratio = spark.createDataFrame([(10, 3), (1, 0)], "a bigint, b bigint").select(
        numbers.float_ratio(F.col("a"), F.col("b")).alias("r")
    )
    assert ratio.dtypes == [("r", "float")]
    assert [r.r for r in ratio.collect()] == [3.3333332538604736, None]


def test_float_ratio_rounds_its_operands(spark):
    """Sums past 24 bits: rounding before the division is not the same as after it."""
    pairs = [(s, n) for s in range(123456789, 123456989, 7) for n in (3, 7, 33554435, 16777219)]
    want = [float(np.float32(s) / np.float32(n)) for s, n in pairs]
    assert want != [float(np.float32(s / n)) for s, n in pairs]
    sql_names.register_sql_functions(spark)
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(pairs)], "i int, s bigint, n bigint")
    got = stage(df, "pairs").select(
        "i",
        numbers.float_ratio(F.col("s"), F.col("n")).alias("r"),
        F.expr("float_ratio(s, n)").alias("q"),
    )
    rows = got.orderBy("i").collect()
    assert [r.r for r in rows] == want
    assert [r.q for r in rows] == want


def test_random_int_is_repeatable_and_in_range(spark):
    draw = [r.r for r in spark.range(0, 500, 1, 2).select(numbers.random_int(3).alias("r")).collect()]
    again = [r.r for r in spark.range(0, 500, 1, 2).select(numbers.random_int(3).alias("r")).collect()]
    assert draw == again and len(set(draw)) > 490
    assert min(draw) < 0 < max(draw)


def test_keys(spark):
    df = spark.createDataFrame(
        [("p", "ch", "usa", "4"), ("p", None, "usa", None)], "p string, ch string, c string, k string"
    )
    got = df.select(keys.statistic_key(*[F.col(c) for c in df.columns]).alias("id")).collect()
    assert [r.id for r in got] == ["p#ch#usa4", "p#null#usanull"]
    safe = df.select(keys.statistic_key(*[F.col(c) for c in df.columns], "#").alias("id")).first()
    assert safe.id == "p#ch#usa#4"
    assert df.select(keys.app_device_key(F.col("p"), F.col("k")).alias("id")).first().id == "p#4"


def test_maps(spark):
    df = spark.createDataFrame(
        [({"a": 1, "b": 2}, {"b": 3, "c": 4})], "l map<string,int>, r map<string,int>"
    )
    merged = df.select(records.merge_maps(F.col("l"), F.col("r")).alias("m")).first().m
    assert merged == {"a": 1, "b": 3, "c": 4}
    parsed = spark.createDataFrame([('{"x":"1","y":"z"}',)], "j string")
    assert parsed.select(records.record_map(F.col("j")).alias("m")).first().m == {"x": "1", "y": "z"}
    text_of = spark.createDataFrame([(1, "a")], "n int, s string").select(
        records.to_record("n", "s").alias("j")
    )
    assert text_of.first().j == '{"n":1,"s":"a"}'


def test_sql_functions_are_expanded_in_the_plan(spark):
    sql_names.register_sql_functions(spark)
    got = spark.sql(
        "SELECT add_counts(NULL, 3L) AS a, add_counts(2L, 3L) AS b, add_counts(NULL, NULL) AS c,"
        " float_ratio(1L, 4L) AS r, float_ratio(1L, 0L) AS z"
    ).first()
    assert tuple(got) == (3, 5, 0, 0.25, None)
