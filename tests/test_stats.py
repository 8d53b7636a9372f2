import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from tallyloom.operators import activity, stats
from tallyloom.session import new_folder
from tallyloom.sources import schemas
from tallyloom.sources.files import as_schema
from tallyloom.sources.keyed import KeyedTable

ROW = "pn string, ch string, c string, appkey string, timestamp bigint"
ROWS = [
    ("app.one", "ch1", "usa", "4", 1612137600002),
    ("app.one", "ch1", "usa", "4", 1612137600001),
    ("app.two", "ch2", "usa", "4", 1612137600001),
]
COUNTERS = "id string, news bigint, starts bigint"


@pytest.fixture(scope="module")
def rows(spark):
    return stats.with_statistic_id(spark.createDataFrame(ROWS, ROW))


def test_rows_of_one_id_add_up_or_count_once(spark, rows, rows_of):
    stored = spark.createDataFrame([("app.one#ch1#usa4", 10, None), ("other", 1, 1)], COUNTERS)
    assert rows_of(stats.incremented(rows, stored)) == [
        ("app.one#ch1#usa4", 12, 2), ("app.two#ch2#usa4", 1, 1)]
    assert rows_of(stats.incremented(rows, stored, once=True)) == [
        ("app.one#ch1#usa4", 11, 1), ("app.two#ch2#usa4", 1, 1)]


def test_seeds(spark, rows):
    got = {r.id: r.asDict() for r in stats.seeds(rows).collect()}
    one = got["app.one#ch1#usa4"]
    assert (one["@timestamp"], one["news"], one["starts"]) == ("2021-02-01T00:00:00.001Z", 1, 1)
    assert (one["app_id"], one["app_key"], one["country"], one["pkg_name"]) == (
        "4", "4", "usa", "app.one")
    assert one["keep30"] == 0 and one["startAvg"] == 0.0 and one["type"] == ""
    missing = set(as_schema(schemas.CHANNEL_STATISTICS).names) - set(one)
    assert missing == {"total"}
    stored = spark.createDataFrame([("app.one#ch1#usa4",)], "id string")
    assert [r.id for r in stats.new_seeds(rows, stored).collect()] == ["app.two#ch2#usa4"]


def test_counters_in_a_keyed_table(spark, rows, rows_of):
    table = KeyedTable(
        spark, "stats_test", schemas.CHANNEL_STATISTICS, new_folder(spark, "stats-test")
    )
    table.insert_missing(stats.seeds(rows))
    table.upsert(stats.incremented(rows, table.read()))
    got = rows_of(table.read(), "id", "news", "starts", "pkg_name")
    assert got == [("app.one#ch1#usa4", 3, 3, "app.one"), ("app.two#ch2#usa4", 2, 2, "app.two")]


@pytest.fixture(scope="module")
def visits(spark):
    draw = random.Random(11)
    start = datetime(2024, 1, 1)
    data = [
        (draw.choice("ab"), draw.randrange(25), start + timedelta(hours=draw.randrange(24 * 40)))
        for _ in range(600)
    ]
    return data, spark.createDataFrame(data, "app string, device_id int, ts timestamp_ntz")


def test_news_activity_and_averages(visits):
    data, df = visits
    first = {}
    for app, device, ts in data:
        first[(app, device)] = min(ts, first.get((app, device), ts))
    want = Counter((app, ts.date()) for (app, _), ts in first.items())
    got = activity.news(df, ["app"]).collect()
    assert {(r.app, r.day): r.news for r in got} == want
    hourly = Counter((app, ts.date(), ts.hour) for (app, _), ts in first.items())
    got = activity.news(df, ["app"], hourly=True).collect()
    assert {(r.app, r.day, r.hour): r.news for r in got} == hourly
    starts = Counter((app, ts.date()) for app, _, ts in data)
    actives = {k: len({d for a, d, t in data if (a, t.date()) == k}) for k in starts}
    for r in activity.start_average(df, ["app"]).collect():
        key = (r.app, r.day)
        assert (r.starts, r.actives) == (starts[key], actives[key])
        assert r.start_avg == pytest.approx(starts[key] / actives[key], rel=1e-6)
    hours = Counter((ts.date(), ts.hour) for _, _, ts in data)
    got = activity.activity(df, hourly=True).collect()
    assert {(r.day, r.hour): r.starts for r in got} == hours


def test_running_total(visits):
    data, df = visits
    for by in (["app"], []):
        totals = activity.running_total(df, by).collect()
        devices = {(tuple([a] if by else []), d) for a, d, _ in data}
        last = {}
        for r in totals:
            key = (r.app,) if by else ()
            last[key] = max(last.get(key, 0), r.total)
        assert last == {k: len([1 for kk, _ in devices if kk == k]) for k in last}


def test_retention(visits):
    data, df = visits
    days = {}
    for app, device, ts in data:
        days.setdefault((app, device), set()).add(ts.date())
    want = {}
    for (app, _), seen in days.items():
        row = want.setdefault((app, min(seen)), Counter())
        row["news"] += 1
        for n in activity.KEEP_DAYS:
            row[n] += (min(seen) + timedelta(days=n)) in seen
    got = activity.retention(df, ["app"]).collect()
    assert len(got) == len(want)
    for r in got:
        row = want[(r.app, r.install_day)]
        assert r.news == row["news"]
        for n in activity.KEEP_DAYS:
            assert r[f"keep_{n}"] == row[n]
            assert r[f"keep_{n}_ratio"] == pytest.approx(row[n] / row["news"], rel=1e-6)
