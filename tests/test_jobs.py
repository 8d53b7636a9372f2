import json

import pytest

from tallyloom.__main__ import parser, run


def us(n, pn="app.one", ch="ch1", key="4", im=None):
    im = im or f"im{n}"
    return {"ai": f"ai{n}", "appkey": key, "c": "usa", "ch": ch, "im": im, "mac": "mac" + im,
            "la": "en", "pn": pn, "t": "model", "ir": False, "w": 0}


def write_log(path, *records):
    lines = [f"{ts}|127.0.0.1|" + json.dumps({"us": u, "se": se}) for ts, u, se in records]
    path.write_text("\n".join([*lines, '9|127.0.0.1|{"us":{"ai":"x"},"se":[{"e":,"s":1}]}']) + "\n")


def test_channel_log(spark, tmp_path, rows_of):
    store = str(tmp_path / "store")

    def load(name, *records):
        write_log(tmp_path / name, *records)
        args = parser().parse_args(
            ["channel-log", "--path", str(tmp_path / name), "--store", store])
        return run(spark, args)

    one = load(
        "one",
        (1612137600002, us(1, key="k1"), [{"e": 2, "s": 1}, {"e": 3, "s": 1}]),
        (1612137600003, us(2, key="k2"), [{"s": 1}, {"e": 2}]),
        (1612137600004, us(3, "app.two", "ch2", "k3"), [{"s": 1}, {"e": 2}]),
        (1612137600004, us(4, "app.two", "ch2", "k4"), [{"s": 1}, {"e": 2}]),
    )
    assert one["devices"].count() == one["app_devices"].count() == 4
    assert rows_of(one["channel_statistics"], "id", "news", "starts") == [
        ("app.one#ch1#usak1", 1, 1), ("app.one#ch1#usak2", 1, 1),
        ("app.two#ch2#usak3", 1, 1), ("app.two#ch2#usak4", 1, 1)]
    assert one["malformed"].count() == 1

    first = {r.imei: (r.device_id, r.first_time) for r in one["devices"].collect()}
    two = load(
        "two",
        (1612137700000, us(1, key="k1"), []),
        (1612137700001, us(1, "app.two", "ch2", "k3"), []),
        (1612137700002, us(5, key="k1"), []),
    )
    second = {r.imei: (r.device_id, r.first_time) for r in two["devices"].collect()}
    assert len(second) == 5 and first.items() <= second.items()
    counters = dict(rows_of(two["channel_statistics"], "id", "starts"))
    assert counters == {"app.one#ch1#usak1": 3, "app.one#ch1#usak2": 1, "app.two#ch2#usak3": 2,
                        "app.two#ch2#usak4": 1}
    assert two["app_devices"].count() == 6


def test_rating_jobs(spark, tmp_path, rows_of):
    files = {
        "ratings": "1::7::5::1\n2::7::4::1\n2::8::1::1\n3::8::2::1\n",
        "users": "1::M::18::4::0\n2::M::18::4::0\n3::F::25::4::0\n",
        "movies": "7::Seven (1995)::Crime\n8::Eight (1999)::Crime|Drama\n",
    }
    given = []
    for name, text in files.items():
        (tmp_path / name).write_text(text)
        given += [f"--{name}", str(tmp_path / name)]
    lists = run(spark, parser().parse_args(["top-lists", *given[:4]]))
    assert [tuple(r) for r in lists["movies_by_mean"].collect()] == [(7, 4.5), (8, 1.5)]
    assert [tuple(r) for r in lists["users"].collect()] == [(2, 2), (1, 1), (3, 1)]
    assert rows_of(lists["users_by_gender"]) == [("F", 3, 1), ("M", 1, 1), ("M", 2, 2)]
    popular = run(spark, parser().parse_args(["popular", *given]))["popular"]
    assert rows_of(popular) == [(7, "Seven (1995)", 2), (8, "Eight (1999)", 1)]
    audience = ["audience", *given, "--title", "Eight (1999)"]
    want = [("F", 25, 1), ("M", 18, 1)]
    assert rows_of(run(spark, parser().parse_args(audience))["audience"]) == want
    assert rows_of(run(spark, parser().parse_args([*audience, "--distinct"]))["audience"]) == want


def test_words_job(spark, tmp_path, rows_of):
    (tmp_path / "text").write_text("a b\na\n")
    got = run(spark, parser().parse_args(["words", "--path", str(tmp_path / "text")]))["words"]
    assert rows_of(got) == [("a", 2), ("b", 1)]


def scratch_tables(spark):
    from tallyloom.session import scratch_root

    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()


def test_a_batch_counts_once_and_leaves_only_what_is_read(spark, tmp_path, rows_of):
    from tallyloom.plans import jobs

    write_log(tmp_path / "log", (1612137600002, us(1), []), (1612137600003, us(1), []))
    before = scratch_tables(spark)
    load = lambda: jobs.channel_log(spark, str(tmp_path / "log"), str(tmp_path / "store"), "day 1")
    once = rows_of(load()["channel_statistics"], "id", "news", "starts")
    left = {name.rsplit("-", 1)[0] for name in scratch_tables(spark) - before}
    assert left == {"parsed"}
    assert rows_of(load()["channel_statistics"], "id", "news", "starts") == once
    assert once == [("app.one#ch1#usa4", 2, 2)]


def test_new_files_of_a_folder_are_counted(spark, tmp_path, rows_of):
    """Run twice over one folder with a new file between, then with a changed one."""
    folder, store = tmp_path / "logs", str(tmp_path / "store")
    folder.mkdir()

    def load(*more):
        args = ["channel-log", "--path", str(folder), "--store", store, *more]
        return run(spark, parser().parse_args(args))

    write_log(folder / "one", (1612137600002, us(1), []), (1612137600003, us(2), []))
    counted = ["id", "news", "starts"]
    assert rows_of(load()["channel_statistics"], *counted) == [("app.one#ch1#usa4", 2, 2)]
    write_log(folder / "two [x]", (1612137600004, us(1), []))
    second = load()
    assert rows_of(second["channel_statistics"], *counted) == [("app.one#ch1#usa4", 3, 3)]
    assert second["malformed"].count() == 1 and second["devices"].count() == 2
    third = load()
    assert rows_of(third["channel_statistics"], *counted) == [("app.one#ch1#usa4", 3, 3)]
    assert third["malformed"].count() == 0
    write_log(folder / "three", (1612137600005, us(1), []))
    assert rows_of(load("--batch", "day 3")["channel_statistics"], *counted) == [("app.one#ch1#usa4", 4, 4)]
    write_log(folder / "four", (1612137600006, us(1), []))
    with pytest.raises(ValueError, match="begun without"):
        load("--batch", "day 3")
    write_log(folder / "one", (1612137600002, us(1), []))
    with pytest.raises(ValueError, match="has changed"):
        load()


def test_a_batch_that_failed_is_taken_up_again(spark, tmp_path, rows_of, monkeypatch):
    from tallyloom.plans import jobs
    from tallyloom.sources.keyed import KeyedTable

    folder, store = tmp_path / "logs", str(tmp_path / "store")
    folder.mkdir()
    write_log(folder / "one", (1612137600002, us(1), []))
    add = KeyedTable.add

    def failing(self, *given):
        raise KeyboardInterrupt

    monkeypatch.setattr(KeyedTable, "add", failing)
    with pytest.raises(KeyboardInterrupt):
        jobs.channel_log(spark, str(folder), store)
    monkeypatch.setattr(KeyedTable, "add", add)
    write_log(folder / "two", (1612137600003, us(1), []))
    done = jobs.channel_log(spark, str(folder), store)
    assert rows_of(done["channel_statistics"], "id", "starts") == [("app.one#ch1#usa4", 2)]


def test_only_statistics_of_new_app_devices_are_seeded(spark, tmp_path, rows_of):
    from tallyloom.plans import jobs
    from tallyloom.sources import schemas
    from tallyloom.sources.keyed import KeyedTable

    apps = KeyedTable(spark, "seed_apps", schemas.APP_DEVICES, str(tmp_path / "apps"))
    table = KeyedTable(spark, "seed_stats", schemas.CHANNEL_STATISTICS, str(tmp_path / "stats"))
    columns = "deviceId string, pn string, ch string, c string, appkey string, la string, t string, timestamp long"

    def rows(*found):
        return spark.createDataFrame([(d, pn, ch, "usa", "4", "en", "m", ts) for d, pn, ch, ts in found], columns)

    first = jobs.seed_new_devices(rows(("d1", "app.one", "ch1", 5)), apps, table)
    assert rows_of(first, "id") == [("app.one#ch1#usa4",)]
    # d1 is known, so its new channel is not seeded; d2 is new.
    second = jobs.seed_new_devices(
        rows(("d1", "app.one", "ch2", 6), ("d2", "app.two", "ch1", 7)), apps, table
    )
    assert rows_of(second, "id", "news") == [("app.one#ch1#usa4", 1), ("app.two#ch1#usa4", 1)]
