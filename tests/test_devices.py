import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators import devices
from tallyloom.operators.components import component_roots

LOG = "imei string, mac string, android_id string, uuid string, timestamp bigint"
STORED = "device_id string, imei string, mac string, first_time string"


def roots_of(edges):
    """Union by least node."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


def check_components(spark, edges):
    df = spark.createDataFrame(edges, "a int, b int")
    assert {r.node: r.root for r in component_roots(df).collect()} == roots_of(edges)


@pytest.mark.parametrize(
    "edges",
    [
        [(i, i + 1) for i in range(90)],
        [(0, i) for i in range(1, 150)],
        [(999, i) for i in range(1, 150)],
        [(5, 5)],
        [(1, 2), (2, 1), (3, 4), (4, 4), (9, 9)],
    ],
    ids=["chain", "least hub", "greatest hub", "loop", "mixed"],
)
def test_components(spark, edges):
    check_components(spark, edges)


def test_components_of_random_graphs(spark):
    for seed in range(2):
        draw = random.Random(seed)
        n = draw.choice([20, 60, 120])
        check_components(spark, [(draw.randrange(n), draw.randrange(n)) for _ in range(n // 2 + 5)])


def brute_resolve(rows, stored):
    """The documented rule, one pair at a time, with a union-find for the open pairs."""

    def hit(column, value):
        found = [(s[3], s[0]) for s in stored if value is not None and s[column] == value]
        return min(found) if found else None

    pairs = {}
    for imei, mac, _, _, ts in rows:
        pairs[(imei, mac)] = min(ts, pairs.get((imei, mac), ts))
    known = {p: hit(1, p[0]) or hit(2, p[1]) for p in pairs}
    nodes = {p: [n for n in (p[0] and "i:" + p[0], p[1] and "m:" + p[1]) if n] for p in pairs}
    open_pairs = [p for p in pairs if known[p] is None and nodes[p]]
    root = roots_of([(nodes[p][0], nodes[p][-1]) for p in open_pairs])
    linked, first = {}, {}
    for p, device in known.items():
        for n in nodes[p] if device else []:
            if n in root:
                linked[root[n]] = min(device, linked.get(root[n], device))
    for p in open_pairs:
        key = (pairs[p], p[0] or "", p[1] or "")
        r = root[nodes[p][0]]
        first[r] = min(first.get(r, (key, p)), (key, p))
    out = {}
    for p in pairs:
        if known[p]:
            out[p] = known[p][1]
        elif nodes[p]:
            r = root[nodes[p][0]]
            imei, mac = first[r][1]
            digest = hashlib.sha256(f"{imei or 'null'}|{mac or 'null'}".encode()).hexdigest()
            out[p] = linked[r][1] if r in linked else digest
        else:
            out[p] = None
    return out


def resolve(spark, rows, stored):
    got = devices.resolve_devices(
        spark.createDataFrame(rows, LOG), spark.createDataFrame(stored, STORED)
    )
    return {(r.imei, r.mac): r.device_id for r in got.collect()}


def log_row(imei, mac, ts):
    return (imei, mac, f"a{ts}", f"u{ts}", ts)


def test_imei_first_then_mac_then_links(spark):
    stored = [("D1", "i1", "m1", "2016-01-01T00:00:00.000Z"),
              ("D2", "i2", "m2", "2016-02-01T00:00:00.000Z")]
    rows = [
        log_row("i1", "m2", 1),   # imei of D1 wins over mac of D2
        log_row("i9", "m2", 2),   # mac of D2
        log_row("i9", "m8", 3),   # i9 came with D2's mac
        log_row("i7", "m8", 4),   # m8 came with i9
        log_row("i5", "m5", 6),   # nothing known
        log_row("i5", "m6", 5),   # shares i5, and is earlier
    ]
    got = resolve(spark, rows, stored)
    new = hashlib.sha256(b"i5|m6").hexdigest()
    assert got == {("i1", "m2"): "D1", ("i9", "m2"): "D2", ("i9", "m8"): "D2", ("i7", "m8"): "D2",
                   ("i5", "m5"): new, ("i5", "m6"): new}
    assert got == brute_resolve(rows, stored)


def test_rows_that_share_both_identifiers_are_one_device(spark):
    rows = [log_row("i1", "m1", 2), log_row("i2", "m2", 1), log_row("i1", "m1", 1)]
    assert len(set(resolve(spark, rows, []).values())) == 2


identifier = st.one_of(st.none(), st.sampled_from("abcdefgh"))
log_rows = st.lists(st.tuples(identifier, identifier, st.integers(1, 9)), min_size=1, max_size=14)
stored_rows = st.lists(st.tuples(identifier, identifier, st.integers(1, 9)), max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(log_rows, stored_rows, st.randoms(use_true_random=False))
def test_resolution_follows_the_rule_in_any_row_order(spark, batch, known, shuffler):
    rows = [(i, m, f"a{n}", f"u{n}", t) for n, (i, m, t) in enumerate(batch)]
    stored = [(f"D{n}", i, m, f"2016-01-0{t}") for n, (i, m, t) in enumerate(known)]
    want = brute_resolve(rows, stored)
    shuffler.shuffle(rows)
    assert resolve(spark, rows, stored) == want


def test_device_table_update(spark, rows_of):
    stored = [("D1", "i1", "m1", "2016-01-01T00:00:00.000Z")]
    rows = [log_row("i1", "m9", 1612137600002), log_row("i1", "m8", 1612137600001),
            log_row("i3", "m3", 1612137600004)]
    df = spark.createDataFrame(rows, LOG)
    resolved = devices.resolve_devices(df, spark.createDataFrame(stored, STORED))
    got = rows_of(devices.device_table_update(df, resolved), "device_id", "imei", "mac",
                  "android_id", "first_time")
    new = hashlib.sha256(b"i3|m3").hexdigest()
    assert got == sorted([
        ("D1", "i1", "m9", "a1612137600002", "2016-01-01T00:00:00.000Z"),
        (new, "i3", "m3", "a1612137600004", "2021-02-01T00:00:00.004Z"),
    ], key=repr)


def test_attach_keeps_every_row(spark):
    rows = [log_row("i1", None, n) for n in range(5)] + [log_row(None, None, 9)]
    df = spark.createDataFrame(rows, LOG)
    resolved = devices.resolve_devices(df, spark.createDataFrame([], STORED))
    attached = devices.attach_device(df, resolved).collect()
    assert len(attached) == 6
    assert sum(r.device_id is None for r in attached) == 1


APP_ROW = "deviceId string, timestamp bigint, appkey string, ch string, c string, pn string, la string, t string"


def test_app_devices_take_the_latest_row_and_keep_ties(spark, rows_of):
    rows = [
        ("d1", 1612137600001, "4", "ch1", "usa", "app.one", "en", "m"),
        ("d1", 1612137600002, "4", "ch2", "usa", "app.two", "en", "m"),
        ("d1", 1612137600002, "4", "ch1", "usa", "app.one", "en", "m"),
        ("d2", 1612137600003, "5", "ch1", "usa", "app.one", "fr", "n"),
    ]
    df = spark.createDataFrame(rows, APP_ROW)
    got = devices.app_devices(df)
    assert set(got.columns) == {"first_time", "app_key", "channel", "country", "pkg_name",
                                "device_id", "language", "model", "id"}
    assert rows_of(got, "id", "first_time", "channel") == [
        ("app.one#d1", "2021-02-01T00:00:00.002Z", "ch1"),
        ("app.one#d2", "2021-02-01T00:00:00.003Z", "ch1"),
        ("app.two#d1", "2021-02-01T00:00:00.002Z", "ch2"),
    ]
    seen = rows_of(devices.app_devices(df, first_seen=True), "id", "first_time")
    assert ("app.one#d1", "2021-02-01T00:00:00.001Z") in seen


def test_one_pair_with_most_rows(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot i")).otherwise(F.concat(F.lit("i"), "id")).alias("imei"),
        F.when(F.col("id") % 3 != 0, F.lit("hot m")).otherwise(F.concat(F.lit("m"), "id")).alias("mac"),
        F.col("id").alias("timestamp"),
    )
    resolved = devices.resolve_devices(rows, spark.createDataFrame([], STORED))
    attached = devices.attach_device(rows, resolved)
    assert attached.count() == 30000
    assert attached.select("device_id").distinct().count() == 10001
