from pyspark.sql import functions as F

from tallyloom.operators import basics, clusters


def test_word_count(spark, rows_of):
    lines = spark.createDataFrame(
        [("good day this is my first count",), ("good night this is my first program",)], "value string"
    )
    got = dict(rows_of(basics.word_count(lines)))
    assert got == {"good": 2, "day": 1, "this": 2, "is": 2, "my": 2, "first": 2, "count": 1,
                   "night": 1, "program": 1}


def test_word_count_keeps_inner_empties_and_drops_trailing_ones(spark, rows_of):
    lines = spark.createDataFrame([("a  b  ",), ("",), ("   ",), (" a",)], "value string")
    assert dict(rows_of(basics.word_count(lines))) == {"a": 2, "b": 1, "": 3}


def test_text_of_several_lines_counts_line_by_line(spark, rows_of):
    whole = spark.createDataFrame([("a b \nb c",)], "value string")
    assert dict(rows_of(basics.word_count(whole))) == {"a": 1, "b": 2, "c": 1}


def test_distincts(spark, rows_of):
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 6, 1, 3)], "n int")
    assert rows_of(basics.distinct_counts(df, "n")) == [(7, 5)]
    assert rows_of(basics.distinct_counts(df.limit(0), "n")) == [(0, 0)]
    paired = df.withColumn("r", F.monotonically_increasing_id())
    assert paired.distinct().count() == 7
    assert rows_of(basics.distinct_on(paired, ["n"]), "n") == [(1,), (2,), (3,), (4,), (6,)]


def test_count_by_leaves_out_nulls(spark, rows_of):
    df = spark.createDataFrame([("p", "c"), ("p", None), ("p", "c")], "pn string, ch string")
    assert rows_of(basics.count_by(df, "pn", "ch", present=["ch"])) == [("p", "c", 2)]


def test_page(spark):
    df = spark.range(100).withColumn("v", -F.col("id"))
    got = basics.page(df, [F.col("v").asc()], start=5, size=3)
    assert [r.id for r in got.collect()] == [94, 93, 92]


def test_positive_norms(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (46341, 46341)], "a int, b int")
    assert basics.positive_norms(df, F.col("a"), F.col("b")).first().hits == 2


def test_counters(spark):
    df = spark.range(10)
    rows, seen = basics.with_counters(df, {"total": None, "even": F.col("id") % 2 == 0}, "t")
    assert rows.count() == 10
    assert seen.get == {"total": 10, "even": 5}


def test_two_obvious_clusters(spark):
    points = [([v, v, v],) for v in (0.0, 0.1, 0.2, 9.0, 9.1, 9.2)]
    df = spark.createDataFrame(points, "features array<double>")
    model, rows = clusters.fit_kmeans(df, F.col("features"), k=2, seed=1)
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.cluster, set()).add(r.features[0])
    assert sorted(groups.values(), key=min) == [{0.0, 0.1, 0.2}, {9.0, 9.1, 9.2}]
    assert sorted(round(c[0], 6) for c in model.clusterCenters()) == [0.1, 9.1]
