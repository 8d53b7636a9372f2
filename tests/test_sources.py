
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import basics
from tallyloom.session import bounded_broadcast, drop_staged, measured_bytes, new_folder, scratch_root, stage
from tallyloom.sources import files, schemas
from tallyloom.sources.jdbc import JdbcTable


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_lines_and_minimum_partitions(spark, tmp_path, rows_of):
    path = put(tmp_path, "words.txt", "one two\ntwo three\n")
    lines = files.read_lines(spark, path, min_partitions=3)
    assert lines.rdd.getNumPartitions() >= 3
    assert rows_of(basics.word_count(lines)) == [("one", 1), ("three", 1), ("two", 2)]
    arrays = basics.split_lines(lines).select("words", "one")
    assert rows_of(arrays) == [(["one", "two"], 1), (["two", "three"], 1)]


def test_ratings_files(spark, tmp_path, rows_of):
    ratings = files.read_ratings(spark, put(tmp_path, "r", "1::1193::5::978300760\n2::7::3::9\n"))
    assert rows_of(ratings) == [(1, 1193, 5, 978300760), (2, 7, 3, 9)]
    users = files.read_users(spark, put(tmp_path, "u", "1::F::1::10::48067\n"))
    assert rows_of(users) == [(1, "F", 1, 10, "48067")]
    movies = files.read_movies(spark, put(tmp_path, "m", '7::A "B", C (1995)::Drama|War\n'))
    assert rows_of(movies) == [(7, 'A "B", C (1995)', "Drama|War")]


def test_bad_number_in_a_delimited_file_stops_the_query(spark, tmp_path):
    bad = files.read_ratings(spark, put(tmp_path, "bad", "1::x::5::9\n"))
    with pytest.raises(Exception):
        bad.collect()


def test_json_lines(spark, tmp_path, rows_of):
    text = '{"commit":"a1","author":"x","author_email":"x@t","date":"d1"}\n'
    text += '{"commit":"b2","author":"y","author_email":"y@t","date":"d2"}\n'
    commits = files.read_json_lines(spark, put(tmp_path, "c", text), schemas.COMMITS)
    assert commits.columns == ["author", "author_email", "commit", "date"]
    assert rows_of(commits.filter("date = 'd2'"), "commit") == [("b2",)]
    assert commits.drop("author").columns == ["author_email", "commit", "date"]


def test_people(spark, rows_of):
    lines = spark.createDataFrame([("ann;1;a@t",), ("bob;2;",)], "value string")
    assert rows_of(files.parse_people(lines)) == [("ann", "1", "a@t"), ("bob", "2", None)]


def test_season_files(spark, tmp_path, rows_of):
    names = files.as_schema(schemas.SEASON_STATS).names
    header = ",".join(names)

    def line(rank, player, points):
        row = dict.fromkeys(names, "")
        row.update({"Rk": str(rank), "Player": player, "Age": "23", "FG%": ".434", "PTS": points})
        return ",".join(row[n] for n in names)

    for season, count in ((1970, 45), (1971, 3)):
        lines = [""]
        for i in range(count):
            if i % 20 == 0:
                lines.append(header)
            lines.append(line(i + 1, f"P{i}*", "7.5"))
        put(tmp_path, f"stats_{season}_per_game.csv", "\n".join(lines))
    got = files.read_season_stats(spark, str(tmp_path))
    assert rows_of(got.groupBy("season").count()) == [(1970, 45), (1971, 3)]
    assert len(got.columns) == 31
    first = got.filter("Rk = 1 and season = 1970").first()
    assert (first["Player"], first["FG%"], first["PTS"], first["GS"]) == ("P0*", 0.434, 7.5, None)


def test_vectors(spark, tmp_path, rows_of):
    got = files.read_vectors(spark, put(tmp_path, "v", "0.0 0.5 1\n9 9.1 9.2\n"))
    assert rows_of(got) == [([0.0, 0.5, 1.0],), ([9.0, 9.1, 9.2],)]


def test_literal_rows_and_ranges(spark):
    assert files.rows(spark, [(1,), (2,)], "n int", slices=2).count() == 2
    numbers = files.integer_range(spark, 10, 5)
    assert numbers.rdd.getNumPartitions() == 5
    assert [r.id for r in numbers.collect()] == list(range(1, 11))


def test_schemas_parse():
    for name in ("DEVICES", "APP_DEVICES", "CHANNEL_STATISTICS", "TEST_USER", "TEST_COUNTRY",
                 "TEST_USER_HISTORY", "APP", "APP_DEVICE", "CHANNEL", "CHANNEL_STATISTICS_DAY",
                 "SOURCE", "LOG_RECORD"):
        assert len(files.as_schema(getattr(schemas, name))) >= 3
    assert len(files.as_schema(schemas.SEASON_STATS)) == 30


class Recorder:
    """Stands in for a reader or writer and keeps the options it is given."""

    def __init__(self):
        self.given = {}

    def format(self, name):
        self.given["format"] = name
        return self

    def mode(self, name):
        self.given["mode"] = name
        return self

    def options(self, **options):
        self.given.update(options)
        return self

    def load(self):
        return self.given

    save = load


class Holder:
    def __init__(self):
        self.read = self.write = Recorder()


def test_jdbc_options():
    table = JdbcTable("jdbc:x:y", "user_info", {"driver": "d"}, "user_id", 1, 1000, 8)
    got = table.read(Holder())
    assert got["format"] == "jdbc" and got["dbtable"] == "user_info" and got["driver"] == "d"
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == (
        "user_id", "1", "1000", "8")
    assert "partitionColumn" not in JdbcTable("u", "t").read(Holder())
    sink = Holder()
    JdbcTable("u", "t").append(sink)
    assert sink.write.given["mode"] == "append" and sink.write.given["batchsize"] == "5000"


def test_scratch_follows_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    assert root.endswith("/tallyloom")
    if named:
        assert root.startswith(named.rstrip("/"))
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_stage_keeps_rows_and_cuts_lineage(spark, rows_of):
    df = spark.range(10).select(F.col("id"), (F.col("id") % 3).cast("string").alias("s"))
    staged = stage(df, "t")
    assert staged.dtypes == df.dtypes and rows_of(staged) == rows_of(df)
    assert all("/tallyloom/t-" in f for f in staged.inputFiles())


def test_nested_columns_are_measured(spark):
    df = spark.createDataFrame([([1, 2], {"a": "b"}), (None, None)], "l array<int>, m map<string,string>")
    assert measured_bytes(df) > 2 * 16


def test_dropping_a_staged_table_leaves_others(spark):
    kept, dropped = stage(spark.range(3).toDF("n"), "kept"), stage(spark.range(3).toDF("n"), "gone")
    drop_staged(dropped)
    assert kept.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(dropped.inputFiles()[0]).count()


def test_broadcast_only_within_the_limit(spark):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    df = spark.range(1000).select(F.col("id").cast("string").alias("s"))
    assert measured_bytes(df) == sum(len(str(i)) + 32 for i in range(1000))
    other = spark.range(5).select(F.col("id").cast("string").alias("s"))
    small = other.join(bounded_broadcast(df), "s")
    large = other.join(bounded_broadcast(df, limit=100), "s")
    assert "strategy=broadcast" in plan(small)
    assert "strategy=broadcast" not in plan(large)
    assert small.count() == large.count() == 5
