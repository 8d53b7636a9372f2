import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyloom.operators import ratings as op

TITLE = "Rings (1978)"


@pytest.fixture(scope="module")
def data(spark):
    draw = random.Random(5)
    users = [(u, draw.choice("FM"), draw.choice([1, 18, 25])) for u in range(1, 41)]
    movies = [(m, f"Movie {m}") for m in range(1, 31)] + [(90, TITLE), (31, TITLE)]
    pairs = draw.sample([(u, m) for u in range(1, 46) for m in range(1, 32)], 700)
    ratings = [(u, m, draw.randint(1, 5), 9) for u, m in pairs]
    frames = (
        spark.createDataFrame(ratings, "user_id int, movie_id int, rating int, rated_at long"),
        spark.createDataFrame(users, "user_id int, gender string, age int"),
        spark.createDataFrame(movies, "movie_id int, title string"),
    )
    return ratings, users, movies, frames


def best(counter, k=10):
    return sorted(counter.items(), key=lambda x: (-x[1], x[0]))[:k]


def test_audience_profile_and_its_semi_join_form_agree(data, rows_of):
    ratings, users, _, (r, u, m) = data
    by_id = {x[0]: x[1:] for x in users}
    want = Counter(by_id[x[0]] for x in ratings if x[1] == 31 and x[0] in by_id)
    joined = rows_of(op.audience_profile(r, u, m, TITLE))
    assert joined == sorted(((g, a, n) for (g, a), n in want.items()), key=repr)
    assert joined == rows_of(op.audience_profile_distinct(r, u, m, TITLE))


def test_repeated_ratings_count_per_rating_or_per_user(spark, rows_of):
    r = spark.createDataFrame([(1, 7, 5), (1, 7, 3)], "user_id int, movie_id int, rating int")
    u = spark.createDataFrame([(1, "F", 18)], "user_id int, gender string, age int")
    m = spark.createDataFrame([(7, "x")], "movie_id int, title string")
    assert rows_of(op.audience_profile(r, u, m, "x")) == [("F", 18, 2)]
    assert rows_of(op.audience_profile_distinct(r, u, m, "x")) == [("F", 18, 1)]


def test_unknown_title_gives_nothing(data):
    _, _, _, (r, u, m) = data
    assert op.audience_profile(r, u, m, "none").isEmpty()
    assert op.audience_profile_distinct(r, u, m, "none").isEmpty()


def test_top_movies_of_a_group(data):
    ratings, users, movies, (r, u, m) = data
    chosen = {x[0] for x in users if x[1:] == ("M", 18)}
    want = best(Counter(x[1] for x in ratings if x[0] in chosen))
    assert [tuple(x) for x in op.top_movies_for(r, u, "M", 18).collect()] == want
    titles = dict(sorted(movies))
    named = {tuple(x) for x in op.top_movies_for_named(r, u, m, "M", 18).collect()}
    assert named == {(i, titles.get(i), n) for i, n in want}


def test_title_lookup_keeps_untitled_movies_and_takes_one_of_several(spark):
    r = spark.createDataFrame([(1, 7, 5), (1, 8, 5)], "user_id int, movie_id int, rating int")
    u = spark.createDataFrame([(1, "F", 18)], "user_id int, gender string, age int")
    m = spark.createDataFrame([(7, "a"), (7, "b")], "movie_id int, title string")
    got = {tuple(x) for x in op.top_movies_for_named(r, u, m, "F", 18).collect()}
    assert got == {(7, "b", 1), (8, None, 1)}


def test_sums_means_and_users(data):
    ratings, users, _, (r, u, _) = data
    chosen = {x[0] for x in users if x[1:] == ("F", 25)}
    sums, per_movie = Counter(), defaultdict(list)
    for user, movie, rating, _ in ratings:
        per_movie[movie].append(rating)
        if user in chosen:
            sums[movie] += rating
    assert [tuple(x) for x in op.top_movies_by_rating_sum(r, u, "F", 25).collect()] == best(sums)
    means = {m: float(np.float32(sum(v)) / np.float32(len(v))) for m, v in per_movie.items()}
    assert [tuple(x) for x in op.top_movies_by_mean(r).collect()] == best(means)
    counts = Counter(x[0] for x in ratings)
    assert [tuple(x) for x in op.top_users(r).collect()] == best(counts)
    gender = {x[0]: x[1] for x in users}
    got = {tuple(x) for x in op.top_users_by_group(r, u, ["F", "M"], k=4).collect()}
    want = {
        (g, i, n)
        for g in "FM"
        for i, n in best(Counter({i: n for i, n in counts.items() if gender.get(i) == g}), 4)
    }
    assert got == want


def test_age_must_be_a_number(spark):
    r = spark.createDataFrame([(1, 7, 5)], "user_id int, movie_id int, rating int")
    u = spark.createDataFrame([(1, "F", "old")], "user_id int, gender string, age string")
    with pytest.raises(Exception):
        op.top_movies_for(r, u, "F", 18).collect()


def test_a_large_set_of_users_prunes_the_scan_of_ratings(spark, tmp_path, rows_of):
    """Beyond the broadcast limit a Bloom filter of the users reaches the ratings' scan."""
    from pyspark.sql import functions as F

    from tallyloom import session

    rated = spark.range(20000).select(
        (F.col("id") % 5000).alias("user_id"), (F.col("id") % 97).alias("movie_id"), F.lit(3).alias("rating"))
    people = spark.range(5000).select(
        F.col("id").alias("user_id"), F.when(F.col("id") % 50 == 0, "F").otherwise("M").alias("gender"),
        F.lit(18).alias("age"))
    rated.write.parquet(str(tmp_path / "rated"))
    people.write.parquet(str(tmp_path / "people"))
    rated, people = spark.read.parquet(str(tmp_path / "rated")), spark.read.parquet(str(tmp_path / "people"))
    want = rows_of(op.top_movies_for(rated, people, "F", 18))
    bloom = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    settings = {bloom: "1b", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    session.configure(spark)
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        top = op.top_movies_for(rated, people, "F", 18)
        assert "might_contain" in top._jdf.queryExecution().executedPlan().toString()
        assert rows_of(top) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
