"""Audience profiles and top lists over ratings, users and movies.

Expected columns: ratings ``user_id, movie_id, rating``; users ``user_id, gender, age`` (one row
per user); movies ``movie_id, title``. Every top list breaks ties by ascending id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import float_ratio, strict_number
from tallyloom.session import bounded_broadcast, stage


def movie_id_of(movies: DataFrame, title: str) -> DataFrame:
    """The smallest id with exactly this title, as one row; null when there is none."""
    return movies.filter(F.col("title") == title).agg(F.min("movie_id").alias("movie_id"))


def _raters(ratings: DataFrame, movies: DataFrame, title: str) -> DataFrame:
    """Ratings per user for the movie of that title. The id is a scalar subquery, so it reaches
    the ratings scan as a pushed filter."""
    wanted = movie_id_of(movies, title).scalar()
    return (
        ratings.filter(F.col("movie_id") == wanted).groupBy("user_id").agg(F.count("*").alias("n"))
    )


def audience_profile(
    ratings: DataFrame, users: DataFrame, movies: DataFrame, title: str
) -> DataFrame:
    """Ratings of a movie by gender and age of the rater.

    Counting per user first leaves at most one row per user to join, whoever rated how often.
    """
    return (
        _raters(ratings, movies, title)
        .join(users.select("user_id", "gender", "age"), "user_id")
        .groupBy("gender", "age")
        .agg(F.sum("n").alias("n"))
    )


def audience_profile_distinct(
    ratings: DataFrame, users: DataFrame, movies: DataFrame, title: str
) -> DataFrame:
    """Users who rated a movie, by gender and age; a user counts once.

    The raters are written once, then measured to choose between broadcast and shuffle.
    """
    raters = stage(_raters(ratings, movies, title).select("user_id"), "raters")
    return (
        users.join(bounded_broadcast(raters), "user_id", "left_semi")
        .groupBy("gender", "age")
        .agg(F.count("*").alias("n"))
    )


def top(df: DataFrame, measure: str, tie_break: str, k: int = 10) -> DataFrame:
    """The k rows with the greatest measure."""
    return df.orderBy(F.col(measure).desc(), F.col(tie_break).asc()).limit(k)


def in_group(gender: str, age: int) -> Column:
    """Users of one gender and one age code; an age that is no number stops the query."""
    return (strict_number(F.col("age")) == age) & (F.col("gender") == gender)


def top_movies_for(
    ratings: DataFrame, users: DataFrame, gender: str, age: int, k: int = 10
) -> DataFrame:
    """Movies with the most ratings from one group of users."""
    chosen = users.filter(in_group(gender, age)).select("user_id")
    counts = ratings.join(chosen, "user_id").groupBy("movie_id").agg(F.count("*").alias("n"))
    return top(counts, "n", "movie_id", k)


def top_movies_for_named(
    ratings: DataFrame, users: DataFrame, movies: DataFrame, gender: str, age: int, k: int = 10
) -> DataFrame:
    """Same list with titles, through a semi-join on the chosen users.

    A movie without a title row keeps a null title; of several title rows the greatest counts.
    The list is computed once and only its ids are looked up: ``k`` of them bound both broadcasts.
    """
    chosen = users.filter(in_group(gender, age)).select("user_id")
    counts = (
        ratings.join(bounded_broadcast(chosen), "user_id", "left_semi")
        .groupBy("movie_id")
        .agg(F.count("*").alias("n"))
    )
    best = stage(top(counts, "n", "movie_id", k), "best")
    titles = (
        movies.join(F.broadcast(best.select("movie_id")), "movie_id", "left_semi")
        .groupBy("movie_id")
        .agg(F.max("title").alias("title"))
    )
    return best.join(F.broadcast(titles), "movie_id", "left").select("movie_id", "title", "n")


def top_movies_by_rating_sum(
    ratings: DataFrame, users: DataFrame, gender: str, age: int, k: int = 10
) -> DataFrame:
    """Movies with the greatest rating sum from one group of users."""
    chosen = users.filter(in_group(gender, age)).select("user_id")
    sums = (
        ratings.join(chosen, "user_id")
        .groupBy("movie_id")
        .agg(F.sum(strict_number(F.col("rating"))).alias("rating_sum"))
    )
    return top(sums, "rating_sum", "movie_id", k)


def top_movies_by_mean(ratings: DataFrame, k: int = 10) -> DataFrame:
    """Movies with the greatest mean rating, as a 32-bit quotient of sum and count."""
    means = ratings.groupBy("movie_id").agg(
        float_ratio(F.sum(strict_number(F.col("rating"))), F.count("*")).alias("mean_rating")
    )
    return top(means, "mean_rating", "movie_id", k)


def ratings_per_user(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user_id").agg(F.count("*").alias("n"))


def top_users(ratings: DataFrame, k: int = 10) -> DataFrame:
    """Users with the most ratings."""
    return top(ratings_per_user(ratings), "n", "user_id", k)


def top_users_by_group(
    ratings: DataFrame, users: DataFrame, genders: list[str], k: int = 10
) -> DataFrame:
    """For each gender, its users with the most ratings.

    Users are joined to the per-user counts, which are one row per user; each list is a top-k of
    its own, so no task ever sees all users of a gender.
    """
    counts = ratings_per_user(ratings)
    wanted = users.filter(F.col("gender").isin(genders)).select("user_id", "gender")
    joined = counts.join(bounded_broadcast(wanted), "user_id")
    lists = [top(joined.filter(F.col("gender") == g), "n", "user_id", k) for g in genders]
    merged = lists[0]
    for more in lists[1:]:
        merged = merged.unionByName(more)
    return merged.select("gender", "user_id", "n")
