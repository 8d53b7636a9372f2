"""The given tables in the roles the operators expect.

Ratings are line items with their order's customer; users are customers, with market segment and
nation standing in for gender and age; movies are parts. Log lines are made from events, with
every fiftieth line damaged. Everything is derived by Spark and grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.times import iso_utc
from tallyloom.operators.logs import device_rows, good_records, parse_lines

DATE_CUT = "1998-01-01 00:00:00"
EVENT_CUT = "2024-01-15 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.col("l_quantity").cast("int").alias("rating"),
        F.col("l_shipdate").alias("rated_at"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("gender"),
        F.col("c_nationkey").alias("age"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title")
    )


def millis(ts: Column) -> Column:
    """Epoch milliseconds of a clock reading taken as UTC (the session zone is UTC)."""
    return F.unix_millis(ts.cast("timestamp"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ms`` (epoch milliseconds) and ``k`` (the number in their properties)."""
    return (
        table(spark, sf_dir, "events")
        .withColumn("ms", millis(F.col("ts")))
        .withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    )


def _s(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines ``epochMillis|ip|{"us":{...},"se":[...]}`` as column ``value``."""
    k, event_id, user_id = F.col("k"), F.col("event_id"), F.col("user_id")
    countries = F.array(*[F.lit(c) for c in ("us", "cn", "fr", "de")])
    device = F.struct(
        F.concat(F.lit("A"), _s(user_id)).alias("ai"),
        k.alias("am"),
        _s(k % 5).alias("appkey"),
        F.when(k % 13 != 0, F.get(countries, (k % 4).cast("int"))).alias("c"),
        F.lit(0).alias("cc"),
        F.when(k % 11 != 0, F.concat(F.lit("ch"), _s(k % 7))).alias("ch"),
        _s(F.col("ts").cast("date")).alias("dateTime"),
        F.lit(0).alias("fr"),
        F.lit(1280).alias("h"),
        F.concat(F.lit("I"), _s(user_id)).alias("im"),
        (event_id % 2 == 0).alias("ir"),
        F.lit("en").alias("la"),
        F.concat(F.lit("M"), _s(user_id)).alias("mac"),
        F.lit(0).alias("om"),
        F.concat(F.lit("app."), F.col("event_type")).alias("pn"),
        F.floor("value").cast("bigint").alias("sv"),
        F.concat(F.lit("T"), _s(user_id % 10)).alias("t"),
        F.lit(720).alias("w"),
    )
    numbers = F.slice(F.array(F.lit(1), F.lit(2), F.lit(3)), F.lit(1), (event_id % 4).cast("int"))

    def one_session(i: Column) -> Column:
        start = F.col("ms") + i * 1000
        return F.struct(
            F.when(k % 3 != 0, start + k * 10 + i).alias("e"), start.alias("s")
        )

    record = F.to_json(F.struct(device.alias("us"), F.transform(numbers, one_session).alias("se")))
    # Damage: a session whose end has no value, as a failing client writes it.
    text = F.when(
        event_id % 50 == 0,
        F.replace(record, F.lit('"se":['), F.lit('"se":[{"e":,"s":1},')),
    ).otherwise(record)
    ip = F.concat(F.lit("10.0."), _s(user_id % 256), F.lit("."), _s(event_id % 256))
    return events(spark, sf_dir).select(F.concat_ws("|", _s("ms"), ip, text).alias("value"))


def parsed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(log_lines(spark, sf_dir))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good_records(parsed_log(spark, sf_dir))


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device_rows(records(spark, sf_dir))


def cut_millis() -> Column:
    return F.unix_millis(F.lit(EVENT_CUT).cast("timestamp"))


def order_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A stored set and an incoming set of documents keyed by customer and priority.

    The stored documents summarise orders before a date, the incoming ones those from it on;
    only stored ones carry ``origin``.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.concat_ws("#", _s("o_custkey"), "o_orderpriority").alias("id"),
        "o_orderdate",
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
    )
    cut = F.lit(DATE_CUT).cast("timestamp_ntz")

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy("id").agg(
            F.count("*").alias("n_orders"), F.max("day").alias("last_day")
        )

    stored = summed(orders.filter(F.col("o_orderdate") < cut)).withColumn("origin", F.lit("old"))
    return stored, summed(orders.filter(F.col("o_orderdate") >= cut))


ORDER_DOCUMENTS = "id string, n_orders bigint, last_day string, origin string"


def stored_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known devices: the even customers of every other block of ten."""
    key = F.col("c_custkey")
    block = F.floor(key / 10)
    return (
        table(spark, sf_dir, "customer")
        .filter((block % 2 == 0) & (key % 2 == 0))
        .select(
            F.concat(F.lit("D"), _s(key)).alias("device_id"),
            F.concat(F.lit("I"), _s(key)).alias("imei"),
            F.concat(F.lit("M"), _s(key)).alias("mac"),
            F.concat(F.lit("A"), _s(key)).alias("android_id"),
            F.lit("stored").alias("uuid"),
            iso_utc(key * 1000).alias("first_time"),
        )
    )


def device_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows with identifiers: orders, whose network id moves within a block of ten customers."""
    key, order = F.col("o_custkey"), F.col("o_orderkey")
    near = F.floor(key / 10) * 10 + (key % 10 + order % 3) % 10
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("I"), _s(key)).alias("imei"),
        F.concat(F.lit("M"), _s(near)).alias("mac"),
        F.concat(F.lit("A"), _s(key)).alias("android_id"),
        F.md5(_s(order)).alias("uuid"),
        (millis(F.col("o_orderdate")) + order % 1000).alias("timestamp"),
    )


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit-like records made from orders."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("author "), _s("o_custkey")).alias("author"),
        F.concat(_s("o_custkey"), F.lit("@mail.test")).alias("author_email"),
        F.md5(_s("o_orderkey")).alias("commit"),
        _s(F.col("o_orderdate").cast("date")).alias("date"),
    )
