"""One function per registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import keys, numbers, records, sql_names, times
from tallyloom.functions.text import words
from tallyloom.operators import (
    activity,
    basics,
    clusters,
    devices,
    latest,
    logs,
    ratings,
    stats,
)
from tallyloom.operators.bitmaps import DeviceDays
from tallyloom.operators.identity import Identities
from tallyloom.plans import jobs, views
from tallyloom.session import configure, new_folder, stage
from tallyloom.sources import files, schemas
from tallyloom.sources.compaction import compact
from tallyloom.sources.keyed import KeyedTable, append_generated
from tallyloom.sources.pages import Pages

# Settings of the ratings reports on the given tables.
TITLE = "red plate"
GENDER, AGE = "MACHINERY", 18
GENDERS = ["BUILDING", "MACHINERY"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


# ratings -----------------------------------------------------------------------------------


def _ratings_users(spark, sf):
    return views.ratings(spark, sf), views.users(spark, sf)


@query
def audience_profile(spark, sf):
    rated, people = _ratings_users(spark, sf)
    return ratings.audience_profile(rated, people, views.movies(spark, sf), TITLE)


@query
def audience_profile_semi(spark, sf):
    rated, people = _ratings_users(spark, sf)
    return ratings.audience_profile_distinct(rated, people, views.movies(spark, sf), TITLE)


@query
def topk_popular(spark, sf):
    return ratings.top_movies_for(*_ratings_users(spark, sf), GENDER, AGE)


@query
def topk_popular_named(spark, sf):
    rated, people = _ratings_users(spark, sf)
    return ratings.top_movies_for_named(rated, people, views.movies(spark, sf), GENDER, AGE)


@query
def topk_rating_sum(spark, sf):
    return ratings.top_movies_by_rating_sum(*_ratings_users(spark, sf), GENDER, AGE)


@query
def topk_avg_rating(spark, sf):
    return ratings.top_movies_by_mean(views.ratings(spark, sf))


@query
def topk_users(spark, sf):
    return ratings.top_users(views.ratings(spark, sf))


@query
def topk_users_by_group(spark, sf):
    return ratings.top_users_by_group(*_ratings_users(spark, sf), GENDERS)


# file sources ------------------------------------------------------------------------------


@query
def scan_text(spark, sf):
    """Documents written as text files and read as lines; lines by length."""
    folder = new_folder(spark, "text")
    views.table(spark, sf, "documents").select("text").write.text(folder)
    lines = files.read_lines(spark, folder, min_partitions=2)
    return (
        lines.groupBy(F.length("value").alias("n_chars"))
        .agg(
            F.count("*").alias("n"),
            F.min("value").alias("first_line"),
            F.max("value").alias("last_line"),
        )
    )


@query
def scan_delimited(spark, sf):
    """Ratings written as ``::`` records and read back with types; ratings by value."""
    folder = new_folder(spark, "delimited")
    columns = ["user_id", "movie_id", "rating", F.unix_date(F.col("rated_at").cast("date"))]
    views.ratings(spark, sf).select(
        F.concat_ws("::", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])
    ).write.text(folder)
    return (
        files.read_ratings(spark, folder)
        .groupBy("rating")
        .agg(
            F.count("*").alias("n"),
            F.sum("user_id").alias("user_sum"),
            F.sum("movie_id").alias("movie_sum"),
            F.sum("rated_at").alias("day_sum"),
        )
    )


@query
def json_scan(spark, sf):
    """Commit records written as JSON lines, read with their schema, two columns kept."""
    folder = new_folder(spark, "json")
    views.commits(spark, sf).write.json(folder)
    return files.read_json_lines(spark, folder, schemas.COMMITS).select("author_email", "commit")


@query
def csv_seasons(spark, sf):
    """Orders written as season files with repeated headers and blank lines, read as data rows."""
    folder = new_folder(spark, "seasons")
    names = files.as_schema(schemas.SEASON_STATS).names
    values = {
        "Rk": F.col("o_orderkey"),
        "Player": F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")),
        "Age": F.col("o_custkey") % 20 + 18,
        "Tm": F.col("o_orderstatus"),
        "PTS": F.col("o_totalprice").cast("decimal(18,2)"),
    }
    line = F.concat_ws(
        ",", *[values[n].cast("string") if n in values else F.lit("") for n in names]
    )
    header = F.array(F.lit(""), F.lit(",".join(names)), line)
    shown = F.when(F.col("o_orderkey") % 20 == 0, header).otherwise(F.array(line))
    views.table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("season"), F.explode(shown).alias("value")
    ).write.partitionBy("season").text(folder)
    return (
        files.read_season_stats(spark, f"{folder}/season=*/", r"season=(\d{4})")
        .groupBy("season", F.col("Tm").alias("team"))
        .agg(
            F.count("*").alias("n"),
            F.count("GS").alias("n_gs"),
            F.sum("Age").alias("age_sum"),
            F.sum(F.col("PTS").cast("decimal(18,2)")).cast("double").alias("points"),
        )
    )


def _vector_files(spark, sf) -> DataFrame:
    """Embeddings written as space-separated numbers and read back as vectors."""
    folder = new_folder(spark, "vectors")
    numbers_of = F.col("embedding").cast("array<double>").cast("array<string>")
    views.table(spark, sf, "embeddings").select(F.array_join(numbers_of, " ")).write.text(folder)
    return files.read_vectors(spark, folder)


@query
def scan_vectors(spark, sf):
    """Vectors read from text, by dimension, with their least and greatest number."""
    return (
        _vector_files(spark, sf)
        .groupBy(F.size("features").alias("dimension"))
        .agg(
            F.count("*").alias("n"),
            F.min(F.array_min("features")).alias("least"),
            F.max(F.array_max("features")).alias("greatest"),
        )
    )


@query
def range_indicator(spark, sf):
    """How many of 1..n, and how many of the n line items, have a positive squared norm."""
    items = views.table(spark, sf, "lineitem")
    numbers_1_to_n = files.integer_range(spark, items.count())
    a, b = F.col("id") % 7 * 2 - 6, F.col("id") % 5 * 2 - 4
    item_a = F.col("l_linenumber").cast("long") * 2 - 6
    item_b = F.col("l_quantity").cast("long") % 5 * 2 - 4
    ranged = basics.positive_norms(numbers_1_to_n, a, b)
    counted = basics.positive_norms(items, item_a, item_b).withColumnRenamed("hits", "item_hits")
    return ranged.withColumn("item_hits", counted.scalar())


# projections and filters -------------------------------------------------------------------


@query
def drop_column(spark, sf):
    return views.commits(spark, sf).drop("author")


@query
def filter_equals(spark, sf):
    return views.commits(spark, sf).filter("date = '1997-05-28'")


@query
def cast_numeric(spark, sf):
    """Strict and lenient number parsing, with damaged text in every seventh lenient value."""
    text = F.col("k").cast("string")
    damaged = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("x"), text)).otherwise(text)
    lenient = numbers.lenient_number(damaged, "long")
    return (
        views.events(spark, sf)
        .groupBy("event_type")
        .agg(
            F.sum(numbers.strict_number(text, "int")).alias("strict_sum"),
            F.sum(lenient).alias("lenient_sum"),
            F.count_if(lenient.isNull()).alias("n_bad"),
        )
    )


@query
def page_offset(spark, sf):
    orders = views.table(spark, sf, "orders").filter(F.col("o_orderpriority") == "5-LOW")
    return basics.page(
        orders.select("o_orderkey", "o_custkey", "o_totalprice"),
        [F.col("o_totalprice").asc(), F.col("o_orderkey").asc()],
        start=10,
        size=10,
    )


# words and distinct rows -------------------------------------------------------------------


@query
def word_count(spark, sf):
    return basics.word_count(views.table(spark, sf, "documents"), "text")


@query
def split_arrays(spark, sf):
    """Each document as one array of pieces, paired with one."""
    return basics.split_lines(views.table(spark, sf, "documents"), "text").select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.md5(F.concat_ws("|", "words")).alias("joined"),
        F.col("one").cast("bigint").alias("one"),
    )


@query
def distinct_counts(spark, sf):
    return basics.distinct_counts(views.table(spark, sf, "events"), "user_id")


@query
def distinct_rows(spark, sf):
    """Distinct (user, per-row value) pairs collapse nothing; distinct users do."""
    pairs = views.table(spark, sf, "events").select(
        "user_id", F.md5(F.col("event_id").cast("string")).alias("row_value")
    )
    return pairs.distinct().groupBy("user_id").agg(F.count("*").alias("n_pairs"))


@query
def distinct_subset(spark, sf):
    chosen = views.table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return basics.distinct_on(chosen, ["user_id", "event_type"])


@query
def side_counters(spark, sf):
    """Counters filled while the events are read once by another action."""
    rows, seen = basics.with_counters(
        views.table(spark, sf, "events"),
        {
            "total": None,
            "purchases": F.col("event_type") == "purchase",
            "errors": F.col("event_type") == "error",
        },
        "events",
    )
    rows.write.format("noop").mode("overwrite").save()
    got = seen.get
    return files.rows(
        spark,
        [(got["total"], got["purchases"], got["errors"])],
        "total bigint, purchases bigint, errors bigint",
    )


# scalar functions --------------------------------------------------------------------------


@query
def duration_bucket(spark, sf):
    seconds = F.col("event_id") * 37 % 400000 - 1000
    return views.table(spark, sf, "events").select(
        "event_id", times.duration_bucket(seconds).alias("bucket")
    )


@query
def iso_time(spark, sf):
    iso = times.iso_utc(F.col("ms"))
    return views.events(spark, sf).select(
        "event_id", iso.alias("iso"), times.millis_from_iso(iso).alias("ms")
    )


@query
def local_day(spark, sf):
    """Day of an event at home and in UTC, and where the home day starts."""
    home = times.day_text(F.col("ms"))
    return views.events(spark, sf).select(
        "event_id",
        home.alias("home_day"),
        times.day_text(F.col("ms"), "UTC").alias("utc_day"),
        times.day_start_millis(home).alias("home_day_start"),
        times.wall_clock(F.col("ms"), times.HOME_ZONE).cast("string").substr(12, 8).alias("clock"),
    )


@query
def parse_basic_date(spark, sf):
    """Basic-format texts in ``Z`` and in offset form, parsed back to milliseconds."""
    iso = times.iso_utc(F.col("ms"))
    basic = F.regexp_replace(iso, "[-:]", "")
    shifted = F.regexp_replace(times.iso_utc(F.col("ms") + 8 * 3600 * 1000), "[-:]", "")
    text = F.when(F.col("event_id") % 2 == 0, basic).otherwise(
        F.replace(shifted, F.lit("Z"), F.lit("+0800"))
    )
    return views.events(spark, sf).select(
        "event_id", F.unix_millis(times.instant_from_basic(text)).alias("ms")
    )


@query
def composite_key(spark, sf):
    rows = views.log_rows(spark, sf)
    plain = keys.statistic_key(F.col("pn"), F.col("ch"), F.col("c"), F.col("appkey"))
    safe = keys.statistic_key(F.col("pn"), F.col("ch"), F.col("c"), F.col("appkey"), "#")
    return (
        rows.groupBy(
            plain.alias("id"),
            safe.alias("safe_id"),
            keys.app_device_key(F.col("pn"), F.col("im")).alias("device_key"),
        ).agg(F.count("*").alias("n"))
    )


@query
def json_roundtrip(spark, sf):
    """Customers as JSON text, and two fields read back from it."""
    json = records.to_record("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    back = F.from_json("json", "c_custkey bigint, c_mktsegment string")
    return (
        views.table(spark, sf, "customer")
        .select(json.alias("json"))
        .withColumn("back", back)
        .select(
            "json",
            F.col("back.c_custkey").alias("back_key"),
            F.col("back.c_mktsegment").alias("back_segment"),
        )
    )


@query
def json_map(spark, sf):
    fields = records.record_map(F.col("props"), "bigint")
    return views.table(spark, sf, "events").select(
        "event_id",
        F.element_at(fields, "k").alias("k"),
        F.cardinality(fields).cast("bigint").alias("n_fields"),
    )


@query
def map_merge(spark, sf):
    left = F.create_map(
        F.lit("kind"), F.col("event_type"), F.lit("k"), F.col("k").cast("string")
    )
    right = F.create_map(
        F.lit("kind"), F.upper("event_type"), F.lit("user"), F.col("user_id").cast("string")
    )
    merged = records.merge_maps(left, right)
    return views.events(spark, sf).select("event_id", merged.alias("m")).select(
        "event_id",
        F.cardinality("m").cast("bigint").alias("n_fields"),
        F.element_at("m", "kind").alias("kind"),
        F.element_at("m", "k").alias("k"),
        F.element_at("m", "user").alias("user"),
    )


@query
def sql_function(spark, sf):
    """Counters added by a registered SQL function, from SQL text."""
    sql_names.register_sql_functions(spark)
    stored, incoming = views.order_documents(spark, sf)
    return spark.sql(
        "SELECT id, add_counts(s.n_orders, i.n_orders) AS n_orders, "
        "float_ratio(s.n_orders, i.n_orders) AS ratio "
        "FROM {stored} s FULL OUTER JOIN {incoming} i USING (id)",
        stored=stored,
        incoming=incoming,
    )


# log lines ---------------------------------------------------------------------------------


@query
def log_parse(spark, sf):
    return views.records(spark, sf).select(
        "timestamp", "ip", "us.*", F.size("se").cast("bigint").alias("n_sessions")
    )


@query
def malformed_rows(spark, sf):
    parsed = views.parsed_log(spark, sf)
    bad = logs.malformed_with_null_field(parsed)
    return bad.select(F.col(schemas.CORRUPT).alias("line"), F.col("`se.e`").alias("session_end"))


@query
def sql_nested(spark, sf):
    """Nested fields selected by SQL text over a temporary view."""
    views.records(spark, sf).createOrReplaceTempView("channel_log")
    return spark.sql(
        "SELECT log.us.im, log.us.pn, log.timestamp, "
        "array_join(transform(log.se.s, x -> cast(x AS string)), ',') AS starts "
        "FROM channel_log AS log WHERE log.us.appkey = '4'"
    )


@query
def session_explode(spark, sf):
    return logs.sessions(views.records(spark, sf), "timestamp", "us.ai")


@query
def explode_outer_union(spark, sf):
    return logs.sessions_or_null(views.records(spark, sf), "timestamp", "us.ai")


@query
def session_flatten(spark, sf):
    return logs.session_rows(views.records(spark, sf)).select(
        "ai", "appkey", "c", "ch", "im", "ip", "ir", "pn", "sv", "timestamp", "e", "s"
    )


def _log_table(spark, sf, *columns: str) -> DataFrame:
    """Columns of the log rows, parsed once and written, for operators that read them twice."""
    return stage(views.log_rows(spark, sf).select(*columns), "log-rows")


@query
def latest_per_key(spark, sf):
    rows = _log_table(spark, sf, "im", "timestamp", "pn", "ch", "ip")
    return latest.latest_rows(rows, ["im"], "timestamp")


@query
def latest_per_key2(spark, sf):
    rows = _log_table(spark, sf, "pn", "ch", "timestamp", "im", "ip")
    return latest.latest_rows(rows, ["pn", "ch"], "timestamp")


@query
def group_count_notnull(spark, sf):
    return basics.count_by(
        views.log_rows(spark, sf), "pn", "ch", "c", present=["ch", "c"]
    )


# keyed tables ------------------------------------------------------------------------------


def _order_table(spark, sf, label) -> tuple[KeyedTable, DataFrame]:
    """A keyed table holding the stored order documents, and the incoming ones."""
    stored, incoming = views.order_documents(spark, sf)
    table = KeyedTable(spark, "order_documents", views.ORDER_DOCUMENTS, new_folder(spark, label))
    table.replace(stored)
    return table, incoming


@query
def keyed_replace(spark, sf):
    table, incoming = _order_table(spark, sf, "replace")
    return table.replace(incoming)


@query
def keyed_upsert(spark, sf):
    table, incoming = _order_table(spark, sf, "upsert")
    return table.upsert(incoming)


@query
def keyed_insert_missing(spark, sf):
    table, incoming = _order_table(spark, sf, "insert")
    return table.insert_missing(incoming)


@query
def keyed_scan(spark, sf):
    table, incoming = _order_table(spark, sf, "scan")
    table.upsert(incoming)
    return table.scan("last_day", metadata=True).select(
        "last_day", F.element_at("_metadata", "_id").alias("document_id")
    )


@query
def keyed_lookup(spark, sf):
    table, incoming = _order_table(spark, sf, "lookup")
    table.upsert(incoming)
    return table.lookup("10#1-URGENT")


@query
def keyed_append(spark, sf):
    """Customers written as ``username;password;mail`` lines and appended twice, under new ids."""
    folder = new_folder(spark, "people")
    lines = views.table(spark, sf, "customer").select(
        F.concat_ws(
            ";", "c_name", F.col("c_custkey").cast("string"), F.concat("c_name", F.lit("@mail.test"))
        ).alias("value")
    )
    people = files.parse_people(lines)
    append_generated(people, folder)
    append_generated(people, folder)
    saved = spark.read.schema(f"{schemas.PERSON}, id string").parquet(folder)
    return saved.agg(
        F.count("*").alias("rows"),
        F.count_distinct("id").alias("ids"),
        F.count_distinct("username", "password", "mail").alias("people"),
    )


@query
def append_compacted(spark, sf):
    """Customers appended in many small writes, whose files are then put together: the same rows."""
    folder = new_folder(spark, "small-writes")
    people = views.table(spark, sf, "customer").select(
        F.col("c_name").alias("username"), F.col("c_mktsegment").alias("segment")
    )
    for segment in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"):
        append_generated(people.filter(F.col("segment") == segment), folder)
    schema = "username string, segment string, id string"
    ids = stage(spark.read.schema(schema).parquet(folder).select("id", "username"), "ids-before")
    compact(spark, folder, schema)
    saved = spark.read.schema(schema).parquet(folder)
    kept = saved.join(ids, ["id", "username"], "left_semi")
    return kept.groupBy("segment").agg(
        F.count("*").alias("rows"),
        F.count_distinct("id").alias("ids"),
        F.count_distinct("username").alias("people"),
    )


@query
def page_after(spark, sf):
    """A page far into the orders by price, after the key of the last row of the page before."""
    orders = views.table(spark, sf, "orders").select("o_totalprice", "o_orderkey", "o_custkey")
    pages = Pages(spark, new_folder(spark, "pages"), ["o_totalprice", "o_orderkey"], 1000)
    pages.write(orders)
    last = orders.orderBy(F.desc("o_orderkey")).select("o_totalprice", "o_orderkey").first()
    return pages.page(size=25, after=tuple(last))


# devices and statistics --------------------------------------------------------------------


@query
def device_resolve(spark, sf):
    """The device table after a batch: identifiers matched, linked, or made new devices."""
    stored, rows = views.stored_devices(spark, sf), views.device_log(spark, sf)
    resolved = stage(devices.resolve_devices(rows, stored), "resolved")
    table = KeyedTable(
        spark, "devices", schemas.DEVICES, new_folder(spark, "devices"), key="device_id"
    )
    table.replace(stored)
    return table.upsert(devices.device_table_update(rows, resolved))


@query
def device_matching(spark, sf):
    """Stored devices found by the network ids of a batch, through the index of the table."""
    table = KeyedTable(
        spark, "indexed_devices", schemas.DEVICES, new_folder(spark, "indexed"), key="device_id",
        indexes=("imei", "mac"),
    )
    table.replace(views.stored_devices(spark, sf))
    batch = views.device_log(spark, sf).filter(F.col("imei").endswith("7"))
    return table.matching("mac", batch).select("device_id", "imei", "mac", "first_time")


@query
def identity_batches(spark, sf):
    """Identifiers and the least identifier each is linked with, after two batches of log rows."""
    log = views.device_log(spark, sf).select(
        F.concat(F.lit("i:"), "imei").alias("a"), F.concat(F.lit("m:"), "mac").alias("b"), "timestamp"
    )
    kept = Identities(spark, "identities", new_folder(spark, "identities"))
    cut = views.millis(F.lit(views.DATE_CUT))
    kept.absorb(log.filter(F.col("timestamp") < cut))
    return kept.absorb(log.filter(F.col("timestamp") >= cut))


def _identified_rows(spark, sf) -> DataFrame:
    """Log rows with the device id found for their identifiers (no devices stored before)."""
    rows = _log_table(
        spark, sf, "im", "mac", "timestamp", "appkey", "ch", "c", "pn", "la", "t"
    )
    named = rows.withColumnsRenamed({"im": "imei"})
    none = spark.createDataFrame([], files.as_schema(schemas.DEVICES))
    resolved = devices.resolve_devices(named, none)
    attached = devices.attach_device(named, resolved)
    return attached.withColumnsRenamed({"imei": "im", "device_id": "deviceId"})


@query
def app_devices(spark, sf):
    """App devices after two batches of log rows, the second upserted over the first."""
    rows = stage(_identified_rows(spark, sf), "identified")
    table = KeyedTable(spark, "app_devices", schemas.APP_DEVICES, new_folder(spark, "app-devices"))
    cut = views.cut_millis()
    table.upsert(devices.app_devices(rows.filter(F.col("timestamp") < cut)))
    return table.upsert(devices.app_devices(rows.filter(F.col("timestamp") >= cut)))


def _stats_after(spark, sf, once: bool) -> DataFrame:
    log_rows = _log_table(spark, sf, "pn", "ch", "c", "appkey", "timestamp")
    rows = stats.with_statistic_id(log_rows).select("id", "timestamp")
    table = KeyedTable(
        spark, "channel_statistics", schemas.CHANNEL_STATISTICS, new_folder(spark, "statistics")
    )
    cut = views.cut_millis()
    early, late = rows.filter(F.col("timestamp") < cut), rows.filter(F.col("timestamp") >= cut)
    table.add(stats.increments(early, once), batch="early")
    table.add(stats.increments(late, once), batch="late")
    # A repeated batch changes nothing.
    return table.add(stats.increments(late, once), batch="late").select("id", "news", "starts")


@query
def stats_increment(spark, sf):
    return _stats_after(spark, sf, once=False)


@query
def stats_increment_once(spark, sf):
    return _stats_after(spark, sf, once=True)


@query
def stats_seed(spark, sf):
    """Seed rows for the statistics of apps that have none stored."""
    rows = stats.with_statistic_id(
        _log_table(spark, sf, "pn", "ch", "c", "appkey", "timestamp")
    )
    table = KeyedTable(
        spark, "seeded_statistics", schemas.CHANNEL_STATISTICS, new_folder(spark, "seeds")
    )
    table.insert_missing(stats.seeds(rows.filter(F.col("pn").isin("app.click", "app.view"))))
    return stats.new_seeds(rows, table.read())


@query
def seed_new_devices(spark, sf):
    """Statistics after two batches that seed them for newly inserted app devices only."""
    rows = stage(_identified_rows(spark, sf), "identified")
    apps = KeyedTable(spark, "new_apps", schemas.APP_DEVICES, new_folder(spark, "new-apps"))
    table = KeyedTable(
        spark, "new_statistics", schemas.CHANNEL_STATISTICS, new_folder(spark, "new-statistics")
    )
    cut = views.cut_millis()
    jobs.seed_new_devices(rows.filter(F.col("timestamp") < cut), apps, table)
    late = rows.filter(F.col("timestamp") >= cut)
    return jobs.seed_new_devices(late, apps, table).drop("total")


def _visits(spark, sf) -> DataFrame:
    return views.table(spark, sf, "events").select(
        F.col("user_id").alias("device_id"), "event_type", "ts"
    )


def _day_text(df: DataFrame, column: str = "day") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


@query
def daily_news(spark, sf):
    return _day_text(activity.news(_visits(spark, sf), ["event_type"]))


@query
def hourly_news(spark, sf):
    return _day_text(activity.news(_visits(spark, sf), ["event_type"], hourly=True))


@query
def daily_activity(spark, sf):
    return _day_text(activity.activity(_visits(spark, sf), ["event_type"]))


@query
def hourly_activity(spark, sf):
    return _day_text(activity.activity(_visits(spark, sf), hourly=True))


@query
def start_avg(spark, sf):
    return _day_text(activity.start_average(_visits(spark, sf), ["event_type"]))


@query
def running_total(spark, sf):
    return _day_text(activity.running_total(_visits(spark, sf), ["event_type"]))


@query
def running_total_all(spark, sf):
    return _day_text(activity.running_total(_visits(spark, sf)))


def _device_days(spark, sf) -> DeviceDays:
    """Days of activity stored as bitmaps, added in two batches of days."""
    days = DeviceDays(spark, "visits", new_folder(spark, "device-days"), ["event_type"])
    visits = _visits(spark, sf).withColumn("device_id", F.col("device_id").cast("string"))
    cut = F.lit(views.EVENT_CUT).cast("timestamp_ntz")
    days.add_days(visits.filter(F.col("ts") < cut))
    days.add_days(visits.filter(F.col("ts") >= cut))
    return days


@query
def activity_bitmaps(spark, sf):
    return _day_text(_device_days(spark, sf).activity())


@query
def retention_bitmaps(spark, sf):
    return _day_text(_device_days(spark, sf).retention(), "install_day")


@query
def active_between(spark, sf):
    """Distinct devices of two weeks, from stored bitmaps."""
    return _device_days(spark, sf).active_between("2024-01-08", "2024-01-21")


@query
def retention(spark, sf):
    return _day_text(activity.retention(_visits(spark, sf), ["event_type"]), "install_day")


@query
def kmeans_fit(spark, sf):
    """Two clusters over the embeddings, by what holds for any sound fit: all vectors are placed,
    both clusters are used, and no vector lies nearer to the other centre (squared distances that
    differ by less than a millionth count as equal)."""
    vectors = _vector_files(spark, sf)
    model, clustered = clusters.fit_kmeans(vectors, F.col("features"), k=2, seed=7)
    distances = clusters.squared_distances(model, F.col("features"))
    own = F.element_at(distances, F.col("cluster") + 1)
    nearest = F.array_min(distances)
    return clustered.agg(
        F.count("*").alias("vectors"),
        F.max(F.size("features")).alias("dimensions"),
        F.count_distinct("cluster").alias("clusters"),
        F.count_if(own > nearest + (nearest + 1) * 1e-6).alias("misplaced"),
    )
