"""Every registered query against its SQL over the smallest tables, and the shape of the plans."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tallyloom.plans import registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(r[i]) for i in order) for r in rows))


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    got = by_name(df.columns, df.collect())
    if name not in ORACLES:
        assert got
        return
    cursor = sql.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == by_name(columns, cursor.fetchall())


def test_every_query_of_the_plans_has_sql():
    assert set(registry.QUERIES) <= set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["movie_id", "mean_rating"] and df.count() == 10


def plan_of(spark, name, mode="formatted"):
    execution = QUERIES[name](spark, SF_DIR)._jdf.queryExecution()
    if mode == "simple":
        return execution.executedPlan().toString()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return execution.explainString(mode)


LAZY = [
    "audience_profile", "audience_profile_semi", "topk_popular", "topk_popular_named",
    "topk_rating_sum", "topk_avg_rating", "topk_users", "topk_users_by_group", "word_count",
    "split_arrays", "distinct_counts", "distinct_rows", "distinct_subset", "daily_news",
    "hourly_activity", "retention", "running_total", "log_parse", "session_explode",
    "group_count_notnull", "page_offset", "iso_time", "duration_bucket",
]


@pytest.mark.parametrize("name", LAZY)
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = plan_of(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                     "ArrowEvalPython", "MapInPandas", "Scan ExistingRDD"):
        assert operator not in plan


@pytest.mark.parametrize(
    "name", ["topk_popular", "topk_rating_sum", "topk_avg_rating", "topk_users", "page_offset"]
)
def test_top_lists_need_no_global_sort(spark, name):
    plan = plan_of(spark, name)
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_title_lookup_reaches_the_scan(spark):
    plan = plan_of(spark, "audience_profile")
    assert "EqualTo(p_name,red plate)" in plan
    assert "EqualTo(l_partkey,ScalarSubquery" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


def test_group_filter_reaches_the_scan(spark):
    plan = plan_of(spark, "topk_popular")
    assert "EqualTo(c_nationkey,18)" in plan and "EqualTo(c_mktsegment,MACHINERY)" in plan


def test_columns_are_pruned(spark):
    assert "ReadSchema: struct<user_id:bigint>" in plan_of(spark, "distinct_counts")
    assert "ReadSchema: struct<text:string>" in plan_of(spark, "word_count")


def test_lines_are_parsed_once(spark):
    assert plan_of(spark, "group_count_notnull", "simple").count("from_json(") == 1
