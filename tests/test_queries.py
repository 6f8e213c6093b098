"""Every registered query against its SQL on the smallest driver tables, and its plan."""

import os
import re

import pytest

import __spark_entry__ as entry_point
from checks import oracles, queries
from checks.compare import as_text_frame, duck, rows, spark_frame

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries.ALL, oracles.all_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "MapInArrow"):
        assert node not in plan, node
    got, want = spark_frame(df), as_text_frame(con, ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_scans_read_only_what_is_asked(spark):
    plan = QUERIES["rank_price"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(read) == ["l_partkey:bigint,l_extendedprice:double", "p_partkey:bigint,p_brand:string"]


def test_no_filter_repeats_the_extraction(spark):
    plan = QUERIES["web_page_products"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp") > 5
    assert not [line for line in plan.splitlines() if " Filter " in line and "regexp" in line]


def test_only_linked_pages_are_parsed(spark):
    plan = QUERIES["shop_catalogue"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_links_are_first_seen_by_hash(spark):
    for name in ("shop_links", "first_seen_links"):
        assert "SortAggregate" not in QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["all_shops_labels", "all_shops_report"])
def test_pages_are_parsed_before_shops_are_compared(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan and "LeftSemi" not in plan
