"""The registered queries on the smallest driver tables: rows, SQL, and no Python where none is allowed."""

import os

import pytest

import __spark_entry__ as entry_point
from checks.compare import as_text_frame, duck, rows, spark_frame
from vitrine.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def test_queries_are_registered():
    names = set(entry_point.queries())
    assert {n.split("_")[0] for n in queries.ALL} == {f"op{i}" for i in range(1, 14)} and set(queries.ALL) | {"pipeline"} <= names
    assert set(queries.SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ALL))
def test_query(spark, name):
    df = queries.ALL[name](spark, SF)
    if name.split("_")[0] in ("op3", "op4", "op9"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "InArrow", "MapPartitions"):
            assert node not in plan, node
    got = spark_frame(df)
    if name in queries.SQL:
        want = as_text_frame(duck(SF), queries.SQL[name])
        assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
    else:
        table = "pages" if name in ("op2_html", "op5_url_rules") else "documents"
        assert len(got) == spark.read.parquet(f"{SF}/{table}.parquet").count()
