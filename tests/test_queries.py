"""Every registered query against its DuckDB oracle on the smallest scale factor, plus plan checks."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from prefspark.plans.queries import QUERIES, USER_HOOKS
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "None"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        v = round(v, 6)
        return str(int(v)) if v.is_integer() else repr(v)
    return str(v)


def _rows(cols, it):
    return sorted(tuple(_cell(r[c]) for c in cols) for r in it)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    srows = _rows(cols, [r.asDict() for r in sdf.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        assert srows is not None
        return
    cur = duck.execute(sql)
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    orows = _rows(cols, [dict(zip(ocols, r)) for r in cur.fetchall()])
    assert srows == orows


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, duck, name):
    from pyspark.sql.pandas.types import to_arrow_schema

    spark_types = {f.name: str(f.type) for f in to_arrow_schema(queries()[name](spark, SF001).schema)}
    duck_types = {f.name: str(f.type) for f in duck.sql(oracle_sql()[name]).to_arrow_table().schema}
    assert spark_types == duck_types


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["conv_id", "text", "n_messages"] and df.count() > 0


CORE = [n for n in NAMES if n not in USER_HOOKS]


@pytest.mark.parametrize("name", CORE)
def test_core_plans_have_no_python_and_no_single_partition(spark, name):
    plan = queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # only a global aggregate's partial results (one row per partition) may meet in one task
            assert "HashAggregate(keys=[]" in lines[i + 1] and "partial_" in lines[i + 1], line
