import pytest

from recsift.llm import queries
from tests.llm.brute import SF
from tools.oracle_check import compare, duck


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE[name])
    assert r["cols_ok"] and r["types_ok"] and r["values_ok"], r


NATIVE = ("op3", "op4", "op8")


@pytest.mark.parametrize("name", sorted(q for q in queries.QUERIES if q.startswith(NATIVE)))
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
