"""Plan checks: no Python evaluation, no Cartesian products, no job while planning, pruned and filtered scans."""

import pytest

import __spark_entry__ as E
from recsift.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_or_cartesian(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_scan_prunes_columns(spark):
    df = E.queries()["valid_interactions"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan \
        or "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan


WRITES = ("roundtrip", "evaluate_paths")
#: Jobs that write a table which several of their parts read, by design.
STORES = ("swing", "swing_same_category", "swing_fan", "pair_support_band", "extend_lists", "evaluate_many", "user_recommendations",
          "user_recommendations_json", "user_recommendations_by_category", "trigger_quota", "category_index", "item_index", "stage_counts", "price_rerank",
          "price_rerank_fan", "ctr_rerank")


def scans(df):
    return df._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet")


@pytest.mark.parametrize("name", STORES)
def test_stored_tables_keep_plans_small(spark, name):
    assert scans(QUERIES[name](spark, SF)) <= 30


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if not q.endswith(WRITES) and q not in STORES))
def test_building_a_query_runs_nothing(spark, name):
    """Only reading parquet schemas may start a job; those run no stage over rows of a plan."""
    sc = spark.sparkContext
    sc.setJobGroup(f"plan-{name}", name)
    try:
        QUERIES[name](spark, SF)
        jobs = sc.statusTracker().getJobIdsForGroup(f"plan-{name}")
        stages = [s for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
        infos = [i for i in map(sc.statusTracker().getStageInfo, stages) if i]
        assert all(i.numTasks == 1 and i.name.startswith("parquet") for i in infos), infos
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["valid_interactions", "latest_behaviour", "ctr_plain", "label_dedup", "item_sentences", "item_cf_events"])
def test_date_bounds_reach_the_scan(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan or "GreaterThanOrEqual(o_orderdate," in plan


@pytest.mark.parametrize("name", ["category_index", "item_index"])
def test_no_sort_of_all_values_in_one_task(spark, name):
    assert "SinglePartition" not in QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
