"""Plan shape of the registered queries (what the formatted plans were reviewed for)."""

import pytest
import __spark_entry__ as entry
from settings import SF_SMALL
from gearbox.plans.registry import REGISTRY

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
MODEL_QUERIES = {n for n, q in REGISTRY.items() if q.fn.__module__.endswith("queries_models")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - MODEL_QUERIES))
def test_no_cartesian_products_or_python_udfs(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in plan], plan


def test_flagship_pushes_null_tests_into_the_scan(spark):
    plan = plan_of(entry.entry(spark))
    assert "PushedFilters: [IsNotNull(listing_id)" in plan and "IsNotNull(price)" in plan


def test_model_preparation_reads_only_used_columns(spark):
    from gearbox.plans.training import prepare
    from gearbox.schema import GBT_CATEGORICALS
    from gearbox.sources.fixtures import listings_table
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = plan_of(prepare(listings_table(spark, SF_SMALL), GBT_CATEGORICALS))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = plan[plan.index("ReadSchema:"):].split("\n")[0]
    assert "fuel_type" not in read and "trim" not in read and "make:" in read and "transmission:" in read


def test_brand_table_is_broadcast_not_shuffled(spark):
    plan = plan_of(entry.queries()["prepared_table"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_global_aggregates_are_partial_before_the_single_partition_exchange(spark):
    df = entry.queries()["row_counts"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
