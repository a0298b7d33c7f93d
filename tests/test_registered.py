"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, con, name):
    assert difference(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["job_entity_mapping", "join_fallback_cross", "agg_mapping_quality"])
def test_matching_plans_no_cross_join(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_building_a_query_runs_no_job(spark):
    names = ["mart_price", "mart_tension", "mart_inequality", "agg_median_cont", "agg_deciles", "agg_describe", "filter_fk_semi",
             "job_fact_transactions", "job_fact_revenus", "job_bridge", "job_entity_mapping", "win_yoy_gated"]
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for name in names:
            queries()[name](spark, FOLDER)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
