"""What no plan may hold, for every registered query."""

import re

import pytest

from sitegauge.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"

# Each view is counted as a whole.
ONE_PARTITION = {"view_registry"}


@pytest.mark.parametrize("name", QUERIES)
def test_plan(spark, conf, plan_of, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "MapInArrow"):
        assert word not in plan
    # But for views counted whole, only sums per range meet in one task.
    single = [part for part in plan.split("\n\n") if "SinglePartition" in part]
    sums = [re.search(r"Input \[2\]: \[_range#\d+, _rows#\d+L?\]", part) for part in single]
    assert all(sums) or name in ONE_PARTITION
    # Nothing is broadcast by a hint but the tables of hot values, and rules whose number is checked.
    hinted = re.findall(r"^\(\d+\) BroadcastExchange\nInput \[\d+\]: \[(.*)\]", plan, flags=re.M)
    assert all("_tasks" in columns or "_rules" in columns for columns in hinted)


@pytest.mark.parametrize("name", ["embedded_json_extract", "bad_record_split", "project_paths"])
def test_built_text_is_not_broadcast(spark, plan_of, name):
    plan = plan_of(QUERIES[name](spark, SF))
    sent = re.findall(r"^\(\d+\) BroadcastExchange\nInput \[\d+\]: \[(.*)\]", plan, flags=re.M)
    assert not any("json" in columns or "history" in columns for columns in sent)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("first_last_growth", {"o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "c_custkey", "c_name"}),
        ("nation_visit_changes", {"o_custkey", "o_orderdate", "c_custkey", "c_nationkey", "n_nationkey", "n_name"}),
        ("completeness_report", {"doc_id", "source", "lang", "quality", "toxic"}),
        ("json_scalar", {"event_id", "props"}),
    ],
)
def test_scans_read_only_what_is_used(spark, plan_of, name, columns):
    plan = plan_of(QUERIES[name](spark, SF))
    read = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert {c.split(":")[0] for part in read for c in part.split(",")} == columns
