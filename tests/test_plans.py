"""Shape of the physical plans: pruned scans, broadcast lookups, no nested loops."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
JOBS = ["login_clean", "order_clean", "own_order_clean", "channel_database", "agency_order_join", "service_clean_agent", "coin_trades", "activations",
        "old_logins", "ip_region", "refund_update", "lookup_large_dimension", "first_event_running"]


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", JOBS)
def test_no_nested_loops(spark, name):
    text = plan(spark, name)
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_scans_read_only_needed_columns(spark):
    text = plan(spark, "warehouse_exists")
    assert "l_partkey" in text and "l_extendedprice" not in text
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text


@pytest.mark.parametrize("name,passes", [("rule_validate", 1), ("project_order", 2), ("activations", 2), ("channel_database", 0), ("agency_order_join", 1)])
def test_json_is_parsed_once_per_pass(spark, name, passes):
    """Change data is two texts, the envelope and the row's object, which stays whole. State reads its input twice: jobs
    with lookups before it write their rows once, so what they run afterwards parses no line again,
    only the rules of test orders."""
    text = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(StructField") == passes


def test_state_window_is_partitioned_by_block(spark):
    assert "_block" in plan(spark, "first_event_running")


def test_tasks_of_a_log_follow_its_rows(spark, monkeypatch):
    """No task's rows grow with the table."""
    from workload import inputs
    monkeypatch.setattr(inputs, "TASK_ROWS", 100)
    inputs.spread.cache_clear()
    rows = inputs.spread(spark, SF, "events")
    inputs.spread.cache_clear()
    assert rows.rdd.getNumPartitions() == -(-rows.count() // 100) > spark.sparkContext.defaultParallelism


def test_load_stages_a_folder_a_table(spark, tmp_path, monkeypatch):
    from playtrail.plans import loads
    monkeypatch.setattr(loads, "OPEN_WRITERS", 2)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = spark.range(0, 1000, 1, 1).selectExpr("id", "concat('t', id % 5) AS route")
    kept = loads.staged(rows, str(tmp_path / "stage"), "route")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, rows.collect()))
    assert {p.name for p in (tmp_path / "stage").glob("route=*")} == {f"route=t{n}" for n in range(5)}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
