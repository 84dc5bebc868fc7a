"""The plans that matter at scale: pruned scans, pushed filters, limits before the shuffle, shared scratch."""

import os
from types import SimpleNamespace

import pytest

import __spark_entry__ as spark_entry
from tablework import session
from test_registered import SF_DIR, plan_of

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
QUERIES = spark_entry.queries()


def plan(spark, name):
    return plan_of(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", ["latest_row_per_key", "kth_smallest", "kth_smallest_distinct", "latest_move",
                                  "top_three_distinct_per_key"])
def test_rank_limit_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", ["top_k", "largest_sets", "dearest_zero_gross", "top_three_distinct", "random_rows"])
def test_top_k_is_merged_not_sorted(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def test_scan_reads_only_needed_columns(spark):
    text = plan(spark, "inner_equi_join")
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(l_linestatus), IsNotNull(l_shipdate), EqualTo(l_linestatus,F)" in plan(spark, "statement_pivot")
    assert "GreaterThanOrEqual(o_orderdate" in plan(spark, "between_dates")


def test_quarter_branches_scan_once(spark):
    assert plan(spark, "quarter_branches").count("FileScan") == 1


def test_year_comparison_scans_once(spark):
    text = plan(spark, "year_earlier_join")
    assert text.count("FileScan") == 1 and "Join" not in text


def test_warnings_are_dealt_once_by_firm(spark):
    executed = QUERIES["early_warning"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    # statements and exposures, each once; quarters, year-on-year, as-of and rolling steps stay where the firm is
    assert executed.count("Exchange hashpartitioning(firm") <= 2 and executed.count("Exchange rangepartitioning") == 0


def test_global_numbers_take_one_shuffle(spark):
    from tablework.operators.ordered import positions

    df = spark.range(1000).selectExpr("id", "id % 7 AS v")
    text = plan_of(positions(df, [], ["v", "id"]))
    # the rows were range-partitioned when they were written; only the block sizes are exchanged now
    assert "rangepartitioning" not in text and "Window" in text and text.count("hashpartitioning(_block") <= 1
    assert [r["pos"] for r in positions(df, [], ["v", "id"]).orderBy("v", "id").collect()] == list(range(1000))


def fake_session(settings, master, checkpoint=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)), sparkContext=context)


def test_scratch_is_below_the_named_folder():
    cluster = fake_session({"spark.checkpoint.dir": "hdfs://shared/cp/"}, "yarn")
    assert session.shared_dir(cluster) == "hdfs://shared/cp"
    assert session.scratch_path(cluster, "x").startswith("hdfs://shared/cp/tablework/x-")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(fake_session({}, "yarn"))
