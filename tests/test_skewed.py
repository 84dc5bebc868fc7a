"""Key-bound queries on tables in which one key holds a third of all rows, with small window groups."""

import os

import pytest

from test_registered import QUERIES, SF_DIR, TABLES, compare

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

HOT = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS o_custkey) FROM t",
    "lineitem": """SELECT * EXCLUDE (r) REPLACE (CASE WHEN r % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN r % 3 = 1 THEN 2 ELSE l_partkey END AS l_partkey, CASE WHEN r % 3 = 2 THEN 3 ELSE l_suppkey END AS l_suppkey)
        FROM (SELECT *, row_number() OVER () AS r FROM t)""",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 8 ELSE user_id END AS user_id) FROM t",
    "documents": """SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN (SELECT text FROM t WHERE doc_id = 0) ELSE text END AS text) FROM t""",
    "customer": "SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_nationkey END AS c_nationkey) FROM t",
    "part": """SELECT * REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'Brand#7' ELSE p_brand END AS p_brand,
        CASE WHEN p_partkey % 3 = 1 THEN 20 ELSE p_size END AS p_size) FROM t""",
    "embeddings": """SELECT * REPLACE (CASE WHEN vec_id % 3 = 0 THEN (SELECT embedding FROM t WHERE vec_id = 0) ELSE embedding END AS embedding,
        CASE WHEN vec_id % 3 = 0 THEN 0 ELSE label END AS label) FROM t""",
}

NAMES = """asof_join best_gain best_run_sum collect_first_seen default_profile describe_columns distinct_keep_first early_warning
    explode_delimited group_count_on_rows inner_equi_join invoice_lines join_group_maximum keep_last knn_error_rates kth_smallest
    latest_row_per_key lead_next_start left_join_star loaded_rows lookup_all_matches membership_start_dates pairs_adding_to_target
    product_of_others rejected_rows resample_month_last rolling_sum_events running_max stratified_split validity_versions
    windows_with_target_sum words_by_letter_set year_earlier_join zero_runs""".split()


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE OR REPLACE VIEW t AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
        connection.execute(f"COPY ({HOT.get(name, 'SELECT * FROM t')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def hot_duck(hot_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{hot_dir}/{name}.parquet'")
    return connection


@pytest.fixture
def small_groups(spark):
    spark.conf.set("spark.tablework.groupRows", "300")
    yield
    spark.conf.unset("spark.tablework.groupRows")


@pytest.mark.parametrize("name", NAMES)
def test_hot_key(spark, small_groups, hot_dir, hot_duck, name):
    compare(QUERIES[name](spark, hot_dir), hot_duck, name)
