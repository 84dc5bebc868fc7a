"""Window functions (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.operators import windows
from tablework.operators.joins import top_rows
from tablework.operators.ordered import shifted
from tablework.plans.registry import query
from tablework.session import table

QUARTERS_SQL = """SELECT o_custkey, last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS quarter,
                  round(sum(o_totalprice), 2) AS revenue, count(*) AS orders FROM orders GROUP BY 1, 2"""


def _quarters(spark, sf):
    quarter = F.last_day(F.add_months(F.trunc("o_orderdate", "quarter"), 2)).alias("quarter")
    return table(spark, sf, "orders").groupBy("o_custkey", quarter).agg(
        F.round(F.sum("o_totalprice"), 2).alias("revenue"), F.count(F.lit(1)).alias("orders"))


@query("E1", """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def latest_row_per_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return top_rows(orders, ["o_custkey"], [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").asc_nulls_last()])


@query("E2 H2", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') || '-' ||
      lpad(CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS VARCHAR), 6, '0') AS line_id FROM orders""")
def global_line_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return windows.line_ids(orders, ["o_orderdate", "o_orderkey"], F.date_format("o_orderdate", "yyyy-MM"), "line_id").select(
        "o_orderkey", "line_id")


@query("E3", "SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer")
def global_rank_column(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return windows.global_rank(customers, [F.col("c_acctbal").desc_nulls_first(), F.col("c_custkey").asc_nulls_last()],
                               "rank").drop("c_acctbal")


@query("E4", f"""
    SELECT o_custkey, quarter, revenue, lag(revenue) OVER w AS last_revenue,
           round(lag(revenue / orders) OVER w, 4) AS last_mean FROM ({QUARTERS_SQL})
    WINDOW w AS (PARTITION BY o_custkey ORDER BY quarter)""")
def lag_columns(spark, sf):
    lagged = shifted(_quarters(spark, sf), ["o_custkey"], ["quarter"], {
        "last_revenue": (F.col("revenue"), 1), "last_mean": (F.col("revenue") / F.col("orders"), 1)}, bounded=True)
    return lagged.select("o_custkey", "quarter", "revenue", "last_revenue", F.round("last_mean", 4).alias("last_mean"))


@query("E5", """
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS since,
           CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE) - 1 AS until FROM orders""")
def lead_next_start(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("since"))
    led = shifted(orders, ["o_custkey"], ["since", "o_orderkey"], {"next": (F.col("since"), -1)})
    return led.select("o_custkey", "o_orderkey", "since", F.date_sub("next", 1).alias("until"))


@query("E6", """
    WITH m AS (SELECT o_custkey, last_day(o_orderdate) AS report,
                 max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS a, max(CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END) AS b
               FROM orders GROUP BY 1, 2)
    SELECT o_custkey, report, CASE WHEN sum(a) OVER w >= 6 THEN 1 ELSE 0 END AS six_of_seven,
           CASE WHEN sum(b) OVER w >= 3 THEN 1 ELSE 0 END AS three_of_seven, CAST(sum(b) OVER w AS BIGINT) AS large_months FROM m
    WINDOW w AS (PARTITION BY o_custkey ORDER BY report ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def rolling_flags(spark, sf):
    months = table(spark, sf, "orders").groupBy("o_custkey", F.last_day("o_orderdate").alias("report")).agg(
        F.max((F.col("o_orderstatus") == "F").cast("int")).alias("a"),
        F.max((F.col("o_totalprice") > 250000).cast("int")).alias("b"))
    summed = windows.rolling(months, ["o_custkey"], ["report"], 7, {
        "sa": ("sum", F.col("a")), "large_months": ("sum", F.col("b"))}, bounded=True)
    return summed.select("o_custkey", "report", F.when(F.col("sa") >= 6, 1).otherwise(0).alias("six_of_seven"),
                         F.when(F.col("large_months") >= 3, 1).otherwise(0).alias("three_of_seven"), "large_months")


@query("E6", """
    SELECT user_id, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2)
      AS rolling FROM events""")
def rolling_sum_events(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return windows.rolling_sum(events, ["user_id"], ["ts", "event_id"], "value", 7, "rolling").select(
        "user_id", "event_id", F.round("rolling", 2).alias("rolling"))


@query("E7", f"""
    SELECT o_custkey, quarter, revenue, lag(revenue) OVER w AS last_revenue,
           round(CASE WHEN lag(revenue) OVER w >= 0 THEN revenue - lag(revenue) OVER w END, 2) AS revenue_diff,
           round(coalesce((revenue - lag(revenue) OVER w) / nullif(lag(revenue) OVER w, 0), 0) * 100, 4) AS revenue_pct
    FROM ({QUARTERS_SQL}) WINDOW w AS (PARTITION BY o_custkey ORDER BY quarter)""")
def period_change(spark, sf):
    changed = windows.period_change(_quarters(spark, sf).drop("orders"), ["o_custkey"], "quarter", ["revenue"])
    return changed.select("o_custkey", "quarter", "revenue", "last_revenue",
                          F.round("revenue_diff", 2).alias("revenue_diff"), F.round("revenue_pct", 4).alias("revenue_pct"))


@query("E8", """
    WITH r AS (SELECT o_custkey, o_totalprice AS latest, lead(o_totalprice) OVER w AS previous, row_number() OVER w AS rn
               FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC))
    SELECT o_custkey, latest, previous, CASE WHEN latest > previous THEN 'up' ELSE 'down' END AS direction,
           round(abs((latest - previous) / previous) * 100, 4) AS percent
    FROM r WHERE rn = 1 AND abs(latest - previous) > 0.05 * previous""")
def latest_move(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return windows.latest_move(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", 0.05)


@query("E9", "SELECT DISTINCT p_retailprice FROM part ORDER BY 1 DESC LIMIT 3")
def top_three_distinct(spark, sf):
    return windows.top_distinct(table(spark, sf, "part"), "p_retailprice", 3)


@query("E9", """
    SELECT p_brand, p_size, CAST(r AS INTEGER) AS rank FROM (
      SELECT DISTINCT p_brand, p_size, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS r FROM part) WHERE r <= 3""")
def top_three_distinct_per_key(spark, sf):
    return windows.top_distinct(table(spark, sf, "part"), "p_size", 3, ["p_brand"])


@query("E10", """
    SELECT user_id, event_id, value, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS highest
    FROM events""")
def running_max(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return windows.running_max(events, ["user_id"], ["ts", "event_id"], "value", "highest").drop("ts")


@query("E11", """
    SELECT user_id, round(greatest(0, max(value - low)), 4) AS gain FROM (
      SELECT user_id, value, min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS low FROM events)
    GROUP BY 1""")
def best_gain(spark, sf):
    return windows.best_gain(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "value").select(
        "user_id", F.round("gain", 4).alias("gain"))


@query("E12", """
    WITH v AS (SELECT user_id, ts, event_id, CAST(round(value * 100) AS BIGINT) - 5000 AS cents FROM events),
    p AS (SELECT user_id, ts, event_id, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS s FROM v),
    m AS (SELECT user_id, s, min(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM p)
    SELECT user_id, max(s - least(0, coalesce(low, 0))) AS best FROM m GROUP BY 1""")
def best_run_sum(spark, sf):
    cents = F.round(F.col("value") * 100).cast("bigint") - 5000
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", cents.alias("cents"))
    return windows.best_run_sum(events, ["user_id"], ["ts", "event_id"], "cents")


@query("E13", """
    WITH v AS (SELECT user_id, CASE WHEN value < 30 THEN 0 ELSE 1 END AS z,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a,
                 row_number() OVER (PARTITION BY user_id, value < 30 ORDER BY ts, event_id) AS b FROM events),
    r AS (SELECT user_id, a - b AS run, count(*) AS n FROM v WHERE z = 0 GROUP BY 1, 2)
    SELECT user_id, count(*) AS runs, max(n) AS longest, CAST(sum(n * (n + 1) // 2) AS BIGINT) AS stretches FROM r GROUP BY 1""")
def zero_runs(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", "ts", "event_id", F.when(F.col("value") < 30, 0).otherwise(1).alias("z"))
    return windows.zero_runs(events, ["user_id"], ["ts", "event_id"], "z")


@query("E14", """
    SELECT i AS l_orderkey FROM (SELECT unnest(range((SELECT min(l_orderkey) FROM lineitem), (SELECT max(l_orderkey) + 1 FROM lineitem))) AS i)
    WHERE i NOT IN (SELECT l_orderkey FROM lineitem)""")
def missing_ids(spark, sf):
    return windows.missing_ids(table(spark, sf, "lineitem"), "l_orderkey")


@query("E15", """
    WITH p AS (SELECT l_orderkey, coalesce(q, 0) AS q, CAST(sum(coalesce(q, 0)) OVER w AS BIGINT) AS s, row_number() OVER w AS i
               FROM (SELECT *, CASE WHEN l_partkey % 11 > 0 THEN CAST(l_quantity AS BIGINT) END AS q FROM lineitem)
               WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING))
    SELECT b.l_orderkey, b.i AS "end", count(*) AS windows, max(a.i) AS nearest_start
    FROM p a JOIN p b ON a.l_orderkey = b.l_orderkey AND a.i <= b.i AND b.s - a.s + a.q = 60 GROUP BY 1, 2""")
def windows_with_target_sum(spark, sf):
    """Some quantities are unknown and count as 0."""
    lines = table(spark, sf, "lineitem").withColumn("q", F.when(F.col("l_partkey") % 11 > 0, F.col("l_quantity").cast("bigint")))
    return windows.target_windows(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "q", 60)


@query("E16", """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rn FROM orders) WHERE rn = 3""")
def kth_smallest(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.kth_smallest(orders, ["o_custkey"], "o_totalprice", ["o_orderkey"], 3)


@query("E16", """
    SELECT DISTINCT p_brand, p_size FROM (
      SELECT p_brand, p_size, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS r FROM part) WHERE r = 4""")
def kth_smallest_distinct(spark, sf):
    return windows.kth_smallest(table(spark, sf, "part"), ["p_brand"], "p_size", [], 4, distinct=True)


@query("E17", """
    SELECT l_orderkey, max(n) > 1 AS has_duplicates FROM (
      SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def duplicate_test(spark, sf):
    return windows.has_duplicates(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber")
