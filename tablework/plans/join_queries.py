"""Joins (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.dates import frac_days, quarter_end
from tablework.operators import joins
from tablework.operators.filters import with_one_row
from tablework.plans.registry import query
from tablework.session import scratch_path, table
from tablework.sources import delimited
from tablework.sources.tables import staged


def _t(spark, sf, *names):
    found = [table(spark, sf, n) for n in names]
    return found if len(found) > 1 else found[0]


@query("C1", """
    SELECT c.c_mktsegment, o.o_orderstatus, count(*) AS orders, round(sum(o.o_totalprice), 2) AS total
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2""")
def inner_equi_join(spark, sf):
    orders, customer = _t(spark, sf, "orders", "customer")
    # one row per customer and status before the join: a customer with very many orders is one row then
    per_customer = orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("t"))
    joined = per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment", "o_orderstatus").agg(
        F.sum("n").alias("orders"), F.round(F.sum("t"), 2).alias("total"))


@query("C2", """
    SELECT n.n_name, r.r_name, p.p_type, o.o_orderstatus, count(*) AS lines, round(sum(l.l_quantity), 2) AS quantity
    FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
    GROUP BY 1, 2, 3, 4""")
def left_join_star(spark, sf):
    lines, orders, customer, nation, region, part, supplier = _t(
        spark, sf, "lineitem", "orders", "customer", "nation", "region", "part", "supplier")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")
        .join(customer, orders.o_custkey == customer.c_custkey, "left")
        .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
        .join(part, lines.l_partkey == part.p_partkey, "left")
        .join(supplier, lines.l_suppkey == supplier.s_suppkey, "left")
        .groupBy("n_name", "r_name", "p_type", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )


@query("C3", """
    SELECT cn.n_name AS buyer, sn.n_name AS seller, count(*) AS lines
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
    GROUP BY 1, 2""")
def lookup_joined_twice(spark, sf):
    lines, orders, customer, nation, supplier = _t(spark, sf, "lineitem", "orders", "customer", "nation", "supplier")
    keys = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey").agg(F.count(F.lit(1)).alias("lines"))
    )
    buyer, seller = nation.alias("buyer"), nation.alias("seller")
    return (
        keys.join(buyer, F.col("c_nationkey") == F.col("buyer.n_nationkey"), "left")
        .join(seller, F.col("s_nationkey") == F.col("seller.n_nationkey"), "left")
        .select(F.col("buyer.n_name").alias("buyer"), F.col("seller.n_name").alias("seller"), "lines")
    )


@query("C4", """
    SELECT c.c_custkey, u.o_orderkey FROM (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000) u
    RIGHT JOIN customer c ON u.o_custkey = c.c_custkey""")
def right_outer_join(spark, sf):
    orders, customer = _t(spark, sf, "orders", "customer")
    urgent = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 300000))
    return urgent.join(customer, F.col("o_custkey") == F.col("c_custkey"), "right").select("c_custkey", "o_orderkey")


def _quarterly(orders):
    return orders.groupBy("o_custkey", quarter_end("o_orderdate").alias("quarter")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query("C5 H14", """
    WITH q AS (SELECT CASE WHEN o_custkey % 11 > 0 THEN o_custkey END AS o_custkey,
                      last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS quarter,
                      round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1, 2)
    SELECT a.o_custkey, a.quarter, a.revenue, b.quarter AS last_quarter, b.revenue AS last_revenue
    FROM q a LEFT JOIN q b ON a.o_custkey = b.o_custkey AND last_day(b.quarter + INTERVAL 12 MONTH) = a.quarter""")
def year_earlier_join(spark, sf):
    """Some customers are unknown (null): their quarters are compared with nothing."""
    orders = _t(spark, sf, "orders").withColumn("o_custkey", F.when(F.col("o_custkey") % 11 > 0, F.col("o_custkey")))
    return joins.year_over_year(_quarterly(orders), ["o_custkey"], "quarter", ["revenue"])


@query("C6", """
    WITH e AS (SELECT event_id, event_type, value, CASE WHEN event_id % 11 > 0 THEN user_id END AS user_id,
                      CASE WHEN event_id % 13 > 0 THEN ts END AS ts FROM events)
    SELECT p.user_id, p.event_id, p.ts, c.event_id AS click_id, c.ts AS click_ts, c.value AS click_value
    FROM (SELECT * FROM e WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'click' AND ts IS NOT NULL) c ON p.user_id = c.user_id AND p.ts >= c.ts""")
def asof_join(spark, sf):
    """Some events have no user or no time: they match nothing."""
    events = _t(spark, sf, "events").withColumns({
        "user_id": F.when(F.col("event_id") % 11 > 0, F.col("user_id")), "ts": F.when(F.col("event_id") % 13 > 0, F.col("ts"))})
    purchases = events.where("event_type = 'purchase'").select("user_id", "event_id", "ts")
    clicks = events.where("event_type = 'click'").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"), F.col("value").alias("click_value"))
    return joins.asof_join(purchases, clicks, ["user_id"], "ts", "click_ts", right_tie="click_id")


@query("C6", """
    WITH months AS (SELECT DISTINCT last_day(o_orderdate) AS report FROM orders),
    q AS (SELECT o_custkey, last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS quarter,
                 round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1, 2),
    r AS (SELECT DISTINCT o_custkey, last_day(o_orderdate) AS report FROM orders)
    SELECT r.o_custkey, r.report, q.quarter, q.revenue
    FROM r ASOF LEFT JOIN q ON r.o_custkey = q.o_custkey AND r.report >= q.quarter""")
def asof_join_statements(spark, sf):
    """Latest quarterly statement on or before each month in which a customer was active."""
    orders = _t(spark, sf, "orders")
    reports = orders.select("o_custkey", F.last_day("o_orderdate").alias("report")).distinct()
    # at most one statement per quarter and one report per month and key
    return joins.asof_join(reports, _quarterly(orders), ["o_custkey"], "report", "quarter", bounded=True)


@query("C7", """
    SELECT m.report, count(*) AS orders, max(CAST(o.o_orderdate AS DATE)) AS latest, round(sum(o.o_totalprice), 2) AS total
    FROM (SELECT DISTINCT last_day(o_orderdate) AS report FROM orders) m JOIN orders o ON m.report >= CAST(o.o_orderdate AS DATE)
    GROUP BY 1""")
def range_join_on_or_before(spark, sf):
    orders = _t(spark, sf, "orders")
    reports = orders.select(F.last_day("o_orderdate").alias("report")).distinct()
    daily = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("t"))
    return joins.on_or_before(reports, daily, "report", "day", [
        F.sum("n").alias("orders"), F.max("day").alias("latest"), F.round(F.sum("t"), 2).alias("total")])


@query("C7", """
    SELECT a.o_orderkey, b.o_orderkey AS later_orderkey, CAST(b.o_orderdate AS DATE) - CAST(a.o_orderdate AS DATE) AS days
    FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND CAST(b.o_orderdate AS DATE) >= CAST(a.o_orderdate AS DATE)
      AND CAST(b.o_orderdate AS DATE) <= CAST(a.o_orderdate AS DATE) + CASE WHEN a.o_orderpriority = '1-URGENT' THEN 365 ELSE 30 END
      AND a.o_orderkey <> b.o_orderkey""")
def range_join_details(spark, sf):
    """Later orders of the same customer, within a month or, after an urgent one, a year."""
    orders = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("since"), "o_orderpriority")
    reach = F.when(F.col("o_orderpriority") == "1-URGENT", 365).otherwise(30)
    spans = orders.select("o_custkey", "o_orderkey", "since", F.date_add("since", reach).alias("till"))
    later = orders.select("o_custkey", F.col("o_orderkey").alias("later_orderkey"), F.col("since").alias("day"))
    pairs = joins.interval_join(later, spans, ["o_custkey"], "day", "since", "till").where("o_orderkey != later_orderkey")
    return pairs.select("o_orderkey", "later_orderkey", F.datediff("day", "since").cast("bigint").alias("days"))


@query("C8", """
    SELECT o.o_orderkey, m.first_day, m.top_price, round(o.o_totalprice / m.top_price, 6) AS share
    FROM orders o CROSS JOIN (SELECT min(CAST(o_orderdate AS DATE)) AS first_day, max(o_totalprice) AS top_price FROM orders) m""")
def attach_one_row(spark, sf):
    orders = _t(spark, sf, "orders")
    one = orders.agg(F.to_date(F.min("o_orderdate")).alias("first_day"), F.max("o_totalprice").alias("top_price"))
    return with_one_row(orders.select("o_orderkey", "o_totalprice"), one).select(
        "o_orderkey", "first_day", "top_price", F.round(F.col("o_totalprice") / F.col("top_price"), 6).alias("share"))


@query("C9", """
    SELECT o.o_orderkey, c.c_mktsegment FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE c.c_mktsegment <> 'BUILDING'""")
def left_join_rejecting_nulls(spark, sf):
    orders, customer = _t(spark, sf, "orders", "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").where(
        "c_mktsegment <> 'BUILDING'").select("o_orderkey", "c_mktsegment")


@query("C10", """
    SELECT c.c_custkey, c.c_name FROM customer c
    LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 450000) o ON c.c_custkey = o.o_custkey
    WHERE o.o_custkey IS NULL""")
def anti_join(spark, sf):
    orders, customer = _t(spark, sf, "orders", "customer")
    large = orders.where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return customer.join(large, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("C11 F6", """
    SELECT doc_id, lang, min(n_chars) AS n_chars FROM (
      SELECT doc_id, lang, n_chars FROM documents UNION ALL SELECT doc_id, lang, n_chars - 1 FROM documents WHERE doc_id % 5 = 0)
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1, 2""")
def new_ids_only(spark, sf):
    """Every fifth document arrives twice."""
    documents, labels = _t(spark, sf, "documents", "labels")
    once = documents.select("doc_id", "lang", "n_chars")
    again = once.where("doc_id % 5 = 0").withColumn("n_chars", F.col("n_chars") - 1)
    return joins.new_rows(once.unionByName(again), labels, ["doc_id"])


@query("C12", """
    WITH m AS (SELECT DISTINCT o_custkey, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders)
    SELECT a.* FROM m a WHERE NOT EXISTS (
      SELECT 1 FROM m b WHERE b.o_custkey = a.o_custkey AND b.o_orderpriority = a.o_orderpriority AND b.season = a.season - 1)""")
def first_appearance(spark, sf):
    membership = _t(spark, sf, "orders").select("o_custkey", "o_orderpriority", F.year("o_orderdate").alias("season"))
    return joins.first_appearances(membership, ["o_custkey", "o_orderpriority"], "season")


@query("C13", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM (
      SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS d
      FROM (SELECT * REPLACE (CASE WHEN o_custkey % 11 > 0 THEN o_custkey END AS o_custkey) FROM orders)) WHERE o_orderdate = d""")
def join_group_maximum(spark, sf):
    """Every order of a customer's last ordering day; orders without customer are a group."""
    orders = _t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 11 > 0, F.col("o_custkey")).alias("o_custkey"), "o_totalprice", "o_orderdate")
    return joins.with_group_value(orders, ["o_custkey"], F.max("o_orderdate").alias("d")).where(
        "o_orderdate = d").drop("o_orderdate", "d")


@query("C14 H15", """
    SELECT o.o_orderkey, o.o_orderdate, l.first_ship,
           round((epoch(l.first_ship) - epoch(o.o_orderdate)) / 86400.0, 6) AS days
    FROM orders o JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1) l ON o.o_orderkey = l.l_orderkey
    WHERE (epoch(l.first_ship) - epoch(o.o_orderdate)) / 86400.0 < 1 AND month(o.o_orderdate) BETWEEN 7 AND 12""")
def join_within_a_day(spark, sf):
    orders, lines = _t(spark, sf, "orders", "lineitem")
    first = lines.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))
    days = frac_days("first_ship", "o_orderdate")
    return orders.join(first, F.col("o_orderkey") == F.col("l_orderkey")).where(
        (days < 1) & F.month("o_orderdate").between(7, 12)
    ).select("o_orderkey", "o_orderdate", "first_ship", F.round(days, 6).alias("days"))


@query("C15", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def zip_join_files(spark, sf):
    """Two column slices of one ordered table, written to a different number of files each."""
    # ordered and written once, so that both slices meet the rows in one order
    part = staged(_t(spark, sf, "part").orderBy("p_partkey"), "ordered_part")
    a, b = scratch_path(spark, "zip_a"), scratch_path(spark, "zip_b")
    delimited.write_delimited(part.select("p_partkey", "p_name"), a)
    delimited.write_delimited(part.select("p_size", "p_retailprice"), b, maxRecordsPerFile=5_000)
    left = delimited.read_delimited(spark, a, "p_partkey bigint, p_name string")
    right = delimited.read_delimited(spark, b, "p_size int, p_retailprice double")
    return delimited.zip_join(left, right).drop("line")


@query("C16", """
    SELECT o_custkey, pos // 8 AS page, string_agg(CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY pos) AS joined, count(*) AS values FROM (
      SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders)
    GROUP BY 1, 2""")
def lookup_all_matches(spark, sf):
    orders = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return joins.matches_per_key(orders, ["o_custkey"], "o_orderkey", ["o_orderdate", "o_orderkey"], page_rows=8)


@query("C17", """
    WITH c AS (SELECT p_size AS v, count(*) AS n, min(p_partkey) AS a FROM part GROUP BY 1),
    s AS (SELECT p_size AS v, p_partkey AS b FROM (
            SELECT p_size, p_partkey, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS r FROM part) WHERE r = 2)
    SELECT x.v AS low_value, y.v AS high_value, CASE WHEN x.v = y.v THEN x.n * (x.n - 1) // 2 ELSE x.n * y.n END AS row_pairs,
           x.a AS low_id, CASE WHEN x.v = y.v THEN s.b ELSE y.a END AS high_id
    FROM c x JOIN c y ON x.v + y.v = 40 AND x.v <= y.v LEFT JOIN s ON s.v = x.v
    WHERE CASE WHEN x.v = y.v THEN x.n * (x.n - 1) // 2 ELSE x.n * y.n END > 0""")
def pairs_adding_to_target(spark, sf):
    return joins.pair_sums(_t(spark, sf, "part"), "p_partkey", "p_size", 40)
