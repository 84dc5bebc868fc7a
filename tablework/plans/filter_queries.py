"""Projection, filter and conditional expressions (B)."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tablework.functions.numbers import safe_div
from tablework.operators import filters
from tablework.plans.registry import query
from tablework.session import table
from tablework.sources.tables import staged


@query("B1", """
    SELECT l_orderkey AS order_id, l_linenumber AS line, round(l_extendedprice * (1 - l_discount), 4) AS net
    FROM lineitem""")
def project_and_rename(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"),
    )


@query("B2", "SELECT p_partkey, p_brand, p_size FROM part")
def drop_columns(spark, sf):
    return table(spark, sf, "part").drop("p_name", "p_type", "p_retailprice")


@query("B3", """
    SELECT l_orderkey, round(l_extendedprice * l_tax, 4) AS tax_due, l_linenumber, l_tax FROM lineitem""")
def column_at_position(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_extendedprice")
    return filters.insert_column(
        lines, 1, "tax_due", F.round(F.col("l_extendedprice") * F.col("l_tax"), 4)).drop("l_extendedprice")


@query("B4", "SELECT *, o_totalprice > 250000 AS large, year(o_orderdate) AS order_year FROM orders")
def star_plus_columns(spark, sf):
    return table(spark, sf, "orders").select(
        "*", (F.col("o_totalprice") > 250000).alias("large"), F.year("o_orderdate").cast("bigint").alias("order_year"))


@query("B5", """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE (o_totalprice >= 400000 AND o_orderstatus <> 'F') OR o_orderpriority = '1-URGENT'""")
def compare_and_or(spark, sf):
    costly = (F.col("o_totalprice") >= 400000) & (F.col("o_orderstatus") != "F")
    return table(spark, sf, "orders").where(costly | (F.col("o_orderpriority") == "1-URGENT")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice")


@query("B6", "SELECT p_partkey, p_type, p_size FROM part WHERE p_size IN (3, 9, 14, 19) AND p_type NOT IN ('ECONOMY', 'SMALL')")
def in_list(spark, sf):
    return table(spark, sf, "part").where(
        F.col("p_size").isin(3, 9, 14, 19) & ~F.col("p_type").isin("ECONOMY", "SMALL")
    ).select("p_partkey", "p_type", "p_size")


@query("B7", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ordered FROM orders
    WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1999-01-01' AND month(o_orderdate) IN (7,8,9,10,11,12)""")
def between_dates(spark, sf):
    d = F.col("o_orderdate")
    orders = table(spark, sf, "orders")
    # the plain range reaches the scan; year and month are tested on the rows that remain
    return orders.where(
        d.between(datetime.date(1996, 1, 1), datetime.date(1998, 12, 31))
        & F.year(d).between(1996, 1998) & F.month(d).between(7, 12)
    ).select("o_orderkey", d.cast("date").alias("ordered"))


@query("B8", """
    SELECT doc_id, lang FROM documents WHERE text IS NOT NULL AND trim(text) <> '' AND trim(lang) <> ''""")
def not_blank_text(spark, sf):
    return table(spark, sf, "documents").where(filters.not_blank("text") & filters.not_blank("lang")).select(
        "doc_id", "lang")


@query("B9", """
    SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment || ':' || c_name
      WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0 THEN 'debt:' || c_nationkey
      WHEN c_mktsegment = 'HOUSEHOLD' THEN 'home:' || coalesce(nullif(c_nationkey, 0), -1)
      ELSE c_mktsegment END AS line_id FROM customer""")
def searched_case(spark, sf):
    seg, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    line_id = (
        F.when(seg.isin("BUILDING", "MACHINERY"), F.concat_ws(":", seg, "c_name"))
        .when((seg == "HOUSEHOLD") & (F.col("c_acctbal") < 0), F.concat(F.lit("debt:"), nation))
        .when(seg == "HOUSEHOLD", F.concat(F.lit("home:"), F.coalesce(F.nullif(nation, F.lit(0)), F.lit(-1))))
        .otherwise(seg)
    )
    return table(spark, sf, "customer").select("c_custkey", line_id.alias("line_id"))


@query("B10", """
    SELECT o_orderkey, CASE WHEN s IS NULL THEN 'unknown' WHEN s = 'F' THEN 'filled' WHEN s = 'O' THEN 'open' END AS status
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS s FROM orders)""")
def decode_values(spark, sf):
    orders = table(spark, sf, "orders").withColumn("s", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderstatus")))
    return orders.select("o_orderkey", F.expr("decode(s, NULL, 'unknown', 'F', 'filled', 'O', 'open')").alias("status"))


@query("B11", """
    SELECT c.c_custkey, coalesce(u.n, x.n, 0) AS orders FROM customer c
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) u ON u.o_custkey = c.c_custkey
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1) x ON x.o_custkey = c.c_custkey""")
def null_substitute(spark, sf):
    # both counts come from one scan and one shuffle
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.nullif(F.count_if(F.col("o_orderpriority") == "1-URGENT"), F.lit(0)).alias("urgent"),
        F.nullif(F.count_if(F.col("o_orderpriority") == "5-LOW"), F.lit(0)).alias("low"),
    )
    customers = table(spark, sf, "customer").select("c_custkey")
    return customers.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.coalesce("urgent", "low", F.lit(0)).alias("orders"))


@query("B12", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_tax / nullif(l_discount, 0), 4) AS tax_per_discount FROM lineitem")
def guarded_division(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(safe_div("l_tax", "l_discount"), 4).alias("tax_per_discount"))


@query("B13", """
    SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_discount > 0.05 AND l_tax < 0.02 THEN 1 ELSE 0 END AS cheap,
           CASE WHEN l_returnflag = 'R' THEN 1 END AS returned FROM lineitem""")
def flag_columns(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.when((F.col("l_discount") > 0.05) & (F.col("l_tax") < 0.02), 1).otherwise(0).alias("cheap"),
        F.when(F.col("l_returnflag") == "R", 1).alias("returned"),
    )


SIZE_GROUPS = {"tiny": list(range(1, 6)), "mid": list(range(6, 31))}


@query("B14 M1", """
    SELECT CASE WHEN p_size <= 5 THEN 'tiny' WHEN p_size <= 30 THEN 'mid' ELSE 'Other' END AS size_group,
           CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'basic' ELSE p_type END AS type_group, count(*) AS parts
    FROM part GROUP BY 1, 2""")
def regroup_categories(spark, sf):
    return table(spark, sf, "part").groupBy(
        filters.regroup("p_size", SIZE_GROUPS, other="Other").alias("size_group"),
        filters.regroup("p_type", {"basic": ["ECONOMY", "SMALL"]}).alias("type_group"),
    ).agg(F.count(F.lit(1)).alias("parts"))


@query("B15", """
    SELECT lang, count(*) AS documents, count(nullif(source, 'src0')) AS known FROM documents GROUP BY lang""")
def sentinel_to_null(spark, sf):
    docs = table(spark, sf, "documents").withColumn("source", F.nullif("source", F.lit("src0")))
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("documents"), F.count("source").alias("known"))


LABELLED = "SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _labelled(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang").join(
        table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")


@query("B16", f"""
    SELECT CASE WHEN quality IS NULL THEN 'incomplete' ELSE 'complete' END AS part, lang, count(*) AS n
    FROM ({LABELLED}) GROUP BY 1, 2""")
def split_complete_rows(spark, sf):
    # both parts read the joined rows
    complete, incomplete = filters.split_complete(staged(_labelled(spark, sf), "labelled"))
    both = complete.withColumn("part", F.lit("complete")).unionByName(incomplete.withColumn("part", F.lit("incomplete")))
    return both.groupBy("part", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("B17", f"SELECT doc_id, lang, quality FROM ({LABELLED}) WHERE quality IS NOT NULL")
def drop_null_rows(spark, sf):
    return _labelled(spark, sf).na.drop(subset=["quality"])


@query("B18", """
    SELECT CASE WHEN year(o_orderdate) <= 1997 THEN 'old' ELSE 'new' END AS era, count(*) AS orders,
           max(o_totalprice) AS dearest FROM orders GROUP BY 1""")
def split_on_year(spark, sf):
    old, new = filters.split_on(table(spark, sf, "orders"), F.year("o_orderdate") <= 1997)
    both = old.withColumn("era", F.lit("old")).unionByName(new.withColumn("era", F.lit("new")))
    return both.groupBy("era").agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("dearest"))


@query("B19", """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity BETWEEN 0 AND 40 THEN l_quantity END AS small_quantity
    FROM lineitem""")
def copy_when_in_range(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        filters.in_range_or_null("l_quantity", 0, 40).alias("small_quantity"))


@query("B20 M4", """
    SELECT o_orderpriority, count(*) AS orders FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') = '1997-03' AND o_orderstatus IN ('F', 'O') GROUP BY 1""")
def bound_parameters(spark, sf):
    return spark.sql(
        """SELECT o_orderpriority, count(*) AS orders FROM {orders}
           WHERE o_orderdate >= to_date(:period, 'yyyy-MM')
             AND o_orderdate < add_months(to_date(:period, 'yyyy-MM'), 1)
             AND o_orderstatus IN (:approved, :invoiced) GROUP BY 1""",
        args={"period": "1997-03", "approved": "F", "invoiced": "O"},
        orders=table(spark, sf, "orders"),
    )


@query("B21", "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_nationkey = 7")
def search_equal(spark, sf):
    return table(spark, sf, "supplier").where(F.col("s_nationkey") == 7).select("s_suppkey", "s_name", "s_acctbal")


@query("B22", "SELECT * FROM part ORDER BY md5('11-' || p_partkey), p_partkey LIMIT 5")
def random_rows(spark, sf):
    return filters.top_random(table(spark, sf, "part"), 5, seed=11, key="p_partkey")


@query("B23", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE year(o_orderdate) = (SELECT min(year(o_orderdate)) FROM orders)""")
def filter_by_global_aggregate(spark, sf):
    orders = table(spark, sf, "orders")
    # the first year as dates, so that the filter is one on the stored column
    start = orders.select(F.trunc(F.min("o_orderdate"), "year")).scalar()
    end = orders.select(F.add_months(F.trunc(F.min("o_orderdate"), "year"), 12)).scalar()
    return orders.where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end)).select("o_orderkey", "o_totalprice")


@query("B24", """
    SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, count(*) AS orders FROM orders
    WHERE year(o_orderdate) IN (1996, 2000) GROUP BY 1""")
def lookup_after_grouping(spark, sf):
    per_year = table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("order_year")).agg(
        F.count(F.lit(1)).alias("orders"))
    return per_year.where(F.col("order_year").isin(1996, 2000))
