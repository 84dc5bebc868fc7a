"""Aggregations (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.numbers import safe_div
from tablework.operators import aggs
from tablework.operators.joins import with_group_value
from tablework.plans.registry import query
from tablework.session import table


@query("D-1", """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice), 2) AS price,
           round(avg(l_discount), 6) AS discount, min(l_quantity) AS least, max(l_extendedprice) AS dearest, count(*) AS lines
    FROM lineitem GROUP BY 1, 2""")
def group_totals(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.round(F.avg("l_discount"), 6).alias("discount"), F.min("l_quantity").alias("least"),
        F.max("l_extendedprice").alias("dearest"), F.count(F.lit(1)).alias("lines"))


@query("D-2", """
    SELECT round(avg(o_totalprice), 4) AS mean_price, max(o_totalprice) AS max_price, min(o_totalprice) AS min_price,
           count(*) AS orders FROM orders""")
def global_totals(spark, sf):
    return table(spark, sf, "orders").agg(
        F.round(F.avg("o_totalprice"), 4).alias("mean_price"), F.max("o_totalprice").alias("max_price"),
        F.min("o_totalprice").alias("min_price"), F.count(F.lit(1)).alias("orders"))


@query("D-3", """
    SELECT d.lang, count(*) AS size, count(l.quality) AS labelled FROM documents d
    LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""")
def count_against_size(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return joined.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.count("quality").alias("labelled"))


@query("D-4 M3", """
    SELECT p_brand, count(DISTINCT p_size) AS sizes, count(DISTINCT p_type) AS types, round(avg(p_retailprice), 4) AS mean_price
    FROM part GROUP BY 1""")
def distinct_counts(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(
        F.countDistinct("p_size").alias("sizes"), F.countDistinct("p_type").alias("types"),
        F.round(F.avg("p_retailprice"), 4).alias("mean_price"))


@query("D-5", """
    SELECT l_linestatus, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
           round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 6) AS return_share FROM lineitem GROUP BY 1""")
def conditional_counts(spark, sf):
    returned = F.col("l_returnflag") == "R"
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(
        F.count_if(returned).alias("returned"), F.round(F.avg(returned.cast("double")), 6).alias("return_share"))


@query("D-6 H27", """
    SELECT event_type, CAST(sum(CASE WHEN event_id % 4 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) AS BIGINT) AS k_total,
           count(*) FILTER (WHERE event_id % 4 <> 0 AND json_extract_string(props, '$.k') IS NOT NULL) AS with_k
    FROM events GROUP BY 1""")
def sum_optional_field(spark, sf):
    """Every fourth event lacks the field; those rows are skipped by the sum."""
    props = F.when(F.col("event_id") % 4 == 0, F.lit("{}")).otherwise(F.col("props"))
    k = F.get_json_object(props, "$.k").try_cast("bigint")
    return table(spark, sf, "events").groupBy("event_type").agg(F.sum(k).alias("k_total"), F.count(k).alias("with_k"))


@query("D-7", """
    WITH l AS (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS last_day,
                      max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey) AS last_flag,
                      CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS flag FROM orders)
    SELECT o_custkey, max(o_totalprice) FILTER (WHERE o_orderdate = last_day) AS max_at_last,
           min(o_totalprice) FILTER (WHERE o_orderdate = last_day) AS min_at_last,
           max(o_orderstatus) FILTER (WHERE o_orderdate = last_day) AS status_at_last,
           CAST(min(o_orderdate) FILTER (WHERE flag = last_flag) AS DATE) AS first_at_flag
    FROM l GROUP BY 1""")
def keep_last(spark, sf):
    day = F.to_date("o_orderdate")
    flag = (F.col("o_orderpriority") == "1-URGENT").cast("int")
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        aggs.keep_last(price, day, "max").alias("max_at_last"),
        aggs.keep_last(price, day, "min").alias("min_at_last"),
        aggs.keep_last(F.col("o_orderstatus"), day, "max").alias("status_at_last"),
        aggs.keep_last(day, flag, "min", date=True).alias("first_at_flag"))


FIRST_EVENTS = """
    SELECT user_id, min(CAST(ts AS DATE)) AS first_day,
           min(CASE WHEN event_type = 'error' THEN CAST(ts AS DATE) END) AS first_error,
           min(CASE WHEN value > 200 THEN CAST(ts AS DATE) END) AS first_large FROM events GROUP BY 1"""


def _first_events(spark, sf):
    day = F.to_date("ts")
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.min(day).alias("first_day"),
        aggs.first_event((F.col("event_type") == "error").cast("int"), day).alias("first_error"),
        aggs.first_event((F.col("value") > 200).cast("int"), day).alias("first_large"))


@query("D-8", FIRST_EVENTS)
def first_event_dates(spark, sf):
    return _first_events(spark, sf)


@query("D-9", f"""
    SELECT user_id, CAST(first_error - first_day AS INTEGER) AS days_to_error,
           CAST(first_large - first_day AS INTEGER) AS days_to_large FROM ({FIRST_EVENTS})""")
def days_to_event(spark, sf):
    return _first_events(spark, sf).select(
        "user_id", F.datediff("first_error", "first_day").alias("days_to_error"),
        F.datediff("first_large", "first_day").alias("days_to_large"))


@query("D-10", """
    SELECT p_brand, arg_max(p_partkey, (p_retailprice, -p_partkey)) AS dearest_id, max(p_retailprice) AS dearest,
           arg_min(p_partkey, (p_size, p_partkey)) FILTER (WHERE p_partkey % 7 > 0) AS smallest_id,
           min(p_size) FILTER (WHERE p_partkey % 7 > 0) AS smallest FROM part GROUP BY 1""")
def extreme_rows(spark, sf):
    """The size of every seventh part is unknown."""
    part = table(spark, sf, "part").select(
        "p_brand", "p_partkey", "p_retailprice", F.when(F.col("p_partkey") % 7 > 0, F.col("p_size")).alias("p_size"))
    rows = aggs.extreme_rows(part, ["p_brand"], {
        "high": ("p_retailprice", "p_partkey", "max"), "low": ("p_size", "p_partkey", "min")})
    return rows.select(
        "p_brand", F.col("high.p_partkey").alias("dearest_id"), F.col("high.p_retailprice").alias("dearest"),
        F.col("low.p_partkey").alias("smallest_id"), F.col("low.p_size").alias("smallest"))


def _describe_sql(rel, columns):
    one = ("SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
           "min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, "
           "round(quantile_cont({c}, 0.75), 4) AS q75, max({c})::DOUBLE AS max FROM {r}")
    return " UNION ALL ".join(one.format(c=c, r=rel) for c in columns)


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("D-11", _describe_sql("lineitem", DESCRIBED))
def describe_columns(spark, sf):
    stats = aggs.describe(table(spark, sf, "lineitem").select(*DESCRIBED), DESCRIBED)
    return stats.select("column", "count", "min", "max", *[F.round(c, 4).alias(c) for c in ("mean", "std", "q25", "q50", "q75")])


@query("D-12", """
    SELECT CAST(0 AS BIGINT) AS doc_id, CAST(0 AS BIGINT) AS lang, count(*) - count(l.quality) AS quality, count(*) - count(l.toxic) AS toxic,
           2 * count(*) - count(l.quality) - count(l.toxic) AS all_columns
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def null_counts(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return aggs.null_counts(joined)


@query("D-13", """
    SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT text, lang, count(*) AS n FROM documents GROUP BY 1, 2)""")
def duplicate_row_count(spark, sf):
    return aggs.duplicate_rows(table(spark, sf, "documents"), ["text", "lang"])


@query("D-14", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("D-14", """
    SELECT user_id, event_type, event_id, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def distinct_keep_first(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return aggs.first_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@query("D-14", "SELECT DISTINCT user_id FROM events ORDER BY user_id LIMIT 25")
def first_distinct_keys(spark, sf):
    """The first n distinct keys, in key order."""
    return table(spark, sf, "events").select("user_id").distinct().orderBy("user_id").limit(25)


@query("D-15", """
    SELECT o_custkey, pos // 2 AS page, count(*) AS values, string_agg(o_orderpriority, ', ' ORDER BY pos) AS joined FROM (
      SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY min((o_orderdate, o_orderkey))) - 1 AS pos
      FROM orders GROUP BY 1, 2) GROUP BY 1, 2""")
def collect_first_seen(spark, sf):
    lists = aggs.ordered_lists(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", ["o_orderdate", "o_orderkey"], page_rows=2)
    return lists.select("o_custkey", "page", F.size("values").cast("bigint").alias("values"), F.array_join("values", ", ").alias("joined"))


PIVOT_CODES = list(range(1, 33))


@query("D-16", f"""
    SELECT l_suppkey, l_linestatus, {", ".join(f'sum(l_quantity) FILTER (WHERE p_size = {c}) AS s{c}' for c in PIVOT_CODES)},
           coalesce(sum(l_quantity) FILTER (WHERE p_size = 1), sum(l_quantity) FILTER (WHERE p_size = 2)) AS first_known
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 32 GROUP BY 1, 2""")
def pivot_sum(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_linestatus", "l_partkey", "l_quantity")
    sized = lines.join(table(spark, sf, "part").where(F.col("p_size") <= 32).select(
        F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey")
    wide = aggs.pivot_sum(sized, ["l_suppkey", "l_linestatus"], "p_size", "l_quantity", PIVOT_CODES)
    return wide.select("l_suppkey", "l_linestatus", *[F.col(str(c)).alias(f"s{c}") for c in PIVOT_CODES],
                       F.coalesce(F.col("1"), F.col("2")).alias("first_known"))


@query("D-17", """
    SELECT round((SELECT count(*) FROM orders WHERE o_orderdate >= DATE '1997-07-01' AND o_orderdate <= DATE '1997-12-31' AND o_orderstatus = 'F')::DOUBLE
      / (SELECT count(*) FROM customer WHERE c_acctbal > 0), 8) AS ratio""")
def ratio_of_counts(spark, sf):
    filled = table(spark, sf, "orders").where(
        (F.col("o_orderdate") >= F.lit("1997-07-01").cast("date")) & (F.col("o_orderdate") <= F.lit("1997-12-31").cast("date"))
        & (F.col("o_orderstatus") == "F")).agg(F.count(F.lit(1)).alias("n"))
    solvent = table(spark, sf, "customer").where("c_acctbal > 0").agg(F.count(F.lit(1)).alias("m"))
    return filled.select(F.round(safe_div(F.col("n"), solvent.scalar()), 8).alias("ratio"))


@query("D-18", """
    SELECT o_orderkey, o_custkey, o_orderstatus, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS how_many
    FROM (SELECT * REPLACE (CASE WHEN o_custkey % 11 > 0 THEN o_custkey END AS o_custkey) FROM orders)""")
def group_count_on_rows(spark, sf):
    """Orders without customer are counted together."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 11 > 0, F.col("o_custkey")).alias("o_custkey"), "o_orderstatus")
    return with_group_value(orders, ["o_custkey", "o_orderstatus"], F.count(F.lit(1)).alias("how_many"))


@query("D-19", """
    SELECT p_brand, count(*) FILTER (WHERE p_size = 7) AS sevens, CAST(sum(CASE WHEN p_size % 3 <> 0 THEN p_size END) AS BIGINT) AS not_threes
    FROM part GROUP BY 1""")
def occurrences_and_conditional_sum(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(
        F.count_if(F.col("p_size") == 7).alias("sevens"),
        F.sum(F.when(F.col("p_size") % 3 != 0, F.col("p_size"))).alias("not_threes"))


@query("D-20", """
    WITH w AS (SELECT word, count(*) AS uses FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1),
    s AS (SELECT word, uses, list_aggregate(list_sort(list_distinct(string_split(word, ''))), 'string_agg', '') AS letters FROM w WHERE word <> '')
    SELECT word, uses, letters, count(*) OVER (PARTITION BY letters) AS words_in_set,
           CAST(sum(uses) OVER (PARTITION BY letters) AS BIGINT) AS uses_in_set FROM s""")
def words_by_letter_set(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("word")).where("word <> ''")
    return aggs.letter_sets(words, "word")


@query("D-21", """
    SELECT frequency, count(*) AS values FROM (SELECT o_custkey, count(*) AS frequency FROM orders GROUP BY 1) GROUP BY 1""")
def frequency_of_frequency(spark, sf):
    return aggs.frequency_of_frequency(table(spark, sf, "orders"), "o_custkey")


@query("D-22", """
    WITH lines AS (SELECT * REPLACE (CASE WHEN l_orderkey % 1000 <> 7 THEN l_orderkey END AS l_orderkey) FROM lineitem),
         g AS (SELECT l_orderkey, coalesce(product(CASE WHEN l_linenumber <> 1 THEN l_linenumber - 1 END), 1) AS p,
                      count(*) FILTER (WHERE l_linenumber = 1) AS z FROM lines GROUP BY 1)
    SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, CASE WHEN z = 0 THEN p / (l.l_linenumber - 1)
      WHEN z = 1 AND l.l_linenumber = 1 THEN p ELSE 0 END::DOUBLE AS others FROM lines l JOIN g ON l.l_orderkey IS NOT DISTINCT FROM g.l_orderkey""")
def product_of_others(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 1000 != 7, F.col("l_orderkey")).alias("l_orderkey"), "l_partkey", "l_linenumber",
        (F.col("l_linenumber") - 1).alias("v"))
    return aggs.product_of_others(lines, ["l_orderkey"], "v", "others").drop("v")
