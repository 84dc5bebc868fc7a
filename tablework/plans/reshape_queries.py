"""Sort, limit, set operations, reshaping (F) and data quality (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.operators import quality, reshape
from tablework.plans.registry import query
from tablework.session import table
from tablework.sources.tables import staged


@query("F1", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def order_by_keys(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal").orderBy(
        F.col("c_mktsegment").asc_nulls_last(), F.col("c_acctbal").desc_nulls_first(), F.col("c_custkey").asc_nulls_last())


@query("F2", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey LIMIT 100""")
def top_k(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice").orderBy(
        F.col("l_extendedprice").desc(), "l_orderkey", "l_partkey", "l_suppkey").limit(100)


@query("F3", """
    SELECT * FROM (SELECT 'head' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'tail' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5)""")
def head_and_tail(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    first = reshape.head(orders, ["o_orderkey"], 5).withColumn("part", F.lit("head"))
    last = reshape.tail(orders, ["o_orderkey"], 5).withColumn("part", F.lit("tail"))
    return first.unionByName(last)


@query("F4 F5", """
    SELECT o_custkey AS client, o_totalprice AS amount, o_orderpriority AS detail FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT c_custkey, c_acctbal, NULL FROM customer""")
def union_with_fillers(spark, sf):
    delivered = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("client"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("detail"))
    filler = table(spark, sf, "customer").select(F.col("c_custkey").alias("client"), F.col("c_acctbal").alias("amount"))
    return reshape.stack(delivered, filler)


@query("F6", "SELECT p_partkey FROM part EXCEPT ALL SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45")
def set_difference(spark, sf):
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R' AND l_quantity >= 45").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf, "part").select("p_partkey").exceptAll(returned)


@query("F7", """
    SELECT o_custkey, last_day(o_orderdate) AS month_end, round(sum(o_totalprice), 2) AS total FROM orders WHERE month(o_orderdate) = 3 GROUP BY 1, 2
    UNION ALL SELECT o_custkey, last_day(o_orderdate), round(sum(o_totalprice), 2) FROM orders WHERE month(o_orderdate) = 6 GROUP BY 1, 2
    UNION ALL SELECT o_custkey, last_day(o_orderdate), round(sum(o_totalprice), 2) FROM orders WHERE month(o_orderdate) = 9 GROUP BY 1, 2
    UNION ALL SELECT o_custkey, last_day(o_orderdate), round(sum(o_totalprice), 2) FROM orders WHERE month(o_orderdate) = 12 GROUP BY 1, 2""")
def quarter_branches(spark, sf):
    """Four equal branches, one per quarter month, written as one scan."""
    return table(spark, sf, "orders").where(F.month("o_orderdate").isin(3, 6, 9, 12)).groupBy(
        "o_custkey", F.last_day("o_orderdate").alias("month_end")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("F8", """
    SELECT item, count(*) AS n FROM (SELECT trim(unnest(string_split(text, ','))) AS item FROM documents) GROUP BY 1""")
def explode_delimited(spark, sf):
    items = reshape.explode_text(table(spark, sf, "documents").select("text"), "text", ",", "item")
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


@query("F9", """
    WITH m AS (SELECT o_custkey, last_day(o_orderdate) AS month_end, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice,
                 arg_max(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderstatus = 'F') AS filled_priority
               FROM orders GROUP BY 1, 2),
    s AS (SELECT o_custkey, unnest(generate_series(date_trunc('month', min(month_end))::TIMESTAMP, date_trunc('month', max(month_end))::TIMESTAMP, INTERVAL 1 MONTH)) AS d
          FROM m GROUP BY 1)
    SELECT s.o_custkey, last_day(s.d) AS month_end, m.o_totalprice, m.filled_priority
    FROM s LEFT JOIN m ON s.o_custkey = m.o_custkey AND last_day(s.d) = m.month_end""")
def resample_month_last(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "filled_priority", F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")))
    return reshape.resample_last(orders, ["o_custkey"], "o_orderdate", ["o_totalprice", "filled_priority"], tie=["o_orderkey"])


@query("F10", """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders FROM orders
    WHERE year(o_orderdate) < (SELECT max(year(o_orderdate)) - 1 FROM orders) GROUP BY 1""")
def drop_last_years(spark, sf):
    per_year = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("order_year")).agg(
        F.count(F.lit(1)).alias("orders"))
    return reshape.drop_last_groups(staged(per_year, "per_year"), "order_year", 2)


@query("F11", "SELECT o_custkey, o_orderstatus, count(*) AS orders FROM orders GROUP BY 1, 2")
def grouped_keys_as_columns(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


TRADE_SQL = """
    WITH pairs AS (SELECT DISTINCT c.c_nationkey AS x, s.s_nationkey AS y FROM lineitem l
      JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN supplier s ON l.l_suppkey = s.s_suppkey),
    edges AS (SELECT DISTINCT least(x, y) AS a, greatest(x, y) AS b FROM pairs)"""


def _trade_edges(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    pairs = (
        lines.join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
        .join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
        .join(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
        .select("c_nationkey", "s_nationkey").distinct()
    )
    # a nation's list of partners is bounded by the number of nations
    adjacency = pairs.groupBy("c_nationkey").agg(F.collect_set("s_nationkey").alias("partners"))
    return reshape.undirected_edges(adjacency, "c_nationkey", "partners")


@query("F12", TRADE_SQL + " SELECT a, b FROM edges")
def undirected_edges(spark, sf):
    return _trade_edges(spark, sf)


@query("F12", TRADE_SQL + """
    SELECT node, count(*) AS degree FROM (SELECT a AS node FROM edges UNION ALL SELECT b FROM edges WHERE a <> b) GROUP BY 1""")
def node_degrees(spark, sf):
    return reshape.degrees(_trade_edges(spark, sf))


@query("G1", "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def key_violations(spark, sf):
    return quality.key_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("G2", """
    SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def foreign_key_orphans(spark, sf):
    filled = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return quality.orphans(lines, filled, "l_orderkey", "o_orderkey")


@query("G2", """
    SELECT CASE WHEN o.o_orderkey IS NOT NULL THEN l.l_orderkey END AS l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber
    FROM lineitem l LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON l.l_orderkey = o.o_orderkey""")
def foreign_key_set_null(spark, sf):
    filled = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return quality.null_missing_parent(lines, filled, "l_orderkey", "o_orderkey")


@query("G3 G6", """
    SELECT count(*) AS rows, count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS text_present,
           count(*) FILTER (WHERE NOT coalesce(length(text) <= 1500, false)) AS text_length,
           count(*) FILTER (WHERE NOT coalesce(lang IN ('en', 'fr', 'de'), false)) AS known_lang FROM documents""")
def rule_counts(spark, sf):
    return quality.rule_counts(table(spark, sf, "documents"), {
        "text_present": F.trim("text") != "",
        "text_length": F.length("text") <= 1500,
        "known_lang": F.col("lang").isin("en", "fr", "de"),
    })


REJECT_RULES = "length(text) <= 4000"
REJECT_SQL = f"""
    WITH j AS (SELECT *, concat_ws(', ', CASE WHEN NOT {REJECT_RULES} THEN 'too long' END, CASE WHEN lang = 'es' THEN 'language' END) AS r FROM documents),
    f AS (SELECT text, min(doc_id) AS first_id FROM j WHERE r = '' GROUP BY 1),
    k AS (SELECT j.doc_id, j.lang, j.source, CASE WHEN j.r <> '' THEN j.r WHEN f.first_id <> j.doc_id THEN 'duplicate key' ELSE '' END AS reason
          FROM j LEFT JOIN f ON j.text = f.text)"""


def _judged(spark, sf):
    # the unique key is a text: its digest and length stand for it, so that no whole text is shuffled
    documents = table(spark, sf, "documents").select(
        "doc_id", "lang", "source", F.length("text").alias("chars"), F.sha2("text", 256).alias("digest"))
    rules = {"too long": F.col("chars") <= 4000, "language": F.col("lang") != "es"}
    return quality.load_with_rejects(documents, rules, unique=["digest", "chars"], order=["doc_id"])


@query("G4", REJECT_SQL + " SELECT doc_id, lang, source, reason FROM k WHERE reason <> ''")
def rejected_rows(spark, sf):
    return _judged(spark, sf)[1].drop("digest", "chars")


@query("G4", REJECT_SQL + " SELECT doc_id, lang, source FROM k WHERE reason = ''")
def loaded_rows(spark, sf):
    return _judged(spark, sf)[0].drop("digest", "chars")


@query("G5", "SELECT doc_id, lang, source FROM documents UNION ALL SELECT doc_id, 'unknown', 'labels' FROM labels")
def append_allowed_columns(spark, sf):
    stored = table(spark, sf, "documents").select("doc_id", "lang", "source")
    fresh = table(spark, sf, "labels").select("doc_id", F.lit("unknown").alias("lang"), F.lit("labels").alias("source"))
    return reshape.stack(stored, quality.require_columns(fresh, stored.columns, key="doc_id"))
