"""Sources and sinks (A): tables are written in a format to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.dates import in_year
from tablework.plans.registry import query
from tablework.session import scratch_path, table
from tablework.sources import delimited, html, landed, tables

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@query("A1 A13", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_with_header(spark, sf):
    path = scratch_path(spark, "customer_csv")
    delimited.write_delimited(table(spark, sf, "customer"), path, header=True)
    return delimited.read_delimited(spark, path, CUSTOMER, header=True)


TEXTS = "doc_id bigint, text string, lang string, note string"
TEXTS_SQL = """SELECT doc_id, text, lang, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  "' || lang || '", ;  '
    WHEN 3 THEN chr(10) || text || chr(13) || chr(10) ELSE '\\N' END AS note FROM documents"""


def _texts(spark, sf):
    """Whole texts with line breaks, and notes that are null, empty, blank at the ends, quoted or broken over lines."""
    n = F.col("doc_id") % 5
    note = F.when(n == 0, None).when(n == 1, "").when(n == 2, F.concat(F.lit('  "'), "lang", F.lit('", ;  '))).when(
        n == 3, F.concat(F.lit("\n"), "text", F.lit("\r\n"))).otherwise("\\N")
    return table(spark, sf, "documents").select("doc_id", "text", "lang", note.alias("note"))


@query("A1 A13", TEXTS_SQL)
def csv_whole_texts(spark, sf):
    path = scratch_path(spark, "texts_csv")
    delimited.write_delimited(_texts(spark, sf), path, header=True, maxRecordsPerFile=20_000)
    return delimited.read_delimited(spark, path, TEXTS, header=True, multi_line=True)


@query("A2 A14", TEXTS_SQL)
def csv_semicolon_texts(spark, sf):
    path = scratch_path(spark, "texts_semicolon")
    delimited.write_delimited(_texts(spark, sf), path, sep=";", maxRecordsPerFile=20_000)
    return delimited.read_delimited(spark, path, TEXTS, sep=";", multi_line=True)


@query("A2 A14", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_semicolon(spark, sf):
    path = scratch_path(spark, "supplier_semicolon")
    delimited.write_delimited(table(spark, sf, "supplier"), path, sep=";")
    return delimited.read_delimited(spark, path, SUPPLIER, sep=";")


@query("A3", "SELECT p_partkey AS id, p_name AS label, p_brand AS maker, p_type AS kind, p_size AS size, "
             "p_retailprice AS price FROM part")
def csv_supplied_names(spark, sf):
    path = scratch_path(spark, "part_headerless")
    delimited.write_delimited(table(spark, sf, "part"), path)
    names = "id bigint, label string, maker string, kind string, size int, price double"
    return delimited.read_delimited(spark, path, names)


@query("A4", "SELECT p_size, p_retailprice, p_brand || '!' AS tail FROM part")
def tsv_fields(spark, sf):
    path = scratch_path(spark, "part_tsv")
    part = table(spark, sf, "part")
    # seven fields, and a stray carriage return at the end of each line
    seven = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", F.concat("p_brand", F.lit("!")).alias("tail"))
    delimited.write_lines(seven, path, end="\r")
    return delimited.read_tab_fields(spark, path, f"{PART}, tail string", ["p_size", "p_retailprice", "tail"])


@query("A5", "SELECT lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') AS plate_code, "
             "trim(substr(p_name, 1, 6)) AS vehicle_code FROM part")
def fixed_width_fields(spark, sf):
    path = scratch_path(spark, "part_fixed")
    line = F.concat(
        F.rpad(F.concat_ws(" ", "p_brand", "p_type"), 58, " "),
        F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"),
        F.rpad("p_name", 6, " "),
    )
    table(spark, sf, "part").select(line.alias("value")).write.text(path)
    return delimited.read_fixed_width(spark, path, {"plate_code": (59, 4), "vehicle_code": (63, 6)})


@query("A6", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def csv_column_slice(spark, sf):
    path = scratch_path(spark, "customer_slice")
    delimited.write_delimited(table(spark, sf, "customer"), path)
    return delimited.read_delimited(spark, path, CUSTOMER, columns=["c_custkey", "c_name", "c_nationkey", "c_acctbal"])


@query("A7", """
    SELECT CAST(event_id // 100 + 1 AS INTEGER) AS page, event_id AS id, event_type AS kind, value
    FROM events WHERE (event_id // 100) % 10 <> 3""")
def json_page_envelope(spark, sf):
    """Pages of 100 events; every tenth page reports an error and is skipped as a whole."""
    path = scratch_path(spark, "event_pages")
    events = table(spark, sf, "events").withColumn("n", F.floor(F.col("event_id") / 100))
    last = events.select(F.max("n") + 1).scalar()
    row = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), "value")
    pages = events.groupBy("n").agg(F.collect_list(row).alias("response")).select(
        F.when(F.col("n") % 10 == 3, F.lit('{"requests":"limit reached"}')).otherwise("[]").alias("errors"),
        F.struct((F.col("n") + 1).alias("current"), last.alias("total")).alias("paging"),
        "response",
    )
    # errors is an empty array or an object, so it is spliced in as raw JSON
    body = F.to_json(F.struct("paging", "response"))
    text = F.concat(F.lit('{"errors":'), F.col("errors"), F.lit(","), F.substring(body, 2, 2_147_483_647))
    pages.select(text.alias("value")).write.text(path)
    return landed.read_pages(spark, path, "struct<id bigint, kind string, value double>")


@query("A8", """
    SELECT r.r_name AS region, 'item' AS kind, CAST(c.c_custkey AS VARCHAR) AS id, c.c_mktsegment AS title,
           c.c_acctbal > 0 AS assignable
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")
def nested_json_items(spark, sf):
    """Documents of up to 500 items, in one folder per region; the region is read from the path."""
    path = scratch_path(spark, "categories")
    customers = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    snippet = F.struct(F.col("c_mktsegment").alias("title"), (F.col("c_acctbal") > 0).alias("assignable"))
    item = F.struct(F.lit("item").alias("kind"), F.col("c_custkey").cast("string").alias("id"), snippet.alias("snippet"))
    docs = customers.groupBy(F.col("r_name").alias("region"), F.floor(F.col("c_custkey") / 500).alias("doc")).agg(
        F.collect_list(item).alias("items")
    )
    text = F.to_json(F.struct(F.lit("list").alias("kind"), "items"))
    docs.select("region", text.alias("value")).write.partitionBy("region").text(path)
    schema = ("kind string, items array<struct<kind string, id string, "
              "snippet struct<title string, assignable boolean>>>")
    items = landed.read_items(spark, f"{path}/*", schema, "items", "region=([^/]+)/", "region")
    return items.select("region", "kind", "id", "snippet.title", "snippet.assignable")


MIXED_SQL = """(SELECT event_id, event_type, CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN '{"k": "' || k || '"}' WHEN 2 THEN '{"k": {"n": ' || k || '}}'
    WHEN 3 THEN '{"x": [1, 2], "k": null}' WHEN 4 THEN '{"k": ' || k || '.0, "x": {"y": [{"z": ' || k || '}, 5]}}' ELSE '{"k": ' || k END AS props
    FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events))"""


def _mixed_props(spark, sf):
    """JSON of several shapes: the number as such, as text, in an object, null, with a fraction, and JSON cut off."""
    k, n = F.get_json_object("props", "$.k"), F.col("event_id") % 6
    text = F.when(n == 0, F.col("props")).when(n == 1, F.concat(F.lit('{"k": "'), k, F.lit('"}'))).when(
        n == 2, F.concat(F.lit('{"k": {"n": '), k, F.lit("}}"))).when(n == 3, '{"x": [1, 2], "k": null}').when(
        n == 4, F.concat(F.lit('{"k": '), k, F.lit('.0, "x": {"y": [{"z": '), k, F.lit("}, 5]}}"))).otherwise(F.concat(F.lit('{"k": '), k))
    return table(spark, sf, "events").select("event_id", "event_type", text.alias("props"))


@query("A8 H27", f"""
    SELECT event_id, CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS BIGINT) AS k, CAST(json_extract_string(props, '$.x.y[0].z') AS BIGINT) AS z
    FROM {MIXED_SQL} WHERE event_id % 6 NOT IN (2, 5)""")
def variant_fields(spark, sf):
    good, _ = landed.variant_fields(_mixed_props(spark, sf), "props", {"k": ("$.k", "bigint"), "z": ("$.x.y[0].z", "bigint")})
    return good.select("event_id", "k", "z")


@query("A8 H27", f"""
    SELECT event_id, props, CASE WHEN json_valid(props) THEN 'k' ELSE 'no JSON' END AS reason FROM {MIXED_SQL} WHERE event_id % 6 IN (2, 5)""")
def variant_misfits(spark, sf):
    _, bad = landed.variant_fields(_mixed_props(spark, sf), "props", {"k": ("$.k", "bigint"), "z": ("$.x.y[0].z", "bigint")})
    return bad.select("event_id", "props", "reason")


@query("A9 A17", """
    SELECT event_type AS endpoint, event_id AS request, CAST(max_value AS VARCHAR) AS finished FROM (
      SELECT event_type, event_id, CASE WHEN value > 50 THEN 'True' ELSE 'False' END AS max_value,
             row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def log_latest_run(spark, sf):
    """Events appended as run-log lines, read back by key; the latest line of each endpoint."""
    path = scratch_path(spark, "run_log")
    runs = table(spark, sf, "events").select(
        F.date_format("ts", "HH:mm:ss").alias("time"),
        F.col("event_type").alias("endpoint"),
        F.col("props").alias("parameters"),
        F.when(F.col("value") > 50, "True").otherwise("False").alias("finished"),
        F.col("event_id").alias("current_requests"),
        F.to_date("ts").alias("day"),
    )
    landed.append_log(runs, path, ["time", "endpoint", "parameters", "finished", "current_requests"], "day")
    log = landed.read_kv_log(spark, f"{path}/*", ["endpoint", "finished", "current_requests"])
    log = log.select("endpoint", "finished", F.col("current_requests").cast("bigint").alias("request"))
    return landed.latest_per(log, ["endpoint"], ["request"])


@query("A10", """
    WITH links AS (
      SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) AS href,
             unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)) AS label,
             unnest(range(1, len(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) + 1)) AS rank
      FROM pages)
    SELECT page_id, CAST(rank AS INTEGER) AS rank, href, label FROM links""")
def html_ranked_links(spark, sf):
    return html.nav_links(table(spark, sf, "pages"), "page_id", "html")


@query("A10", """
    SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
           regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS heading,
           regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang FROM pages""")
def html_page_fields(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        html.first_text("html", "title").alias("title"),
        html.first_text("html", "h1").alias("heading"),
        F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"),
    )


@query("A12", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def select_all_ordered(spark, sf):
    return table(spark, sf, "supplier").orderBy("s_name")


@query("A15", "SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance "
              "FROM customer GROUP BY c_mktsegment")
def one_folder_per_key(spark, sf):
    path = scratch_path(spark, "customer_by_segment")
    delimited.write_partitioned(table(spark, sf, "customer"), path, ["c_mktsegment"])
    back = spark.read.schema(CUSTOMER).csv(path)
    return back.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("A16", """
    SELECT 'INSERT INTO customers(id, name, segment) VALUES(' || c_custkey || ', ''' || c_name || ''', ' ||
           CASE WHEN c_custkey % 5 = 0 THEN 'null' ELSE '''' || c_mktsegment || '''' END || ')' AS statement
    FROM customer""")
def rows_as_inserts(spark, sf):
    path = scratch_path(spark, "inserts")
    rows = table(spark, sf, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")))
    names = {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"}
    tables.render_inserts(rows, "customers", names).write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "statement")


@query("A18 A20", """
    SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total
    FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1""")
def reuse_staged_season(spark, sf):
    """The second request finds the stage of the first and does not build again."""
    root = scratch_path(spark, "stages")
    orders = table(spark, sf, "orders")

    def build():
        return orders.where(in_year("o_orderdate", 1997))

    def refuse():
        raise AssertionError("stage was not reused")

    tables.reuse_or_build(spark, root, "orders", build, season=1997)
    again = tables.reuse_or_build(spark, root, "orders", refuse, season=1997)
    return again.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("A19", """
    SELECT o_orderstatus, count(*) AS orders, round(avg(total), 4) AS mean_total FROM (
      SELECT o_custkey, o_orderstatus, sum(o_totalprice) AS total FROM orders GROUP BY 1, 2) GROUP BY 1""")
def staged_result(spark, sf):
    totals = table(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.sum("o_totalprice").alias("total"))
    kept = tables.staged(totals, "customer_totals")
    return kept.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.avg("total"), 4).alias("mean_total"))


@query("A21", """
    SELECT c.c_custkey, w.team, w.bonus FROM customer c JOIN (
      VALUES ('BUILDING', 'north', 10), ('MACHINERY', 'south', 20), ('HOUSEHOLD', 'west', 30)) AS w(segment, team, bonus)
    ON c.c_mktsegment = w.segment""")
def literal_rows(spark, sf):
    literal = spark.sql(
        "VALUES ('BUILDING', 'north', 10), ('MACHINERY', 'south', 20), ('HOUSEHOLD', 'west', 30) AS w(segment, team, bonus)")
    customers = table(spark, sf, "customer")
    return customers.join(literal, F.col("c_mktsegment") == F.col("segment")).select("c_custkey", "team", "bonus")


@query("A22", """
    SELECT p_partkey, CAST(('0x' || md5('7-' || p_partkey)[1:12])::BIGINT % 6 + 1 AS INTEGER) AS die,
           CAST(('0x' || md5('8-' || p_partkey)[1:12])::BIGINT % 10 AS INTEGER) AS digit FROM part""")
def random_numbers(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey")
    return tables.random_integers(
        tables.random_integers(parts, "die", 1, 6, seed=7, key="p_partkey"), "digit", 0, 9, seed=8, key="p_partkey")


@query("A23", """
    WITH n AS (SELECT o_custkey, count(DISTINCT date_trunc('month', o_orderdate)) AS n FROM orders GROUP BY 1)
    SELECT 'M' || lpad(CAST(i AS VARCHAR), CAST(length(CAST(n AS VARCHAR)) AS INTEGER), '0') AS billingperiod, o_custkey AS client_id
    FROM (SELECT o_custkey, n, unnest(range(1, n + 1)) AS i FROM n)""")
def billing_period_names(spark, sf):
    """One period per month in which the customer ordered (bounded by the calendar)."""
    months = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.countDistinct(F.trunc("o_orderdate", "month")).alias("periods"))
    return tables.billing_periods(months, "o_custkey", "periods")
