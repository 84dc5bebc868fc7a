"""Change capture and history (J), streaming (K), feature preparation and models (L)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F, types as T

from tablework.functions.dates import in_year, season
from tablework.operators import history, ml
from tablework.operators.reshape import stack
from tablework.plans.registry import query
from tablework.session import scratch_path, table
from tablework.sources.buckets import BucketTable
from tablework.sources.tables import staged
from tablework.streaming import ingest

# The newer state of customer: some segments change, some balances become null, some customers leave, some join.
NEW_SQL = """(SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 13 <> 0 THEN c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 7 = 0 THEN 'RETAIL' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 11 <> 0
     UNION ALL SELECT c_custkey + 1000000000, c_name || '*', c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 17 = 0)"""


def _new_customers(spark, sf):
    old = table(spark, sf, "customer")
    k = F.col("c_custkey")
    kept = old.where(k % 11 != 0).withColumns({
        "c_acctbal": F.when(k % 13 != 0, F.col("c_acctbal")),
        "c_mktsegment": F.when(k % 7 == 0, "RETAIL").otherwise(F.col("c_mktsegment")),
    })
    joined = old.where(k % 17 == 0).withColumns({"c_custkey": k + 1_000_000_000, "c_name": F.concat("c_name", F.lit("*"))})
    return old, kept.unionByName(joined)


@query("J1", f"""
    SELECT * FROM {NEW_SQL} UNION ALL SELECT * FROM customer WHERE c_custkey % 11 = 0""")
def upsert_rows(spark, sf):
    old, new = _new_customers(spark, sf)
    stored = BucketTable(spark, scratch_path(spark, "customers")).create(old, ["c_custkey"], buckets=8)
    history.upsert_table(stored, new, ["c_custkey"])
    return stored.read()


@query("J2", """
    WITH c AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, arg_max(o_orderpriority, o_orderkey) AS team FROM orders GROUP BY 1, 2)
    SELECT o_custkey, team, d AS valid_since, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) - 1 AS valid_till FROM c""")
def validity_versions(spark, sf):
    changes = table(spark, sf, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("since"), F.col("o_orderpriority").alias("team"), "o_orderkey")
    return history.versions(changes, ["o_custkey"], "team", "since", ["o_orderkey"])


@query("J3", f"""
    WITH n AS (SELECT c_custkey AS k, c_mktsegment AS s, c_nationkey AS a FROM {NEW_SQL}),
    d AS (SELECT o.c_custkey AS old_key, n.k AS new_key, n.s, n.a FROM customer o FULL JOIN n ON o.c_custkey = n.k
          WHERE o.c_mktsegment IS DISTINCT FROM n.s OR o.c_nationkey IS DISTINCT FROM n.a)
    SELECT c.c_custkey, c.c_mktsegment, c.c_nationkey, DATE '2023-01-01' AS valid_since,
           CASE WHEN d.old_key IS NOT NULL THEN DATE '2024-02-01' END AS valid_till
    FROM customer c LEFT JOIN d ON c.c_custkey = d.old_key
    UNION ALL SELECT c_custkey, 'NONE', c_nationkey, DATE '2022-01-01', DATE '2023-01-01' FROM customer
    UNION ALL SELECT new_key, s, a, DATE '2024-02-01', NULL FROM d WHERE new_key IS NOT NULL""")
def snapshot_comparison_history(spark, sf):
    old, new = _new_customers(spark, sf)
    day = lambda text: F.lit(text).cast("date")
    open_rows = old.select("c_custkey", "c_mktsegment", "c_nationkey", day("2023-01-01").alias("valid_since"),
                           F.lit(None).cast("date").alias("valid_till"))
    closed_rows = old.select("c_custkey", F.lit("NONE").alias("c_mktsegment"), "c_nationkey",
                             day("2022-01-01").alias("valid_since"), day("2023-01-01").alias("valid_till"))
    stored = BucketTable(spark, scratch_path(spark, "segments")).create(open_rows.unionByName(closed_rows), ["c_custkey"], buckets=8)
    history.scd2_apply_table(stored, old, new, "c_custkey", ["c_mktsegment", "c_nationkey"], day("2024-02-01"))
    return stored.read()


@query("J4", f"""
    SELECT '2024-01' AS snapshot, c_mktsegment, count(*) AS customers FROM customer GROUP BY 2
    UNION ALL SELECT '2024-02', c_mktsegment, count(*) FROM {NEW_SQL} GROUP BY 2""")
def snapshot_rotation(spark, sf):
    root = scratch_path(spark, "snapshots")
    old, new = _new_customers(spark, sf)
    history.snapshot(old, root, "customer", "2024-01-31")
    history.snapshot(new, root, "customer", "2024-02-29")
    kept = spark.read.schema(T.StructType([*old.schema.fields, T.StructField("snapshot", T.StringType())])).parquet(f"{root}/customer")
    return kept.groupBy("snapshot", "c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@query("J5", """
    SELECT s_name || '/' || n_name AS name, (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY s_name, n_name) AS s_suppkey
    FROM supplier JOIN nation ON s_nationkey <> n_nationkey AND n_regionkey = s_nationkey % 5""")
def surrogate_keys(spark, sf):
    """New branch suppliers numbered after the highest stored key."""
    stored, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    fresh = stored.join(nation, F.col("s_nationkey") % 5 == F.col("n_regionkey")).where(
        "s_nationkey <> n_nationkey").select(F.concat_ws("/", "s_name", "n_name").alias("name"))
    return history.assign_keys(stored, fresh, "s_suppkey", ["name"])


@query("J6", """
    SELECT s_suppkey, s_name, CASE WHEN s_suppkey = 5 THEN 0.0 ELSE s_acctbal END AS s_acctbal FROM supplier WHERE s_suppkey <> 9
    UNION ALL SELECT max(s_suppkey) + 1, 'Supplier new', 10.5 FROM supplier""")
def update_delete_insert(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    changed = history.update_column(suppliers, F.col("s_suppkey") == 5, "s_acctbal", F.lit(0.0))
    left = history.delete_rows(changed, F.col("s_suppkey") == 9)
    added = suppliers.agg((F.max("s_suppkey") + 1).alias("s_suppkey")).select(
        "s_suppkey", F.lit("Supplier new").alias("s_name"), F.lit(10.5).alias("s_acctbal"))
    return stack(left, added)


@query("J7", """
    WITH squads AS (SELECT o_custkey, o_orderpriority AS team, min(o_orderkey) AS first_order FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1, 2),
    n AS (SELECT o_custkey, count(*) AS n FROM squads GROUP BY 1),
    t AS (SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS latest FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT s.o_custkey, CASE WHEN n.n > 1 THEN coalesce(t.latest, s.team) ELSE s.team END AS team, min(s.first_order) AS first_order
    FROM squads s JOIN n ON s.o_custkey = n.o_custkey LEFT JOIN t ON s.o_custkey = t.o_custkey GROUP BY 1, 2""")
def latest_team_membership(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "team")
    squads = orders.where(in_year("o_orderdate", 1998)).groupBy("o_custkey", "team").agg(F.min("o_orderkey").alias("first_order"))
    transfers = orders.where("o_orderstatus = 'F'")
    return history.latest_membership(squads, transfers, "o_custkey", "team", "o_orderdate", "o_orderkey", ["first_order"])


SEASON_SQL = "CAST(CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER)"


@query("J8", f"""
    WITH m AS (SELECT DISTINCT o_custkey AS player, o_orderpriority AS team, {SEASON_SQL} AS season FROM orders),
    p AS (SELECT player, season, count(DISTINCT team) AS teams FROM m GROUP BY 1, 2),
    t AS (SELECT player, team, d, row_number() OVER (PARTITION BY player, team ORDER BY d) AS n FROM (
            SELECT DISTINCT o_custkey AS player, o_orderpriority AS team, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'F')),
    r AS (SELECT *, row_number() OVER (PARTITION BY player, team ORDER BY season) AS n FROM m)
    SELECT r.player, r.team, r.season, coalesce(t.d, CASE WHEN p.teams > 1 THEN make_date(r.season + 1, 1, CAST(10 + CAST(r.team[1] AS INTEGER) AS INTEGER))
           ELSE make_date(r.season, 7, CAST(r.team[1] AS INTEGER)) END) AS valid_since
    FROM r JOIN p ON r.player = p.player AND r.season = p.season LEFT JOIN t ON r.player = t.player AND r.team = t.team AND r.n = t.n""")
def membership_start_dates(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("player"), F.col("o_orderpriority").alias("team"), season("o_orderdate").alias("season"),
        F.to_date("o_orderdate").alias("date"), "o_orderstatus")
    number = F.substring("team", 1, 1).cast("int")
    windows = orders.select("team").distinct().select(
        "team", F.lit(1).alias("winter_month"), (number + 10).alias("winter_day"),
        F.lit(7).alias("summer_month"), number.alias("summer_day"))
    return history.membership_start(orders, orders.where("o_orderstatus = 'F'"), windows)


@query("J9", f"""
    WITH a AS (SELECT o_custkey, {SEASON_SQL} AS season, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS team,
                 arg_max(o_totalprice, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderstatus = 'F') AS price FROM orders GROUP BY 1, 2)
    SELECT c.c_custkey, CASE WHEN s.o_custkey IS NULL THEN p.team ELSE s.team END AS team, CASE WHEN s.o_custkey IS NULL THEN p.price ELSE s.price END AS price
    FROM customer c LEFT JOIN a s ON c.c_custkey = s.o_custkey AND s.season = 1999 LEFT JOIN a p ON c.c_custkey = p.o_custkey AND p.season = 1998""")
def fill_from_earlier_season(spark, sf):
    """Attributes of season 1999, or all of them from 1998 when the player has no row for 1999 (two tries)."""
    at = F.struct("o_orderdate", "o_orderkey")
    seasons = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), season("o_orderdate").alias("season")).agg(
        F.max_by("o_orderpriority", at).alias("team"),
        F.max(F.when(F.col("o_orderstatus") == "F", F.struct(at.alias("at"), "o_totalprice")))["o_totalprice"].alias("price"))
    candidates = seasons.where("season <= 1999").withColumn("rank", F.lit(2000) - F.col("season"))
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.lit(None).cast("string").alias("team"), F.lit(None).cast("double").alias("price"))
    return history.fill_from_candidates(customers, candidates, ["c_custkey"], ["team", "price"], "rank", tries=2)


def _landed_events(spark, sf):
    """Events landed as several files; events before noon are delivered twice."""
    path = scratch_path(spark, "event_landing")
    events = table(spark, sf, "events")
    again = events.where(F.hour("ts") < 12)
    events.unionByName(again).repartition("event_type", F.to_date("ts"), F.hour("ts")).write.parquet(path)
    return path, events.schema


@query("K1", """
    SELECT event_type AS topic, count(*) AS messages, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total
    FROM events GROUP BY 1""")
def stream_topics(spark, sf):
    source = table(spark, sf, "events")
    path, out = scratch_path(spark, "messages"), scratch_path(spark, "topics")
    source.select(F.col("event_type").alias("topic"), F.col("props").alias("value"), F.col("ts").alias("timestamp")).write.parquet(path)
    messages = ingest.read_files(spark, path, "topic string, value string, timestamp timestamp_ntz", files_per_batch=4)
    parsed = ingest.typed(messages, "value", "k bigint")
    ingest.route_topics(parsed, "topic", out, f"{out}-checkpoint").awaitTermination()
    routed = spark.read.schema("timestamp timestamp_ntz, k bigint, topic string").parquet(out)
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"), F.sum("k").alias("k_total"))


@query("K2", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_unseen_ids(spark, sf):
    path, schema = _landed_events(spark, sf)
    out = scratch_path(spark, "unseen")
    stream = ingest.read_files(spark, path, schema, files_per_batch=2)
    ingest.append_unseen(stream, ["event_id"], ["ts"], out, f"{out}-checkpoint").awaitTermination()
    return spark.read.schema(schema).parquet(out).select("event_id", "ts", "user_id", "event_type", "value")


@query("K2", "SELECT event_id, user_id, event_type, value FROM events")
def stream_unseen_within_horizon(spark, sf):
    """Bounded state: an id is remembered for ten years of event time, longer than the table reaches."""
    path, schema = _landed_events(spark, sf)
    out = scratch_path(spark, "unseen_within")
    stream = ingest.read_files(spark, path, schema).withColumn("at", F.col("ts").cast("timestamp"))
    kept = ingest.unseen_within(stream, ["event_id"], "at", "3650 days").select("event_id", "user_id", "event_type", "value")
    kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.schema(kept.schema).parquet(out)


@query("K3", "SELECT user_id, max(value) AS highest FROM events GROUP BY 1")
def stream_running_max(spark, sf):
    path, schema = _landed_events(spark, sf)
    out = scratch_path(spark, "highest")
    stream = ingest.read_files(spark, path, schema, files_per_batch=2)
    ingest.running_max(stream, ["user_id"], "value", out, f"{out}-checkpoint").awaitTermination()
    return ingest.current(spark, [f"{out}-checkpoint"], ["user_id"])


@query("L1", """
    WITH m AS (SELECT avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_tax) AS m3, avg(l_extendedprice) AS my,
        var_pop(l_quantity) AS a, covar_pop(l_quantity, l_discount) AS b, covar_pop(l_quantity, l_tax) AS c, var_pop(l_discount) AS d,
        covar_pop(l_discount, l_tax) AS e, var_pop(l_tax) AS f, covar_pop(l_quantity, l_extendedprice) AS g1,
        covar_pop(l_discount, l_extendedprice) AS g2, covar_pop(l_tax, l_extendedprice) AS g3 FROM lineitem),
    w AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM m),
    s AS (SELECT *, (g1 * (d * f - e * e) - b * (g2 * f - e * g3) + c * (g2 * e - d * g3)) / det AS w1,
        (a * (g2 * f - e * g3) - g1 * (b * f - c * e) + c * (b * g3 - g2 * c)) / det AS w2,
        (a * (d * g3 - g2 * e) - b * (b * g3 - g2 * c) + g1 * (b * e - c * d)) / det AS w3 FROM w),
    p AS (SELECT l_tax, l_extendedprice AS y, my + w1 * (l_quantity - m1) + w2 * (l_discount - m2) + w3 * (l_tax - m3) AS fit FROM lineitem, s)
    SELECT l_tax, round(avg(fit), 4) AS mean_prediction, round(avg(y), 4) AS mean_price, round(sqrt(avg((fit - y) * (fit - y))), 4) AS rmse,
           count(*) AS rows FROM p GROUP BY 1""")
def linear_regression(spark, sf):
    """Price from quantity, discount and tax: mean prediction and error per tax rate."""
    lines = table(spark, sf, "lineitem")
    features = ["l_quantity", "l_discount", "l_tax"]
    model, rows = ml.linear_model(lines, features, "l_extendedprice")
    scored = model.transform(rows)
    error = F.col("prediction") - F.col("l_extendedprice")
    return scored.groupBy("l_tax").agg(
        F.round(F.avg("prediction"), 4).alias("mean_prediction"), F.round(F.avg("l_extendedprice"), 4).alias("mean_price"),
        F.round(F.sqrt(F.avg(error * error)), 4).alias("rmse"), F.count(F.lit(1)).alias("rows"))


@query("L2", """
    SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
           round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem GROUP BY 1""")
def fit_line(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"),
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 3).alias("intercept"),
        F.round(F.regr_r2("l_extendedprice", "l_quantity"), 6).alias("r2"))


@query("L3", """
    WITH s AS (SELECT avg(p_size) AS ms, stddev_samp(p_size) AS ss, avg(p_retailprice) AS mp, stddev_samp(p_retailprice) AS sp FROM part)
    SELECT p_partkey, round((p_size - ms) / nullif(ss, 0), 6) AS p_size, round((p_retailprice - mp) / nullif(sp, 0), 6) AS p_retailprice FROM part, s""")
def standardise_columns(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    scaled = ml.standardise(part, ["p_size", "p_retailprice"])
    return scaled.select("p_partkey", F.round("p_size", 6).alias("p_size"), F.round("p_retailprice", 6).alias("p_retailprice"))


def _split_sql(rel, label, key, seed):
    return f"""SELECT *, CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}-' || {key}), {key}) <=
        floor(count(*) OVER (PARTITION BY {label}) * 0.7::DOUBLE + 0.5) THEN 'train' ELSE 'test' END AS part FROM {rel}"""


_QUALITY_SQL = "(SELECT doc_id, CASE WHEN doc_id % 11 > 0 THEN quality END AS quality FROM labels)"


@query("L4", f"SELECT doc_id, quality, part FROM ({_split_sql(_QUALITY_SQL, 'quality', 'doc_id', 101)})")
def stratified_split(spark, sf):
    """Rows without label are a stratum."""
    labels = table(spark, sf, "labels").select("doc_id", F.when(F.col("doc_id") % 11 > 0, F.col("quality")).alias("quality"))
    return ml.stratified_split(labels, "quality", "doc_id", 0.7, seed=101)


@query("L5", f"""
    WITH s AS ({_split_sql('embeddings', 'label', 'vec_id', 7)}),
    d AS (SELECT t.vec_id, t.label, r.vec_id AS n, r.label AS nl,
            round(list_sum(list_transform(list_zip(t.embedding, r.embedding), lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) * (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)))), 9) AS dist
          FROM s t, (SELECT * FROM s WHERE part = 'train') r WHERE t.part = 'test'),
    k AS (SELECT vec_id, label, nl, row_number() OVER (PARTITION BY vec_id ORDER BY dist, n) AS rank FROM d),
    v AS (SELECT vec_id, label, ks.k, nl, count(*) AS c, min(rank) AS f FROM k JOIN (SELECT unnest(range(1, 11)) AS k) ks ON rank <= ks.k GROUP BY ALL),
    p AS (SELECT vec_id, label, k, arg_max(nl, (c, -f)) AS predicted FROM v GROUP BY ALL)
    SELECT CAST(k AS INTEGER) AS k, round(avg(CASE WHEN predicted <> label THEN 1.0 ELSE 0.0 END), 6) AS error, count(*) AS rows FROM p GROUP BY 1""")
def knn_error_rates(spark, sf):
    # both parts are read several times
    split = staged(ml.stratified_split(table(spark, sf, "embeddings"), "label", "vec_id", 0.7, seed=7), "vector_split")
    predictions = ml.knn_classify(split.where("part = 'train'"), split.where("part = 'test'"), "vec_id", "embedding",
                                  "label", list(range(1, 11)))
    return ml.error_rates(predictions).withColumn("error", F.round("error", 6))


@query("L6", """
    WITH i AS (SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS i FROM customer GROUP BY 1)
    SELECT c_custkey, CAST(i.i AS DOUBLE) AS segment_index, CAST(i.i + 1 AS INTEGER) AS hot_position FROM customer JOIN i USING (c_mktsegment)""")
def encode_categories(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    encoded = ml.encode_categories(customers, ["c_mktsegment"])
    hot = F.array_position(vector_to_array("c_mktsegment_hot"), 1.0)
    return encoded.select("c_custkey", F.col("c_mktsegment_index").alias("segment_index"), hot.cast("int").alias("hot_position"))


@query("L7", """
    SELECT p_brand, round(avg(p_retailprice), 4) AS mean_price FROM part WHERE p_size > 10 AND p_type <> 'SMALL' GROUP BY 1""")
def mean_after_filter(spark, sf):
    return table(spark, sf, "part").where("p_size > 10 AND p_type <> 'SMALL'").groupBy("p_brand").agg(
        F.round(F.avg("p_retailprice"), 4).alias("mean_price"))
