"""Data quality, history, sources and streaming on small invented rows."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from tablework.operators import history, joins, quality, reshape
from tablework.plans import reports
from tablework.session import owned_scratch, scratch_path
from tablework.sources import delimited, html, landed, tables
from tablework.sources.buckets import BucketTable, ChangedMeanwhile
from tablework.streaming import ingest

DAY = datetime.date


def test_duplicate_names_are_rejected(spark, rows):
    accounts = spark.createDataFrame([(i, "user", f"name {i}") for i in range(4)], "id int, username string, given string")
    good, bad = quality.load_with_rejects(accounts, {}, unique=["username"], order=["id"])
    assert rows(good) == [(0, "user", "name 0")]
    assert {r["reason"] for r in bad.collect()} == {"duplicate key"} and bad.count() == 3


def test_row_rejected_by_a_rule_does_not_take_the_key(spark, rows):
    df = spark.createDataFrame([(0, "u", None), (1, "u", "b"), (2, None, "c"), (3, None, "d")], "id int, u string, g string")
    good, bad = quality.load_with_rejects(df, {"given": F.col("g").isNotNull()}, unique=["u"], order=["id"])
    assert [r["id"] for r in good.orderBy("id").collect()] == [1, 2, 3]
    assert rows(bad) == [(0, "u", None, "given")]


def test_required_columns(spark):
    df = spark.range(1).withColumn("x", F.lit(1))
    with pytest.raises(ValueError, match="not allowed: x"):
        quality.require_columns(df, ["id"])
    with pytest.raises(ValueError, match="key column k"):
        quality.require_columns(df, ["id", "x"], key="k")
    assert reshape.missing_columns(df, ["id"]) == ["x"]


def test_upsert_overwrites_with_null(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert rows(history.upsert(old, new, ["k"])) == [(1, "a"), (2, None), (3, "c")]


def test_versions(spark, rows):
    """Same start keeps the last write; a start before all others is closed as well."""
    writes = [(1, 10, DAY(2024, 3, 1), 1), (1, 20, DAY(2024, 5, 1), 2), (1, 30, DAY(2024, 3, 1), 3), (1, 40, DAY(2024, 1, 1), 4)]
    df = spark.createDataFrame(writes, "k int, team int, since date, n int")
    assert rows(history.versions(df, ["k"], "team", "since", ["n"])) == sorted([
        (1, 40, DAY(2024, 1, 1), DAY(2024, 2, 29)), (1, 30, DAY(2024, 3, 1), DAY(2024, 4, 30)), (1, 20, DAY(2024, 5, 1), None)], key=str)


def test_snapshot_history(spark, rows):
    old = spark.createDataFrame([("A", "r1"), ("B", "r1"), ("C", None)], "k string, r string")
    new = spark.createDataFrame([("A", "r2"), ("C", None), ("D", "r4")], "k string, r string")
    past = spark.sql("""VALUES ('A', 'r0', DATE '2020-01-01', DATE '2021-01-01'), ('A', 'r1', DATE '2021-01-01', NULL),
        ('B', 'r1', DATE '2020-01-01', NULL), ('C', NULL, DATE '2020-01-01', NULL) AS t(k, r, valid_since, valid_till)""")
    now = DAY(2024, 2, 1)
    assert rows(history.scd2_apply(past, old, new, "k", ["r"], F.lit(now))) == sorted([
        ("A", "r0", DAY(2020, 1, 1), DAY(2021, 1, 1)), ("A", "r1", DAY(2021, 1, 1), now), ("A", "r2", now, None),
        ("B", "r1", DAY(2020, 1, 1), now), ("C", None, DAY(2020, 1, 1), None), ("D", "r4", now, None)], key=str)


def test_surrogate_keys_on_an_empty_table(spark):
    fresh = spark.createDataFrame([("x",), ("y",)], "name string")
    stored = spark.createDataFrame([], "id bigint, name string")
    keyed = history.assign_keys(stored, fresh, "id", ["name"])
    assert {(r["name"], r["id"]) for r in keyed.collect()} == {("x", 1), ("y", 2)}


def test_year_over_year_at_leap_month_end(spark):
    df = spark.createDataFrame([(1, DAY(2023, 2, 28), 5.0), (1, DAY(2024, 2, 29), 8.0), (1, DAY(2024, 5, 31), 1.0),
                                (2, DAY(2024, 2, 29), 3.0)], "k int, d date, v double")
    out = joins.year_over_year(df, ["k"], "d", ["v"])
    assert {(r["k"], r["d"], r["last_d"], r["last_v"]) for r in out.collect()} == {
        (1, DAY(2023, 2, 28), None, None), (1, DAY(2024, 2, 29), DAY(2023, 2, 28), 5.0),
        (1, DAY(2024, 5, 31), None, None), (2, DAY(2024, 2, 29), None, None)}


def test_statement_on_the_report_date_counts(spark):
    left = spark.createDataFrame([(1, DAY(2024, 3, 31)), (1, DAY(2024, 3, 30)), (2, DAY(2024, 3, 31))], "k int, r date")
    right = spark.createDataFrame([(1, DAY(2024, 3, 31), 7)], "k int, d date, v int")
    out = joins.asof_join(left, right, ["k"], "r", "d")
    assert {(r["k"], r["r"], r["v"]) for r in out.collect()} == {
        (1, DAY(2024, 3, 31), 7), (1, DAY(2024, 3, 30), None), (2, DAY(2024, 3, 31), None)}


def test_first_appearances_chain(spark, rows):
    df = spark.createDataFrame([("p", 2021), ("p", 2022), ("p", 2022), ("p", 2024), ("q", 2022)], "k string, s int")
    assert rows(joins.first_appearances(df, ["k"], "s")) == [("p", 2021), ("p", 2024), ("q", 2022)]


def test_resample_keeps_empty_months(spark):
    df = spark.createDataFrame([("a", DAY(2024, 1, 3), 1, None), ("a", DAY(2024, 1, 9), None, 5), ("a", DAY(2024, 4, 1), 2, None)],
                               "k string, d date, x int, y int")
    out = reshape.resample_last(df, ["k"], "d", ["x", "y"]).orderBy("month_end")
    assert [tuple(r)[1:] for r in out.collect()] == [
        (DAY(2024, 1, 31), 1, 5), (DAY(2024, 2, 29), None, None), (DAY(2024, 3, 31), None, None), (DAY(2024, 4, 30), 2, None)]


def test_pair_sums_counts_without_listing(spark, rows):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([4, 6, 5, 5, 5, 6, 9])], "id bigint, v int")
    assert rows(joins.pair_sums(df, "id", "v", 10)) == [(4, 6, 2, 0, 1), (5, 5, 3, 2, 3)]


def test_graph_degrees(spark, rows):
    lists = spark.createDataFrame([("a", ["b", "c"]), ("b", ["a"]), ("c", ["c"])], "n string, near array<string>")
    edges = reshape.undirected_edges(lists, "n", "near")
    assert rows(edges) == [("a", "b"), ("a", "c"), ("c", "c")]
    assert rows(reshape.degrees(edges)) == [("a", 2), ("b", 1), ("c", 2)]


def test_zip_join_of_unequal_files(spark, rows):
    a, b = scratch_path(spark, "zip"), scratch_path(spark, "zip")
    spark.range(50).select(F.format_string("l%02d", "id")).repartitionByRange(4, F.col("format_string(l%02d, id)")).write.text(a)
    spark.range(48).select(F.format_string("r%02d", "id")).coalesce(1).write.text(b)
    joined = delimited.zip_join(spark.read.text(a).withColumnRenamed("value", "x"), spark.read.text(b).withColumnRenamed("value", "y"))
    assert rows(joined) == sorted([(i, f"l{i:02d}", f"r{i:02d}" if i < 48 else None) for i in range(50)], key=str)


def test_log_values_may_hold_question_marks(spark, rows):
    path = scratch_path(spark, "log")
    lines = [("time ? 18:17:13|endpoint ? players|finished ? True|errors_info ? {}|current_requests ? 0",),
             ("time ? 18:30:56|endpoint ? teams?x=1|finished ? False",)]
    spark.createDataFrame(lines, "value string").write.text(path)
    log = landed.read_kv_log(spark, path, ["endpoint", "finished", "current_requests"])
    assert rows(log) == [("players", "True", "0"), ("teams?x=1", "False", None)]


def test_pages_with_errors_are_skipped(spark, rows):
    path = scratch_path(spark, "pages")
    lines = [('{"errors":[],"paging":{"current":1,"total":2},"response":[{"id":1},{"id":2}]}',),
             ('{"errors":{"requests":"limit"},"paging":{"current":2,"total":2},"response":[{"id":3}]}',)]
    spark.createDataFrame(lines, "value string").write.text(path)
    assert rows(landed.read_pages(spark, path, "struct<id bigint>")) == [(1, 1), (1, 2)]


def test_one_document_per_file(spark, rows, tmp_path):
    for code, titles in (("US", ["Film", "Music"]), ("PL", ["News"])):
        items = ",\n".join(f'{{"id": "{i}", "snippet": {{"title": "{t}"}}}}' for i, t in enumerate(titles))
        (tmp_path / f"{code}_category_id.json").write_text(f'{{"kind": "list",\n "items": [{items}]}}')
    schema = "kind string, items array<struct<id string, snippet struct<title string>>>"
    found = landed.read_items(spark, str(tmp_path), schema, "items", "/([A-Z]+)_category", "region", whole_file=True)
    assert rows(found.select("region", "id", "snippet.title")) == [("PL", "0", "News"), ("US", "0", "Film"), ("US", "1", "Music")]


def test_inserts(spark, rows):
    df = spark.sql("VALUES (1, 'O''Hara', 2.5), (2, NULL, NULL) AS t(id, name, x)")
    assert rows(tables.render_inserts(df, "people", {"id": "pid", "name": "pname"})) == [
        ("INSERT INTO people(pid, pname) VALUES(1, 'O''Hara')",), ("INSERT INTO people(pid, pname) VALUES(2, null)",)]


def test_database_options():
    options = tables.jdbc_options("jdbc:x", "t", "d", partition_column="id", lower=0, upper=9, parts=3)
    assert options["numPartitions"] == "3" and options["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", "d", partition_column="id")


def test_stage_path_is_shared_by_reader_and_writer(spark):
    root = scratch_path(spark, "stage")
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    for _ in range(2):
        assert tables.reuse_or_build(spark, root, "teams", build, season=2023).count() == 3
    assert built == [1]
    assert tables.stage_path("/r", "teams", season=2023) == "/r/teams/season=2023"


def test_listing_card(spark):
    card = ('<div><article data-id="77"><a href="https://x/1" target="_self"> Family car </a><p class="line">1 234 cm3 • 99 KM • '
            'Roomy estate</p><h3>45 600</h3><dd data-parameter="mileage">12 345 km</dd><dd data-parameter="fuel_type">petrol</dd>'
            '<dd data-parameter="gearbox">manual</dd><dd data-parameter="year">2021</dd><dd>Town</dd><dd><p>9 minut temu</p></dd></article></div>')
    page = spark.createDataFrame([(card,)], "html string")
    row = html.parse_listings(page, "html", F.lit("2025-01-10 12:00:00").cast("timestamp_ntz")).first()
    assert tuple(row) == (77, "Family car", "https://x/1", "1 234 cm3", "99 KM", "Roomy estate", 45600, 12345, "petrol",
                          "manual", 2021, datetime.datetime(2025, 1, 10, 11, 51))


def test_listing_cards_with_inner_markup_and_missing_parts(spark):
    value = lambda name, text: f"<dt>\n {name}</dt>\n<dd class='v' data-parameter='{name}'>\n<svg><path d='m1 2'></path></svg>\n {text}\n</dd>"
    full = (
        '<article class="a b" data-id="5" data-media="s">\n<section><div><img src="a.jpg"/></div><div>\n<h2 class="t">\n<a href="https://x/5" '
        'target="_self">\n Small  car\n</a>\n</h2>\n<p class="d">\n 998 cm3 • 70 KM • City\n</p></div><dl>' + value("mileage", "7 km")
        + value("fuel_type", "petrol") + value("gearbox", "manual") + value("year", "2024") + "</dl><dl><dd class='w'>\n<p>Town (Land)</p>\n</dd>\n"
        "<dd class='w'>\n<p>\n Opublikowano 2 godziny temu\n</p></dd></dl><article class='inner'><a href='/other'>x</a></article>"
        "<h3 class='p'>\n 12\xa0300\n</h3></section></article>")
    bare = "<article data-id='6'><h2><a target='_self' class='l'>Only a title</a></h2></article>"
    page = spark.createDataFrame([(f"<html>{full}{bare}</html>",), (None,), ("",)], "html string")
    rows = html.parse_listings(page, "html", F.lit("2025-01-10 12:00:00").cast("timestamp_ntz")).orderBy("listing_id").collect()
    assert [tuple(r) for r in rows] == [
        (5, "Small car", "https://x/5", "998 cm3", "70 KM", "City", 12300, 7, "petrol", "manual", 2024, datetime.datetime(2025, 1, 10, 10, 0)),
        (6, "Only a title", None, "NOT SPECIFIED", "NOT SPECIFIED", "NOT DEFINED", None, None, None, None, None, None)]


def test_membership_start(spark):
    members = spark.createDataFrame([(1, "A", 2021), (1, "A", 2022), (1, "B", 2022), (2, "B", 2022)], "player int, team string, season int")
    moves = spark.createDataFrame([(1, "A", DAY(2021, 8, 5))], "player int, team string, date date")
    windows = spark.createDataFrame([("A", 1, 10, 7, 1), ("B", 1, 20, 7, 2)],
                                    "team string, winter_month int, winter_day int, summer_month int, summer_day int")
    out = history.membership_start(members, moves, windows)
    assert {tuple(r) for r in out.collect()} == {
        (1, "A", 2021, DAY(2021, 8, 5)), (1, "A", 2022, DAY(2023, 1, 10)), (1, "B", 2022, DAY(2023, 1, 20)), (2, "B", 2022, DAY(2022, 7, 2))}


def test_early_warning_by_hand(spark):
    quarter_ends = [DAY(2022, 3, 31), DAY(2022, 6, 30), DAY(2022, 9, 30), DAY(2022, 12, 31), DAY(2023, 3, 31)]
    statement = lambda firm, d, cr, income, woz=None: (firm, d, 20.0, cr, 0.9, 0.5, woz, 5.0, income, 10.0, 100.0)
    rows = [statement("weak", d, 0.3, 100.0) for d in quarter_ends] + [statement("fine", d, 0.9, 100.0) for d in quarter_ends]
    rows += [statement("town", d, 0.3, 100.0, 150.0) for d in quarter_ends]
    statements = spark.createDataFrame(
        rows, "firm string, date date, k1 double, cr double, qr double, wod double, woz double, ros double, income double, profit double, equity double")
    months = [DAY(2022, m, 28) for m in range(4, 13)] + [DAY(2023, m, 28) for m in range(1, 5)]
    exposures = spark.createDataFrame(
        [(f, d, 2e6, 1) for f in ("weak", "fine", "town") for d in months], "firm string, report_date date, exposure double, bucket int")
    matched = reports.monitored(statements, exposures)
    options = {"report_date": DAY(2023, 4, 28), "min_year": 2022, "min_exposure": 1e6, "bucket": 1}
    found = reports.early_warning(matched, **options).collect()
    assert [(r["firm"], r["date"], r["low_cr"], r["lasting_cr"], r["low_qr"], r["last_date"]) for r in found] == [
        ("weak", DAY(2023, 3, 31), 1, 1, 0, DAY(2022, 3, 31))]
    shared = reports.early_warning_shared(matched, **options).collect()
    assert [(r["firm"], r["hits"]) for r in shared] == [("town", 7)]


def test_unseen_ids_across_restarts(spark, rows):
    """A second run reads only new files and accepts only ids it has not stored."""
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    first = spark.range(10).select("id", F.col("id").alias("at"))
    first.union(first.limit(4)).coalesce(1).write.parquet(path)
    schema = "id bigint, at bigint"

    def run():
        stream = ingest.read_files(spark, path, schema, files_per_batch=1)
        ingest.append_unseen(stream, ["id"], ["at"], out, f"{out}-checkpoint").awaitTermination()
        return rows(spark.read.schema(schema).parquet(out).select("id"))

    assert run() == sorted([(i,) for i in range(10)], key=str)
    spark.range(5, 15).select("id", F.col("id").alias("at")).coalesce(1).write.mode("append").parquet(path)
    assert run() == sorted([(i,) for i in range(15)], key=str)


def test_a_new_checkpoint_keeps_what_is_stored(spark, rows):
    """A stream that starts anew on a filled store, with batch 0, loses neither stored nor new rows."""
    path, out, top = (scratch_path(spark, n) for n in ("in", "out", "top"))
    schema = "id bigint, at bigint"

    def run(values, name):
        folder = f"{path}/{name}"
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(folder)
        stream = ingest.read_files(spark, folder, schema)
        ingest.append_unseen(stream, ["id"], ["at"], out, f"{out}-{name}").awaitTermination()
        stream = ingest.read_files(spark, folder, schema)
        ingest.running_max(stream, ["id"], "at", top, f"{top}-{name}").awaitTermination()

    run([(i, i) for i in range(10)] + [(None, 1)], "first")
    run([(3, 1), (11, 5), (12, 6), (None, 2)], "second")
    assert rows(spark.read.schema(schema).parquet(out).select("id")) == sorted([(i,) for i in [*range(10), 11, 12, None]], key=str)
    state = ingest.current(spark, [f"{top}-first", f"{top}-second"], ["id"])
    assert dict(state.where("id IN (3, 11)").collect()) == {3: 3, 11: 5}


def test_half_a_stage_is_built_again(spark):
    import os

    root, build = scratch_path(spark, "stages"), lambda: spark.range(5)
    assert tables.reuse_or_build(spark, root, "ids", lambda: spark.range(3), part=1).count() == 3
    os.remove(f"{root.removeprefix('file:')}/ids/part=1/_SUCCESS")
    assert tables.reuse_or_build(spark, root, "ids", build, part=1).count() == 5


def test_last_of_a_repeated_key_counts(spark, rows):
    path = scratch_path(spark, "log")
    spark.createDataFrame([("a ? 1|b ? 2|a ? 3",), ("b ? x ? y",), ("",)], "value string").write.text(path)
    assert rows(landed.read_kv_log(spark, path, ["a", "b"])) == sorted([("3", "2"), (None, "x ? y"), (None, None)], key=str)


def test_leap_days_and_null_keys_a_year_later(spark):
    day = lambda t: None if t is None else datetime.date.fromisoformat(t)
    data = [(1, "2024-02-28", 1), (1, "2024-02-29", 2), (1, "2025-02-28", 3), (None, "2024-03-31", 4), (None, "2025-03-31", 5), (2, None, 6)]
    df = spark.createDataFrame([(k, day(d), v) for k, d, v in data], "k int, d date, v int")
    got = {r["v"]: r["last_v"] for r in joins.year_over_year(df, ["k"], "d", ["v"]).collect()}
    assert got == {1: None, 2: None, 3: 2, 4: None, 5: None, 6: None}


def test_unseen_within_a_horizon(spark, rows):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    at = lambda i: F.timestamp_seconds(F.lit(1_700_000_000) + i)
    first = spark.range(20).select("id", at(F.col("id")).alias("ts"))
    first.union(first).coalesce(1).write.parquet(path)
    stream = ingest.read_files(spark, path, "id bigint, ts timestamp")
    kept = ingest.unseen_within(stream, ["id"], "ts", "1 hour")
    kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    assert rows(spark.read.schema("id bigint").parquet(out)) == sorted([(i,) for i in range(20)], key=str)


def test_kafka_options():
    options = ingest.kafka_options("host:1", list(ingest.TOPICS))
    assert options["subscribe"].split(",") == list(ingest.TOPICS)


def test_owned_scratch_is_dropped(spark):
    outside = scratch_path(spark, "rows")
    with owned_scratch(spark) as outer:
        kept = tables.staged(spark.range(5).toDF("a"), "rows")
        with owned_scratch(spark) as inner:
            assert inner.startswith(outer) and scratch_path(spark, "x").startswith(inner)
            tables.staged(spark.range(3).toDF("a"), "rows")
        assert kept.count() == 5 and not os.path.exists(inner.removeprefix("file:"))
    assert not os.path.exists(outer.removeprefix("file:"))
    assert scratch_path(spark, "rows").rsplit("/", 1)[0] == outside.rsplit("/", 1)[0]


def test_a_batch_reads_no_stored_row(spark):
    """Batches look their keys up in the state: neither the store nor earlier input is scanned again."""
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for part in range(4):
        spark.range(part * 50, part * 50 + 100).select("id", F.col("id").alias("at")).coalesce(1).write.mode("append").parquet(path)
    stream = ingest.read_files(spark, path, "id bigint, at bigint", files_per_batch=1)
    query = ingest.append_unseen(stream, ["id"], ["at"], out, f"{out}-checkpoint")
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [100] * 4
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == spark.read.parquet(out).count() == 250
    assert dict(spark.read.schema("id bigint, at bigint, run string, batch bigint").parquet(out).groupBy("batch").count().collect()) == {0: 100, 1: 50, 2: 50, 3: 50}


def test_a_batch_commits_few_partitions_and_only_its_changes(spark):
    """However many partitions joins use and keys are stored; the session's own number stays as it is."""
    import pathlib

    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for part in range(2):
        spark.range(part * 50, part * 50 + 100).select("id", F.col("id").alias("at")).coalesce(1).write.mode("append").parquet(path)
    most, before = 2 * spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(most + 5))
    try:
        query = ingest.append_unseen(ingest.read_files(spark, path, "id bigint, at bigint", files_per_batch=1), ["id"], ["at"], out, f"{out}-checkpoint")
        query.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(most + 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {p["stateOperators"][0]["numShufflePartitions"] for p in query.recentProgress if p["numInputRows"]} == {most}
    assert list(pathlib.Path(f"{out}-checkpoint".removeprefix("file:")).glob("state/0/*/*.changelog"))
    assert spark.read.parquet(out).count() == 150


def test_the_first_row_of_a_batch_wins(spark, rows):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    schema = "id bigint, at bigint, name string"
    for batch in ([(1, 5, "late"), (1, 2, "early"), (None, 1, "none"), (2, None, "null first"), (2, 0, "zero")], [(1, 0, "too late"), (3, 3, None)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
        ingest.append_unseen(ingest.read_files(spark, path, schema), ["id"], ["at"], out, f"{out}-checkpoint").awaitTermination()
    assert rows(spark.read.schema(schema).parquet(out).select("id", "name")) == sorted([(1, "early"), (None, "none"), (2, "null first"), (3, None)], key=str)


def test_late_rows_go_aside_and_keys_are_forgotten(spark, rows):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    at = lambda seconds: F.timestamp_seconds(F.lit(1_700_000_000) + seconds)
    batch = lambda ids, seconds: spark.createDataFrame([(i,) for i in ids], "id bigint").select("id", at(seconds).alias("ts")).coalesce(1)
    schema = "id bigint, ts timestamp"
    for ids, seconds in (([1, 2], 0), ([3], 10_000), ([1, 4, 3], 9_000), ([5, 2], 100), ([6], 10_001)):
        batch(ids, seconds).write.mode("append").parquet(path)
        stream = ingest.read_files(spark, path, schema)
        ingest.append_unseen_for_a_time(stream, ["id"], ["ts"], out, f"{out}-checkpoint", time="ts", lateness="1 hour").awaitTermination()
    read = lambda folder: rows(spark.read.schema(schema).parquet(folder).select("id"))
    assert read(out) == [(1,), (2,), (3,), (4,), (6,)] and read(f"{out}-late") == [(2,), (5,)]


def test_keys_come_back_after_they_were_forgotten(spark, rows):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for _ in range(2):
        spark.range(3).select("id", F.col("id").alias("at")).coalesce(1).write.mode("append").parquet(path)
        stream = ingest.read_files(spark, path, "id bigint, at bigint")
        ingest.append_unseen_for_a_time(stream, ["id"], ["at"], out, f"{out}-checkpoint", forget_ms=1).awaitTermination()
    assert rows(spark.read.schema("id bigint").parquet(out).select("id")) == [(0,), (0,), (1,), (1,), (2,), (2,)]


# tables in buckets


def test_untouched_buckets_keep_their_files(spark, rows):
    stored = BucketTable(spark, scratch_path(spark, "table")).create(spark.range(1000).select("id", F.lit("old").alias("v")), ["id"], buckets=16)
    before = set(stored.files())
    fresh = spark.createDataFrame([(3, "new"), (2000, None)], "id bigint, v string")
    assert history.upsert_table(stored, fresh, ["id"]) == 2
    after = set(stored.files())
    assert len(before - after) <= 2 and len(before & after) >= len(before) - 2
    got = {r["id"]: r["v"] for r in stored.read().collect()}
    assert got == {**{i: "old" for i in range(1000)}, 3: "new", 2000: None}
    assert stored.read(1).where("v = 'old'").count() == 1000
    stored.drop_unused()
    assert set(stored.files()) == after and stored.read().count() == 1001


def test_one_of_two_changes_fails(spark):
    stored = BucketTable(spark, scratch_path(spark, "table")).create(spark.range(10), ["id"], buckets=2)

    def overtaken(rows):
        if stored.version() == 1:
            history.upsert_table(BucketTable(spark, stored.path), spark.range(20, 21), ["id"])
        return rows

    with pytest.raises(ChangedMeanwhile):
        stored.rewrite(spark.range(3), overtaken)
    assert stored.version() == 2 and stored.read().count() == 11


def test_buckets_with_null_keys_and_without_rows(spark, rows):
    empty = BucketTable(spark, scratch_path(spark, "table")).create(spark.createDataFrame([], "k string, v int"), ["k"], buckets=4)
    assert empty.read().count() == 0
    assert history.upsert_table(empty, spark.createDataFrame([("a", 1)], "k string, v int"), ["k"]) == 2
    assert empty.rewrite(spark.createDataFrame([], "k string"), lambda r: r) == 2
    assert empty.rewrite(spark.createDataFrame([("a",)], "k string"), lambda r: r.where("false")) == 3
    assert rows(empty.read()) == []


# files and pages


def test_texts_come_back_as_they_were(spark, rows):
    texts = [None, "", " ", "  pad ", "a\nb", "\r\n", "a\rb", 'say "x"', '"', ",", ";", "\\", '\\"', "#", "\\N", "null", "\t", "é漢", "x" * 100_000, '""', "\n\n"]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "id int, a string, b string")
    for sep in (",", ";"):
        for header in (True, False):
            path = scratch_path(spark, "texts")
            delimited.write_delimited(df, path, sep=sep, header=header, maxRecordsPerFile=4)
            back = delimited.read_delimited(spark, path, df.schema, sep=sep, header=header, multi_line=True)
            assert rows(back) == rows(df)
            assert rows(delimited.read_delimited(spark, path, df.schema, sep=sep, header=header, multi_line=True, columns=["b", "id"])) == rows(df.select("b", "id"))


@pytest.mark.parametrize("piece", ["<a ", "<dd><p>", "<article data-id='1'>", "x ", "<h3>", "<dd class='w'></dd>", "<", '<a target="_self">'])
def test_long_cards_without_closing_tags(spark, piece):
    """Time grows with the length of a card, not with its square."""
    import time

    page = f"<article data-id='9'><a target='_self' href='l'>t</a>{piece * (1_000_000 // len(piece))}"
    df = spark.createDataFrame([(page,)], "html string")
    begin = time.perf_counter()
    found = html.parse_listings(df, "html", F.lit("2025-01-10 12:00:00").cast("timestamp_ntz")).where("listing_id = 9").collect()
    assert time.perf_counter() - begin < 60
    assert [(r["notice_name"], r["link"]) for r in found] == [("t", "l")]


def test_variants_keep_their_misfits(spark, rows):
    texts = ['{"a": 1}', '{"a": "2"}', '{"a": {"b": 3}}', '{"a": null}', "{}", "[1]", "5", '{"a": [1, {"b": "x"}]}', "{", None, '{"a": 1e400}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    good, bad = landed.variant_fields(df, "t", {"a": ("$.a", "bigint"), "b": ("$.a.b", "string")})
    assert {r["id"]: (r["a"], r["b"]) for r in good.collect()} == {
        0: (1, None), 1: (2, None), 3: (None, None), 4: (None, None), 5: (None, None), 6: (None, None), 9: (None, None)}
    assert {r["id"]: r["reason"] for r in bad.collect()} == {2: "a", 7: "a", 8: "no JSON", 10: "a"}
    schemas = landed.variant_schema(df.where("id IN (0, 1, 3)"), "t").collect()
    assert [r["schema"] for r in schemas] == ["OBJECT<a: VARIANT>"]
