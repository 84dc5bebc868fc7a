"""Plain windows against the split path for hot keys, and the running-maximum vectors."""

from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablework.operators import aggs, joins, ml, ordered, windows
from tablework.session import owned_scratch


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows belong to key 0; a few keys have one row, one key is null."""
    ids = spark.range(3000)
    key = F.when(F.col("id") % 3 != 0, 0).when(F.col("id") % 30 == 0, None).otherwise(F.col("id") % 17 + 1)
    value = F.pmod(F.xxhash64("id"), F.lit(41)) - 20
    at = F.pmod(F.xxhash64(F.col("id") + 7), F.lit(500))
    return ids.select("id", key.cast("int").alias("k"), at.alias("t"), value.cast("bigint").alias("v")).cache()


ORDER = ["t", "id"]


def outputs():
    return {
        "total": ("sum", F.col("v")), "low": ("min", F.col("v")), "high": ("max", F.col("v")),
        "n": ("count", F.when(F.col("v") > 0, 1)), "seen": ("last", F.when(F.col("v") > 10, F.col("id"))),
    }


@pytest.mark.parametrize("earlier", [False, True])
@pytest.mark.parametrize("keys", [["k"], ["k", "t"]])
def test_running_split_equals_window(skewed, rows, keys, earlier):
    plain = ordered.running(skewed, keys, ORDER, outputs(), earlier=earlier, bounded=True)
    split = ordered.running(skewed, keys, ORDER, outputs(), earlier=earlier, group_rows=70)
    assert rows(plain) == rows(split.select(plain.columns))


def test_positions_without_keys(skewed):
    numbered = ordered.positions(skewed, [], ORDER)
    assert [r["pos"] for r in numbered.orderBy(*ORDER).collect()] == list(range(3000))


def test_shifted_and_rolling_split_equal_window(skewed, rows):
    out = {"back": (F.col("v"), 2), "ahead": (F.col("id"), -3)}
    plain = ordered.shifted(skewed, ["k"], ORDER, out, bounded=True)
    assert rows(plain) == rows(ordered.shifted(skewed, ["k"], ORDER, out, group_rows=70).select(plain.columns))
    out = {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}
    plain = ordered.rolling(skewed, ["k"], ORDER, 7, out, bounded=True)
    assert rows(plain) == rows(ordered.rolling(skewed, ["k"], ORDER, 7, out, group_rows=70).select(plain.columns))


def test_asof_with_hot_key(skewed, rows):
    left = skewed.where("id % 2 = 0").select("k", "t", "id").where("k IS NOT NULL")
    right = skewed.where("id % 2 = 1").select("k", F.col("t").alias("at"), F.col("id").alias("rid"))
    plain = joins.asof_join(left, right, ["k"], "t", "at", right_tie="rid", bounded=True)
    split = joins.asof_join(left, right, ["k"], "t", "at", right_tie="rid", group_rows=50)
    assert rows(plain) == rows(split)
    matched = {r["id"]: (r["at"], r["rid"]) for r in plain.collect()}
    statements = right.collect()
    for r in left.collect():
        earlier = [(s["at"], s["rid"]) for s in statements if s["k"] == r["k"] and s["at"] <= r["t"]]
        assert matched[r["id"]] == (max(earlier) if earlier else (None, None))


@pytest.mark.parametrize("values, expected", [
    ([], []), ([1], [1]), ([1, 2, 3, 4, 5], [1, 2, 3, 4, 5]),
    ([1, 2, 2, 1, 3, 3, 3, 2, 2], [1, 2, 2, 2, 3, 3, 3, 3, 3]), ([-1, -2, -3, -4, -5], [-1] * 5),
])
def test_running_max_vectors(spark, values, expected):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "k int, i int, v int")
    for options in ({"bounded": True}, {"group_rows": 2}):
        out = windows.running_max(df, ["k"], ["i"], "v", "m", **options)
        assert [r["m"] for r in out.orderBy("i").collect()] == expected


def test_best_run_sum_vector(spark):
    numbers = [-2, 1, -3, 4, -1, 2, 1, -5, 4]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(numbers)] + [(2, 0, -3), (2, 1, -1)], "k int, i int, v int")
    for group_rows in (100, 3):
        best = windows.best_run_sum(df, ["k"], ["i"], "v", group_rows=group_rows)
        assert {r["k"]: r["best"] for r in best.collect()} == {1: 6, 2: -1}


def test_target_windows_with_zeros_and_negatives(spark):
    numbers = [0, 3, -3, 0, 5, 0, -5, 3, 0]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(numbers)], "k int, i int, v int")
    expected = {}
    for j in range(len(numbers)):
        starts = [i for i in range(j + 1) if sum(numbers[i:j + 1]) == 0]
        if starts:
            expected[j + 1] = (len(starts), max(starts) + 1)
    for group_rows in (100, 2):
        found = windows.target_windows(df, ["k"], ["i"], "v", 0, group_rows=group_rows)
        assert {r["end"]: (r["windows"], r["nearest_start"]) for r in found.collect()} == expected


def test_zero_runs_and_best_gain(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([1, 3, 0, 0, 2, 0, 0, 4])], "k int, i int, v int")
    for options in ({"bounded": True}, {"group_rows": 2}):
        run = windows.zero_runs(df, ["k"], ["i"], "v", **options).first()
        assert (run["runs"], run["longest"], run["stretches"]) == (2, 2, 6)
        gain = windows.best_gain(df.withColumn("v", F.col("v").cast("double")), ["k"], ["i"], "v", **options).first()
        assert gain["gain"] == 4.0


def test_missing_ids_and_top_distinct(spark, rows):
    df = spark.createDataFrame([(i,) for i in (3, 4, 4, 7, 9)], "id bigint")
    assert rows(windows.missing_ids(df, "id")) == [(5,), (6,), (8,)]
    assert windows.missing_ids(df.limit(0), "id").count() == 0
    assert [r[0] for r in windows.top_distinct(df, "id", 3).collect()] == [9, 7, 4]


def test_quantiles_split_equals_numpy(skewed):
    import numpy as np
    values = [r["v"] for r in skewed.select("v").collect()]
    probs = {"a": 0.0, "b": 0.1, "c": 0.333, "d": 0.5, "e": 1.0}
    for options in ({"bounded": True}, {"group_rows": 10}):
        row = aggs.exact_quantiles(skewed, ["v"], probs, **options).first()
        for name, p in probs.items():
            assert row[name] == pytest.approx(np.quantile(values, p))


def test_pages_of_a_hot_key_lose_nothing(skewed):
    pages = joins.matches_per_key(skewed, ["k"], "id", ORDER, page_rows=100, group_rows=50)
    found = [int(v) for r in pages.collect() for v in r["joined"].split("\n")]
    assert sorted(found) == list(range(3000))
    assert pages.agg(F.max("values")).first()[0] == 100


def test_knn_in_blocks_equals_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    points = [(i, [float(x) for x in rng.integers(0, 4, 3)], int(i % 3)) for i in range(200)]
    df = spark.createDataFrame(points, "id bigint, x array<float>, y int")
    test, train = df.where("id < 40"), df.where("id >= 40")
    near = ml.nearest_neighbours(train, test, "id", "x", "y", 5, test_block=16)
    found = {}
    for r in near.collect():
        found.setdefault(r["id"], {})[r["rank"]] = r["neighbour"]
    for i, x, _ in points[:40]:
        order = sorted((sum((a - b) ** 2 for a, b in zip(x, z)), j) for j, z, _ in points[40:])[:5]
        assert [found[i][k] for k in range(1, 6)] == [j for _, j in order]


def test_linear_model_equals_least_squares(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    data = [(float(a), float(b), float(2 * a - 3 * b + 4 + e)) for a, b, e in rng.normal(size=(300, 3))]
    model, _ = ml.linear_model(spark.createDataFrame(data, "a double, b double, y double"), ["a", "b"], "y")
    x = np.array([[1, a, b] for a, b, _ in data])
    expected = np.linalg.lstsq(x, np.array([y for _, _, y in data]), rcond=None)[0]
    assert [model.intercept, *model.coefficients] == pytest.approx(list(expected))


def test_knn_searches_all_rows_in_cells(spark):
    """Beyond max_train rows the cells give what the comparison with every row gives, ties, repeats and null rows included."""
    import numpy as np

    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 4)) * 20
    points = [(i, (centres[i % 12] + rng.integers(0, 3, 4)).tolist(), i % 5) for i in range(900)]
    points += [(2000 + i, points[0][1], 7) for i in range(300)] + [(5000, None, 1), (5001, points[3][1], None)]
    df = spark.createDataFrame(points, "id bigint, x array<double>, y int")
    test, train = df.where("id % 7 = 0"), df.where("id % 7 != 0")
    whole = ml.nearest_neighbours(train, test, "id", "x", "y", 6)
    parts = ml.nearest_neighbours(train, test, "id", "x", "y", 6, max_train=50, pivots=40, test_block=8)
    same = lambda r: (r["id"], r["rank"], r["neighbour"], round(r["distance"], 6), r["neighbour_label"])
    assert sorted(map(same, whole.collect()), key=str) == sorted(map(same, parts.collect()), key=str)
    few = ml.nearest_neighbours(df.where("id < 4"), df.where("id < 2"), "id", "x", "y", 6, max_train=2, pivots=2).collect()
    assert len(few) == 2 * 4
    assert ml.nearest_neighbours(df.limit(0), df, "id", "x", "y", 3).count() == 0


def test_knn_leaves_cells_out(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    points = [(i, (np.eye(10)[i % 10] * 50 + rng.normal(size=10)).tolist(), 1) for i in range(1000)]
    rows = spark.createDataFrame(points, "id bigint, features array<double>, label int")
    cells = ml._cells(rows, 30, 100, 0)
    tests = rows.limit(100).withColumn("t", F.col("id")).withColumn("limit", F.lit(100.0))
    pairs = sum(cells.sizes[r["cell"]] for r in ml.searched_cells(tests, cells, 5).collect())
    assert 0 < pairs < 100 * 1000 / 3


def test_cells_leave_the_schema_of_the_rows(spark):
    """The frame keeps its schema; with the cell's columns added to that very object, later steps look for columns it lacks."""
    rows = spark.createDataFrame([(i, [float(i), 1.0], i % 2) for i in range(20)], "id bigint, features array<double>, label int")
    cells = ml._cells(rows, 4, 5, 0)
    assert rows.columns == ["id", "features", "label"] and cells.rows.columns == ["id", "features", "label", "cell", "reach"]
    assert cells.rows.count() == 20


def _brute_force(train, test, k):
    """(test id, rank): (neighbour, label, distance); rows are (id, vector, label), vectors with null or not finite numbers are left out."""
    import numpy as np

    whole = lambda rows: [r for r in rows if r[1] is not None and None not in r[1] and np.isfinite(r[1]).all()]
    found = []
    for i, x, _ in whole(test):
        near = sorted((round(float(((np.array(x) - np.array(z)) ** 2).sum()), 9), j, str(y)) for j, z, y in whole(train))[:k]
        found += [(i, rank, j, y, round(d, 6)) for rank, (d, j, y) in enumerate(near, 1)]
    return sorted(found)


def test_knn_over_many_tiles_equals_brute_force(spark, monkeypatch):
    """Blocks of cells and test rows in every combination: clusters far from the origin, a vector that half of all rows have, repeated ids, odd numbers."""
    import numpy as np

    monkeypatch.setattr(ml, "BLOCK_ROWS", 60)
    monkeypatch.setattr(ml, "TASK_TESTS", 2)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(9, 5)) * 3000
    points = [(i, (centres[i % 9] + rng.integers(0, 3, 5)).tolist(), i % 4) for i in range(400)]
    points += [(1000 + i, points[5][1], i % 3) for i in range(400)]
    points += [(i, points[i + 1][1], None) for i in range(0, 40, 2)]
    points += [(5000, None, 1), (5001, [float("nan")] * 5, 1), (5002, [float("inf"), 1.0, 1.0, 1.0, 1.0], 2), (5003, [None, 1.0, 1.0, 1.0, 1.0], 3)]
    train, test = [p for p in points if p[0] % 4], [p for p in points if p[0] % 4 == 0] + points[-3:]
    frame = lambda rows: spark.createDataFrame(rows, "id bigint, x array<double>, y int")
    near = ml.nearest_neighbours(frame(train), frame(test), "id", "x", "y", 7, test_block=8, max_train=50, pivots=20)
    assert sorted((r["id"], r["rank"], r["neighbour"], str(r["neighbour_label"]), round(r["distance"], 6)) for r in near.collect()) == _brute_force(train, test, 7)


def test_knn_writes_no_row_per_test_row_and_cell(spark, tmp_path):
    """Where no cell can be left out, intermediate results stay in proportion to the rows."""
    import numpy as np

    points = [(i, x.tolist(), 1) for i, x in enumerate(np.random.default_rng(6).normal(size=(600, 30)))]
    df = spark.createDataFrame(points, "id bigint, x array<float>, y int")
    with owned_scratch(spark) as folder:
        ml.nearest_neighbours(df.where("id >= 100"), df.where("id < 100"), "id", "x", "y", 3, max_train=50, pivots=64).collect()
        root, written = Path(folder.removeprefix("file:")), Counter()
        for p in root.rglob("*.parquet"):
            written[p.relative_to(root).parts[0]] += pq.ParquetFile(p).metadata.num_rows
    assert written and max(written.values()) <= 1000


def test_knn_cells_are_named_in_small_pieces(spark, monkeypatch):
    """A batch of test rows that ask for every cell does not become one frame with a row for each of them and cell."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(8)
    rows = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(rng.normal(size=(300, 30)))], "id bigint, features array<double>, label int")
    cells = ml._cells(rows, 64, 100, 0)
    tests = rows.limit(1).withColumn("t", F.col("id")).withColumn("limit", F.lit(100.0))
    caught = []
    monkeypatch.setattr(type(tests), "mapInPandas", lambda self, f, schema: caught.append(f))
    ml.searched_cells(tests, cells, 5)
    batch = pd.DataFrame({"t": range(2000), "features": list(rng.normal(size=(2000, 30))), "limit": 1000.0})
    sizes = [len(x) for x in caught[0](iter([batch]))]
    assert sum(sizes) > 2000 * 50 and max(sizes) <= 10_000


def test_knn_memory_is_bounded_where_all_tie(monkeypatch):
    import tracemalloc

    import numpy as np

    monkeypatch.setattr(ml, "TRAIN_BLOCK", 256)
    matrix, number = np.ones((20_000, 8)), np.arange(20_000)
    matrix[::2] += np.random.default_rng(2).integers(0, 2, (10_000, 8))
    expected = np.flatnonzero((matrix == 1.0).all(1))[:10]
    tracemalloc.start()
    best = ml._Best(np.ones((3000, 8)), 10, 64)
    for part in ml._parts(number, matrix, 10):
        best.meet(np.arange(3000), part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (best.number == expected).all() and not best.distance.any()
    # 3000 x 20,000 distances would be 480 MB
    assert peak < 30_000_000


def test_category_index_and_slots(spark):
    df = spark.createDataFrame([(i, "abca"[i % 4] if i % 10 else None) for i in range(50)], "id int, c string")
    got = {r["c"]: (r["c_index"], r["c_hot"].indices.tolist()) for r in ml.encode_categories(df, ["c"]).collect()}
    counts = df.groupBy("c").count().collect()
    order = sorted(counts, key=lambda r: (-r["count"], r["c"] is None, r["c"] or ""))
    assert got == {r["c"]: (float(i), [i]) for i, r in enumerate(order)}


def test_a_hot_key_takes_one_exchange_of_rows(spark, skewed):
    """Cut by fixed bounds: rows are exchanged once, on (block, key); nothing is staged."""
    for made in (ordered.running(skewed, ["k"], ORDER, outputs(), group_rows=70), ordered.positions(skewed, ["k"], ORDER, group_rows=70)):
        physical = made._jdf.queryExecution().executedPlan().toString()
        rows_moved = [line for line in physical.splitlines() if "Exchange hashpartitioning(" in line and "k#" in line and "_ord_block" in line]
        # one exchange of the rows, one of the totals per block
        assert len(rows_moved) == 2 and "rangepartitioning" not in physical


def test_blocks_are_bounded(spark, skewed):
    blocked = ordered._blocked(skewed, ["k"], ORDER, 70, False)
    sizes = blocked.groupBy("k", "_ord_block").count().where("_ord_block > 0 OR k = 0").toPandas()
    assert len(sizes) > 20 and sizes["count"].max() < 300
    assert blocked.where("NOT _ord_hot").select("_ord_block").distinct().collect() == [(0,)]


def test_frames_that_span_whole_blocks(skewed, rows):
    """Blocks shorter than the frame: the edge rows of several blocks stand in one row."""
    out = {"s": ("sum", F.col("v")), "n": ("count", F.lit(1))}
    plain = ordered.rolling(skewed, ["k"], ORDER, 40, out, bounded=True)
    assert rows(plain) == rows(ordered.rolling(skewed, ["k"], ORDER, 40, out, group_rows=9).select(plain.columns))


def test_descending_orders_and_no_keys(skewed, rows):
    order = [F.col("t").desc_nulls_last(), F.col("id").desc()]
    plain = ordered.running(skewed, ["k"], order, outputs(), bounded=True)
    assert rows(plain) == rows(ordered.running(skewed, ["k"], order, outputs(), group_rows=70).select(plain.columns))
    out = {"next": (F.col("id"), -1), "s": (F.col("v"), 3)}
    plain = ordered.shifted(skewed, [], ["id"], out, bounded=True)
    assert rows(plain) == rows(ordered.shifted(skewed, [], ["id"], out, group_rows=200).select(plain.columns))


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_quantiles_from_brackets(spark, accuracy):
    import numpy as np

    values = np.concatenate([np.random.default_rng(1).lognormal(0, 4, 5000), np.full(3000, 2.5), -np.arange(500.0), [0.0]])
    df = spark.createDataFrame([(float(v), None if i % 3 else int(v) % 7, None) for i, v in enumerate(values)], "a double, b int, c int")
    probs = {"low": 0.0, "q1": 0.123, "half": 0.5, "q9": 0.987, "top": 1.0}
    got = {r["column"]: r for r in aggs.exact_quantiles(df, ["a", "b", "c"], probs, accuracy=accuracy).collect()}
    few = [int(v) % 7 for v in values[::3]]
    for name, p in probs.items():
        assert got["a"][name] == pytest.approx(np.quantile(values, p), rel=1e-12)
        assert got["b"][name] == pytest.approx(np.quantile(few, p))
    assert "c" not in got and aggs.exact_quantiles(df.where("false"), ["a"], probs).count() == 0


def test_products_that_leave_the_range_on_the_way(spark):
    from fractions import Fraction
    from math import prod

    rng = __import__("random").Random(1)
    groups = {
        1: [100.0] * 200 + [0.01] * 200, 2: [1e-300, 1e-300, 1e300, 1e300, 3.0], 3: [2.0, 0.0, -5.0], 4: [0.0, 0.0], 5: [-1.5],
        6: [rng.choice([1e3, 1e-3, -7.0, 1 / 7]) for _ in range(10_000)], None: [4.0, 0.25],
    }
    df = spark.createDataFrame([(k, i, v) for k, vs in groups.items() for i, v in enumerate(vs)], "k int, i int, v double")
    got = {(r["k"], r["i"]): r["o"] for r in aggs.product_of_others(df, ["k"], "v", "o").collect()}
    assert len(got) == sum(map(len, groups.values()))
    for k, vs in groups.items():
        zeros, whole = vs.count(0.0), prod(Fraction(v) for v in vs if v)
        for i in {0, 1, len(vs) - 1} & set(range(len(vs))):
            want = whole / Fraction(vs[i]) if not zeros else whole if zeros == 1 and not vs[i] else 0
            try:
                want = float(want)
            except OverflowError:
                want = float("inf") if want > 0 else float("-inf")
            assert got[k, i] == pytest.approx(want, rel=1e-11)


def test_interval_join_against_all_pairs(spark, rows):
    rng = __import__("random").Random(3)
    points = [(rng.choice([1, 1, 1, 2, None]), i, rng.choice([None, rng.randrange(-5000, 5000)])) for i in range(300)]
    spans = []
    for i in range(200):
        start = rng.randrange(-5000, 5000)
        spans.append((rng.choice([1, 1, 2, 3, None]), i, start, rng.choice([start, start + rng.randrange(10), start + rng.randrange(9000), start - 5, None])))
    left = spark.createDataFrame(points, "k int, p int, at long")
    right = spark.createDataFrame(spans, "k int, s int, a long, b long")
    want = [(k, p, s) for k, p, at in points for q, s, a, b in spans if k is not None and k == q and None not in (at, b) and a <= at <= b]
    joined = joins.interval_join(left, right, ["k"], "at", "a", "b")
    assert rows(joined.select("k", "p", "s")) == sorted(want, key=str) and joined.columns == ["k", "p", "at", "s", "a", "b"]
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()
    days = [F.date_add(F.lit("2020-01-01").cast("date"), F.col(c).cast("int")).alias(c) for c in ("a", "b")]
    dated = joins.interval_join(left.select("k", "p", F.date_add(F.lit("2020-01-01").cast("date"), F.col("at").cast("int")).alias("at")),
                                right.select("k", "s", *days), ["k"], "at", "a", "b")
    assert rows(dated.select("k", "p", "s")) == sorted(want, key=str)
    assert joins.interval_join(left, right.where("false"), ["k"], "at", "a", "b").count() == 0


def test_tiled_product_of_wide_rows(spark):
    import numpy as np

    from tablework.operators import matrix

    rng = np.random.default_rng(2)
    a, b = rng.standard_normal((9, 23)), rng.standard_normal((23, 7))
    b[5, 2] = 0.0
    left = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(a)] + [(99, None)], "i long, v array<double>")
    right = spark.createDataFrame([(k, j, float(b[k, j])) for k in range(23) for j in range(7) if (k, j) != (5, 2)], "k int, j int, v double")
    for tile in (4, 64):
        got = {(r["i"], r["j"]): r["v"] for r in matrix.tiled_product(left, "i", "v", right, tile).collect()}
        assert len(got) == 63 and all(abs(got[i, j] - (a @ b)[i, j]) < 1e-12 for i, j in got)
