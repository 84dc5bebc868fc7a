"""Feature preparation and simple models."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tablework.operators.joins import top_rows, with_group_value
from tablework.operators.ordered import positions
from tablework.sources.tables import seeded_digest, staged

# Training rows that every task may hold. More of them are kept in cells round so many pivots, and a task compares blocks of
# about so many training rows, read batch by batch, with so many test rows, which it holds.
MAX_TRAIN = 50_000
PIVOTS = 256
BLOCK_ROWS = 65_536
TASK_TESTS = 64
# Test and training rows compared at once: 256 x 2048 doubles are 4 MB in a task (TASK_TESTS counts blocks of TEST_BLOCK), and
# distances worked out at once.
TEST_BLOCK = 256
TRAIN_BLOCK = 2048
EXACT_ROWS = 8192
# number of a neighbour not met yet, after all others
NOT_MET = np.iinfo(np.int64).max


def linear_model(df: DataFrame, features: list[str], label: str) -> tuple[LinearRegressionModel, DataFrame]:
    """Least squares on several predictors; returns the model and the assembled rows."""
    rows = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip").transform(
        df.select(*[F.col(c).cast("double") for c in [*features, label]]))
    model = LinearRegression(featuresCol="features", labelCol=label, solver="normal").fit(rows)
    return model, rows


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns shifted to mean 0 and scaled to sample standard deviation 1; a constant column gives null."""
    stats = df.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in columns],
                            *[F.stddev_samp(c).alias(f"s_{c}") for c in columns]).alias("s"))
    scaled = df.withColumn("_s", stats.scalar())
    return scaled.withColumns({
        c: (F.col(c) - F.col(f"_s.m_{c}")) / F.nullif(F.col(f"_s.s_{c}"), F.lit(0.0)) for c in columns}).drop("_s")


def stratified_split(df: DataFrame, label: str, id_col: str, share: float, seed: int, **options) -> DataFrame:
    """Add ``part`` (train or test): exactly the given share of every label, in a seeded hash order."""
    mixed = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string"))))
    ranked = positions(mixed, [label], ["_h", id_col], "_pos", **options)
    sized = with_group_value(ranked, [label], F.count(F.lit(1)).alias("_n"), few_groups=True)
    cut = F.floor(F.col("_n") * F.lit(share) + 0.5)
    return sized.withColumn("part", F.when(F.col("_pos") < cut, "train").otherwise("test")).drop("_h", "_pos", "_n")


def category_index(df: DataFrame, column: str, name: str) -> DataFrame:
    """Index of each category, most frequent first, then by name; null is a category of its own, after equal ones."""
    counts = df.groupBy(F.col(column).alias("_category")).agg(F.count(F.lit(1)).alias("_c"))
    ranked = positions(counts, [], [F.col("_c").desc(), F.col("_category").asc_nulls_last()], "_i")
    index = ranked.select("_category", F.col("_i").cast("double").alias(name))
    return df.join(index, F.col(column).eqNullSafe(F.col("_category")), "left").drop("_category")


def encode_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """Category indexes (most frequent first) and one-hot vectors for text columns, for any number of categories."""
    for c in columns:
        df = category_index(df, c, f"{c}_index")
    encoder = OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_hot" for c in columns], dropLast=False)
    return encoder.fit(df).transform(df)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.maximum(square, 0.0)


def _matrix(features) -> np.ndarray:
    return np.stack(features).astype("float64")


def _error(numbers: int, square) -> np.ndarray:
    """What a squared distance got from a product of matrices is off by at most, for vectors with so large squares."""
    return 4e-16 * (numbers + 2) * square


class _Part(NamedTuple):
    """Training rows compared at once: their numbers, vectors, and (-2 x vector, its square)."""

    number: np.ndarray
    matrix: np.ndarray
    turned: np.ndarray


def _first_copies(rows: np.ndarray, k: int) -> np.ndarray:
    """Rows with fewer than k equal rows before them."""
    same = np.unique(np.ascontiguousarray(rows).view(f"V{rows.itemsize * rows.shape[1]}").ravel(), return_inverse=True)[1].ravel()
    order = np.argsort(same, kind="stable")
    return np.sort(order[np.arange(len(rows)) - np.searchsorted(same[order], same[order]) < k])


def _parts(number: np.ndarray, matrix: np.ndarray, k: int) -> Iterator[_Part]:
    """Training rows, lower numbers first; a row that k equal ones precede is nobody's k-th nearest and left out."""
    for at in range(0, len(matrix), TRAIN_BLOCK):
        part = matrix[at : at + TRAIN_BLOCK]
        turned = np.hstack([-2.0 * part, (part * part).sum(1)[:, None]])
        first = _first_copies(turned, k)
        yield _Part(number[at : at + TRAIN_BLOCK][first], part[first], turned[first])


class _Best:
    """The k nearest training rows met so far of every test row, of equal distances those with the lowest numbers.

    ``limit`` is the squared distance that none of them exceeds. It goes down as nearer rows are met.
    """

    def __init__(self, matrix: np.ndarray, k: int, block: int, limit=np.inf):
        self.k, self.block = k, block
        self.rows, self.square = np.hstack([matrix, np.ones((len(matrix), 1))]), (matrix * matrix).sum(1)
        self.limit = np.array(np.broadcast_to(limit, len(matrix)), "float64")
        self.distance, self.number = np.full((len(matrix), k), np.inf), np.full((len(matrix), k), NOT_MET)

    def reaching(self, cells: _Cells, cell: int) -> np.ndarray:
        """Test rows that the cell can hold a neighbour of."""
        away = np.sqrt(_distances(self.rows[:, :-1], cells.pivots[cell : cell + 1]))
        return np.flatnonzero(cells.within(away, self.square, self.limit, slice(cell, cell + 1))[:, 0])

    def meet(self, asked: np.ndarray, part: _Part) -> None:
        step = self.block * TRAIN_BLOCK // len(part.number)
        for at in range(0, len(asked), step):
            self._compare(asked[at : at + step], part)

    def _compare(self, asked: np.ndarray, part: _Part) -> None:
        rows, square, limit = self.rows[asked], self.square[asked], self.limit[asked]
        # squared distances less the test row's own square
        rough = rows @ part.turned.T
        # half a unit of the rounding below on either side, and the error of the product
        slack = 1e-9 + _error(rows.shape[1], square + part.turned[:, -1].max())
        most = limit - square + slack
        open_rows = np.flatnonzero(np.isinf(limit))
        if len(open_rows) and len(part.number) > self.k:
            most[open_rows] = np.partition(rough[open_rows], self.k - 1, axis=1)[:, self.k - 1] + 2 * slack[open_rows]
        row, column = np.nonzero(rough <= most[:, None])
        distance = np.empty(len(row))
        for at in range(0, len(row), EXACT_ROWS):
            gap = rows[row[at : at + EXACT_ROWS], :-1] - part.matrix[column[at : at + EXACT_ROWS]]
            # rounded so that equal vectors tie exactly; the lower number then comes first
            distance[at : at + EXACT_ROWS] = np.round(np.einsum("ij,ij->i", gap, gap), 9)
        near = distance <= limit[row]
        self._keep(asked[row[near]], distance[near], part.number[column[near]])

    def _keep(self, row: np.ndarray, distance: np.ndarray, number: np.ndarray) -> None:
        met = np.unique(row)
        row = np.concatenate([np.repeat(met, self.k), row])
        distance = np.concatenate([self.distance[met].ravel(), distance])
        number = np.concatenate([self.number[met].ravel(), number])
        order = np.lexsort((number, distance, row))
        row = row[order]
        # every row has k entries at least: its own from before
        order = order[np.arange(len(row)) - np.searchsorted(row, row) < self.k]
        self.distance[met], self.number[met] = distance[order].reshape(-1, self.k), number[order].reshape(-1, self.k)
        self.limit[met] = np.minimum(self.limit[met], self.distance[met, -1])

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(test row, place from 0, distance, number) of the neighbours."""
        row, place = np.nonzero(self.number != NOT_MET)
        return row, place, self.distance[row, place], self.number[row, place]


def _nearest(k: int, train_id, matrix, labels, rows_at_once: int):
    def in_batches(batches):
        parts = [*_parts(np.arange(len(matrix)), matrix, k)]
        for batch in batches:
            if not len(batch):
                continue
            best = _Best(_matrix(batch["features"]), k, rows_at_once)
            for part in parts:
                best.meet(np.arange(len(batch)), part)
            row, place, distance, column = best.found()
            yield pd.DataFrame({
                "id": batch["id"].to_numpy()[row], "distance": distance, "neighbour": train_id[column],
                "neighbour_label": labels[column], "rank": place + 1,
            })

    return in_batches


class _Cells(NamedTuple):
    """Training rows in cells round pivots, and what the driver knows of the cells: a block has about so many rows of cells in a row."""

    rows: DataFrame | None
    pivots: np.ndarray
    sizes: np.ndarray
    nearest: np.ndarray
    farthest: np.ndarray
    block_rows: int

    def within(self, away: np.ndarray, square: np.ndarray, limit: np.ndarray, of=slice(None)) -> np.ndarray:
        """Cells that the triangle inequality leaves to test rows so far away from the pivots, with such squares and limits."""
        pivots, high = self.pivots[of], self.farthest[of]
        # a little more than the radius, for rounding: a vector of the cell is no longer than pivot and reach
        longest = (np.sqrt((pivots * pivots).sum(1)) + high)[None, :]
        slack = 1e-6 + 2 * np.sqrt(_error(pivots.shape[1], 2.0)) * (np.sqrt(square)[:, None] + longest)
        return (np.maximum(away - high, self.nearest[of] - away) <= np.sqrt(limit)[:, None] * (1 + 1e-9) + slack) & (self.sizes[of] > 0)

    def blocks(self) -> np.ndarray:
        """Which blocks (columns) have rows of the cells."""
        last = np.cumsum(self.sizes)
        of = np.arange(-(-last[-1] // self.block_rows))[None, :]
        return ((last - self.sizes)[:, None] // self.block_rows <= of) & (of <= (last - 1)[:, None] // self.block_rows) & (self.sizes > 0)[:, None]


def _in_a_chain(pivots: np.ndarray) -> np.ndarray:
    """Each pivot is followed by the nearest of those left, so that cells with near numbers are near to each other."""
    away, order = _distances(pivots, pivots), [0]
    while len(order) < len(pivots):
        away[:, order[-1]] = np.inf
        order.append(int(away[order[-1]].argmin()))
    return pivots[order]


def _cells(train: DataFrame, pivot_rows: int, block_rows: int, seed: int) -> _Cells:
    """Every training row goes to its nearest pivot; the pivots are ``pivot_rows`` rows drawn by a seeded digest."""
    drawn = train.orderBy(seeded_digest(seed, "id"), "id").limit(pivot_rows).toPandas()
    pivots = _in_a_chain(np.unique(_matrix(drawn["features"]), axis=0))

    def assign(batches):
        for batch in _pieces(batches):
            square = _distances(_matrix(batch["features"]), pivots)
            cell = square.argmin(1)
            yield batch.assign(cell=cell.astype("int32"), reach=np.sqrt(square[np.arange(len(batch)), cell]))

    # a new schema: add() would change the one that the frame keeps
    schema = T.StructType([*train.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("reach", T.DoubleType())])
    placed = staged(train.mapInPandas(assign, schema), "cells")
    known = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("reach").alias("low"), F.max("reach").alias("high")).collect()
    sizes, low, high = np.zeros(len(pivots), np.int64), np.full(len(pivots), np.inf), np.zeros(len(pivots))
    for row in known:
        sizes[row["cell"]], low[row["cell"]], high[row["cell"]] = row["n"], row["low"], row["high"]
    return _Cells(placed, pivots, sizes, low, high, block_rows)


def _pieces(batches, rows: int = 1024) -> Iterator[pd.DataFrame]:
    """Batches cut so that a matrix with a column per pivot stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]


def _per_cell(values: np.ndarray, cell: str = "cell") -> Column:
    """A literal array with one number per pivot, at the row's cell."""
    return F.get(F.array(*[F.lit(int(v)) for v in values]), F.col(cell))


def _dealt(cell: str, key: str, sizes: np.ndarray, rows: int) -> Column:
    """Blocks of about so many rows: cells in a row, a large cell over several blocks."""
    place = _per_cell(np.cumsum(sizes) - sizes, cell) + F.pmod(F.xxhash64(key), _per_cell(np.maximum(sizes, 1), cell))
    return F.floor(place / F.lit(rows)).cast("int")


def _compared(left: DataFrame, right: DataFrame, cells: _Cells, k: int, block: int, tiles: int) -> DataFrame:
    """(t, distance, r): the k nearest rows of each tile, from test rows (tile, t, features, limit) and training rows
    (tile, r, features, cell).

    A task holds the test rows of one tile at a time and reads the training rows cell by cell behind them.
    """
    spark = left.sparkSession
    known = cells._replace(rows=None)

    def nearest(batches):
        of, tests, best = None, [], None

        def neighbours():
            row, _, distance, number = best.found()
            t = np.concatenate([x["n"].to_numpy() for x in tests])
            return pd.DataFrame({"t": t[row], "distance": distance, "r": number})

        for batch in batches:
            tile, cell = batch["tile"].to_numpy(), batch["cell"].to_numpy()
            cuts = np.flatnonzero((np.diff(tile) != 0) | (np.diff(cell) != 0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(batch)]):
                if start == stop:
                    continue
                if tile[start] != of:
                    if best:
                        yield neighbours()
                    of, tests, best = tile[start], [], None
                run = batch.iloc[start:stop]
                if cell[start] < 0:
                    tests.append(run)
                    continue
                if not best:
                    best = _Best(np.concatenate([_matrix(x["features"]) for x in tests]), k, block, np.concatenate([x["limit"] for x in tests]))
                for part in _parts(run["n"].to_numpy(), _matrix(run["features"]), k):
                    best.meet(best.reaching(known, cell[start]), part)
        if best:
            yield neighbours()

    rows = left.select("tile", F.col("t").alias("n"), "features", "limit", F.lit(-1).alias("cell")).unionByName(
        right.select("tile", F.col("r").alias("n"), "features", F.lit(0.0).alias("limit"), "cell"))
    parts = min(tiles, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionById(max(parts, 1), F.col("tile")).sortWithinPartitions("tile", "cell", "n")
    return dealt.mapInPandas(nearest, "t long, distance double, r long")


def _distance_found(tests: DataFrame, cells: _Cells, k: int, block: int, test_rows: int) -> DataFrame:
    """(t, limit): the distance of the k-th nearest row in a test row's nearest cells, which hold k rows or all there are."""
    pairs = staged(searched_cells(tests.withColumn("limit", F.lit(None).cast("double")), cells, k), "pairs")
    asked = {r["cell"]: r["count"] for r in pairs.groupBy("cell").count().collect()}
    # a cell that many test rows ask for is read by several tasks, and so is one with many rows
    shares = np.array([-(-asked.get(c, 0) // test_rows) for c in range(len(cells.sizes))])
    blocks = -(-cells.sizes // cells.block_rows)
    tiles = shares * blocks
    up_to = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    tile = (_per_cell(np.cumsum(tiles) - tiles) + F.col("share") * _per_cell(blocks) + F.col("block")).cast("int")
    dealt = lambda key, n: F.pmod(F.xxhash64(key), _per_cell(np.maximum(n, 1)))
    left = pairs.withColumn("share", dealt("t", shares)).withColumn("block", up_to(_per_cell(blocks)))
    right = cells.rows.where(_per_cell(shares) > 0).withColumn("block", dealt("r", blocks)).withColumn("share", up_to(_per_cell(shares)))
    found = _compared(left.withColumn("tile", tile), right.withColumn("tile", tile), cells, k, block, int(tiles.sum()))
    return top_rows(found, ["t"], [F.col("distance"), F.col("r")], k).groupBy("t").agg(F.max("distance").alias("limit"))


def searched_cells(tests: DataFrame, cells: _Cells, k: int) -> DataFrame:
    """(t, features, limit, cell): cells that can hold one of the k nearest rows of (t, features, limit).

    Without a limit (null) the nearest cells that hold k rows together; with one, the distance of the k-th row found there,
    all other cells that the triangle inequality does not rule out.
    """
    known = cells._replace(rows=None)

    def choose(batches):
        for batch in _pieces(batches):
            matrix, limit = _matrix(batch["features"]), batch["limit"].to_numpy(dtype="float64", na_value=np.nan)
            away = np.sqrt(_distances(matrix, known.pivots))
            order = np.argsort(away, axis=1, kind="stable")
            before = np.cumsum(known.sizes[order], axis=1) - known.sizes[order]
            first = np.zeros(away.shape, bool)
            np.put_along_axis(first, order, before < k, axis=1)
            within = known.within(away, (matrix * matrix).sum(1), np.nan_to_num(limit, nan=0.0))
            row, cell = np.nonzero(np.where(np.isnan(limit)[:, None], first, within & ~first) & (known.sizes > 0))
            # a row for each cell: in pieces, since they may be many times the batch
            for at in range(0, len(row), 4096):
                part = row[at : at + 4096]
                yield pd.DataFrame({"t": batch["t"].to_numpy()[part], "features": batch["features"].to_numpy()[part],
                                    "limit": np.nan_to_num(limit, nan=np.inf)[part], "cell": cell[at : at + 4096].astype("int32")})

    return tests.select("t", "features", "limit").mapInPandas(
        choose, f"t long, features {tests.schema['features'].dataType.simpleString()}, limit double, cell int")


def searched_blocks(tests: DataFrame, cells: _Cells) -> DataFrame:
    """(t, features, limit, cell, blocks): a test row's nearest cell, and the blocks with cells that its limit leaves to it."""
    known = cells._replace(rows=None)

    def choose(batches):
        blocks = known.blocks().astype("float32")
        for batch in _pieces(batches):
            matrix = _matrix(batch["features"])
            away = np.sqrt(_distances(matrix, known.pivots))
            within = known.within(away, (matrix * matrix).sum(1), batch["limit"].to_numpy())
            asked = within.astype("float32") @ blocks > 0
            yield batch.assign(cell=away.argmin(1).astype("int32"), blocks=[np.flatnonzero(x).astype("int32") for x in asked])

    return tests.select("t", "features", "limit").mapInPandas(
        choose, f"t long, features {tests.schema['features'].dataType.simpleString()}, limit double, cell int, blocks array<int>")


def _in_cells(train: DataFrame, test: DataFrame, k: int, pivot_rows: int, block_rows: int, block: int, test_rows: int, seed: int) -> DataFrame:
    # numbers in the order of the ids, which may repeat
    cells = _cells(positions(train, [], [F.col("id").asc_nulls_last()], "r"), pivot_rows, block_rows, seed)
    tests = staged(test.withColumn("t", F.monotonically_increasing_id()), "tests")
    limits = _distance_found(tests, cells, k, block, test_rows)
    asked = staged(searched_blocks(tests.join(limits, "t"), cells), "asked")
    counts = np.zeros(len(cells.sizes), np.int64)
    for row in asked.groupBy("cell").count().collect():
        counts[row["cell"]] = row["count"]
    # test rows near to each other are compared by the same task, with the blocks that any of them asks for
    left = asked.withColumn("share", _dealt("cell", "t", counts, test_rows)).withColumn("block", F.explode("blocks"))
    right = cells.rows.withColumn("block", _dealt("cell", "r", cells.sizes, cells.block_rows))
    pairs = sorted(map(tuple, left.select("share", "block").distinct().collect()))
    tiles = F.broadcast(test.sparkSession.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "tile int, share int, block int"))
    found = _compared(left.join(tiles, ["share", "block"]), right.join(tiles, "block"), cells, k, block, len(pairs))
    best = found.withColumn("rank", F.row_number().over(W.partitionBy("t").orderBy("distance", "r"))).where(F.col("rank") <= k)
    named = cells.rows.select("r", F.col("id").alias("neighbour"), F.col("label").alias("neighbour_label"))
    return tests.select("t", "id").join(best.join(named, "r"), "t").select("id", "distance", "neighbour", "neighbour_label", "rank")


def nearest_neighbours(train: DataFrame, test: DataFrame, id_col: str, features: str, label: str, k: int,
                       test_block: int = TEST_BLOCK, max_train: int = MAX_TRAIN, pivots: int = PIVOTS, seed: int = 0) -> DataFrame:
    """Exact k nearest training rows of every test row, by squared Euclidean distance; of equal ones the lowest ids.

    Up to ``max_train`` training rows every task holds them all, and test rows are compared where they lie, ``test_block`` at
    a time, never shuffled. Beyond it training rows are kept in cells round ``pivots`` of them: a test row is compared
    with its nearest cells first, and then only with the cells that the triangle inequality does not rule out. A task holds
    ``TASK_TESTS`` x ``test_block`` test rows, and reads a block of training rows in batches. Rows without features, or with
    numbers in them that are null or not finite, are left out.
    """
    # floats are kept as they are until they are compared
    kind = "array<float>" if {df.select(features).dtypes[0][1] for df in (train, test)} == {"array<float>"} else "array<double>"
    finite = F.forall("features", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    row = lambda df: df.select(F.col(id_col).alias("id"), F.col(features).cast(kind).alias("features"),
                               F.col(label).alias("label")).where(finite)
    kinds = {f.name: f.dataType.simpleString() for f in row(train).schema}
    schema = f"id {row(test).schema['id'].dataType.simpleString()}, distance double, neighbour {kinds['id']}, neighbour_label {kinds['label']}, rank int"
    fitted = row(train).limit(max_train + 1).toPandas()
    if len(fitted) > max_train:
        return _in_cells(row(train), row(test), k, pivots, BLOCK_ROWS, test_block, TASK_TESTS * test_block, seed)
    fitted = fitted.sort_values("id")
    if fitted.empty:
        return test.sparkSession.createDataFrame([], schema)
    find = _nearest(min(k, len(fitted)), fitted["id"].to_numpy(), _matrix(fitted["features"]), fitted["label"].to_numpy(), test_block)
    return row(test).mapInPandas(find, schema)


def knn_classify(train: DataFrame, test: DataFrame, id_col: str, features: str, label: str, ks: list[int],
                 **blocks) -> DataFrame:
    """Majority vote of the k nearest rows for every k; on a tie the label met first wins."""
    near = nearest_neighbours(train, test, id_col, features, label, max(ks), **blocks)
    voted = near.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).where("rank <= k")
    votes = voted.groupBy("id", "k", "neighbour_label").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first"))
    chosen = votes.groupBy("id", "k").agg(
        F.max_by("neighbour_label", F.struct(F.col("n"), -F.col("first"))).alias("predicted"))
    actual = test.select(F.col(id_col).alias("id"), F.col(label).alias("label"))
    return chosen.join(actual, "id")


def error_rates(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("k").agg(
        F.avg((F.col("predicted") != F.col("label")).cast("double")).alias("error"), F.count(F.lit(1)).alias("rows"))
