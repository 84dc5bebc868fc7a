"""Matrices as coordinate tables (i, k, v), and products with dense rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

# Rows and columns of a tile.
TILE = 64


def coordinates(df: DataFrame, row: str, values: str, *keep: str) -> DataFrame:
    """Array column to one row per element."""
    exploded = df.select(F.col(row).alias("i"), *keep, F.posexplode(values).alias("k", "v"))
    return exploded.withColumn("v", F.col("v").cast("double"))


def product(a: DataFrame, b: DataFrame) -> DataFrame:
    """(i, k, v) times (k, j, v) as a join on k and a sum per (i, j)."""
    right = b.select("k", "j", F.col("v").alias("_w"))
    return a.join(right, "k").groupBy("i", "j").agg(F.sum(F.col("v") * F.col("_w")).alias("v"))


def column_tiles(b: DataFrame, tile: int = TILE) -> DataFrame:
    """(k, j, v) as dense tiles: (part, columns), the columns j of one tile with their values for ``tile`` neighbouring k.

    A tile holds about ``tile`` columns; what is missing in one counts as 0.
    """
    groups = math.ceil(b.select("j").distinct().count() / tile) or 1
    cells = b.groupBy(F.floor(F.col("k") / tile).cast("int").alias("part"), "j").agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("k") % tile).cast("int"), "v"))).alias("cells"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(tile - 1)), lambda p: F.coalesce(F.try_element_at("cells", p), F.lit(0.0)))
    column = F.struct("j", dense.alias("values"))
    return cells.groupBy("part", F.pmod(F.xxhash64("j"), F.lit(groups)).alias("_group")).agg(
        F.collect_list(column).alias("columns")).drop("_group")


def tiled_product(rows: DataFrame, row: str, values: str, b: DataFrame, tile: int = TILE) -> DataFrame:
    """Rows of a dense matrix, as arrays, times (k, j, v): (i, j, v).

    A row is cut into parts of ``tile`` values, and each part meets the tiles of its place: their dot products are made
    inside arrays, so what is shuffled afterwards is one number per row, column and part, combined before the
    shuffle; with a single part nothing is. Null values count as 0, null rows are left out.
    """
    parts = F.expr(f"transform(sequence(0, cast(ceil(size({values}) / {tile}) as int) - 1), p -> slice({values}, p * {tile} + 1, {tile}))")
    sliced = rows.where(F.size(values) > 0).select(F.col(row).alias("i"), F.posexplode(parts).alias("part", "slice"))
    tiles = column_tiles(b, tile)
    dot = F.expr("transform(columns, c -> struct(c.j AS j, aggregate(zip_with(slice, c.values, (x, y) -> coalesce(x * y, 0D)), 0D, (s, x) -> s + x) AS v))")
    cells = sliced.join(tiles, "part").select("i", F.inline(dot))
    longest = rows.agg(F.max(F.size(values))).first()[0] or 0
    return cells if longest <= tile else cells.groupBy("i", "j").agg(F.sum("v").alias("v"))
