"""Near duplicates among vectors, by counting collisions on one-dimensional projections.

Every vector is projected on many random directions. Some projections are cut at their median: their signs name a cell,
one set of cuts per table. A vector lives in its own cell and visits every cell that its query-centred window of half-width
``REACH`` touches, so a pair meets unless a cut falls between the two and outside both windows. Inside a cell the other
projections count: a pair whose values differ by at most ``WINDOW`` on ``least`` of ``COUNTED`` directions is verified with
its exact cosine. ``least`` follows from the wanted recall of a pair right at the threshold, and the number of tables from
the recall measured on all vectors, each paired with an artificial partner at the threshold; there are as many tables as
that recall takes.
"""

from __future__ import annotations

import logging
import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tablework.llm.common import picked, prepare, stage
from tablework.llm.components import components

COUNTED = 16
# Vectors per cell that the number of cuts aims at, and rows of one side of a block that one task compares at once.
CELL = 128
BLOCK = 1024
# Most tables of the first try; twice as many are tried as long as they do not reach the recall.
MOST_TABLES = 16
RECALL = 0.995
_OUT = "id long, links long, a long, b long"


def directions(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def units(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def least_collisions(window: float, distance: float, recall: float = 0.9999) -> int:
    """Largest count that a pair at ``distance`` reaches on ``COUNTED`` directions with the wanted probability."""
    p = math.erf(window / distance / math.sqrt(2))
    tail = 0.0
    for count in range(COUNTED, -1, -1):
        tail += math.comb(COUNTED, count) * p**count * (1 - p) ** (COUNTED - count)
        if tail >= recall:
            return count
    return 0


def codes(values: np.ndarray, cuts: np.ndarray, reach: float, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(own cell, levels whose cut lies inside the window) of each table, as bits."""
    offset = (values - cuts).reshape(len(values), -1, levels) if levels else np.zeros((len(values), len(cuts) or 1, 0))
    bits = 1 << np.arange(levels, dtype=np.int64)
    return ((offset > 0) * bits).sum(axis=2), ((np.abs(offset) <= reach) * bits).sum(axis=2)


def meets(home, visitor, open_levels):
    """Does the visitor's window reach the home's cell?"""
    return ((home ^ visitor) & ~open_levels) == 0


def _projected(vector: Column, count: int, seed: int) -> Column:
    @F.pandas_udf("struct<vector: binary, values: array<float>>")
    def made(vectors: pd.Series) -> pd.DataFrame:
        out: list = [None] * len(vectors)
        sizes = vectors.map(len).to_numpy()
        for dim in np.unique(sizes):
            at = np.nonzero(sizes == dim)[0]
            unit = units(np.array([vectors.iloc[i] for i in at], dtype=np.float64))
            values = (unit @ directions(int(dim), count, seed)).astype(np.float32)
            for k, i in enumerate(at):
                out[i] = (unit[k].tobytes(), values[k])
        return pd.DataFrame(out, columns=["vector", "values"])

    return made(vector)


def _coded(tables: int, levels: int, reach: float) -> Column:
    @F.pandas_udf("struct<own: array<long>, open: array<long>>")
    def made(values: pd.Series, cuts: pd.Series) -> pd.DataFrame:
        v, c = np.array(values.tolist(), np.float64), np.array(cuts.tolist(), np.float64)
        used = tables * levels
        if not levels:
            zero = [np.zeros(1, np.int64)] * len(values)
            return pd.DataFrame({"own": zero, "open": zero})
        own, opened = codes(v[:, :used], c[:, :used], reach, levels)
        return pd.DataFrame({"own": list(own), "open": list(opened)})

    return made("values", "cuts")


def partners(unit: np.ndarray, distance: float, seed: int) -> np.ndarray:
    """For every unit vector another one at ``distance``, in a direction that the vector itself seeds."""
    if unit.shape[1] < 2:  # nothing lies at a distance there but the opposite
        return unit
    other = np.array([np.random.default_rng([seed, zlib.crc32(x.tobytes())]).standard_normal(len(x)) for x in unit])
    other -= (other * unit).sum(axis=1, keepdims=True) * unit
    cosine = 1 - distance * distance / 2
    return cosine * unit + math.sqrt(1 - cosine * cosine) * units(other)


def meetings(unit: np.ndarray, values: np.ndarray, cuts: np.ndarray, levels: int, distance: float, reach: float, seed: int) -> np.ndarray:
    """Does a vector with these projections meet its artificial partner? One column per table."""
    used = cuts.shape[-1]
    # as many directions as the vectors were projected on: another number would be other directions
    axes = directions(unit.shape[1], used + COUNTED, seed)[:, :used]
    there = (partners(unit, distance, seed) @ axes).astype(np.float32).astype(np.float64)
    a, a_open = codes(values, cuts, reach, levels)
    b, b_open = codes(there, cuts, reach, levels)
    return meets(a, b, b_open) | meets(b, a, a_open)


def _enough(found: list[float]) -> int | None:
    """Number of tables that reach ``RECALL``, from the share of pairs met by the first table, the first two, ..."""
    for tables, recall in enumerate(found, 1):
        if recall >= RECALL:
            return tables
    logging.getLogger(__name__).warning("%d tables meet %.4f of the pairs at the threshold, %.4f wanted", len(found), found[-1], RECALL)
    return None


def _calibrated(vectors: np.ndarray, cuts: np.ndarray, levels: int, distance: float, reach: float, seed: int) -> int:
    """Number of tables, out of ``MOST_TABLES``, that vectors in memory need; all of them if they do not reach the recall."""
    if not levels or not len(vectors):
        return 1
    values = vectors @ directions(vectors.shape[1], len(cuts) + COUNTED, seed)[:, : len(cuts)]
    met = meetings(vectors, values, cuts, levels, distance, reach, seed)
    return _enough(list(np.maximum.accumulate(met, axis=1).mean(axis=0))) or MOST_TABLES


def _first_meeting(tables: int, levels: int, distance: float, reach: float, seed: int) -> Column:
    """Number of the table, from 0, in which a vector first meets its artificial partner; ``tables`` if in none."""

    @F.pandas_udf("int")
    def made(vectors: pd.Series, values: pd.Series, cuts: pd.Series) -> pd.Series:
        out, sizes = np.full(len(vectors), tables, np.int32), vectors.map(len).to_numpy()
        for size in np.unique(sizes):
            at = np.nonzero(sizes == size)[0]
            unit = np.frombuffer(b"".join(vectors.iloc[at]), np.float64).reshape(len(at), -1)
            v, c = (np.array(part.iloc[at].tolist(), np.float64)[:, : tables * levels] for part in (values, cuts))
            met = meetings(unit, v, c, levels, distance, reach, seed)
            out[at] = np.where(met.any(axis=1), met.argmax(axis=1), tables)
        return pd.Series(out)

    return made("vector", "values", "cuts")


def recall_by_tables(placed: DataFrame, tables: int, levels: int, distance: float, reach: float, seed: int) -> list[float]:
    """Share of all vectors of (dim, vector, values, cuts) that meet a partner at the threshold in the first table, the first two, ...

    Of several lengths of vectors the one with the lowest share counts.
    """
    first = placed.select("dim", _first_meeting(tables, levels, distance, reach, seed).alias("first"))
    shares = first.groupBy("dim").agg(*[F.avg((F.col("first") <= t).cast("double")).alias(f"t{t}") for t in range(tables)])
    return list(shares.agg(*[F.min(f"t{t}") for t in range(tables)]).first())


def compare_block(block: pd.DataFrame, table: int, cosine: float, window: float, least: int) -> pd.DataFrame:
    """Links between the residents and the visitors of a block.

    A pair can meet in several cells; it is counted only at the first meeting, which both rows' codes tell. For components
    the links of a block shrink to one edge per row, found by spreading the least id.
    """
    home, guest = block[~block.visit], block[block.visit]
    empty = pd.DataFrame({"id": [], "links": [], "a": [], "b": []}).astype("int64")
    if home.empty or guest.empty:
        return empty

    def columns(part):
        n = len(part)
        stacked = lambda c, kind: np.frombuffer(b"".join(part[c]), kind).reshape(n, -1)
        return (part.id.to_numpy(), part.copies.to_numpy(), stacked("vector", np.float64),
                np.array(part["counted"].tolist(), np.float32), np.array(part.own.tolist(), np.int64),
                np.array(part["open"].tolist(), np.int64))

    h_id, h_n, h_vec, h_val, h_own, h_open = columns(home)
    v_id, v_n, v_vec, v_val, v_own, v_open = columns(guest)
    collisions = np.zeros((len(h_id), len(v_id)), np.int8)
    for k in range(COUNTED):
        collisions += np.abs(h_val[:, k, None] - v_val[None, :, k]) <= window
    r, c = np.nonzero((collisions >= least) & (h_id[:, None] != v_id[None, :]))
    if not len(r):
        return empty
    linked = np.concatenate([
        (h_vec[r[i : i + 65536]] * v_vec[c[i : i + 65536]]).sum(axis=1) for i in range(0, len(r), 65536)
    ]) >= cosine
    r, c = r[linked], c[linked]
    seen = np.zeros(len(r), bool)
    for t in range(table + 1):
        guest_came = meets(h_own[r, t], v_own[c, t], v_open[c, t])
        home_went = meets(v_own[c, t], h_own[r, t], h_open[r, t])
        # in the table itself the meeting at the smaller id's cell comes first
        seen |= (guest_came | home_went) if t < table else (home_went & (v_id[c] < h_id[r]))
    first_r, first_c = r[~seen], c[~seen]
    h_links = np.bincount(first_r, v_n[first_c], len(h_id)).astype(np.int64)
    v_links = np.bincount(first_c, h_n[first_r], len(v_id)).astype(np.int64)
    h_label, v_label = h_id.copy(), v_id.copy()
    while True:
        was = h_label.sum() + v_label.sum()
        np.minimum.at(h_label, r, v_label[c])
        np.minimum.at(v_label, c, h_label[r])
        if h_label.sum() + v_label.sum() == was:
            break
    ids, labels = np.concatenate([h_id, v_id]), np.concatenate([h_label, v_label])
    links = np.concatenate([h_links, v_links])
    some = (links > 0) | (ids != labels)
    return pd.DataFrame({"id": ids[some], "links": links[some], "a": ids[some], "b": labels[some]})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95,
                    seed: int = 11) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Equal vectors are one class with a number of copies, so a group of copies costs one row. Vectors that are null, empty,
    zero, or hold a null or non-finite component link with nothing, and vectors of different length do not link. A repeated
    row is one more vector. A null id counts after all others: component_id is null only if no vector of the component
    has an id, and kept is then false. An empty table gives no rows; other columns are not looked at.
    """
    prepare(vectors.sparkSession)
    rows = picked(vectors, vec_id=id_col, vector=vector_col)
    usable = F.col("vector").isNotNull() & F.coalesce(
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0),
        F.lit(False),
    )
    good = rows.where(usable)
    classes = stage(
        good.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("id", F.monotonically_increasing_id()),  # written at once, so fixed from here on
        "vectors",
    )
    links, roots = _linked(classes, cosine, seed)
    placed = classes.join(roots, classes.id == roots.node, "left").select("id", "vec_id", F.coalesce("root", "id").alias("root"))
    heads = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    found = (
        placed.join(heads, "root").join(links, "id", "left")
        .select("id", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    )
    by_vector = classes.select("id", "vector", "copies").join(found, "id").drop("id")
    joined = good.join(by_vector, "vector").select(
        "vec_id", (F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"), "component_id"
    )
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _linked(classes: DataFrame, cosine: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(id, links) and (node, root) of the classes that have a link."""
    distance = math.sqrt(2 - 2 * cosine)
    reach, window = 0.95 * distance, 2 * distance
    least = least_collisions(window, distance)
    total = classes.count()
    levels = max(0, math.ceil(math.log2(total / CELL))) if total else 0
    at_hand, tables = MOST_TABLES, 1
    while True:
        cutting = at_hand * levels
        projected = stage(
            classes.select("id", "copies", F.size("vector").alias("dim"), _projected(F.col("vector"), cutting + COUNTED, seed).alias("p"))
            .select("id", "copies", "dim", "p.*"),
            "projected",
        )
        medians = stage(
            projected.groupBy("dim").agg(
                F.array(*[F.percentile_approx(F.col("values")[i], 0.5, 200) for i in range(cutting)]).cast("array<float>").alias("cuts")
            ),
            "cuts",
        )
        placed = projected.join(medians, "dim")
        if not levels:
            break
        enough = _enough(recall_by_tables(placed, at_hand, levels, distance, reach, seed))
        if enough:
            tables = enough
            break
        at_hand *= 2
    counted = F.slice("values", cutting + 1, COUNTED)
    coded = stage(
        placed.select("id", "copies", "dim", "vector", counted.alias("counted"), _coded(tables, levels, reach).alias("c"))
        .select("id", "copies", "dim", "vector", "counted", "c.*"),
        "coded",
    )
    # all cells whose cuts differ from the own cell only where the window is open
    subsets = F.aggregate(
        F.filter(F.sequence(F.lit(0), F.lit(levels)), lambda i: F.getbit("_open", i) == 1),
        F.array(F.lit(0).cast("long")),
        lambda found, i: F.concat(found, F.transform(found, lambda x: x + F.pow(F.lit(2.0), i).cast("long"))),
    )
    spread = coded.select("*", F.posexplode("own").alias("t", "_own")).withColumn("_open", F.element_at("open", F.col("t") + 1))
    guests = spread.withColumn("cell", F.explode(F.transform(subsets, lambda x: x.bitwiseXOR(F.col("_own"))))).withColumn("visit", F.lit(True))
    homes = spread.withColumn("cell", F.col("_own")).withColumn("visit", F.lit(False))
    key = ["t", "dim", "cell"]
    sizes = stage(
        guests.select(*key, F.lit(0).alias("h"), F.lit(1).alias("g")).unionByName(homes.select(*key, F.lit(1).alias("h"), F.lit(0).alias("g")))
        .groupBy(*key).agg(F.sum("h").alias("h"), F.sum("g").alias("g")).where((F.col("h") > 0) & (F.col("g") > 1))
        .select(*key, F.ceil(F.col("h") / BLOCK).cast("int").alias("hs"), F.ceil(F.col("g") / BLOCK).cast("int").alias("gs")),
        "cells",
    )
    # a crowded cell is cut into blocks: every part of the residents meets every part of the visitors once
    part = F.pmod(F.xxhash64("id"), F.when(F.col("visit"), F.col("gs")).otherwise(F.col("hs"))).cast("int")
    across = F.sequence(F.lit(0), F.when(F.col("visit"), F.col("hs")).otherwise(F.col("gs")) - 1)
    wanted = ["t", "dim", "cell", "visit", "id", "copies", "vector", "counted", "own", "open"]
    blocks = (
        guests.select(*wanted).unionByName(homes.select(*wanted)).join(sizes, key)
        .withColumn("part", part).withColumn("other", F.explode(across))
        .withColumn("i", F.when(F.col("visit"), F.col("other")).otherwise(F.col("part")))
        .withColumn("j", F.when(F.col("visit"), F.col("part")).otherwise(F.col("other")))
        .drop("part", "other", "hs", "gs")
    )

    def compare(key, block):
        return compare_block(block, int(key[0]), cosine, window, least)

    found = stage(blocks.groupBy("t", "dim", "cell", "i", "j").applyInPandas(compare, _OUT), "links")
    return found.groupBy("id").agg(F.sum("links").alias("links")), components(found.select("a", "b"))
