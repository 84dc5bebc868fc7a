"""Row-order operators that keep working when one key holds most of the rows.

A window over ``partitionBy(key)`` sends a whole key to one task. Every operator here measures the groups first (one
column-pruned count with map-side combine). Groups of at most ``group_rows`` rows use the plain window. Beyond it the rows of
the larger keys are cut into blocks by bounds on the order, taken from a small sample and then fixed: the block is an
expression of the row, so that one exchange on (block, key) brings the rows together, nothing has to be
written in between, and a task that runs again finds the same blocks.

* Running aggregates are computed per block and topped up with the totals of the key's earlier blocks, which are
  aggregated on the map side; there is one row per block, so that side is broadcast.
* Lag, lead and rolling frames are computed per block; the few rows next to a block's edges, whose frame reaches into the
  neighbour, are computed again among the edge rows alone.

A whole table without keys, or an order that is not ascending with nulls first, is cut by a range exchange instead, which
a reliable checkpoint fixes, because its bounds are sampled again at every evaluation. ``order`` must be a total
order inside a key (end it with a unique column) or equal rows may be numbered either way.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablework.session import checkpointed
from tablework.sources.tables import staged

GROUP_ROWS = 5_000_000
GROUP_ROWS_CONF = "spark.tablework.groupRows"
# More blocks than this cost more in shuffle files than they save in block size; a larger block
# still streams through its window from a spilled sort.
MAX_BLOCKS = 20_000
# Sampled rows for each block bound.
SAMPLES_PER_BLOCK = 20
# An order column whose values compare as they sort: ascending, nulls first.
_ASCENDING = re.compile(r"Column<'(\w+)( ASC NULLS FIRST)?'>")

_INCLUSIVE = (W.unboundedPreceding, W.currentRow)
_EARLIER = (W.unboundedPreceding, -1)


def _group_rows(df: DataFrame, given: int | None) -> int:
    return given or int(df.sparkSession.conf.get(GROUP_ROWS_CONF, str(GROUP_ROWS)))


def group_extent(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """(rows of the largest group, rows in total)."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.max("n"), F.sum("n")).first()
    return row[0] or 0, row[1] or 0


def fits(df: DataFrame, keys: list[str], rows_per_row: int = 1, group_rows: int | None = None) -> bool:
    """Is every group small enough for a plain window, even if each row becomes ``rows_per_row`` rows?

    An operator with several passes over the same keys asks once and hands the answer on as ``bounded``.
    """
    return group_extent(df, keys)[0] * rows_per_row <= _group_rows(df, group_rows)


def _as_columns(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _agg(kind: str, value: Column) -> Column:
    if kind == "count":
        return F.count(value)
    if kind == "last":
        return F.last(value, ignorenulls=True)
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](value)


def _merge(kind: str, local: Column, carry: Column) -> Column:
    """Value over earlier blocks (carry) and this block (local); either may be null."""
    if kind in ("sum", "count"):
        both = local + carry
        return F.coalesce(both, local, carry)
    if kind == "last":
        return F.coalesce(local, carry)
    return {"min": F.least, "max": F.greatest}[kind](local, carry)


def _same(keys: list[str], other: str) -> Column:
    """Equal keys, nulls included, with the other side's keys prefixed."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"{other}{k}"))
    return on


def _ascending(order: list) -> list[str] | None:
    """Names of the order columns, None if one does not compare as it sorts."""
    names = [c if isinstance(c, str) else (m := _ASCENDING.fullmatch(str(c))) and m.group(1) for c in order]
    return names if all(names) else None


def _bounded_blocks(df: DataFrame, keys: list[str], order: list[str], sizes: DataFrame, limit: int) -> DataFrame:
    """Add ``_ord_block`` (0 for keys within the limit) and ``_ord_hot`` from fixed bounds on the order of each larger key."""
    at = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    hot = sizes.where(F.col("n") > limit).select(*[F.col(k).alias(f"_ord_hot_{k}") for k in keys])
    every = min(limit, SAMPLES_PER_BLOCK)
    # there are fewer than rows / limit such keys, and ``every`` sampled rows for each block
    sampled = df.join(F.broadcast(hot), _same(keys, "_ord_hot_")).select(*keys, at.alias("_ord_at"))
    if limit > every:
        sampled = sampled.sample(every / limit, seed=1)
    bounds = sampled.groupBy(*[F.col(k).alias(f"_ord_hot_{k}") for k in keys]).agg(F.sort_array(F.collect_list("_ord_at")).alias("_ord_all"))
    bounds = bounds.withColumn("_ord_all", F.filter("_ord_all", lambda b, i: i % every == every - 1))
    # in groups of about the root of their number: a row compares with the first of each, then within one
    bounds = bounds.withColumn("_ord_width", F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("_ord_all")))).cast("int"))
    steps = F.expr("if(size(_ord_all) > 0, sequence(0, cast((size(_ord_all) - 1) div _ord_width as int)), array())")
    bounds = bounds.withColumn("_ord_bounds", F.transform(steps, lambda i: F.slice("_ord_all", i * F.col("_ord_width") + 1, F.col("_ord_width")))).drop("_ord_all")
    # collected, so that they are the same in every evaluation: at most MAX_BLOCKS bounds
    bounds = df.sparkSession.createDataFrame(bounds.collect(), bounds.schema)
    placed = df.withColumn("_ord_at", at).join(F.broadcast(bounds), _same(keys, "_ord_hot_"), "left")
    group = F.size(F.filter("_ord_bounds", lambda g: g[0] <= F.col("_ord_at")))
    inside = F.size(F.filter(F.get("_ord_bounds", group - 1), lambda b: b <= F.col("_ord_at")))
    block = F.when(F.col("_ord_bounds").isNull() | (group == 0), 0).otherwise((group - 1) * F.col("_ord_width") + inside)
    return placed.select(*df.columns, block.alias("_ord_block"), F.col("_ord_bounds").isNotNull().alias("_ord_hot"))


def _blocked(df: DataFrame, keys: list[str], order: list, group_rows: int | None, bounded: bool) -> DataFrame | None:
    """None when a plain window is safe, else the rows with ``_ord_block`` and ``_ord_hot``."""
    if bounded:
        return None
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    limit = _group_rows(df, group_rows)
    if (largest or 0) <= limit:
        return None
    limit = max(limit, math.ceil(total / MAX_BLOCKS))
    names = _ascending(order)
    if keys and names:
        return _bounded_blocks(df, keys, names, sizes, limit)
    by = [F.col(k) for k in keys] + _as_columns(order)
    ranged = df.repartitionByRange(max(2, math.ceil(total / limit)), *by)
    return checkpointed(ranged.withColumns({"_ord_block": F.spark_partition_id(), "_ord_hot": F.lit(True)}))


def _block_totals(blocked: DataFrame, keys: list[str], order: list, outputs: dict) -> DataFrame:
    """One row per (block, key) of the cut keys: the aggregates over the whole block."""
    hot, names = blocked.where("_ord_hot"), _ascending(order)
    if names or all(kind != "last" for kind, _ in outputs.values()):
        at = F.struct(*names) if names else None
        totals = [(F.max_by(v, F.when(v.isNotNull(), at)) if k == "last" else _agg(k, v)).alias(f"_carry_{o}") for o, (k, v) in outputs.items()]
        return hot.groupBy("_ord_block", *keys).agg(*totals)
    w = W.partitionBy("_ord_block", *keys).orderBy(*_as_columns(order))
    ends = hot.withColumns({f"_carry_{o}": _agg(k, v).over(w.rowsBetween(*_INCLUSIVE)) for o, (k, v) in outputs.items()})
    return ends.withColumn("_next", F.lead(F.lit(1)).over(w)).where("_next IS NULL").select("_ord_block", *keys, *[f"_carry_{o}" for o in outputs])


def _running_in_blocks(blocked: DataFrame, keys: list[str], order: list, outputs: dict, earlier: bool) -> DataFrame:
    w = W.partitionBy("_ord_block", *keys).orderBy(*_as_columns(order)).rowsBetween(*(_EARLIER if earlier else _INCLUSIVE))
    across = W.partitionBy(*keys).orderBy("_ord_block").rowsBetween(*_EARLIER)
    before = {f"_carry_{o}": _agg("sum" if k == "count" else k, F.col(f"_carry_{o}")).over(across) for o, (k, _) in outputs.items()}
    # one row per block, of which there are MAX_BLOCKS at most
    carries = _block_totals(blocked, keys, order, outputs).withColumns(before).withColumnsRenamed({c: f"_of_{c}" for c in ["_ord_block", *keys]})
    local = blocked.withColumns({o: _agg(k, v).over(w) for o, (k, v) in outputs.items()})
    topped = local.join(F.broadcast(carries), _same(["_ord_block", *keys], "_of_"), "left")
    return topped.withColumns({o: _merge(k, F.col(o), F.col(f"_carry_{o}")) for o, (k, _) in outputs.items()})


def running(df: DataFrame, keys: list[str], order, outputs: dict, *, earlier: bool = False,
            bounded: bool = False, group_rows: int | None = None) -> DataFrame:
    """Add running aggregates per key.

    ``outputs`` maps a new column to ``(kind, Column)`` with kind sum, min, max, count or last (last
    non-null). ``earlier=True`` leaves the current row out of its own frame. ``bounded=True`` states
    that the group size has a bound by construction (for example one row per calendar month).
    """
    blocked = _blocked(df, keys, order, group_rows, bounded)
    if blocked is None:
        w = W.partitionBy(*keys).orderBy(*_as_columns(order)).rowsBetween(*(_EARLIER if earlier else _INCLUSIVE))
        return df.withColumns({o: _agg(k, v).over(w) for o, (k, v) in outputs.items()})
    return _running_in_blocks(blocked, keys, order, outputs, earlier).select(*df.columns, *outputs)


def _numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Global numbers with one shuffle: the place in a sorted range block plus the rows of the blocks before it.

    The low bits of ``monotonically_increasing_id`` are the place, the high bits the block. Both are written with the
    rows, so the sampled range bounds and the places stay as they are.
    """
    place = F.monotonically_increasing_id()
    blocks = staged(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place), "numbered")
    block, low = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    before = W.orderBy("_block").rowsBetween(*_EARLIER)
    # one row per block
    sizes = blocks.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = blocks.withColumn("_block", block).join(F.broadcast(offsets), "_block")
    return numbered.select(*df.columns, (F.col("_offset") + low).alias(name))


def positions(df: DataFrame, keys: list[str], order, name: str = "pos", **options) -> DataFrame:
    """Number the rows of each key from 0 in the given order; ``keys=[]`` numbers the whole table."""
    if not keys:
        return _numbered(df, _as_columns(order), name)
    numbered = running(df, keys, order, {name: ("count", F.lit(1))}, **options)
    return numbered.withColumn(name, F.col(name) - 1)


def _framed(df, keys, order, outputs, back: int, ahead: int, bounded, group_rows):
    """Window columns whose frame reaches at most ``back`` rows back and ``ahead`` rows forward.

    ``outputs`` maps a name to a function of the window specification.
    """
    blocked = _blocked(df, keys, order, group_rows, bounded)
    if blocked is None:
        w = W.partitionBy(*keys).orderBy(*_as_columns(order))
        return df.withColumns({o: make(w) for o, make in outputs.items()})
    w = W.partitionBy("_ord_block", *keys).orderBy(*_as_columns(order))
    rows = F.count(F.lit(1)).over(W.partitionBy("_ord_block", *keys))
    local = blocked.withColumns({**{o: make(w) for o, make in outputs.items()}, "_ord_nth": F.row_number().over(w)})
    local = local.withColumn("_ord_after", rows - F.col("_ord_nth"))
    near = lambda first, last: F.col("_ord_hot") & ((F.col("_ord_nth") <= first) | (F.col("_ord_after") < last))
    # a row whose frame leaves the block finds all of it among this many rows on either side of the edge
    edges = local.where(near(back + ahead, back + ahead))
    across = W.partitionBy(*keys).orderBy("_ord_block", "_ord_nth")
    again = edges.withColumns({o: make(across) for o, make in outputs.items()}).where(near(back, ahead))
    return local.where(~near(back, ahead)).unionByName(again).select(*df.columns, *outputs)


def shifted(df: DataFrame, keys: list[str], order, outputs: dict, *, bounded: bool = False,
            group_rows: int | None = None) -> DataFrame:
    """Lag (positive offset) and lead (negative offset): ``{name: (Column, offset)}``."""
    back = max([n for _, n in outputs.values() if n > 0], default=0)
    ahead = max([-n for _, n in outputs.values() if n < 0], default=0)
    made = {o: (lambda w, c=c, n=n: F.lag(c, n).over(w)) for o, (c, n) in outputs.items()}
    return _framed(df, keys, order, made, back, ahead, bounded, group_rows)


def rolling(df: DataFrame, keys: list[str], order, rows: int, outputs: dict, *, bounded: bool = False,
            group_rows: int | None = None) -> DataFrame:
    """Aggregates over the current and the ``rows - 1`` preceding rows: ``{name: (kind, Column)}``."""
    made = {
        o: (lambda w, k=k, v=v: _agg(k, v).over(w.rowsBetween(1 - rows, 0))) for o, (k, v) in outputs.items()
    }
    return _framed(df, keys, order, made, rows - 1, 0, bounded, group_rows)
