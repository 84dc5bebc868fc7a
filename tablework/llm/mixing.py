"""Mixing sources to target weights, without a row of Python.

Sizes are word counts. Sources in code point order (null last) take the weights in turn and share ``share`` times the
words of all; a target stops at ``most`` times its source's words and the excess goes to the others by weight. A keyed
hash is the fixed random permutation of a source: the digits of that hash cut it into blocks, blocks of digits into
smaller ones. A target is so many whole passes over the source plus the first rows of its permutation; the row
where it ends is found digit by digit, from sums per digit, so no source is ever sorted or held in one task.

The block draws of all passes are then split among output shards along a binary tree. In each node the draws
are put in keyed random order and cut in two at the quota of the left child, which makes the sources' numbers in
both halves multivariate hypergeometric, with no draw lost or used twice. Rows follow their block to its shard and
are shuffled there by sorting on another keyed hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablework.llm.common import picked_rows, prepare, settled, stage, word_count
from tablework.operators.ordered import positions

# Of the 63 bits of the permutation the first BLOCK_BITS name a block; the end of a target is searched in steps of STEP_BITS.
HASH_BITS = 63
BLOCK_BITS = 7
STEP_BITS = 14


def _permutation(seed: int, *columns: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)


def source_targets(sources: DataFrame, weights, share: float, most: float) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Every round gives what is left to the sources that are not full; those that would go above ``most`` times their size
    are filled. The rounds end when none is above, after at most one round per source and mostly after three.
    """
    ranked = positions(sources, [], [F.col("source").asc_nulls_last()], "at")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    table = stage(ranked.withColumn("weight", weight).drop("at").withColumn("full", F.lit(False)), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    while True:
        state = table.agg(
            F.sum(F.when(F.col("full"), F.col("source_size") * most)).alias("filled"),
            F.sum(F.when(~F.col("full"), F.col("weight"))).alias("open"),
            F.sum(F.when(F.col("full"), 1)).alias("n"),
        ).first()
        per_weight = (total * share - (state["filled"] or 0.0)) / state["open"] if state["open"] else 0.0
        due = F.col("weight") * F.lit(per_weight)
        above = ~F.col("full") & (due > F.col("source_size") * most)
        if not table.where(above).take(1):
            break
        table = stage(table.withColumn("full", F.col("full") | above), "sources")
    target = F.when(F.col("full"), F.col("source_size") * F.lit(float(most))).otherwise(due)
    return table.select("source", "source_size", "weight", target.alias("target"))


def _ends(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, passes, end): whole passes, and the hash below which rows are taken once more.

    Each step sums the words per digit inside the current stretch, finds the digit in which the remainder ends, and goes
    on inside it. What is left at the end is one hash value, so the words taken differ from the target by
    less than one row (rows that share an id and a text share a hash and are taken or left together).
    """
    size = F.greatest(F.col("source_size"), F.lit(1))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / size + 1e-12)).otherwise(F.lit(0)).cast("long")
    state = stage(
        targets.select("source", passes.alias("passes"), (F.col("target") - passes * F.col("source_size")).alias("rest"))
        .withColumn("low", F.lit(0).cast("long")),
        "ends",
    )
    shift = HASH_BITS
    while shift:
        step = min(STEP_BITS, shift)
        digit = F.shiftrightunsigned(F.col("hash"), shift - step)
        here = F.shiftrightunsigned(F.col("hash"), shift) == F.shiftrightunsigned(F.col("low"), shift) if shift < HASH_BITS else F.lit(True)
        start = state.select(F.col("source").alias("_source"), "low", "rest")
        sums = (
            sized.join(start, F.col("source").eqNullSafe(F.col("_source"))).where(here)
            .groupBy("source", digit.alias("digit")).agg(F.sum("size").alias("size"))
        )
        # at most 2^STEP_BITS rows per source, whatever its size
        by_digit = F.array_sort(F.collect_list(F.struct("digit", "size")))
        listed = sums.groupBy("source").agg(by_digit.alias("digits"))
        joined = state.join(listed.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
        walked = F.aggregate(
            F.coalesce("digits", F.array().cast("array<struct<digit: long, size: long>>")),
            F.struct(F.col("rest").alias("rest"), F.lit(None).cast("long").alias("at")),
            lambda acc, d: F.when(acc["at"].isNotNull(), acc)
            .when(acc["rest"] < d["size"], F.struct(acc["rest"].alias("rest"), d["digit"].alias("at")))
            .otherwise(F.struct((acc["rest"] - d["size"]).alias("rest"), F.lit(None).cast("long").alias("at"))),
        )
        # past the last digit only when the rest is used up to rounding: everything before the end of the stretch
        low = F.when(F.col("w.at").isNotNull(), F.shiftleft(F.col("w.at"), shift - step)).otherwise(F.col("low"))
        state = stage(
            joined.withColumn("w", walked).select("source", "passes", F.col("w.rest").alias("rest"), low.alias("low")),
            "ends",
        )
        shift -= step
    return state.select("source", "passes", F.col("low").alias("end"), "rest")


def _halves(draws: DataFrame, seed: int, levels: int) -> DataFrame:
    """(source, block, pass, shard): the draws split along a tree of ``levels`` levels."""
    nodes = stage(draws.withColumn("shard", F.lit(0)), "draws")
    for level in range(levels):
        order = F.xxhash64(F.lit(seed), F.lit(level), "source", "block", "pass")
        numbered = positions(nodes.withColumn("_o", order), ["shard"], ["_o", "source", "block", "pass"], "_at")
        sizes = nodes.groupBy("shard").agg(F.count(F.lit(1)).alias("_n"))
        right = (F.col("_at") * 2 >= F.col("_n")).cast("int")
        nodes = stage(
            numbered.join(F.broadcast(sizes), "shard").withColumn("shard", F.col("shard") * 2 + right).drop("_o", "_at", "_n"),
            "tree",
        )
    return nodes


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            weights=(3, 1, 2), share: float = 1.5, most: float = 2.0, shards: int = 16, seed: int = 42) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, copies and shards.

    taken is size times copies; shards lists the output shard of each copy. ``shards`` is a power of two and ``most`` a
    whole number. A null text has size 0; null is a source of its own; null ids are hashed like any value; repeated rows (same
    id, source and text) share one draw; an empty table gives no rows; other columns are not looked at. Reruns agree,
    since everything follows from keyed hashes of the rows.
    """
    prepare(docs.sparkSession)
    rows = settled(docs, "mix-input")
    sized = stage(
        picked_rows(rows, doc_id=id_col, source=source_col, text=text_col).select(
            "row", "doc_id", "source", word_count(F.col("text")).alias("size"),
            _permutation(seed, "doc_id", "source", "text").alias("hash"),
        ),
        "sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(sources, weights, share, most), "targets")
    ends = _ends(sized, targets)
    plan = stage(
        targets.join(ends.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source"),
        "plan",
    )
    # a block is drawn once in every pass; the last, partial pass draws the blocks up to its end
    block = F.shiftrightunsigned(F.col("hash"), HASH_BITS - BLOCK_BITS)
    whole = plan.select("source", "passes", "end", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((1 << BLOCK_BITS) - 1).cast("long"))).alias("block"))
    partly = (F.shiftleft("block", HASH_BITS - BLOCK_BITS) < F.col("end")).cast("long")
    drawn = F.col("passes") + partly
    draws = whole.where(drawn > 0).select("source", "block", F.explode(F.sequence(F.lit(1).cast("long"), drawn)).alias("pass"))
    placed = _halves(draws, seed, (shards - 1).bit_length())
    block_shards = placed.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("placed"))
    # whole texts are hashed once, above; from here on rows are a few numbers wide
    taken = sized.withColumn("block", block).join(
        plan.select(F.col("source").alias("_source"), "source_size", "target", "passes", "end", "rest"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")
    copies = F.col("passes") + (F.col("hash") < F.col("end")).cast("long")
    copies = F.least(copies, F.lit(int(most)))
    joined = taken.withColumn("copies", copies).join(
        block_shards.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "placed"),
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")), "left",
    )
    return joined.select(
        "row", "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies",
        F.when(F.col("copies") > 0, F.transform(F.slice("placed", F.lit(1), F.col("copies").cast("int")), lambda p: p["shard"]))
        .otherwise(F.array().cast("array<int>")).alias("shards"),
    )


def mixed_order(mix: DataFrame, seed: int = 42) -> DataFrame:
    """One row per copy, (shard, doc_id, copy), each shard in keyed random order in one place of the output.

    Shards are range-partitioned with the random key behind them, so a shard larger than a task is spread over several.
    """
    copies = mix.select("row", "doc_id", F.posexplode("shards").alias("copy", "shard"))
    key = F.xxhash64(F.lit(seed + 1), "row", "copy")
    return copies.withColumn("key", key).repartitionByRange("shard", "key").sortWithinPartitions("shard", "key").select("shard", "doc_id", "copy")
