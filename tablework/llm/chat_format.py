"""Chat logs as training texts: snapshots of a growing conversation collapse into the longest one.

Every turn has two hashes; their running sums identify each prefix of a conversation. A conversation whose whole sum is a
proper prefix of another one is a snapshot of it and goes, by anti-join; of equal conversations the one with the
smallest id stays. The others are rendered turn by turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablework.llm.common import picked, stage
from tablework.operators.ordered import running

# Turns per rendered row: a conversation of any length is rendered in parts of this many turns.
PART_TURNS = 2000
TURN = "<|im_start|>{}\n{}<|im_end|>\n"
NO_ROLE = "unknown"


def rendered(role: Column, text: Column) -> Column:
    """One turn in the tagged form; a null role is ``unknown``, a null text empty."""
    before, middle, after = TURN.split("{}")
    return F.concat(F.lit(before), F.coalesce(role, F.lit(NO_ROLE)), F.lit(middle), F.coalesce(text, F.lit("")), F.lit(after))


def _hash(seed: int) -> Column:
    # which of the three are null is part of the value, since a null leaves the hash as it was
    marks = [F.col(c).isNull() for c in ("turn", "role", "text")]
    return F.xxhash64(F.lit(seed), "turn", "role", "text", *marks).cast("decimal(20,0)")


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", part_turns: int = PART_TURNS, group_rows: int | None = None) -> DataFrame:
    """(conv_id, part, n_turns, copies, text) of every maximal conversation.

    Turns come in the order of turn, role and text, nulls first; a row that is logged twice in a conversation counts once.
    Turn numbers are part of a turn, so a prefix starts at the same number. n_turns counts the whole conversation, copies
    the equal conversations it stands for, and text holds the turns of one part of ``part_turns``, in order.
    Rows with a null conv_id form one conversation without id, which loses against an equal one with an id. Empty tables
    give no rows; other columns are not looked at.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    rows = picked(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).distinct()
    hashed = rows.withColumns({"h1": _hash(1), "h2": _hash(2)})
    options = {} if group_rows is None else {"group_rows": group_rows}
    sums = {"n": ("count", F.lit(1)), "p1": ("sum", F.col("h1")), "p2": ("sum", F.col("h2"))}
    log = stage(running(hashed, ["conv_id"], order, sums, earlier=True, **options), "turns")
    # the state before a turn is a proper prefix; the same prefix of many conversations is combined before the shuffle
    prefixes = log.where("n > 0").select("n", "p1", "p2").distinct()
    whole = log.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum("h1").alias("p1"), F.sum("h2").alias("p2"))
    same = whole.groupBy("n", "p1", "p2").agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("no_id"), "conv_id")).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    as_prefix = [same.n == prefixes.n, same.p1 == prefixes.p1.cast(same.schema["p1"].dataType), same.p2 == prefixes.p2.cast(same.schema["p2"].dataType)]
    maximal = same.join(prefixes, as_prefix, "left_anti").select(
        F.col("first.conv_id").alias("kept_id"), F.col("n").alias("n_turns"), "copies"
    )
    kept = log.join(maximal, F.col("conv_id").eqNullSafe(F.col("kept_id")))
    parts = kept.groupBy("conv_id", F.floor(F.col("n") / part_turns).alias("part")).agg(
        F.max("n_turns").alias("n_turns"), F.max("copies").alias("copies"),
        F.array_sort(F.collect_list(F.struct("n", rendered(F.col("role"), F.col("text")).alias("piece")))).alias("pieces"),
    )
    return parts.select("conv_id", "part", "n_turns", "copies", F.array_join("pieces.piece", "").alias("text"))
