"""A trie of all conversation prefixes with totals per subtree, by the recursion of van Emde Boas layouts.

Depths are cut in half: the upper half of every conversation names its cut prefix, and below each name hangs a lower
forest. All upper tries and lower forests of one level of the recursion are named by the same job, so a trie of depth D
takes log2(D) jobs. Totals go the other way: once every piece of L levels knows the totals of its own subtrees, the totals
of the roots of the lower pieces are grafted onto all their ancestors in the piece above, which makes pieces of 2 L levels.

A node is called by its smallest member and its depth. If a conversation is the smallest member of a node, it is so in
every deeper node on its path: each conversation owns one run of depths, and its ``first`` owned depth hangs below a
node of a smaller conversation.
"""

from __future__ import annotations

from functools import reduce

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablework.llm.common import picked, prepare, stage
from tablework.operators.ordered import positions

# Turns of another conversation that a rebuilt one may borrow, and conversations that borrow from the same one.
MOST_BORROWED, LENDERS = 9, 5
# Characters of text that order turns with one number and role; beyond it their digests do.
TIE_CHARS = 64
# Bytes of joined ids in one row.
PIECE_BYTES = 1 << 20

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ordered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, digest, n_bytes) of every turn of a conversation with an id; pos counts from 0.

    Turns come by number (null first), then role, then the first ``TIE_CHARS`` characters of the text, then the digest of both;
    a null role or text is empty. Repeated rows are turns of their own. Only digests and short texts are shuffled.
    """
    named = picked(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv_id IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length of the role says where the text begins
    digest = _digest(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary"))
    slim = named.select("conv_id", "turn", role.alias("role"), F.left(text, F.lit(TIE_CHARS)).alias("start"), digest.alias("digest"),
                        F.octet_length(text).cast("long").alias("n_bytes"))
    order = [F.col("turn").asc_nulls_first(), "role", "start", "digest"]
    return positions(slim, ["conv_id"], order).select("conv_id", F.col("pos").cast("long").alias("pos"), "digest", "n_bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) with borrowed beginnings: conversation c starts with the first h turns of c - c % 5 in the
    place of its own first h, h = crc32 of its decimal id, modulo 9; a lender without that many gives all it has.

    ``turns`` are ``ordered_turns``. Conversations without any turn left are listed, too.
    """
    length = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    borrows = length.withColumns({
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_BORROWED,
        "lender": F.col("conv_id") - F.col("conv_id") % LENDERS,
    })
    lenders = length.select(F.col("conv_id").alias("lender"), F.col("own").alias("lent"))
    plan = stage(borrows.join(lenders, "lender", "left").withColumn("lent", F.least("h", F.coalesce("lent", F.lit(0)))), "borrowing")
    begin = turns.where(F.col("pos") < MOST_BORROWED).where(F.col("conv_id") % LENDERS == 0).withColumnRenamed("conv_id", "lender")
    borrowed = begin.join(plan.select("lender", "conv_id", "h"), "lender").where("pos < h")
    own = turns.join(plan.select("conv_id", "h", "lent"), "conv_id").where("pos >= h")
    columns = ["conv_id", "pos", "digest", "n_bytes"]
    both = borrowed.select(*columns).unionByName(own.withColumn("pos", F.expr("pos - h + lent")).select(*columns))
    return plan.select("conv_id"), both


def _blocks(turns: DataFrame, levels: int) -> list[DataFrame]:
    """Digests of the turns from ``start`` on, 1, 2, 4, ... of them, at starts that are multiples of that number."""
    made = [turns.select("conv_id", F.col("pos").alias("start"), "digest", "n_bytes")]
    for level in range(1, levels):
        half, both = 1 << (level - 1), 1 << level
        right = F.col("start") % both == half
        pairs = made[-1].groupBy("conv_id", (F.col("start") - F.col("start") % both).alias("start")).agg(
            F.max(F.when(~right, F.col("digest"))).alias("left"), F.max(F.when(right, F.col("digest"))).alias("right"),
            F.max(F.when(right, F.col("n_bytes"))).alias("n_bytes"),
        )
        whole = pairs.where(F.col("left").isNotNull() & F.col("right").isNotNull())
        made.append(stage(whole.select("conv_id", "start", _digest("left", "right").alias("digest"), "n_bytes"), "blocks"))
    return made


def _named(turns: DataFrame, levels: int) -> DataFrame:
    """(conv_id, depth, name, n_bytes): the name of every prefix, equal for equal prefixes of one depth, and its last bytes.

    Level by level: a piece that starts at a named depth is cut in half, and the name of the start with the digest of the
    turns up to the cut is the name of the cut prefix.
    """
    blocks = _blocks(turns, levels)
    done: list[DataFrame] = []
    for level in reversed(range(levels)):
        half = 1 << level
        left = blocks[level].where(F.col("start") % (2 * half) == 0)
        top = left.where("start = 0").select("conv_id", F.lit(half).cast("long").alias("depth"), "digest", "n_bytes")
        if done:
            above = reduce(DataFrame.unionByName, done).select("conv_id", F.col("depth").alias("start"), "name")
            below = left.where("start > 0").join(above, ["conv_id", "start"])
            lower = below.select("conv_id", (F.col("start") + half).alias("depth"), _digest("name", "digest").alias("digest"), "n_bytes")
            top = top.unionByName(lower)
        done.append(stage(top.withColumnRenamed("digest", "name"), "names"))
    return reduce(DataFrame.unionByName, done)


def _ends(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of nodes where a conversation ends: ids are joined in sorted runs of bounded size by
    many tasks, and only the joined runs of a node meet in one task, which hashes them one after the other."""

    def join(batches):
        key, first, piece, size = None, None, [], 0

        def run():
            return pa.RecordBatch.from_pylist([{"conv_id": key[0], "depth": key[1], "first": first, "piece": ",".join(piece)}], _PIECE)

        for batch in batches:
            for node, depth, member in zip(*[c.to_pylist() for c in batch.columns]):
                if key != (node, depth) or size > PIECE_BYTES:
                    if piece:
                        yield run()
                    key, first, piece, size = (node, depth), member, [], 0
                piece.append(str(member))
                size += len(piece[-1]) + 1
        if piece:
            yield run()

    def digest(batches):
        key, sha = None, None
        for batch in batches:
            done = []
            for node, depth, piece in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "depth", "piece")]):
                if key == (node, depth):
                    sha.update(b"," + piece.encode())
                    continue
                if key:
                    done.append((*key, sha.hexdigest()))
                key, sha = (node, depth), hashlib.sha256(piece.encode())
            if done:
                yield _rows(done)
        if key:
            yield _rows([(*key, sha.hexdigest())])

    by = ["node", "depth", "conv_id"]
    runs = ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(join, "conv_id long, depth long, first long, piece string")
    at = ["conv_id", "depth"]
    return runs.repartition(*at).sortWithinPartitions(*at, "first").mapInArrow(digest, "conv_id long, depth long, ends_sha256 string")


_PIECE = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("piece", pa.string())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["conv_id", "depth", "ends_sha256"])


def _grafted(base: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) summed over subtrees.

    ``base`` has every node with its own share, ``paths`` every node on the path of a conversation.
    """
    sums = [F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")]
    total = ["conv_id", "depth", "n_leaves", "saved_tokens"]
    made = [base.select(*total, "parent_conv_id")]
    for level in range(levels):
        size = 1 << level
        # pieces of ``size`` levels: the roots of the lower ones, then the leaves above them, then their ancestors
        roots = reduce(DataFrame.unionByName, made).where(F.col("depth") % (2 * size) == size)
        known = roots.groupBy("conv_id", "depth").agg(F.max("parent_conv_id").alias("above"), *sums)
        leaves = known.groupBy(F.col("above").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(*sums)
        hung = leaves.select("conv_id", F.floor(F.col("depth") / size).alias("piece"), "n_leaves", "saved_tokens")
        last = F.col("depth") - F.col("depth") % size + size - 1
        upper = paths.where((F.col("depth") % (2 * size) < size) & (last <= F.col("length")) & (last >= F.col("first")))
        reached = upper.select("conv_id", F.floor(F.col("depth") / size).alias("piece"), "node", "depth").join(hung, ["conv_id", "piece"])
        up = reached.groupBy(F.col("node").alias("conv_id"), "depth").agg(*sums)
        made.append(stage(up.select(*total, F.lit(None).cast("long").alias("parent_conv_id")), "grafts"))
    return reduce(DataFrame.unionByName, made).groupBy("conv_id", "depth").agg(*sums)


def prefix_trie(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node (``NODE``): the distinct beginnings of the conversations, the empty one included.

    ``conversations`` lists every conv_id once, ``turns`` has (conv_id, pos, digest, n_bytes) of their turns, pos from 0
    without gaps; equal digests are equal turns. conv_id is the smallest member, parent_conv_id the parent's (null for the root),
    n_convs the members, n_children the children, n_leaves the childless nodes of the subtree, saved_tokens the bytes
    that the subtree saves by storing shared turns once, and ends_sha256 hashes the ids of the conversations that end there.
    Conversations without turns are members of the root alone. No conversations give no rows.
    """
    spark = prepare(turns.sparkSession)
    turns = stage(turns, "rebuilt")
    found = conversations.agg(F.min("conv_id").alias("root"), F.count(F.lit(1)).alias("n")).first()
    if not found["n"]:
        return spark.createDataFrame([], NODE)
    root, longest = F.lit(found["root"]).cast("long"), turns.agg(F.max("pos")).first()[0]
    levels = 0 if longest is None else (longest + 1).bit_length()
    if not levels:
        names = turns.select("conv_id", F.col("pos").alias("depth"), F.col("digest").alias("name"), "n_bytes").where("false")
    else:
        names = _named(turns, levels)
    nodes = stage(names.groupBy("depth", "name").agg(F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes")), "nodes")
    # the node at every depth of every conversation
    whole = conversations.select("conv_id", F.lit(0).cast("long").alias("depth"), root.alias("node"))
    path = stage(names.join(nodes.select("depth", "name", "node"), ["depth", "name"]).select("conv_id", "depth", "node").unionByName(whole), "path")
    foreign = F.when(F.col("node") != F.col("conv_id"), F.struct("depth", "node"))
    runs = path.groupBy("conv_id").agg(F.max("depth").alias("length"), F.max(foreign).alias("above"))
    runs = stage(runs.select("conv_id", "length", F.coalesce(F.col("above.depth") + 1, F.lit(0)).alias("first"), F.col("above.node").alias("above")), "runs")

    owned = nodes.select(F.col("node").alias("conv_id"), "depth", "n_convs", "n_bytes").unionByName(
        spark.createDataFrame([(found["root"], 0, found["n"], 0)], "conv_id long, depth long, n_convs long, n_bytes long"))
    branches = runs.where("first <= length AND above IS NOT NULL").groupBy(F.col("above").alias("conv_id"), (F.col("first") - 1).alias("depth"))
    at = ["conv_id", "depth"]
    # each conversation goes on below its own nodes; all other children are first nodes of other runs
    hung = owned.join(runs, "conv_id").join(branches.agg(F.count(F.lit(1)).alias("branches")), at, "left")
    children = F.coalesce("branches", F.lit(0)) + (F.col("depth") < F.col("length")).cast("long")
    parent = F.when(F.col("depth") == 0, None).when(F.col("depth") == F.col("first"), F.col("above")).otherwise(F.col("conv_id"))
    base = stage(hung.select(*at, parent.alias("parent_conv_id"), "n_convs", children.alias("n_children"),
                             (children == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens")), "base")
    reach = path.join(runs.select("conv_id", "length", "first").where("first <= length"), "conv_id")
    totals = _grafted(base, stage(reach, "reach"), levels)
    last = path.join(runs.select("conv_id", F.col("length").alias("depth")), at)
    out = base.drop("n_leaves", "saved_tokens").join(totals, at).join(_ends(last), at, "left")
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256))).select(*NODE.replace(" long", "").replace(" string", "").split(", "))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``prefix_trie`` of the rebuilt conversations of a table of turns.

    Rows without conv_id belong to no conversation and are left out; ids are whole numbers. Other columns are not looked at.
    """
    return prefix_trie(*rebuilt(stage(ordered_turns(conversations), "turns")))
