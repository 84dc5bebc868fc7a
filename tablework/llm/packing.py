"""Documents packed into training sequences: cutting stock by column generation.

Every document is tokenised once; full sequences are cut off its front and what remains is one piece. Pieces are
classed by length, and only the histogram of the classes, whose size is fixed, reaches the driver. There a linear program
over patterns (which classes share a sequence) covers the histogram with little padding; new patterns are priced by a
knapsack dynamic program. The rounded patterns say which ranks of a class go where, so that ranked pieces find their
sequence by a join with that table. Pieces that no pattern takes are laid end to end and cut at sequence ends.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tablework.llm.common import picked, prepare, row_id, stage
from tablework.operators.ordered import positions, running

SEQUENCE = 2048
END_ID = 1
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
# Lengths are classed by this many tokens: a smaller number pads less and makes the linear program larger.
CLASS_WIDTH = 8
# Padding that is accepted to save one cut.
CUT_COST = 16
# The linear program ends when no solution can be better by this share of all tokens.
GAP = 0.00002
# Longer texts are encoded in parts, at places where no token can cross.
PART_CHARS = 1 << 20
ROWS_PER_BATCH = 512

# Latin letters, digits, punctuation: there both libraries split texts alike (tests compare them).
_PLAIN = re.compile("[\x00-ɏ‐-‧€]*")
# Before a single blank between two other signs one token ends and another begins.
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Token ids of texts as the tokenizer file gives them, without added special tokens.

    Plain texts take the faster library when ``ranks``, the same vocabulary as ranks, is given; texts with other signs or
    with the name of a special token take the tokenizer file itself.
    """

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer)
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            with open(tokenizer, encoding="utf-8") as file:
                self.special = [t["content"] for t in json.load(file)["added_tokens"]]

    def _part(self, text: str) -> np.ndarray:
        if self.fast and _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        parts, begin = [], 0
        while len(text) - begin > PART_CHARS and (cut := _SAFE_CUT.search(text, begin + PART_CHARS)):
            parts.append(self._part(text[begin:cut.start()]))
            begin = cut.start()
        return np.concatenate([*parts, self._part(text[begin:])]).astype(np.uint32)


@lru_cache(maxsize=2)
def encoder(tokenizer: str, ranks: str | None) -> Encoder:
    """The encoder of a worker; names without a folder are files of the installed collection of public tokenizers."""
    import public_tokenizers

    def found(name):
        return name if name is None or "/" in name else str(public_tokenizers.path(name))

    return Encoder(found(tokenizer), found(ranks), public_tokenizers.PATTERN)


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def tokenised(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, end_id: int = END_ID,
              tokenizer: str = TOKENIZER, ranks: str | None = RANKS) -> DataFrame:
    """(doc_id, doc_tokens, start, length, ids, ids_crc32): every document with its end id, in pieces of at most ``sequence``."""
    spark = prepare(documents.sparkSession)
    rows = picked(documents, doc_id=id_col, text=text_col)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, doc_tokens long, start long, length long, ids array<int>, ids_crc32 long"

    def batch_of(doc_ids, made):
        numbers = np.array([m[:4] for m in made], np.int64)
        values = np.concatenate([m[4] for m in made]).view(np.int32)
        offsets = np.concatenate([[0], np.cumsum(numbers[:, 3])]).astype(np.int32)
        return pa.RecordBatch.from_arrays([
            doc_ids.take(pa.array(numbers[:, 0])), *[pa.array(numbers[:, c]) for c in (1, 2, 3)],
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array([checksum(m[4]) for m in made], pa.int64()),
        ], ["doc_id", "doc_tokens", "start", "length", "ids", "ids_crc32"])

    def task(batches):
        encode = encoder(tokenizer, ranks).encode
        for batch in batches:
            made = []
            for k, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype(np.uint32)
                for start in range(0, len(ids), sequence):
                    piece = ids[start:start + sequence]
                    made.append((k, len(ids), start, len(piece), piece))
                    if len(made) == ROWS_PER_BATCH:
                        yield batch_of(batch.column(0), made)
                        made = []
            if made:
                yield batch_of(batch.column(0), made)

    return rows.mapInArrow(task, schema)


# the linear program


def _best_pattern(values: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """Knapsack: the classes (size 1, 2, ..., repeats allowed) of greatest total value that fit into ``capacity``."""
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for size in range(1, capacity + 1):
        reached = best[:size] + values[size - 1::-1]
        k = int(reached.argmax())
        if reached[k] > best[size - 1]:
            best[size], took[size] = reached[k], size - k
        else:
            best[size] = best[size - 1]
    pattern: dict[int, int] = {}
    room = capacity
    while room:
        if taken := int(took[room]):
            pattern[taken] = pattern.get(taken, 0) + 1
        room -= taken or 1
    return float(best[capacity]), pattern


def patterns(counts: np.ndarray, capacity: int, leave_cost: float = CUT_COST / SEQUENCE, gap: float = GAP) -> list[tuple[dict[int, int], int]]:
    """(pattern, times): how often which classes share a sequence.

    ``counts[k]`` pieces have size k + 1, all below ``capacity``. Minimises padding plus ``leave_cost`` per unit that is left
    to be cut, as a linear program solved by the revised simplex method with generated columns, ended once it is
    certain that no solution is better by more than ``gap`` of all units; the solution is rounded down, and then
    patterns are used again as long as pieces are there, greatest remainder first.
    """
    used = np.flatnonzero(counts)
    if not len(used):
        return []
    sizes, demand = used + 1, counts[used].astype(float)
    rows, units = len(used), float(demand @ (used + 1))
    row_of = {int(s): i for i, s in enumerate(sizes)}
    inverse, amount, cost = np.eye(rows), demand.copy(), leave_cost * sizes
    basis: list[dict[int, int] | None] = [None] * rows
    most = 2 * units / capacity + 1
    while True:
        dual = cost @ inverse
        values = np.full(capacity, -np.inf)
        # a pattern costs its padding, capacity less the sizes in it
        values[used] = dual + sizes
        best, pattern = _best_pattern(values, capacity)
        # no cost is below zero, and none is below the dual bound
        if min(float(cost @ amount), (best - capacity) * most) <= gap * units:
            break
        column = np.zeros(rows)
        for size, times in pattern.items():
            column[row_of[size]] = times
        step = inverse @ column
        rises = step > 1e-9
        # among equal ratios the largest pivot, for the sake of rounding
        ratio = np.where(rises, np.maximum(amount, 0) / np.where(rises, step, 1), np.inf)
        near = np.flatnonzero(ratio <= ratio.min() + 1e-12)
        out = int(near[step[near].argmax()])
        inverse[out] /= step[out]
        amount[out] /= step[out]
        step[out] = 0
        moved = np.flatnonzero(step)
        inverse[moved] -= np.outer(step[moved], inverse[out])
        amount -= step * amount[out]
        basis[out], cost[out] = pattern, capacity - column @ sizes
    chosen = [(pattern, float(x)) for pattern, x in zip(basis, amount) if pattern]
    left = counts.copy()
    made = []
    for pattern, x in chosen:
        times = min([int(x + 1e-6), *[int(left[s - 1]) // n for s, n in pattern.items()]])
        for s, n in pattern.items():
            left[s - 1] -= n * times
        made.append([pattern, times, x - times])
    for entry in sorted(made, key=lambda e: -e[2]):
        again = min(int(left[s - 1]) // n for s, n in entry[0].items())
        for s, n in entry[0].items():
            left[s - 1] -= n * again
        entry[1] += again
    return [(pattern, times) for pattern, times, _ in made if times]


def _places(found: list[tuple[dict[int, int], int]], first: int) -> tuple[list[tuple], int]:
    """(class, lo, hi, per, sequence, slot) rows, and the next free sequence: ranks lo to hi of a class, ``per`` to a sequence."""
    taken: dict[int, int] = {}
    rows = []
    for pattern, times in found:
        slot = 0
        for size, per in sorted(pattern.items(), reverse=True):
            lo = taken.get(size, 0)
            taken[size] = lo + per * times
            rows.append((size, lo, taken[size], per, first, slot))
            slot += per
        first += times
    return rows, first


class Packing(NamedTuple):
    """``pieces`` says where every id lies, ``tokens`` has the ids of the pieces before they were cut again, by ``row``."""

    pieces: DataFrame
    tokens: DataFrame

    def with_ids(self) -> DataFrame:
        """The pieces with their ids; one shuffle of all ids."""
        ids = self.tokens.select(row_id(self.tokens).alias("row"), F.col("start").alias("cut_from"), "ids")
        joined = self.pieces.drop("ids_crc32").join(ids, "row")
        return joined.withColumn("ids", F.slice("ids", (F.col("start") - F.col("cut_from") + 1).cast("int"), F.col("length").cast("int"))).drop("row", "cut_from")

    def sequences(self) -> DataFrame:
        """(sequence_id, ids) ready for training, without padding."""
        parts = self.with_ids().groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))


def pack(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, class_width: int = CLASS_WIDTH,
         end_id: int = END_ID, tokenizer: str = TOKENIZER, ranks: str | None = RANKS) -> Packing:
    """Pieces of all documents in sequences of at most ``sequence`` ids, a multiple of ``class_width``.

    A null or empty text is its end id alone. Repeated rows and null ids are documents of their own; the rank of a piece
    in its class follows doc_id, so ties are broken by the place of the row. An empty table gives no pieces. A text of any
    length is encoded in parts. Other columns are not looked at.

    A sequence may be shorter than ``sequence`` by the padding of its pattern; what no pattern takes is laid end to
    end in full sequences, and the rest of that at the very end in sequences whose lengths are powers of two, which need no padding.
    """
    spark = documents.sparkSession
    tokens = stage(tokenised(documents, id_col, text_col, sequence, end_id, tokenizer, ranks), "tokens")
    light = tokens.select(row_id(tokens).alias("row"), "doc_id", "doc_tokens", "start", "length", "ids_crc32",
                          F.ceil(F.col("length") / class_width).cast("int").alias("class"))
    full = sequence // class_width
    counts = np.zeros(full, np.int64)
    for row in light.groupBy("class").count().collect():
        counts[row["class"] - 1] = row["count"]
    whole, counts[full - 1] = int(counts[full - 1]), 0
    rows, following = _places(patterns(counts, full), whole)
    rows.append((full, 0, whole, 1, 0, 0))
    # at most one pattern per class, and a pattern has few classes, since their sizes add up
    plan = spark.createDataFrame(rows, "class int, lo long, hi long, per long, first long, slot long")
    ranked = positions(light, ["class"], [F.col("doc_id").asc_nulls_first(), "start", "row"], "rank")
    ranked, plan = ranked.alias("r"), F.broadcast(plan).alias("p")
    inside = (F.col("r.class") == F.col("p.class")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    placed = stage(ranked.join(plan, inside, "left").select(
        *[f"r.{c}" for c in light.columns], (F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("per"))).alias("sequence_id"),
        (F.col("slot") + (F.col("rank") - F.col("lo")) % F.col("per")).alias("slot")), "placed")
    # a sequence holds ``full`` pieces at most
    before = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    columns = ["row", "doc_id", "doc_tokens", "start", "length", "ids_crc32", "sequence_id"]
    kept = placed.where("sequence_id IS NOT NULL").select(*columns, offset)

    loose = placed.where("sequence_id IS NULL").drop("sequence_id", "slot")
    laid = running(loose, [], ["class", F.col("doc_id").asc_nulls_first(), "start", "row"], {"at": ("sum", F.col("length"))}, earlier=True)
    laid = stage(laid.withColumn("at", F.coalesce("at", F.lit(0))), "laid")
    total = laid.agg(F.sum("length")).first()[0] or 0
    tail, begin = [], total - total % sequence
    while begin < total:
        size = 1 << ((total - begin).bit_length() - 1)
        tail.append((begin, size, following + total // sequence + len(tail)))
        begin += size
    # sequences that a loose piece meets: full ones by division, then those of the tail
    last = "least((at + length - 1) div {0}, {1} div {0} - 1)".format(sequence, total)
    fulls = f"transform(if(at div {sequence} <= {last}, sequence(at div {sequence}, {last}), array()), k -> named_struct('b', k * {sequence}, 'n', {sequence}L, 'id', k + {following}L))"
    ends = "array({})".format(", ".join(f"named_struct('b', {b}L, 'n', {n}L, 'id', {i}L)" for b, n, i in tail)) if tail else f"slice({fulls}, 1, 0)"
    cut = laid.withColumn("s", F.explode(F.expr(f"filter(concat({fulls}, {ends}), s -> s.b < at + length AND s.b + s.n > at)")))
    low, high = F.greatest("at", "s.b"), F.least(F.col("at") + F.col("length"), F.col("s.b") + F.col("s.n"))
    whole_piece = (F.col("at") >= F.col("s.b")) & (F.col("at") + F.col("length") <= F.col("s.b") + F.col("s.n"))
    cut = cut.select("row", "doc_id", "doc_tokens", (F.col("start") + low - F.col("at")).alias("start"), (high - low).alias("length"),
                     F.when(whole_piece, F.col("ids_crc32")).alias("ids_crc32"), F.col("s.id").alias("sequence_id"), (low - F.col("s.b")).alias("offset"))
    cut = stage(cut, "cut")
    # few pieces are cut, so the ids of the others are not shuffled: files of this size tell Spark how to join
    parted = stage(cut.where("ids_crc32 IS NULL"), "parted")
    ids = tokens.select(row_id(tokens).alias("row"), F.col("start").alias("cut_from"), "ids")

    def sums(batches):
        for batch in batches:
            *keep, ids, cut_from = batch.columns
            names = batch.schema.names[:-2]
            slices = zip(ids, cut_from.to_pylist(), keep[names.index("start")].to_pylist(), keep[names.index("length")].to_pylist())
            found = [checksum(i.values.to_numpy()[s - f:s - f + n].view(np.uint32)) for i, f, s, n in slices]
            keep[names.index("ids_crc32")] = pa.array(found, pa.int64())
            yield pa.RecordBatch.from_arrays(keep, names)

    summed = parted.join(ids, "row").select(*parted.columns, "ids", "cut_from").mapInArrow(sums, parted.schema)
    pieces = kept.unionByName(cut.where("ids_crc32 IS NOT NULL")).unionByName(summed)
    return Packing(pieces, tokens)
