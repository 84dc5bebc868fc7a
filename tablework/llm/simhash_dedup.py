"""SimHash near duplicates, compared at the anchors of a covering code.

Fingerprint: the majority, bit by bit, of the XXH64 values of all word shingles. Two 23-bit blocks of it are decoded
with the perfect binary Golay code (covering radius 3); the remaining 18 bits are covered by the single word of a
trivial code. An anchor is a pair of Golay code words. Two fingerprints that differ in at most t bits have a
midpoint, and the anchor next to that midpoint lies within the covering radius plus ceil(t / 2) of both. So each
fingerprint is copied to every anchor within that radius, block excesses added up, and compared there: no linked
pair is missed, and for t = 2 a fingerprint has 9.6 anchors of 16.7 million on average.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tablework.llm.common import picked_rows, prepare, row_id, settled, stage
from tablework.llm.components import components

# Fixed values of the (23, 12) Golay code: its generator polynomial, length and covering radius.
GOLAY_POLYNOMIAL = 0xAE3
GOLAY_BITS = 23
GOLAY_RADIUS = 3
HASH_SEED = 42
_SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of a text; 0 when it has no word."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= words_per_shingle:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    sizes = np.fromiter(map(len, words), np.int64, n) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends + 1 - sizes)[: n - words_per_shingle + 1].tolist()
    ends = ends[words_per_shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], HASH_SEED) for s, e in zip(starts, ends)), "<u8", len(starts))
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SHINGLES_AT_ONCE):
        part = hashes[at : at + _SHINGLES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, words_per_shingle: int = 3) -> Column:
    """SimHash as a signed long (the same 64 bits)."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, words_per_shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    return hashed(text)


def _parity_masks() -> list[int]:
    """For each of the 11 syndrome bits, the positions that flip it: remainders of x^i by the polynomial."""
    remainders = []
    for i in range(GOLAY_BITS):
        value = 1 << i
        for high in range(i, 10, -1):
            if value >> high & 1:
                value ^= GOLAY_POLYNOMIAL << (high - 11)
        remainders.append(value)
    return [sum((r >> bit & 1) << i for i, r in enumerate(remainders)) for bit in range(11)]


def _coset_table(spark, reach: int) -> DataFrame:
    """(syndrome, patterns): the error patterns that lead to code words within radius 3 + reach, with their excess.

    2,048 rows; for reach 1 they hold 10,903 patterns. The size follows from the code, not from the data.
    """
    masks = _parity_masks()
    rows: dict[int, list] = {}
    for weight in range(GOLAY_RADIUS + reach + 1):
        for bits in combinations(range(GOLAY_BITS), weight):
            e = sum(1 << b for b in bits)
            syndrome = sum((bin(e & m).count("1") & 1) << i for i, m in enumerate(masks))
            rows.setdefault(syndrome, []).append((e, max(0, weight - GOLAY_RADIUS)))
    return spark.createDataFrame(list(rows.items()), "syndrome int, patterns array<struct<e: long, excess: int>>")


def _block(fp: Column, shift: int) -> Column:
    return F.shiftright(fp, shift).bitwiseAND(F.lit((1 << GOLAY_BITS) - 1).cast("long"))


def _syndrome(block: Column) -> Column:
    bits = [
        F.shiftleft(F.bit_count(block.bitwiseAND(F.lit(m).cast("long"))).bitwiseAND(F.lit(1)), i)
        for i, m in enumerate(_parity_masks())
    ]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def at_anchors(prints: DataFrame, max_distance: int) -> DataFrame:
    """(anchor, fp): every fingerprint at every anchor within reach."""
    reach = math.ceil(max_distance / 2)
    table = _coset_table(prints.sparkSession, reach)
    first = table.select(F.col("syndrome").alias("s1"), F.col("patterns").alias("p1"))
    second = table.select(F.col("syndrome").alias("s2"), F.col("patterns").alias("p2"))
    blocks = prints.select(
        "fp", _block(F.col("fp"), 0).alias("w1"), _block(F.col("fp"), GOLAY_BITS).alias("w2")
    ).withColumns({"s1": _syndrome(F.col("w1")), "s2": _syndrome(F.col("w2"))})
    # 2,048 rows by construction
    found = blocks.join(F.broadcast(first), "s1").join(F.broadcast(second), "s2")
    anchors = F.flatten(F.transform("p1", lambda x: F.transform(
        F.filter("p2", lambda y: x["excess"] + y["excess"] <= reach),
        lambda y: F.shiftleft(F.col("w1").bitwiseXOR(x["e"]), GOLAY_BITS).bitwiseOR(F.col("w2").bitwiseXOR(y["e"])),
    )))
    return found.select("fp", F.explode(anchors).alias("anchor"))


def linked(prints: DataFrame, max_distance: int) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in 1 to ``max_distance`` bits; a pair may come more than once."""
    placed = at_anchors(prints, max_distance)
    one, two = placed.select("anchor", F.col("fp").alias("a")), placed.select("anchor", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    return one.join(two, "anchor").where((F.col("a") < F.col("b")) & near).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3,
                    max_distance: int = 2) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, kept.

    component_id is the smallest doc_id that links reach. Equal fingerprints are one class from the start, so a large
    group of copies is a single row in the search. kept marks exactly one row of each component: one with the smallest
    id. Null, empty and blank texts have fingerprint zero and link like any other; a null id counts after all others
    (component_id is null only when no row of the component has an id); repeated rows are rows of their own; an empty
    table gives no rows; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    rows = settled(docs, "simhash-input")
    source = picked_rows(rows, doc_id=id_col, text=text_col)
    printed = stage(source.select("row", "doc_id", fingerprint_column(F.col("text"), words_per_shingle).alias("fp")), "simhash")
    classes = stage(
        printed.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")),
        "simhash-classes",
    )
    roots = components(linked(classes.select("fp"), max_distance))
    placed = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    heads = placed.groupBy("root").agg(F.min("first").alias("head"))
    by_print = placed.join(heads, "root").select("fp", "head")
    return printed.join(by_print, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("head.doc_id").alias("component_id"),
        (F.col("row") == F.col("head.row")).alias("kept"),
        "row",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns."""
    rows = settled(docs, "simhash-input")
    kept = near_duplicates(rows, id_col, text_col, **options).where("kept").select(F.col("row").alias("_kept_row"))
    packed = rows.select(row_id(rows).alias("_kept_row"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("_doc"))
    return packed.join(kept, "_kept_row", "left_semi").select("_doc.*")
