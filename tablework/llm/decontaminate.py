"""Benchmark items inside documents, allowing a few wrong characters.

An item may differ from the passage in k = len // ``chars_per_error`` characters. Cut into k + 1 pieces, at least one
piece is left whole, so documents are scanned once for all pieces with an Aho-Corasick automaton. Around each
hit the least edit distance of the whole item is found with Myers' bit-parallel recurrence.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablework.llm.common import picked, prepare

# Characters of all items of one scan. A larger benchmark is scanned in shards of this size, one pass over the
# documents for each, so what a task holds has a bound.
SHARD_CHARS = 8_000_000
_TOKENS = re.compile(r"\w+")


def plain(text: str | None) -> str:
    """Lower case, words only, one blank between them and at both ends; empty when there is no word."""
    words = _TOKENS.findall(text.lower()) if text else []
    return f" {' '.join(words)} " if words else ""


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): ``errors`` + 1 pieces of nearly equal length."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def least_distance(item: str, region: str, stop_at: int = 0) -> int:
    """Least edit distance of ``item`` to any stretch of ``region`` (Myers, one machine word of len(item) bits)."""
    m = len(item)
    at: dict[str, int] = {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = mask, 0, m, m
    for c in region:
        equal = at.get(c, 0)
        vertical = equal | down
        equal |= ((equal & up) + up) ^ up
        plus = down | (~(equal | up) & mask)
        minus = up & equal
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus, minus = plus << 1 & mask, minus << 1 & mask
        up, down = minus | (~(vertical | plus) & mask), plus & vertical
        if score < best:
            best = score
            if best <= stop_at:
                break
    return best


class Scanner:
    """All pieces of a shard of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], chars_per_error: int):
        self.items = [(i, p, len(p) // chars_per_error) for i, p in ((i, plain(t)) for i, t in items) if p]
        self.automaton = ahocorasick.Automaton()
        for number, (_, item, errors) in enumerate(self.items):
            for offset, piece in pieces(item, errors):
                if piece not in self.automaton:
                    self.automaton.add_word(piece, [])
                self.automaton.get(piece).append((number, offset, len(piece)))
        if self.items:
            self.automaton.make_automaton()

    def found(self, text: str | None) -> list[tuple[int, int]]:
        """(item id, distance) of every item within its budget somewhere in the text."""
        body = plain(text) if self.items else ""
        best: dict[int, int] = {}
        if not body:
            return []
        # where each item may begin, as ranges: pieces of one place in the item are met from left to right
        begins: dict[tuple[int, int], list[list[int]]] = {}
        for end, owners in self.automaton.iter(body):
            for number, offset, length in owners:
                errors = self.items[number][2]
                if not errors:
                    best[number] = 0
                if best.get(number) == 0:
                    continue
                start = end - length + 1 - offset
                ranges = begins.setdefault((number, offset), [])
                if ranges and start - ranges[-1][1] <= errors:
                    ranges[-1][1] = start
                else:
                    ranges.append([start, start])
        by_item: dict[int, list[list[int]]] = {}
        for (number, _), ranges in begins.items():
            by_item.setdefault(number, []).extend(ranges)
        for number, ranges in by_item.items():
            _, item, errors = self.items[number]
            for low, high in _merged(ranges, errors):
                region = body[max(0, low - errors) : high + len(item) + errors]
                distance = 0 if item in region else least_distance(item, region)
                if distance <= errors:
                    best[number] = min(distance, best.get(number, distance))
                if best.get(number) == 0:
                    break
        return [(self.items[number][0], distance) for number, distance in best.items()]


def _merged(ranges: list[list[int]], gap: int) -> list[list[int]]:
    """Ranges at most ``gap`` apart as one, so that no part of a text is compared again and again."""
    out: list[list[int]] = []
    for low, high in sorted(ranges):
        if out and low - out[-1][1] <= gap:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def _shards(items: DataFrame, shard_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Items in lists of about ``shard_chars`` characters."""
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = math.ceil(chars / shard_chars)
    for shard in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == shard)
        # ids travel as text: the scan need not know their type
        yield [tuple(r) for r in part.select(F.col("item_id").cast("string"), "text").toLocalIterator()]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", chars_per_error: int = 20,
                 shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(doc_id, item_id, distance): one row per row of ``docs`` and benchmark item found in its whole text.

    distance is the least edit distance of the normalised item, at most one for every ``chars_per_error`` characters.
    Null, empty or word-free texts and items match nothing; repeated rows are reported for each row, repeated items for
    each (one row for equal id and text); null ids are passed on, item ids of any type that text can be cast to; an
    empty table on either side gives no rows.
    """
    prepare(docs.sparkSession)
    items = picked(benchmark, item_id=item_id_col, text=item_text_col).where("text IS NOT NULL").distinct()
    source = picked(docs, doc_id=id_col, text=text_col)
    item_type = items.schema["item_id"].dataType
    schema = source.select("doc_id").withColumns(
        {"item_id": F.lit(None).cast("string"), "distance": F.lit(None).cast("int")}
    ).schema
    out = docs.sparkSession.createDataFrame([], schema)
    for number, shard in enumerate(_shards(items, shard_chars)):
        hits = source.mapInArrow(_scan(shard, chars_per_error), schema)
        out = hits if not number else out.unionByName(hits)
    return out.withColumn("item_id", F.col("item_id").cast(item_type))


def _scan(shard, chars_per_error):
    """A function that scans record batches for the items of one shard."""

    def run(batches):
        scanner = Scanner(shard, chars_per_error)
        for batch in batches:
            rows, found, distances = [], [], []
            for row, text in enumerate(batch.column(1)):
                for item, distance in scanner.found(text.as_py()):
                    rows.append(row)
                    found.append(item)
                    distances.append(distance)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, pa.string()), pa.array(distances, pa.int32())],
                names=["doc_id", "item_id", "distance"],
            ) if rows else pa.RecordBatch.from_arrays(
                [batch.column(0).slice(0, 0), pa.array([], pa.string()), pa.array([], pa.int32())],
                names=["doc_id", "item_id", "distance"],
            )

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", chars_per_error: int = 20,
                      shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no benchmark item is found; null texts stay."""
    prepare(docs.sparkSession)
    items = picked(benchmark, item_id="item_id", text="text").where("text IS NOT NULL").distinct()
    at = docs.columns.index(text_col)
    out = docs
    for shard in _shards(items, shard_chars):
        out = out.mapInArrow(_without(shard, chars_per_error, at), docs.schema)
    return out


def _without(shard, chars_per_error, at):
    def run(batches):
        scanner = Scanner(shard, chars_per_error)
        for batch in batches:
            yield batch.filter(pa.array([not scanner.found(t.as_py()) for t in batch.column(at)], pa.bool_()))

    return run
