"""Repeated runs of lines, found by winnowing.

A gram is the shortest stretch of lines from a line on that has ``gram_words`` words; a window is the shortest stretch
from a line on, or up to a line, that has ``run_words``. Of all grams inside a window the one with the least hash is
marked, a fingerprint that the same lines get wherever they stand. Only marks whose gram occurs again go on. A gram can
first occur in a shorter run than the one searched for, so the windows behind a mark choose the text it is compared
with: the first place of each window in the whole table. That match is extended line by line both ways, and the later
run goes when it has ``run_words`` words. Every line of a run of that size lies in a window of the run, so all of it is met.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tablework.llm.common import picked_rows, prepare, row_id, settled, stage

_LINES = "hashes array<long>, words array<int>, marks array<struct<gram: binary, pos: int, windows: array<long>>>"


def marked_lines(text: str | None, gram_words: int = 25, run_words: int = 50):
    """(line hashes, words per line, [(gram hash, line, hashes of the windows that mark it)]) of a text."""
    lines = [] if text is None else [line.strip() for line in text.encode().split(b"\n")]
    if not lines:
        return [], [], []
    n = len(lines)
    hashes = np.fromiter((xxhash.xxh64_intdigest(line) for line in lines), np.uint64, n)
    words = np.fromiter((len(line.split()) for line in lines), np.int64, n)
    upto = np.cumsum(words)
    before = upto - words
    gram_end = np.searchsorted(upto, before + gram_words).tolist()
    raw, marks, grams = hashes.tobytes(), {}, {}
    for first, last in _windows(words, before, upto, run_words):
        best = None
        for s in range(first, last + 1):
            if gram_end[s] > last:
                break
            if not words[s]:
                continue
            gram = grams.get(s)
            if gram is None:
                gram = grams[s] = xxhash.xxh3_128_digest(raw[8 * s : 8 * gram_end[s] + 8])
            if best is None or gram < best[0]:
                best = (gram, s)
        window = xxhash.xxh64_intdigest(raw[8 * first : 8 * last + 8])
        marks.setdefault(best, []).append(window - (window >> 63 << 64))
    return hashes.view(np.int64).tolist(), words.tolist(), [(gram, s, found) for (gram, s), found in marks.items()]


def _windows(words, before, upto, run_words: int) -> list[tuple[int, int]]:
    """(first, last) line of the shortest stretches of ``run_words`` words from each line on and up to each line."""
    starts = np.nonzero(words)[0]
    ends = np.searchsorted(upto, before[starts] + run_words)
    found = set(zip(starts[ends < len(words)].tolist(), ends[ends < len(words)].tolist()))
    lasts = starts[upto[starts] >= run_words]
    firsts = np.searchsorted(before, upto[lasts] - run_words, side="right") - 1
    return sorted(found | set(zip(firsts.tolist(), lasts.tolist())))


def _marked(text: Column, gram_words: int, run_words: int) -> Column:
    @F.pandas_udf(_LINES)
    def made(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([marked_lines(t, gram_words, run_words) for t in texts], columns=["hashes", "words", "marks"])

    return made(text)


def repeated_ranges(matches, later, first, words, same: bool, run_words: int) -> list[tuple[int, int]]:
    """Ranges of lines of the later text that repeat the first one.

    ``matches`` has (line in the later text, line in the first) of equal grams; each is extended both ways as far as the
    lines agree and the range counts when it holds ``run_words`` words.
    """
    later, first, words = np.asarray(later), np.asarray(first), np.asarray(words)
    ranges, done = [], {}
    for at, origin in sorted(matches):
        shift = at - origin
        if done.get(shift, -1) >= at:
            continue
        lo, hi = max(0, shift), min(len(later), len(first) + shift)
        unequal = np.nonzero(later[lo:hi] != first[lo - shift : hi - shift])[0] + lo
        k = int(np.searchsorted(unequal, at))
        if k < len(unequal) and unequal[k] == at:
            continue
        start = int(unequal[k - 1]) + 1 if k else lo
        end = int(unequal[k]) if k < len(unequal) else hi
        done[shift] = end - 1
        if same:
            # inside one text the run must not reach back into the lines it repeats: those come first
            start = max(start, shift)
        if words[start:end].sum() >= run_words:
            ranges.append((start, end - 1))
    return ranges


def _ranges(run_words: int) -> Column:
    @F.pandas_udf("array<struct<start: int, end: int>>")
    def found(matches: pd.Series, later: pd.Series, first: pd.Series, words: pd.Series, same: pd.Series) -> pd.Series:
        return pd.Series([
            repeated_ranges([(m["pos"], m["origin"]) for m in hits], a, b, w, s, run_words)
            for hits, a, b, w, s in zip(matches, later, first, words, same)
        ])

    return found("matches", "later", "first", "words", "same")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram_words: int = 25,
                  run_words: int = 50) -> DataFrame:
    """(row, ranges): the lines to delete from each row of ``docs`` (a settled frame) that repeats an earlier run."""
    prepare(docs.sparkSession)
    source = picked_rows(docs, doc_id=id_col, text=text_col)
    lines = stage(
        source.where("text IS NOT NULL").select("row", "doc_id", _marked(F.col("text"), gram_words, run_words).alias("l"))
        .select("row", "doc_id", "l.*"),
        "lines",
    )
    marks = lines.select("row", "doc_id", F.explode("marks").alias("m")).select("row", "doc_id", "m.*")
    # Written, so that the joins stand apart from the aggregations and adaptive execution can split their other side: a
    # gram or window that a third of all texts share is one row here.
    again = stage(marks.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "grams")
    windows = stage(
        marks.join(again, "gram", "left_semi").select("row", "doc_id", "pos", F.explode("windows").alias("window")), "windows"
    )
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "pos")
    firsts = stage(
        windows.groupBy("window").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "firsts"
    )
    hits = windows.join(firsts, "window").where((F.col("row") != F.col("at.row")) | (F.col("pos") != F.col("at.pos")))
    matches = hits.groupBy("row", F.col("at.row").alias("origin_row")).agg(
        F.collect_set(F.struct("pos", F.col("at.pos").alias("origin"))).alias("matches")
    )
    later = lines.select("row", F.col("hashes").alias("later"), "words")
    first = lines.select(F.col("row").alias("origin_row"), F.col("hashes").alias("first"))
    paired = matches.join(later, "row").join(first, "origin_row").withColumn("same", F.col("row") == F.col("origin_row"))
    ranges = paired.select("row", _ranges(run_words).alias("ranges")).where(F.size("ranges") > 0)
    return ranges.groupBy("row").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram_words: int = 25,
                        run_words: int = 50) -> DataFrame:
    """All rows and columns of ``docs``, the text without repeated runs, plus ``lines_dropped``.

    Rows come in the order of doc_id (nulls last, rows with one id in a fixed order), lines in the order of the text; of
    equal runs the first stays. Lines are compared without blanks at their ends. A null text stays null, an empty one
    empty; a text all of whose lines repeat becomes empty. A repeated row is a later copy. Runs below ``run_words`` words stay. An
    existing column ``lines_dropped`` is replaced.
    """
    rows = settled(docs, "lines-input")
    gone = repeated_runs(rows, id_col, text_col, gram_words, run_words).withColumnRenamed("row", "_row")
    packed = rows.select(row_id(rows).alias("_row"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("_doc"))
    joined = packed.join(gone.withColumnRenamed("ranges", "_ranges"), "_row", "left")
    text = F.col(f"_doc.`{text_col}`")
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.exists("_ranges", lambda r: (r["start"] <= i) & (i <= r["end"])))
    cleaned = F.when(F.col("_ranges").isNull(), text).otherwise(F.array_join(kept, "\n"))
    dropped = F.when(F.col("_ranges").isNull(), 0).otherwise(F.size(lines) - F.size(kept))
    return joined.select(
        *[cleaned.alias(c) if c == text_col else F.col(f"_doc.`{c}`") for c in docs.columns if c != "lines_dropped"],
        dropped.alias("lines_dropped"),
    )
