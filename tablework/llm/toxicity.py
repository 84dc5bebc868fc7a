"""Toxicity scores: boosted trees over a few dense features, calibrated by isotonic regression.

The lexicon is learned: words and word beginnings that toxic texts hold far more often than others. Features of
the whole text are lexicon densities, hits near a second person, capitals, punctuation and disguised words.
Lexicon, trees and calibration learn from different folds, so that chance entries of the lexicon cannot mislead the trees.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from tablework.llm.common import fold, picked, prepare, stage

# Bounds of what is learned: labelled texts in all, entries of the lexicon.
TRAIN_DOCS = 20_000
LEXICON = 2000
PREFIXES = (3, 4, 5, 6, 7, 8)
NEAR = 5
# Words that address the reader, in the languages of the tables.
SECOND_PERSON = frozenset(
    "you your yours yourself ya ur du dich dir dein deine deinen ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split()
)
# Signs written for letters.
LEET = str.maketrans("013457@$!", "oieastasi")
_WORD = re.compile(r"\w+")
# Runs are taken whole, from their first sign: a later start would fail for the same reason, so long runs cost one pass.
_MIXED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[0-9@$!*]++[^\W\d_][\w@$!*]*+|(?<![0-9@$])[0-9@$]++[^\W\d_]{2,}+[\w@$!*]*+")
_SIGN_IN_WORD = re.compile(r"[0-9@$!*]")
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?!\w)")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_MARKS = re.compile(r"[!?]")
_SIGNS = re.compile(r"[^\w\s]")
_CAPITAL_WORD = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{2,}\b")
FEATURES = ("hits", "density", "distinct", "starts", "start_density", "near", "capitals", "capital_words", "marks",
            "signs", "disguised", "disguised_hits", "spaced_hits", "log_words")


def entries(text: str) -> set[str]:
    """What the lexicon can hold of a text: words, and beginnings of longer words (with a final *)."""
    words = set(_WORD.findall(text.lower()))
    return words | {f"{w[:k]}*" for w in words for k in PREFIXES if len(w) > k}


def _changed(text: str, lower: str) -> int:
    """Number of capital letters: characters that lower case changes."""
    if len(text) != len(lower):
        return sum(map(str.isupper, text))
    return int(np.count_nonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") != np.frombuffer(lower.encode("utf-32-le"), "<u4")))


def features(text: str | None, words_in: frozenset, starts_in: frozenset) -> list[float]:
    """The dense features of a whole text; all zero for a null or empty one."""
    if not text:
        return [0.0] * len(FEATURES)
    lower = text.lower()
    words = _WORD.findall(lower)
    unique = set(words)
    whole = unique & words_in
    begun = {w for k in {len(s) for s in starts_in} for w in unique if w[:k] in starts_in and len(w) > k} - whole
    hits = starts = near = 0
    if whole or begun:
        at = [i for i, w in enumerate(words) if w in whole or w in begun]
        hits = sum(words[i] in whole for i in at)
        starts = len(at) - hits
        if unique & SECOND_PERSON:
            near = sum(not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]) for i in at)
    # most texts hold no sign that could stand for a letter, and few single letters
    mixed = _MIXED.findall(text) if _SIGN_IN_WORD.search(text) else []
    undone = sum(w.lower().translate(LEET).strip("*") in words_in for w in mixed)
    spaced = 0
    if sum(len(w) == 1 for w in unique) > 2:
        spaced = sum(re.sub(r"[ .\-_*]", "", s).lower() in words_in for s in _SPACED.findall(text))
    spaced += sum(_STRETCHED.sub(r"\1", w) in words_in for w in unique - whole if _STRETCHED.search(w))
    n, chars = max(1, len(words)), len(text)
    return [
        float(hits), hits / n, float(len(whole) + len(begun)), float(starts), starts / n, float(near),
        _changed(text, lower) / chars, len(_CAPITAL_WORD.findall(text)) / n, len(_MARKS.findall(text)) / n,
        len(_SIGNS.findall(text)) / n, len(mixed) / n, float(undone), float(spaced), math.log1p(len(words)),
    ]


def _labelled(labels: DataFrame, id_col: str, label_col: str, folds: int, held_out: int, most: int, seed: int) -> DataFrame:
    """(doc_id, toxic, part) of at most about ``most`` ids outside the held-out fold, chosen by a keyed hash."""
    usable = picked(labels, doc_id=id_col, toxic=label_col).where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    usable = usable.withColumn("part", fold(F.col("doc_id"), folds)).where(F.col("part") != held_out)
    one = usable.groupBy("doc_id", "part").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    share = min(1.0, most / max(1, one.count()))
    return one.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20)) < share * (1 << 20))


def _lexicon(texts: DataFrame) -> tuple[frozenset, frozenset]:
    """Entries that toxic texts hold far more often: at least three texts and more than chance among all entries."""

    def counted(batches):
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for entry in entries(text or ""):
                    seen.setdefault(entry, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_pydict({
                "entry": pa.array(list(seen), pa.string()),
                "clean": pa.array([c for c, _ in seen.values()], pa.int64()),
                "toxic": pa.array([t for _, t in seen.values()], pa.int64()),
            })

    totals = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    toxic_texts, clean_texts = totals.get(1, 0), max(1, totals.get(0, 0))
    if not toxic_texts:
        return frozenset(), frozenset()
    counts = stage(
        texts.select("text", "toxic").mapInArrow(counted, "entry string, clean long, toxic long")
        .groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
        "lexicon",
    )
    chance = 0.9 * math.log(max(2, counts.count()))
    ratio = (F.col("toxic") / toxic_texts) / ((F.col("clean") + 0.5) / clean_texts)
    gain = F.col("toxic") * F.log(ratio)
    best = counts.where((F.col("toxic") >= 3) & (ratio >= 8) & (gain >= chance)).orderBy(gain.desc(), "entry").limit(LEXICON)
    found = [r["entry"] for r in best.select("entry").collect()]
    return frozenset(e for e in found if e[-1] != "*"), frozenset(e[:-1] for e in found if e[-1] == "*")


def _features(text: Column, lexicon) -> Column:
    words_in, starts_in = lexicon

    @F.pandas_udf("array<double>")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, words_in, starts_in) for t in texts])

    return made(text)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
             label_col: str = "toxic", folds: int = 5, held_out: int = 0, train_docs: int = TRAIN_DOCS, seed: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    The score is the calibrated probability, moved by at most 1 % of the trees' own probability so that equal
    calibrated values keep their order. Null and empty texts have all features 0 and are scored like any text. When the labels of the
    learning folds lack one of the two classes, every score is 0. Null labels are not learned from; of several labels of
    one id the largest counts; null ids are never held out; repeated rows get equal scores; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    source = picked(docs, doc_id=id_col, text=text_col)
    held = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out")
    chosen = stage(_labelled(labels, label_id_col, label_col, folds, held_out, train_docs, seed), "labelled")
    # the sample has a bound: train_docs ids
    texts = source.where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    parts = [p for p in range(folds) if p != held_out]
    middle = len(parts) // 2
    lexicon = _lexicon(texts.where(F.col("part").isin(parts[:middle])))
    scored = stage(source.select("doc_id", _features(F.col("text"), lexicon).alias("x")), "features")
    learned = stage(
        scored.join(F.broadcast(chosen.where(~F.col("part").isin(parts[:middle]))), "doc_id")
        .select(array_to_vector("x").alias("features"), F.col("toxic").cast("double").alias("label"), "part"),
        "learned",
    )
    trees, steps = learned.where(F.col("part") == parts[middle]), learned.where(F.col("part").isin(parts[middle + 1 :]))
    if trees.select("label").distinct().count() < 2 or steps.select("label").distinct().count() < 2:
        return scored.select("doc_id", held, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    model = GBTClassifier(maxIter=15, maxDepth=3, seed=seed, maxBins=64, minInstancesPerNode=2).fit(trees)
    own = vector_to_array("probability")[1]
    calibration = IsotonicRegression(featuresCol="own", predictionCol="calibrated").fit(
        model.transform(steps).select(own.alias("own"), "label")
    )
    probed = model.transform(scored.select("doc_id", array_to_vector("x").alias("features"))).select("doc_id", own.alias("own"))
    score = F.least(F.greatest(F.lit(0.99) * F.col("calibrated") + F.lit(0.01) * F.col("own"), F.lit(0.0)), F.lit(1.0))
    return calibration.transform(probed).select("doc_id", held, score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
