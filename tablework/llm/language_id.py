"""Language identification by a byte convolutional network.

A text is cut into windows of a fixed number of bytes. Filters of several widths slide over the embedded bytes, the
largest answer of each filter in a window is kept, and a softmax layer turns these into probabilities; a text has the mean
of its windows. The network is trained in numpy on windows of a bounded sample of labelled texts. For prediction the
embedding and the filters are folded into tables of byte pairs, so a window costs look-ups and additions.
"""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablework.llm.common import fold, picked, prepare

_log = logging.getLogger(__name__)

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
# Bound of the fitted sample: labelled texts in all, shared evenly by the languages, and windows of each text.
TRAIN_DOCS = 3000
WINDOWS_PER_DOC = 2
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_WINDOWS_AT_ONCE = 512


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text, the last filled up with zero bytes."""
    count = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(count * WINDOW, b"\0"), np.uint8).reshape(count, WINDOW)


@dataclass
class ByteNetwork:
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """For each width, look-up tables by byte pair (or last byte) in the order of their offsets."""
        out = []
        for kernel, width in zip(self.filters, WIDTHS):
            by_byte = [self.embedding @ kernel[j * EMBEDDING : (j + 1) * EMBEDDING] for j in range(width)]
            parts = []
            for j in range(0, width - 1, 2):
                # the low byte of a little-endian pair comes first
                parts.append((by_byte[j + 1][:, None, :] + by_byte[j][None, :, :]).reshape(-1, FILTERS).astype(np.float32))
            if width % 2:
                parts.append(by_byte[-1].astype(np.float32))
            out.append(parts)
        return out

    def probabilities(self, windows: np.ndarray, tables) -> np.ndarray:
        pooled = []
        pairs = windows[:, :-1].astype(np.uint16) | windows[:, 1:].astype(np.uint16) << 8
        for parts, width in zip(tables, WIDTHS):
            length = WINDOW - width + 1
            answer = parts[0].take(pairs[:, :length], axis=0)
            for k, table in enumerate(parts[1:], 1):
                index = pairs[:, 2 * k : 2 * k + length] if len(table) > 256 else windows[:, 2 * k : 2 * k + length]
                answer += table.take(index, axis=0)
            pooled.append(answer.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.biases, 0)
        return softmax(hidden @ self.dense + self.dense_bias)


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.01,
          seed: int = 7) -> ByteNetwork:
    """Adam on the cross entropy; the gradient of the maximum flows to the place it was found at."""
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    hidden = FILTERS * len(WIDTHS)
    weights = [rng.normal(0, 0.5, (256, EMBEDDING))]
    weights += [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)) for w in WIDTHS]
    weights += [np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), (hidden, len(languages))), np.zeros(len(languages))]
    first, second, step = [np.zeros_like(x) for x in weights], [np.zeros_like(x) for x in weights], 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            gradients = _gradients(weights, windows[chosen], target[chosen])
            step += 1
            for x, g, m, v in zip(weights, gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    n = len(WIDTHS)
    return ByteNetwork(languages, weights[0], weights[1 : n + 1], weights[n + 1], weights[n + 2], weights[n + 3])


def _gradients(weights, windows, target):
    embedding, filters, (biases, dense, dense_bias) = weights[0], weights[1:-3], weights[-3:]
    embedded = embedding[windows]
    stretches, places, pooled = [], [], []
    rows = np.arange(len(windows))[:, None]
    for kernel, width in zip(filters, WIDTHS):
        length = WINDOW - width + 1
        stretch = np.concatenate([embedded[:, j : j + length] for j in range(width)], axis=2)
        answer = stretch @ kernel
        place = answer.argmax(axis=1)
        stretches.append(stretch)
        places.append(place)
        pooled.append(np.take_along_axis(answer, place[:, None], axis=1)[:, 0])
    before = np.concatenate(pooled, axis=1) + biases
    active = np.maximum(before, 0)
    error = softmax(active @ dense + dense_bias)
    error[np.arange(len(target)), target] -= 1
    error /= len(target)
    back = (error @ dense.T) * (before > 0)
    d_embedding, d_filters = np.zeros_like(embedding), []
    for k, (kernel, width) in enumerate(zip(filters, WIDTHS)):
        d = back[:, k * FILTERS : (k + 1) * FILTERS]
        seen = stretches[k][rows, places[k]]
        d_filters.append(np.einsum("nfe,nf->ef", seen, d))
        for j in range(width):
            part = d[:, :, None] * kernel[j * EMBEDDING : (j + 1) * EMBEDDING].T[None]
            np.add.at(d_embedding, windows[rows, places[k] + j].ravel(), part.reshape(-1, EMBEDDING))
    return [d_embedding, *d_filters, back.sum(axis=0), active.T @ error, error.sum(axis=0)]


def _windows_of_sample(docs: DataFrame, seed: int):
    """Up to ``WINDOWS_PER_DOC`` windows, spread over the whole text, of each sampled document."""

    def cut(batches):
        for batch in batches:
            langs, parts = [], []
            for text, lang, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = windows_of(text.encode())
                chosen = sorted({(key + i * len(found) // WINDOWS_PER_DOC) % len(found) for i in range(WINDOWS_PER_DOC)})
                langs += [lang] * len(chosen)
                parts += [found[i].tobytes() for i in chosen]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.binary())], names=["lang", "bytes"])

    return docs.mapInArrow(cut, "lang string, bytes binary").collect()


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3,
        held_out: int = 1, train_docs: int = TRAIN_DOCS, seed: int = 7) -> ByteNetwork | None:
    """Train on labelled texts outside the held-out fold: ``train_docs`` of them at most, in the order of a keyed hash."""
    prepare(docs.sparkSession)
    usable = picked(docs, doc_id=id_col, text=text_col, lang=lang_col).where(
        (fold(F.col("doc_id"), folds) != held_out) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    labelled = picked(docs, doc_id=id_col, lang=lang_col).where((fold(F.col("doc_id"), folds) != held_out) & F.col("lang").isNotNull())
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(train_docs).toLocalIterator()}
    if not counts:
        return None
    each = max(1, train_docs // len(counts))
    # the share of a language that gives `each` texts; one comparison per row instead of a sort
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))])
    key = F.xxhash64(F.lit(seed), "doc_id")
    chosen = usable.where((F.pmod(key, F.lit(1 << 20)) / float(1 << 20)) < F.try_element_at(share, F.col("lang")))
    sample = _windows_of_sample(chosen.select("text", "lang", F.pmod(F.shiftrightunsigned(key, 20), F.lit(1 << 30)).alias("key")), seed)
    if not sample:
        return None
    sample.sort(key=lambda r: (r["lang"], bytes(r["bytes"])))
    windows = np.frombuffer(b"".join(bytes(r["bytes"]) for r in sample), np.uint8).reshape(-1, WINDOW)
    return train(windows, [r["lang"] for r in sample], seed=seed)


def predict(texts, network: ByteNetwork | None, tables) -> tuple[list[str], list[float]]:
    """Language and score of each text, all windows counted."""
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if network is None:
        return langs, scores
    sums, counts = np.zeros((len(texts), len(network.languages))), np.zeros(len(texts))
    waiting, owners, held = [], [], 0

    def flush():
        if waiting:
            windows, owner = np.concatenate(waiting), np.concatenate(owners)
            for at in range(0, len(windows), _WINDOWS_AT_ONCE):
                part = network.probabilities(windows[at : at + _WINDOWS_AT_ONCE], tables)
                np.add.at(sums, owner[at : at + _WINDOWS_AT_ONCE], part)
            np.add.at(counts, owner, 1)
            waiting.clear()
            owners.clear()

    for i, text in enumerate(texts):
        if text is None or not _LETTER.search(text):
            continue
        found = windows_of(text.encode())
        waiting.append(found)
        owners.append(np.full(len(found), i))
        held += len(found)
        if held >= 4 * _WINDOWS_AT_ONCE:
            flush()
            held = 0
    flush()
    for i in np.nonzero(counts)[0]:
        mean = sums[i] / counts[i]
        best = int(mean.argmax())
        langs[i], scores[i] = network.languages[best], float(min(1.0, mean[best]))
    return langs, scores


def prediction(text: Column, network: ByteNetwork | None) -> Column:
    """struct<lang_pred: string, score: double> of a text column."""
    tables = network.tables() if network else None

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def made(texts: pd.Series) -> pd.DataFrame:
        langs, scores = predict(texts, network, tables)
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    return made(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3,
             held_out: int = 1, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    lang_pred is ``und`` with score 0 where the text is null or has no letter, and everywhere when there is nothing to learn
    from (an empty table, no label). A null id is never held out and never learned from. Labels and ids take no part in a
    prediction, repeated rows get equal answers, very long texts are used whole, other columns are not looked at.
    """
    network = fit(docs, id_col, text_col, lang_col, folds, held_out, train_docs)
    source = picked(docs, doc_id=id_col, text=text_col)
    return source.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
        prediction(F.col("text"), network).alias("p"),
    ).select("doc_id", "held_out", "p.*")


def keep_identified(docs: DataFrame, least_score: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is recognised with at least ``least_score``.

    Without a label to learn from nothing is recognised and nothing rejected: all rows stay, and a warning says so.
    """
    network = fit(docs, id_col, text_col, lang_col)
    if not network:
        _log.warning("no labelled text to learn languages from: all documents stay")
        return docs
    p = prediction(F.col(f"`{text_col}`"), network)
    return docs.where((p["lang_pred"] != UNKNOWN) & (p["score"] >= least_score))
