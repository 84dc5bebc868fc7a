"""Packing, whitening and the prefix trie against brute force: nulls, ties, repeats, long texts, empty tables, clashing names."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablework.llm import packing, prefix_trie, whitening

# packing

DOCS = "doc_id long, text string, length long, `row` int, class int, sequence_id string"


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 7, 8, 9, "s") for i, t in zip(ids, texts)], DOCS)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(str(public_tokenizers.path(packing.TOKENIZER)))


def test_both_libraries_give_the_same_ids(tokenizer):
    plain = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), 0x20AC]]
    assert all(packing._PLAIN.fullmatch(c) for c in plain) and not packing._PLAIN.fullmatch("漢")
    rng = random.Random(3)
    texts = [f"a{c}b {c} 1{c}2{c}{c} {c}x" for c in plain] + ["".join(rng.choices(plain + [" ", "e", "n"] * 100, k=300)) for _ in range(200)]
    texts += ["<|endoftext|> x", "漢字 \U0001f600 ok", "", "  ", "it's we'll", "\r\n\r\n a  b", "﻿x"]
    encode = packing.encoder(packing.TOKENIZER, packing.RANKS).encode
    assert all(encode(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids for t in texts)


def test_long_texts_are_encoded_in_parts(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "PART_CHARS", 40)
    rng = random.Random(5)
    encode = packing.encoder(packing.TOKENIZER, packing.RANKS).encode
    for text in ["".join(rng.choices("ab1.,' \n\té", k=2000)) for _ in range(40)] + ["x" * 3000, " " * 500, "a b" * 700]:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def packed(tokenizer, frame, texts, **options):
    """Pieces after the checks of the contract; (share of padding, sequences, documents of one sequence that were cut)."""
    packing_ = packing.pack(frame, **options)
    size = options.get("sequence", packing.SEQUENCE)
    rows = [r.asDict() for r in packing_.with_ids().collect()]
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}
    by_doc, by_sequence, cut = {}, {}, 0
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == ids.keys()
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["start"])
        assert sum((r["ids"] for r in pieces), []) == ids[i]
        assert [r["start"] for r in pieces] == [sum(q["length"] for q in pieces[:k]) for k in range(len(pieces))]
        assert all(r["doc_tokens"] == len(ids[i]) and r["length"] == len(r["ids"]) > 0 for r in pieces)
        cut += len(pieces) > 1 and len(ids[i]) <= size
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == [sum(q["length"] for q in pieces[:k]) for k in range(len(pieces))]
        fill = sum(r["length"] for r in pieces)
        assert fill <= size
        padding += 0 if fill & (fill - 1) == 0 else size - fill
    sums = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing_.pieces.collect()}
    assert sums == {(r["doc_id"], r["start"]): zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows}
    assert sorted(map(tuple, packing_.sequences().collect()), key=str) == sorted(((s, sum((r["ids"] for r in p), [])) for s, p in by_sequence.items()), key=str)
    return padding / max(1, sum(map(len, ids.values()))), len(by_sequence), cut


def test_odd_documents(spark, tokenizer):
    texts = {0: None, 1: "", 2: " \n", 3: "one", 4: "word " * 5000, 5: "one", 6: "x" * 4096, 7: "<|endoftext|>", -3: "é漢", None: "no id"}
    padding, _, _ = packed(tokenizer, documents(spark, list(texts.values()), list(texts)), texts)
    assert padding == 0
    assert packing.pack(documents(spark, [])).pieces.count() == 0


def test_repeated_rows_are_documents_of_their_own(spark):
    pieces = packing.pack(documents(spark, ["a b c"] * 300, [4] * 300)).pieces.collect()
    assert len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces) and sum(r["length"] for r in pieces) == 300 * 4


def test_many_documents_keep_whole(spark, tokenizer):
    rng = random.Random(2)
    texts = {i: "a " * rng.randrange(1, 60) for i in range(3000)}
    padding, sequences, cut = packed(tokenizer, documents(spark, list(texts.values())), texts, sequence=64, class_width=1)
    assert padding < 0.01 and cut < 0.05 * len(texts)


def test_a_hot_class_is_ranked_in_blocks(spark, tokenizer):
    texts = {i: "a " * (30 if i % 3 else 20) for i in range(400)}
    spark.conf.set("spark.tablework.groupRows", "50")
    try:
        assert packed(tokenizer, documents(spark, list(texts.values())), texts, sequence=128, class_width=4)[0] < 0.05
    finally:
        spark.conf.unset("spark.tablework.groupRows")


@pytest.mark.parametrize("seed", range(5))
def test_patterns_fit_the_histogram(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 2000, 40)
    counts[rng.integers(0, 40, 10)] = 0
    found = packing.patterns(counts.copy(), 64)
    taken = np.zeros(40, np.int64)
    for pattern, times in found:
        assert sum(s * n for s, n in pattern.items()) <= 64 and times > 0
        for s, n in pattern.items():
            taken[s - 1] += n * times
    sizes = np.arange(1, 41)
    assert (taken <= counts).all() and taken @ sizes > 0.9 * (counts @ sizes) and len(found) <= 40
    assert sum(t * (64 - sum(s * n for s, n in p.items())) for p, t in found) < 0.01 * (counts @ sizes)
    assert packing.patterns(np.zeros(9, np.int64), 10) == []


# whitening

VECTORS = "vec_id long, embedding array<float>, component string, n int"


def whitened(spark, rows, **options):
    out = whitening.whiten(spark.createDataFrame([(i, v, "c", 1) for i, v in rows], VECTORS), **options).collect()
    found = {}
    for r in out:
        found.setdefault(r["vec_id"], []).append(r)
    return {i: sorted(rs, key=lambda r: r["component"]) for i, rs in found.items()}


def check_whitened(rows, got, components=4):
    width = max((len(v) for _, v in rows if v), default=0)
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (width - len(v)) for _, v in kept], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    want = np.abs((x - sums / n) @ vectors / np.sqrt(values))
    trace = (centred ** 2).sum() / n
    assert set(got) == {i for i, _ in kept}
    for (i, _), w, row in zip(kept, want, x):
        assert np.allclose([abs(r["whitened"]) for r in got[i]], w, atol=1e-9)
        assert [r["component"] for r in got[i]] == list(range(1, components + 1))
        assert {(r["n"], r["deviation"]) for r in got[i]} == {(n, sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)))}
        assert np.allclose([r["explained"] for r in got[i]], values / trace, rtol=1e-9) and got[i][0]["identity_error"] < 1e-9


def test_whitening_against_a_full_decomposition(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((300, 48)) * np.linspace(2, 0.5, 48)).tolist()
    rows = list(enumerate(vectors)) + [(1000 + k, vectors[0]) for k in range(200)]
    odd = [(2000, None), (2001, [float("nan")] * 48), (2002, [float("inf")] * 48), (2003, [None] * 48), (2004, [1.0, 2.0]), (2005, [])]
    check_whitened(rows + odd, whitened(spark, rows + odd))


def test_whitening_of_few_dimensions(spark):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(30)]
    check_whitened(rows, whitened(spark, rows), components=2)
    # a direction without variance is no component
    flat = whitened(spark, [(i, [float(i), 1.0, float(2 * i)]) for i in range(9)])
    assert all(len(r) == 1 and abs(r[0]["explained"] - 1) < 1e-12 for r in flat.values())


def test_whitening_without_variance(spark):
    assert whitened(spark, []) == {} == whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == whitened(spark, [(1, None), (2, [])])


def test_whitening_of_repeated_rows_and_null_ids(spark):
    got = whitened(spark, [(None, [1.0, 0.0]), (None, [0.0, 1.0]), (3, [2.0, 2.0]), (3, [2.0, 2.0])], components=1)
    assert len(got[None]) == 2 and len(got[3]) == 2


def test_exact_deviations_of_wide_numbers():
    centred = whitening._Centred(3, [5 << 40, -7])
    x = np.array([[1 << 41, 3], [-(1 << 62), 1 << 62]], np.int64)
    exact = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, centred.sums)) for row in x]
    assert centred.deviations(x) == [v if v < 1 << 63 else None for v in exact] and centred.deviations(x)[1] is None
    small = np.array([[1, 2]], np.int64)
    assert whitening._Centred(3, [4, 5]).deviations(small) == [2]


def test_close_values_are_told_apart():
    rng = np.random.default_rng(4)
    turn = np.linalg.qr(rng.standard_normal((80, 80)))[0]
    values = np.concatenate([[5, 4.999, 4.99, 4.9], np.linspace(4.8, 0, 76)])
    matrix = (turn * values) @ turn.T
    got, vectors = whitening.leading(lambda q: matrix @ q, 80, 4)
    assert np.allclose(got, values[:4], rtol=1e-12) and np.allclose(np.abs((vectors * turn[:, :4]).sum(0)), 1, atol=1e-10)


# prefix trie

TURNS = "conv_id long, turn long, role string, text string, depth string, pos int"


def brute_trie(rows):
    talks = {}
    for c, turn, role, text in rows:
        if c is not None:
            talks.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [t[2:] for t in sorted(ts)] for c, ts in talks.items()}
    built = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(talks.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    children, totals, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        below, cs = children.get(p, []), members[p]
        saved = (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
        totals[p] = (sum(totals[q][0] for q in below) or 1, saved + sum(totals[q][1] for q in below))
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(p))
        if p:
            children.setdefault(p[:-1], []).append(p)
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(below), *totals[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows):
    frame = spark.createDataFrame([(*r, "d", 5) for r in rows], TURNS)
    return sorted(map(tuple, prefix_trie.conversation_trie(frame).collect()), key=str)


def talks(rng, n, longest, ids):
    return [(c, t, rng.choice(["user", "bot", None]), rng.choice(["é", "b", None, ""])) for c in ids for t in range(rng.randrange(1, longest))][:n]


def test_trie_against_brute_force(spark):
    rng = random.Random(6)
    rows = talks(rng, 2000, 9, range(-12, 130)) + [(c, t, "user", "same") for c in range(200, 240) for t in range(4)]
    # ties, repeats, null turns, a conversation without id, one that is a whole prefix of another, long texts
    rows += [(7, 0, "user", "x"), (7, 0, "user", "x"), (7, 0, "bot", "y"), (8, None, "user", "z"), (None, 0, "user", "x"), (300, 0, None, "é" * 100_000)]
    rng.shuffle(rows)
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_of_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 10)
    rng = random.Random(8)
    rows = [(c, t, "user", "a") for c in range(40) for t in range(rng.choice([2, 70]))]
    spark.conf.set("spark.tablework.groupRows", "100")
    try:
        assert trie(spark, rows) == brute_trie(rows)
    finally:
        spark.conf.unset("spark.tablework.groupRows")


def test_trie_of_little(spark):
    assert trie(spark, []) == []
    for rows in ([(3, 0, None, None)], [(-1, 0, "user", "a")], [(6, 0, "user", "a"), (5, 0, "user", "a")], [(None, 0, "a", "b")]):
        assert trie(spark, rows) == brute_trie(rows)
