"""No text may crash or hang a task: texts of a megabyte made of one piece, for the operators that look for patterns."""

import time

import pytest

from tablework.llm import decontaminate, pii, toxicity, url_filter

PIECES = ["a", "a.", "x@a.", "@", "<a ", "1 ", "1", "a a ", "1-", "1.", "a1", "!", "+", "href", "A ", "é", "\n", "0 0", "a@b.co "]
SIZE = 1_000_000
SECONDS = 60


@pytest.mark.parametrize("piece", PIECES)
def test_toxicity_features(piece):
    begin = time.perf_counter()
    values = toxicity.features(piece * (SIZE // len(piece)), frozenset({"a"}), frozenset({"abc*"}))
    assert len(values) == len(toxicity.FEATURES) and time.perf_counter() - begin < SECONDS


@pytest.mark.parametrize("piece", PIECES)
def test_decontamination(piece):
    items = [(1, "a " * 400), (2, "the quick brown fox jumps over the lazy dog again and again"), (3, "1 2 3 4 1 2 3 4 1 2 3 4"), (4, "a"), (5, "b " * 30 + "c " * 30)]
    scanner = decontaminate.Scanner(items, 20)
    text = piece * (SIZE // len(piece))
    begin = time.perf_counter()
    found = dict(scanner.found(text))
    assert time.perf_counter() - begin < SECONDS
    assert found.get(4) == (0 if " a " in decontaminate.plain(text) else None)


def test_merged_regions_find_what_single_ones_do():
    import random

    rng = random.Random(4)
    items = [(i, " ".join(rng.choice("ab abc b c".split()) for _ in range(rng.randrange(1, 60)))) for i in range(30)]
    scanner = decontaminate.Scanner(items, 20)
    for _ in range(40):
        text = " ".join(rng.choice("ab abc b c d".split()) for _ in range(200)) + " " + rng.choice(items)[1].replace("abc", "abd", 1)
        body = decontaminate.plain(text)
        got = dict(scanner.found(text))
        for i, item, errors in scanner.items:
            distance = decontaminate.least_distance(item, body)
            assert got.get(i) == (distance if distance <= errors else None)


def test_pseudonyms(spark):
    """Digits parted by blanks, thousands of them in a row, are slow still (README): here a few hundred."""
    pieces = ["a", "a.", "x@a.", "@", "<a ", "a a ", "!", "+", "href", "A ", "\n"]
    rows = [(i, p * (SIZE // len(p))) for i, p in enumerate(pieces)]
    rows += [(100, "mail x@" + "a." * 2000 + " and me@example.com."), (101, "1 " * 200), (102, "1" * 100_000)]
    begin = time.perf_counter()
    out = {r["doc_id"]: r["text"] for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), key="k").collect()}
    assert time.perf_counter() - begin < 2 * SECONDS
    assert len(out) == len(rows) and "me@example.com" not in out[100] and out[102] == rows[-1][1]


def test_links(spark):
    rows = [("h", p * (SIZE // len(p)) + '<a href="http://b.org/x">') for p in PIECES]
    begin = time.perf_counter()
    links = url_filter.host_links(spark.createDataFrame(rows, "host string, html string")).collect()
    assert time.perf_counter() - begin < SECONDS
    assert [(r["src"], r["dst"]) for r in links] == [("h", "b.org")]
