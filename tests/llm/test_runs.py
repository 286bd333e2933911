"""Periodic runs against a plain version, and every given table against SQL."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from visitlog.llm import runs
from visitlog.llm.runs import Positions, document_runs, find_runs, newly_adjacent, periodic_runs


def plain(words, exponent=4, least=6):
    """All runs of a list by comparing words a period apart, for every period."""
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if size >= max(least, exponent * q):
                found.append((i, size, q))
            i = j + 1
    smallest = {}
    for i, size, q in found:
        smallest[i, size] = min(q, smallest.get((i, size), q))
    return sorted((i, size, q) for (i, size), q in smallest.items())


def plain_row(i, text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
    found = plain(words)
    gone = {k for s, size, q in found for k in range(s + q, s + size)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    text = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (
        i, len(found), *best, best[1] and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in found).encode()).hexdigest(),
        hashlib.sha256(text.encode()).hexdigest(),
    )


def found_in(texts, **how):
    words = [w for t in texts for w in t]
    bounds = np.cumsum([0, *map(len, texts)])
    out = [[] for _ in texts]
    for t, *run in zip(*(x.tolist() for x in find_runs(np.array(words, np.uint64), bounds, **how))):
        out[t].append(tuple(run))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4), st.sampled_from([(4, 6), (2, 2), (3, 1), (4, 30)]))
def test_all_runs(texts, how):
    exponent, length = how
    assert found_in(texts, exponent=exponent, length=length) == [plain(t, exponent, length) for t in texts]


@pytest.mark.parametrize("block", [1000, 4])
def test_repeats_in_repeats(block, monkeypatch):
    monkeypatch.setattr(runs, "BLOCK", block)
    dice, texts = random.Random(3), []
    for _ in range(150):
        text = []
        while len(text) < 200:
            piece = [dice.randrange(4) for _ in range(dice.randint(1, 6))] * dice.randint(1, 8)
            text += piece * dice.randint(1, 5)
        texts.append(text)
    assert found_in(texts) == [plain(t) for t in texts]
    assert found_in(texts, exponent=2, length=2) == [plain(t, 2, 2) for t in texts]


@given(st.permutations(range(60)))
def test_ordered_positions(order):
    from unittest.mock import patch

    with patch.object(runs, "BLOCK", 4):
        held, seen = Positions(order[0]), [order[0]]
        for x in order[1:]:
            before, after = held.add(x)
            assert before == max((y for y in seen if y < x), default=None)
            assert after == min((y for y in seen if y > x), default=None)
            seen.append(x)
        assert list(held) == sorted(order)


def test_neighbours_by_decreasing_lcp():
    # Suffixes of b a n a n a, in order: a, ana, anana, banana, na, nana.
    pairs = list(newly_adjacent([5, 3, 1, 0, 4, 2], np.array([1, 3, 0, 0, 2])))
    assert [p[2] for p in pairs] == sorted((p[2] for p in pairs), reverse=True)
    assert {(1, 3, 3), (2, 4, 2), (3, 5, 1)} <= set(pairs)


def test_long_texts():
    one = [[7] * 300_000, [1, 2] * 100_000 + [3], list(range(100_000))]
    assert found_in(one) == [[(0, 300_000, 1)], [(0, 200_000, 2)], []]


def odd_rows():
    line = "the same line again "
    texts = [None, "", " \t\n ", "a", "a a a a a", "a a a a a a", "a\x0ba\fa a\ra  a b", line * 9, line * 3, "x y " * 8,
             "é ü " * 5 + "tail", "z " * 3000, "p q r s " * 500 + "q r s p " * 400]
    return [(i, texts[i % len(texts)]) for i in range(130)] + [(None, line * 9), (None, None), (5, "b " * 9), (5, "b " * 9)]


def test_rows_equal_plain_version(spark):
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, runs string").repartition(3)
    got = sorted((tuple(r) for r in document_runs(docs).collect()), key=str)
    assert got == sorted((plain_row(*r) for r in rows), key=str)
    assert document_runs(docs.limit(0)).collect() == []


def test_given_documents(spark, small):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in document_runs(small).collect())
    assert got == sorted(plain_row(*r) for r in rows)
    assert sum(r[1] > 0 for r in got) > 10


def test_texts_come_out(spark):
    docs = spark.createDataFrame([("k", "go on on on on on on now", 3)], "name string, body string, collapsed int")
    row = periodic_runs(docs, "name", "body").first()
    assert (row.doc_id, [tuple(r) for r in row.runs], row.collapsed) == ("k", [(1, 6, 1)], "go on now")
