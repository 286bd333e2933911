"""Hard negatives: Strassen's products, heaps, and rows against a plain version."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from visitlog.llm import negatives
from visitlog.llm.negatives import Heaps, label_negatives, strassen, window

SCHEMA = "vec_id long, embedding array<float>, label int, score string, block string, place string"


def plain(rows):
    """Rows of the query for ``(vec_id, vector, label)``, one by one."""
    valid = []
    for i, vector, label in rows:
        if None in (i, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        valid.append((i, [math.floor(256 * float(np.float32(x))) for x in vector], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for at, (i, a, label) in enumerate(valid):
        if i % 100:
            continue
        scores = sorted(
            (-sum(x * y for x, y in zip(a, b)), j, other) for k, (j, b, other) in enumerate(valid) if k != at
        )
        for s, j, _ in [x for x in scores if x[2] == label and x[1] != i][:5]:
            near = [x for x in scores if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, k + 1, n, -s, -score) for k, (score, n, _) in enumerate(near)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "b", "p") for r in rows], SCHEMA)


def mined(spark, rows):
    return sorted(tuple(r) for r in label_negatives(frame(spark, rows)).collect())


@pytest.mark.parametrize("m,k,n", [(5, 64, 700), (300, 64, 301), (257, 33, 1025), (129, 17, 129), (0, 4, 5), (3, 0, 4)])
def test_product(m, k, n):
    random = np.random.default_rng(m)
    # Large enough for the halves' sums to pass the longs' range.
    a, b = random.integers(-(2**62), 2**62, (m, k)), random.integers(-(2**62), 2**62, (k, n))
    assert (strassen(a, b) == a @ b).all()


@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=20))
def test_window(scores):
    least, most = window(np.array(scores), 30, 90)
    assert least.tolist() == [-(-30 * s // 100) for s in scores]
    assert most.tolist() == [90 * s // 100 for s in scores]


@settings(max_examples=50)
@given(st.lists(st.lists(st.tuples(st.integers(-3, 3), st.booleans()), min_size=1, max_size=6), max_size=5), st.integers(1, 4))
def test_heaps_merge(parts, size):
    heaps, seen, at = Heaps(1, size), [], 0
    for part in parts:
        ids = np.arange(at, at + len(part))
        at += len(part)
        heaps.merge(np.array([0]), *(np.array([x]) for x in ([s for s, _ in part], ids, [v for _, v in part])))
        seen += [(-s, i) for (s, v), i in zip(part, ids) if v]
    _, scores, ids = heaps.entries()
    assert list(zip(-scores, ids)) == sorted(seen)[:size]


def vectors(n, seed=7, width=6):
    """Vectors around a few centres, with ties, copies and rows that take no part."""
    random = np.random.default_rng(seed)
    centres = random.normal(size=(4, width))
    rows = []
    for i in range(n):
        v = (centres[i % 4] + random.normal(size=width) * 0.3).astype(np.float32).tolist()
        rows.append((i, v, int(i % 4 if i % 3 else random.integers(10))))
    rows[50] = (50, rows[49][1], rows[49][2])
    rows[60:64] = [(60, None, 1), (61, rows[3][1], None), (62, [float("nan")] * width, 1), (63, [None] * width, 1)]
    rows[64:66] = [(64, [float("inf")] + [0.0] * (width - 1), 1), (None, rows[3][1], 1)]
    # Repeated rows, also of an anchor, shorter vectors, an empty one.
    return rows + [rows[100], rows[17], (700, [0.5, 0.5], 2), (701, [], 2), (800, [-1.0] * width, 9)]


@pytest.mark.parametrize("blocks", [None, (3, (16, 16), 8)])
def test_equals_plain_version(spark, blocks, monkeypatch):
    if blocks:
        monkeypatch.setattr(negatives, "ANCHOR_BLOCK", blocks[0])
        monkeypatch.setattr(negatives, "CANDIDATE_BLOCK", blocks[1])
        monkeypatch.setattr(negatives, "CANDIDATE_BLOCKS", blocks[2])
    rows = vectors(420)
    assert mined(spark, rows) == plain(rows)


def test_hot_label_and_equal_vectors(spark):
    same = [(i, [0.25, -0.5, 0.125], 3 if i % 3 else 4) for i in range(300)]
    assert mined(spark, same) == plain(same) == []
    spread = same + [(1000 + i, [0.125, -0.25, 0.01 * (i % 5)], 5) for i in range(40)]
    assert mined(spark, spread) == plain(spread) != []


def test_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1), (3, [1.0], 1), (4, [0.5], 2)]) == [(100, 3, 1, 4, 65536, 32768)]
    # A negative score has an empty window.
    assert mined(spark, [(100, [1.0], 1), (3, [-1.0], 1), (4, [-0.5], 2)]) == []
