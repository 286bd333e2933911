"""What training and scoring of the language model take, and that they are exact."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from visitlog.llm import lm


def _model(heads, seed=5):
    rng = np.random.default_rng(seed)
    units = heads + lm.TAILS + 1
    return lm.LogBilinear(heads=heads, counts=rng.integers(1, 99, units), sketches=rng.normal(size=(units, 3)))


def _direct(model, two, one, target):
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    hidden = p["seen"][two] @ p["far"] + p["seen"][one] @ p["next"]

    def share(scores, at):
        scores = scores - scores.max(1, keepdims=True)
        return scores[np.arange(len(at)), at] - np.log(np.exp(scores).sum(1))

    out = share(hidden @ p["classes"].T + p["class_bias"], model.unit_class[target])
    for i, unit in enumerate(target):
        c = model.unit_class[unit]
        own = slice(model.first[c], model.first[c + 1])
        out[i] += share(hidden[i : i + 1] @ p["units"][own].T + p["bias"][own], [model.rank[unit] - own.start])[0]
    return out


def test_shares_are_those_of_a_plain_softmax(monkeypatch):
    model, rng = _model(200), np.random.default_rng(1)
    # Sorted, unsorted, in several blocks, and with scores whose exponentials overflow.
    for wide, factor in ((lm.WIDE, 1), (500, 1), (lm.WIDE, 30), (500, 30)):
        monkeypatch.setattr(lm, "WIDE", wide)
        model.p["seen"] = rng.normal(0, factor, model.p["seen"].shape).astype(np.float32)
        cells = rng.integers(0, model.begin, (3, 700))
        for two, one, target in (cells, cells[:, np.lexsort(cells[::-1])]):
            assert np.allclose(model.log_probabilities(two, one, target), _direct(model, two, one, target), rtol=1e-4, atol=1e-3)


def test_exponentials_are_shared_by_contexts(monkeypatch):
    model, found, exp = _model(200), [0], np.exp
    two, one = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60), indexing="ij"))

    def counted(x, *args, **kwargs):
        found[0] += np.size(x)
        return exp(x, *args, **kwargs)

    monkeypatch.setattr(np, "exp", counted)
    model.log_probabilities(two, one, np.full(len(two), 7))
    size = np.diff(model.first)[model.unit_class[7]] + len(model.first) - 1
    assert 0 < found[0] <= 2 * 60 * size


def test_steps_take_no_new_tables():
    model, rng = _model(6000), np.random.default_rng(2)
    two, one, target = rng.integers(0, model.begin, (3, 500))
    times = np.ones(500, np.float32)
    model.start()
    before = {k: v.copy() for k, v in model.p.items()}
    model.step(two, one, target, times, rng)
    assert all((model.p[k] != before[k]).any() for k in before)
    tracemalloc.start()
    model.step(two, one, target, times, rng)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * model.p["seen"].nbytes


def test_words_are_counted_by_language():
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, "", "x", "x Y", "y x x z"])) for _ in range(300)]
    batch = pa.RecordBatch.from_pylist([{"text": t, "lang": x} for x, t in rows], pa.schema([("text", pa.string()), ("lang", pa.string())]))
    got, want = Counter(), Counter()
    for part in lm._count_task([batch.slice(0, 100), batch.slice(100)]):
        for row in part.to_pylist():
            got[row["lang"], row["word"]] += row["n"]
    words = {t: next(lm._words(pa.array([t])))[1].tolist() for t in ("x", "y", "z")}
    for lang, text in rows:
        for word in (text or "").lower().split():
            want[lang, words[word][0]] += 1
        want[lang, lm.END_WORD] += 1
    assert got == want
