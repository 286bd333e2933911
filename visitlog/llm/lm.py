"""Scoring texts with a log-bilinear language model trained by noise contrast.

The model predicts units: every word of at least ``LEAST`` training tokens in a
language is a unit of its own, so their number grows with the corpus; above
``MOST`` of them (their vectors are held by every task) each language keeps its
most frequent words, and languages that need fewer leave their places to others.
The remaining words share ``TAILS`` units by how they end, and the end of a text
is one. The two units before a word give, through a matrix per place, a vector.

The softmax over all units is normalised exactly in two products: units are in
classes of about the root of their number, and a unit's probability is that of
its class times that of the unit within it, both from the same vector. Classes
join units that follow alike ones. Within the unit of other words, a word has
its smoothed share of the unit's corpus counts, unknown words included, so the
probabilities of all words sum to one.

Word counts are Spark sums over the whole training part of the corpus. Training
passes over all of its words in ``ROUNDS`` rounds: tasks take noise-contrastive
steps on batches of their own rows, with noise drawn from class and unit
frequencies, and Spark averages their parameters after each round.

Counts of the ``COMMON`` most frequent words (a bounded table) and of the model's
own words go to all tasks; the remaining words of each text, with repeats merged,
are joined with the full table of counts. No word of that join is frequent, and a
text's words are summed map-side.

Defined cases: NULL text is the empty text, which has its end only; NULL language
is a language, and without that column all texts are of one; repeated rows are
trained on and scored one by one; without training rows every word is unknown;
an empty table gives no rows.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlog.llm.frames import MERGE, bounded_batches
from visitlog.llm.words import hash_words, random_words, row_slices, text_bytes
from visitlog.session import stage

# Places of units in a model of HEADS words; any other number shifts them alike.
HEADS, TAILS = 96, 31
END = HEADS + TAILS
BEGIN = END + 1
UNITS = BEGIN + 1
# Words of a model: those of at least LEAST tokens in a language, MOST altogether.
LEAST, MOST = 20, 1 << 15
COMMON = 1 << 17
RANK, STEPS, ROUNDS, RATE = 24, 120, 4, 0.05
# Noise per batch: classes, and units of each class.
NOISE_CLASSES, NOISE_UNITS = 32, 16
# Training words altogether: a small corpus is passed over more than once, a large one
# once; and those of a task.
WANTED, MOST_PASSES, TASK_WORDS = 20_000_000, 12, 5_000_000
# Different trigrams of a step, words they are counted over, words scored at once, and
# values of a parameter row in a shuffle.
TRAINED, COUNTED, BATCH, SLAB = 1 << 15, 1 << 20, 1 << 16, 1 << 16
# Parameters changed at once, exponentials of a block of contexts, and the largest score
# whose exponential may be multiplied by another.
STRETCH, WIDE, SAFE = 1 << 14, 1 << 21, 40.0
SKETCH = 12
SMOOTH = 0.1
# Fixed value: the word that stands for the end of a text among the counts.
END_WORD = -1
_SUFFIX = random_words(1 << 16, 4)


def tail_units(data, firsts, ends):
    """Which of the shared units each word has: by its last two bytes."""
    last = data[ends - 1].astype(np.int64)
    before = np.where(ends - firsts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.int64)
    low = np.where((last >= 65) & (last <= 90), last + 32, last)
    low_before = np.where((before >= 65) & (before <= 90), before + 32, before)
    return (_SUFFIX[low_before << 8 | low] % np.uint64(TAILS)).astype(np.int64)


def _words(column):
    """Slices of a text column as ``(rows, hashes as signed, bounds, data, firsts, ends)``."""
    for begin, end in row_slices(column):
        data, offsets = text_bytes(column.slice(begin, end - begin))
        hashes, bounds, firsts, ends = hash_words(data, offsets)
        # The value of END_WORD is left to the end of a text.
        signed = hashes.view(np.int64)
        yield slice(begin, end), np.where(signed == END_WORD, 0, signed), bounds, data, firsts, ends


def _count_task(batches):
    held, size = [], 0

    def counted():
        langs = pa.chunked_array([h[2] for h in held]).dictionary_encode().combine_chunks()
        lang = langs.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        lang = np.repeat(lang, np.concatenate([h[3] for h in held]))
        words, tails = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        # Equal words have equal units.
        found = pa.table({"lang": lang, "word": words, "unit": tails}).group_by(["lang", "word"], use_threads=False)
        found = found.aggregate([("unit", "min"), ([], "count_all")]).combine_chunks()
        lang = found["lang"].to_numpy()
        names = langs.dictionary.take(pa.array(lang, mask=lang < 0))
        arrays = [names, *(found[c].combine_chunks() for c in ("word", "unit_min", "count_all"))]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "word", "unit", "n"])

    for batch in batches:
        for rows, hashes, bounds, data, firsts, ends in _words(batch.column("text")):
            # The end of a text comes after its words.
            words, _ = _with_ends(hashes, bounds, END_WORD)
            tails, full = _with_ends(tail_units(data, firsts, ends), bounds, TAILS)
            held.append((words, tails, batch.column("lang").slice(rows.start, rows.stop - rows.start), np.diff(full)))
            size += len(words)
            if size > 2_000_000:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


class Lookup:
    """Counts and units of the common words, as sorted arrays."""

    def __init__(self, words, counts, units):
        order = np.argsort(words)
        self.words, self.counts, self.units = words[order], counts[order], units[order]

    def find(self, hashes):
        """``(place, whether it is there)`` of each word."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return at, self.words[at] == hashes


def units_of(lookup, heads, hashes, data, firsts, ends):
    at, there = lookup.find(hashes)
    own = lookup.units[at] if len(lookup.units) else at
    return np.where(there & (own >= 0), own, heads + tail_units(data, firsts, ends)), at, there


def _with_ends(values, bounds, end):
    """Values of all words with ``end`` after each text's last one; and new bounds."""
    return np.insert(values, bounds[1:], end), bounds + np.arange(len(bounds))


def contexts(units, bounds, begin=BEGIN):
    """The units one and two places before each, with ``begin`` before a text."""
    one = np.concatenate([[begin], units[:-1]]) if len(units) else units
    two = np.concatenate([[begin, begin], units[:-2]])[: len(units)] if len(units) else units
    first = bounds[:-1][np.diff(bounds) > 0]
    one[first], two[first] = begin, begin
    second = first + 1
    two[second[second < len(units)]] = begin
    return two, one


def _encode_task(shared, heads, smooth_total, base_total):
    """Rows without their texts: units as bytes, sums over common words, other words."""

    def task(batches):
        lookup = Lookup(*shared.value)
        log_counts = np.log10(lookup.counts + SMOOTH)
        for batch in batches:
            columns = {n: [] for n in ("n_tokens", "known", "base", "within", "units", "words", "times")}
            for _, hashes, bounds, data, firsts, ends in _words(batch.column("text")):
                units, at, there = units_of(lookup, heads, hashes, data, firsts, ends)
                rare = ~there
                _, end_there = lookup.find(np.array([END_WORD]))
                end_at = lookup.find(np.array([END_WORD]))[0][0]
                end_log = log_counts[end_at] if end_there[0] else np.log10(SMOOTH)
                logs = np.where(there, log_counts[at] if len(lookup.words) else 0.0, 0.0)
                shared_unit = there & (units >= heads)
                full, where = _with_ends(units, bounds, heads + TAILS)
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    words, times = np.unique(hashes[a:b][rare[a:b]], return_counts=True)
                    columns["n_tokens"].append(b - a + 1)
                    columns["known"].append(int(there[a:b].sum()) + int(end_there[0]))
                    columns["base"].append(float(logs[a:b].sum() + end_log - base_total * (b - a + 1)))
                    columns["within"].append(
                        float(logs[a:b][shared_unit[a:b]].sum() - smooth_total[np.maximum(units[a:b] - heads, -1)].sum())
                    )
                    columns["units"].append(full[where[i] : where[i + 1]].astype(np.uint16).tobytes())
                    columns["words"].append(words)
                    columns["times"].append(times.astype(np.int32))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            arrays = [pa.array(v, k) for v, k in zip(columns.values(), kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), batch.column("place"), *arrays],
                ["doc_id", "held_out", "place", *columns],
            )

    return task


class Held(dict):
    """Arrays by name that are used again: fresh memory takes longer than the sums in it."""

    def array(self, name, *shape):
        size = math.prod(shape)
        if name not in self or self[name].size < size:
            self[name] = np.empty(size, np.float32)
        return self[name][:size].reshape(shape)


def _sums_of(place, columns, n, held=None, name="sums"):
    """Sums of the values of each place below ``n``, as rows; ``columns`` holds a row of
    values for each column of the sums."""
    held = Held() if held is None else held
    by_column = held.array("by column", len(columns), n)
    for sums, values in zip(by_column, columns):
        sums[:] = np.bincount(place, values, n)
    return _turned(by_column, held.array(name, n, len(columns)))


def _rows(values, at, out=None):
    """Rows of a table; much faster than by index, and without a new array if ``out`` is given."""
    return values.take(at, 0, out, "clip")


def _turned(values, out):
    """The transposed array, copied by blocks that stay in the cache."""
    wide = values.shape[1] > values.shape[0]
    for at in range(0, max(values.shape), 1024):
        part = slice(at, at + 1024)
        if wide:
            out[part] = values[:, part].T
        else:
            out[:, part] = values[part].T
    return out


def _sigmoid(x):
    """In the place of ``x``."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def classes_of(sketches, n):
    """A class for each of the sketched units, ``n`` (a power of two) of nearly equal
    sizes: groups are halved along the direction in which they differ most."""
    groups = [np.arange(len(sketches))]
    while len(groups) < n:
        halves = []
        for group in groups:
            some = sketches[group] - sketches[group].mean(0)
            axis = np.linalg.eigh(some.T @ some)[1][:, -1]
            group = group[np.argsort(some @ axis, kind="stable")]
            halves += [group[: (len(group) + 1) // 2], group[(len(group) + 1) // 2 :]]
        groups = halves
    out = np.empty(len(sketches), np.int64)
    for i, group in enumerate(groups):
        out[group] = i
    return out


def n_classes(units):
    """The power of two nearest to the root of the number of units."""
    return 1 << max(0, round(np.log2(max(1, units)) / 2))


class LogBilinear:
    """Scores of units after two units; see the module's text.

    ``counts`` are those of the predicted units (all but the one before a text),
    ``sketches`` a row of features of each, by which they are put in classes."""

    def __init__(self, seed=0, heads=HEADS, counts=None, sketches=None):
        rng = np.random.default_rng(seed)
        self.begin = heads + TAILS + 1
        self.units = self.begin + 1
        n = n_classes(self.begin)
        self.unit_class = classes_of(
            np.arange(self.begin, dtype=np.float64)[:, None] if sketches is None else sketches, n
        )
        # Units of a class are neighbours in ``order``; ``first`` says where each class begins.
        self.order = np.argsort(self.unit_class, kind="stable")
        self.first = np.searchsorted(self.unit_class[self.order], np.arange(n + 1))
        self.rank = np.empty(self.begin, np.int64)
        self.rank[self.order] = np.arange(self.begin)
        self.p = {
            "seen": rng.normal(0, 0.1, (self.units, RANK)).astype(np.float32),
            "far": np.eye(RANK, dtype=np.float32) * 0.5,
            "next": np.eye(RANK, dtype=np.float32),
            "classes": rng.normal(0, 0.1, (n, RANK)).astype(np.float32),
            "class_bias": np.zeros(n, np.float32),
            # By rank, not by unit.
            "units": rng.normal(0, 0.1, (self.begin, RANK)).astype(np.float32),
            "bias": np.zeros(self.begin, np.float32),
        }
        if counts is not None:
            self.set_frequencies(counts)

    def set_frequencies(self, counts):
        """Noise, and the biases to begin with, from counts of units."""
        n = counts.astype(np.float64)[self.order] + 1
        totals = np.add.reduceat(n, self.first[:-1])
        self.class_share = (totals / totals.sum()).astype(np.float32)
        self.share = (n / np.repeat(totals, np.diff(self.first))).astype(np.float32)
        self.running = np.cumsum(n)
        self.p["class_bias"] = np.log(self.class_share)
        self.p["bias"] = np.log(self.share)

    def _tables(self, held):
        """What each unit adds to a vector, by its place."""
        shape, p = self.p["seen"].shape, self.p
        return tuple(np.matmul(p["seen"], p[name], out=held.array(f"table {name}", *shape)) for name in ("far", "next"))

    def _by_class(self, classes):
        """``(class, begin, end)`` of runs of equal values in sorted ``classes``."""
        at = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
        return zip(classes[at].tolist(), at.tolist(), [*at[1:].tolist(), len(classes)])

    def log_probabilities(self, two, one, target):
        """Natural logarithms of the normalised probabilities.

        What the classes add up to depends on the two units before only, and what the
        units of a class add up to on those and the class: neighbours that agree in
        these share one sum, and all sums share the exponentials of each unit before."""
        held = Held()
        far, near = self._tables(held)
        p, classes = self.p, self.unit_class.astype(np.uint16)[target]
        first, run = _runs_of(two.astype(np.int64) * self.units + one)
        two, one = two[first], one[first]
        out = _log_shares(far, near, p["classes"], p["class_bias"], two, one, run, classes, held)
        order = np.argsort(classes, kind="stable")
        for c, a, b in self._by_class(classes[order]):
            own, at = slice(self.first[c], self.first[c + 1]), order[a:b]
            heads, pair = _runs_of(run[at])
            some = run[at[heads]]
            vectors, picked = (p["units"][own], p["bias"][own]), self.rank[target[at]] - own.start
            out[at] += _log_shares(far, near, *vectors, two[some], one[some], pair, picked, held)
        return out

    def log_table(self):
        """Normalised log10 probabilities of every unit after every two units; for small models."""
        n = np.arange(self.units**2 * self.begin)
        two, one = n // (self.units * self.begin), n // self.begin % self.units
        table = self.log_probabilities(two, one, n % self.begin)
        return table.reshape(self.units, self.units, self.begin) / np.float32(np.log(10))

    def gradients(self, two, one, target, times, rng):
        """Of the noise-contrastive loss of one batch: its classes are told from
        ``NOISE_CLASSES`` drawn ones, and its units from ``NOISE_UNITS`` of their class."""
        p, held, grads = self.p, self.held, {}
        far, near = self._tables(held)
        ranks = self.rank[target]
        order = np.argsort(ranks.astype(np.uint16), kind="stable")
        ranks, two, one = ranks[order], two[order], one[order]
        weight = (times[order] / times.sum()).astype(np.float32)
        classes = self.unit_class[self.order[ranks]]
        shape = len(two), RANK
        hidden = _rows(far, two, held.array("hidden", *shape))
        hidden += _rows(near, one, held.array("own", *shape))
        columns, back = _turned(hidden, held.array("columns", *shape[::-1])), held.array("back", *shape)
        back[:] = 0

        def real(at, vectors, bias, log_noise):
            own = _rows(p[vectors], at, held.array("own", *shape))
            error = (_sigmoid(np.einsum("ij,ij->i", hidden, own) + p[bias][at] - log_noise[at]) - 1) * weight
            grads[bias] = np.bincount(at, error, len(log_noise)).astype(np.float32)
            products = np.multiply(error, columns, out=held.array("products", *columns.shape))
            grads[vectors] = _sums_of(at, products, len(log_noise), held, vectors)
            own *= error[:, None]
            np.add(back, own, out=back)

        def noise(at, runs, vectors, bias, log_noise):
            """``at`` has a row of drawn vectors for each of ``runs`` of rows, ``(begin, end)``."""
            own, shift = p[vectors][at], p[bias][at] - log_noise[at]
            error = held.array("error", len(hidden), at.shape[1])
            for (a, b), drawn, more in zip(runs, own, shift):
                np.matmul(hidden[a:b], drawn.T, out=error[a:b])
                error[a:b] += more
            _sigmoid(error)
            error *= weight[:, None]
            sums, products = np.empty(at.shape, np.float32), np.empty(own.shape, np.float32)
            more = held.array("own", *shape)
            for i, (a, b) in enumerate(runs):
                some = error[a:b]
                np.add.reduce(some, 0, out=sums[i])
                np.matmul(some.T, hidden[a:b], out=products[i])
                np.matmul(some, own[i], out=more[a:b])
            np.add(back, more, out=back)
            np.add.at(grads[bias], at.ravel(), sums.ravel())
            np.add.at(grads[vectors], at.ravel(), products.reshape(-1, RANK))

        def drawn(low, high, running, n):
            """``n`` places of each range, as often as their part of it."""
            below, to = np.where(low > 0, running[low - 1], 0.0)[:, None], running[high - 1][:, None]
            at = np.searchsorted(running, below + rng.random((len(low), n)) * (to - below), "right")
            return np.clip(at, low[:, None], high[:, None] - 1)

        of_classes = "classes", "class_bias", np.log(NOISE_CLASSES * self.class_share)
        of_units = "units", "bias", np.log(NOISE_UNITS * self.share)
        real(classes, *of_classes)
        all_classes = np.array([0]), np.array([len(self.class_share)])
        among = drawn(*all_classes, np.cumsum(self.class_share, dtype=np.float64), NOISE_CLASSES)
        noise(among, [(0, len(hidden))], *of_classes)
        real(ranks, *of_units)
        present, *runs = zip(*self._by_class(classes))
        present = np.array(present)
        noise(drawn(self.first[present], self.first[present + 1], self.running, NOISE_UNITS), list(zip(*runs)), *of_units)
        _turned(back, columns)
        by_far, by_near = (_sums_of(x, columns, self.units, held, name) for x, name in ((two, "by far"), (one, "by near")))
        grads["far"], grads["next"] = p["seen"].T @ by_far, p["seen"].T @ by_near
        grads["seen"] = np.matmul(by_far, p["far"].T, out=far)
        grads["seen"] += np.matmul(by_near, p["next"].T, out=near)
        return grads

    def start(self):
        """Moments of the steps that follow, and parameters that they may change."""
        self.p, self.held = {k: v.copy() for k, v in self.p.items()}, Held()
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps = 0

    def step(self, two, one, target, times, rng, rate=RATE):
        self.steps += 1
        for name, grad in self.gradients(two, one, target, times, rng).items():
            mean, square = self.moments[name]
            arrays = [v.reshape(-1) for v in (self.p[name], grad, mean, square)]
            part, least = np.float32(rate / (1 - 0.9**self.steps)), np.float32(1 - 0.99**self.steps)
            # A stretch that stays in the cache at a time.
            for at in range(0, grad.size, STRETCH):
                value, grad_, mean, square = (v[at : at + STRETCH] for v in arrays)
                mean += 0.1 * (grad_ - mean)
                square += 0.01 * (grad_ * grad_ - square)
                value -= mean * part / (np.sqrt(square / least) + np.float32(1e-8))

    def train(self, cells, counts, steps=STEPS, rate=RATE):
        """Steps over counted trigrams ``(two * units + one) * units + target``."""
        if not len(cells):
            return self
        two, one, target = cells // self.units**2, cells // self.units % self.units, cells % self.units
        self.set_frequencies(np.bincount(target, counts, self.begin))
        self.start()
        rng = np.random.default_rng(0)
        for i in range(steps):
            at = slice(0, len(cells)) if len(cells) <= BATCH else rng.integers(0, len(cells), BATCH)
            self.step(two[at], one[at], target[at], counts[at], rng, rate * (1 - i / steps))
        return self


def _runs_of(values):
    """Where each run of equal neighbours begins, and which run each value is in."""
    new = np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]])
    return np.flatnonzero(new), np.cumsum(new, dtype=np.int32) - 1


def _log_shares(far, near, vectors, bias, two, one, row, at, held):
    """Logarithm of the share of vector ``at`` in the exponentials of its context.

    Contexts are ``two`` and ``one``, and ``row`` (ascending) is that of each ``at``. A
    score is the sum of one of either unit, so its exponential is a product of two, which
    are found once for each unit of a block of contexts."""
    out = np.empty(len(at), np.float32)
    size = max(1, WIDE // len(vectors))
    for begin in range(0, len(two), size):
        own = slice(*np.searchsorted(row, (begin, begin + size)))
        picked, rows = at[own], row[own] - begin
        heads, place_two = _runs_of(two[begin : begin + size])
        ones, place_one = _places(one[begin : begin + size], len(near))
        by_two, by_one = (
            np.matmul(_rows(table, units, held.array("rows", len(units), RANK)), vectors.T, out=held.array(name, len(units), len(vectors)))
            for name, table, units in (("by two", far, two[begin + heads]), ("by one", near, ones))
        )
        by_two += bias
        if max(by_two.max(), by_one.max(), -by_two.min(), -by_one.min()) < SAFE:
            score = by_two[place_two[rows], picked] + by_one[place_one[rows], picked]
            np.exp(by_two, out=by_two)
            np.exp(by_one, out=by_one)
            total = np.empty(len(place_two), np.float32)
            first, second = held.array("contexts", 2, 256, len(vectors))
            for some in range(0, len(total), 256):
                part = slice(some, some + 256)
                n = len(total[part])
                x, y = _rows(by_two, place_two[part], first[:n]), _rows(by_one, place_one[part], second[:n])
                np.einsum("ij,ij->i", x, y, out=total[part])
            out[own] = score - np.log(total)[rows]
            continue
        for some in range(0, len(place_two), 4096):
            scores = _rows(by_two, place_two[some : some + 4096])
            scores += _rows(by_one, place_one[some : some + 4096])
            part = slice(*np.searchsorted(rows, (some, some + 4096)))
            most = scores.max(1)
            score = scores[rows[part] - some, picked[part]]
            total = most + np.log(np.exp(scores - most[:, None]).sum(1))
            out[own][part] = score - total[rows[part] - some]
    return out


def _places(values, n):
    """The different ones of values below ``n``, and which of them each value is."""
    there = np.zeros(n, bool)
    there[values] = True
    different = np.flatnonzero(there)
    place = np.empty(n, np.int64)
    place[different] = np.arange(len(different))
    return different, place[values]


def _runs(batches):
    """The units of about ``COUNTED`` words of the rows at a time, a list of arrays."""
    held, size = [], 0
    for batch in batches:
        for raw in batch.column("units").to_pylist():
            held.append(np.frombuffer(raw, np.uint16))
            size += len(held[-1])
            if size >= COUNTED:
                yield held
                held, size = [], 0
    if held:
        yield held


def _counted(texts, begin, rng):
    """``(two, one, unit, times)`` of the different trigrams of some texts, in an order
    without meaning, ``TRAINED`` at most at once."""
    flat, units = np.concatenate(texts).astype(np.int64), begin + 1
    two, one = contexts(flat, np.concatenate([[0], np.cumsum([len(u) for u in texts])]), begin)
    cells, times = np.unique((two * units + one) * units + flat, return_counts=True)
    order = rng.permutation(len(cells))
    for at in range(0, len(cells), TRAINED):
        cell, n = cells[order[at : at + TRAINED]], times[order[at : at + TRAINED]]
        yield cell // units**2, cell // units % units, cell % units, n.astype(np.float32)


def _slabs(values, weight, added):
    """A flat array as rows ``part``, ``some``, ``weight``, ``data``; a few at a time.
    ``some`` is one of ``added`` groups of tasks."""
    some = TaskContext.get().partitionId() % added
    for begin in range(0, len(values), SLAB):
        data = (values[begin : begin + SLAB] * np.float32(weight)).astype(np.float32).tobytes()
        arrays = [pa.array([begin // SLAB]), pa.array([some]), pa.array([float(weight)]), pa.array([data], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "some", "weight", "data"])


def _add_slabs(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, weight = None, 0.0
    for batch in batches:
        for w, data in zip(batch.column("weight").to_pylist(), batch.column("data").to_pylist()):
            value = np.frombuffer(data, np.float32).astype(np.float64)
            total, weight = value if total is None else total + value, weight + w
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()]), pa.array([0]), pa.array([weight]),
         pa.array([total.astype(np.float32).tobytes()], pa.binary())],
        ["part", "some", "weight", "data"],
    )


def _summed(frame, task):
    """``(sum, weight)`` of the arrays that ``task`` gives; None without any. Added up by
    Spark in two steps, so no task adds up what all tasks gave, and the driver gets one
    array however many there are."""
    kind = "part long, some long, weight double, data binary"
    added = frame.mapInArrow(task, kind).groupBy("part", "some").applyInArrow(_add_slabs, kind)
    rows = added.groupBy("part").applyInArrow(_add_slabs, kind).collect()
    rows.sort(key=lambda r: r.part)
    return (np.concatenate([np.frombuffer(r.data, np.float32) for r in rows]), rows[0].weight) if rows else (None, 0)


def _sketch_task(begin, frequency, added):
    """Sums over what comes before each unit, of a fixed random row for each unit."""
    rng = np.random.default_rng(1)
    rows = rng.normal(0, 1, (begin + 1, SKETCH)).astype(np.float32)
    rows /= np.sqrt(np.append(frequency, frequency[-1]) + 1)[:, None].astype(np.float32)
    columns = np.ascontiguousarray(rows.T)

    def task(batches):
        out, held = np.zeros((begin, SKETCH), np.float32), Held()
        some = False
        for texts in _runs(batches):
            units = np.concatenate(texts).astype(np.int64)
            _, one = contexts(units, np.concatenate([[0], np.cumsum([len(u) for u in texts])]), begin)
            for at in range(0, len(units), BATCH):
                part = slice(at, at + BATCH)
                out += _sums_of(units[part], np.take(columns, one[part], 1), begin, held)
            some = True
        if some:
            yield from _slabs(out.ravel(), 1, added)

    return task


def _train_task(shared, turn, passes, added):
    """Parameters after steps on the task's rows; those of ``passes`` of ``ROUNDS`` runs if
    these are fewer, else all of them, more than once."""

    def task(batches):
        model = LogBilinear.__new__(LogBilinear)
        model.__dict__ |= shared.value.__dict__
        model.p = dict(model.p)
        model.start()
        place, rng, words = TaskContext.get().partitionId(), np.random.default_rng(turn), 0
        for i, texts in enumerate(_runs(batches)):
            if (i + place + turn) % ROUNDS < passes:
                for _ in range(max(1, round(passes / ROUNDS))):
                    for batch in _counted(texts, model.begin, rng):
                        model.step(*batch, rng, RATE * (1 - turn / ROUNDS))
                words += sum(map(len, texts))
        if words:
            flat = np.concatenate([v.ravel() for v in model.p.values()])
            yield from _slabs(flat, words, added)

    return task


def train_model(training, heads, counts):
    """A model of the frame's ``units``; ``counts`` are those of the predicted units."""
    begin, spark, words = heads + TAILS + 1, training.sparkSession, int(counts.sum())
    # A task sends all parameters once a round, so it gets enough rows for that.
    tasks = 1 + words // TASK_WORDS
    training = training.coalesce(tasks)
    # What so many tasks send is added up in as many groups as each then has tasks.
    added = max(1, round(tasks**0.5))
    passes = min(MOST_PASSES, max(1, round(WANTED / max(1, words))))
    sums, _ = _summed(training, _sketch_task(begin, counts, added))
    if sums is None:
        return LogBilinear(heads=heads, counts=counts)
    sketches = sums.reshape(begin, SKETCH).astype(np.float64) / (counts + LEAST)[:, None]
    model = LogBilinear(heads=heads, counts=counts, sketches=sketches)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        total, weight = _summed(training, _train_task(shared, turn, passes, added))
        if total is None:
            continue
        at = 0
        for name, value in model.p.items():
            model.p[name] = (total[at : at + value.size] / weight).reshape(value.shape).astype(np.float32)
            at += value.size
        shared.unpersist()
    return model


def _score_task(shared):
    def task(batches):
        model = shared.value
        for batch in batches:
            units = [np.frombuffer(raw, np.uint16) for raw in batch.column("units").to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(u) for u in units])]).astype(np.int64)
            flat = np.concatenate([np.zeros(0, np.uint16), *units])
            two, one = (x.astype(np.uint16) for x in contexts(flat, bounds, model.begin))
            # Equal trigrams are neighbours in this order.
            order = np.argsort(flat, kind="stable")
            for values in (one, two):
                order = order[np.argsort(values[order], kind="stable")]
            two, one, flat = two[order], one[order], flat[order]
            first, run = _runs_of((two.astype(np.int64) * model.units + one) * model.units + flat)
            logs = np.empty(len(flat), np.float32)
            logs[order] = model.log_probabilities(two[first], one[first], flat[first])[run]
            del order, run, two, one, flat
            running = np.concatenate([[0], np.cumsum(logs, dtype=np.float64)])
            scores = np.diff(running[bounds]) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns - 1)], pa.array(scores, pa.float64())],
                [*batch.schema.names[:-1], "model"],
            )

    return task


def count_words(training):
    """``lang``, ``word`` (hash), which shared ``unit`` it would have, and ``n`` of all
    words of a frame of texts."""
    counted = training.select("text", "lang").mapInArrow(_count_task, "lang string, word long, unit long, n long")
    # Equal words have equal units.
    return counted.groupBy("lang", "word").agg(F.min("unit").alias("unit"), F.sum("n").alias("n"))


LEVEL = "cast(floor(8 * log2(n)) as int)"


def _common(counts, most=COMMON):
    """A condition for the most frequent words, ``most`` at most: those above a frequency
    that is found from the number of words per eighth of a doubling. No sort, no single task."""
    level = F.expr(LEVEL)
    sizes = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    sizes = sizes.sort_values("level", ascending=False)
    fit = sizes[sizes["n"].cumsum() <= most]["level"]
    return level >= int(fit.min()) if len(fit) else F.lit(False)


def _head_words(by_lang, most, least):
    """The words that are units of their own: all of at least ``least`` tokens in a
    language or, if these are more than ``most``, the most frequent of each language,
    with room divided evenly among the languages that need it."""
    rows = by_lang.filter((F.col("n") >= least) & (F.col("word") != END_WORD))
    sizes = rows.groupBy("lang", F.expr(LEVEL).alias("level")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    levels = {}
    for lang, level, n in sizes.itertuples(index=False):
        levels.setdefault(lang if isinstance(lang, str) else None, []).append((level, n))
    room, keep = most, F.lit(False)
    for i, lang in enumerate(sorted(levels, key=lambda x: (sum(n for _, n in levels[x]), x or ""))):
        share, lowest = room // (len(levels) - i), None
        for level, n in sorted(levels[lang], reverse=True):
            if n > share:
                break
            share, room, lowest = share - n, room - n, level
        if lowest is not None:
            keep = keep | (F.col("lang").eqNullSafe(F.lit(lang)) & (F.expr(LEVEL) >= int(lowest)))
    return rows.filter(keep).select("word").distinct()


def score_documents(docs, id_col="doc_id", text_col="text", lang_col="lang", most=MOST, least=LEAST):
    """One row per document: ``held_out``, counts, the base score and the model's."""
    bounded_batches(docs)
    spark = docs.sparkSession
    doc_id = F.col(f"`{id_col}`")
    held_out = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))
    lang = F.col(f"`{lang_col}`") if lang_col in docs.columns else F.lit(None)
    rows = docs.select(
        doc_id.alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), held_out.alias("held_out"),
        lang.cast("string").alias("lang"),
    )
    by_lang = stage(count_words(rows.filter(~held_out)), "words-by-language")
    counts = stage(by_lang.groupBy("word").agg(F.min("unit").alias("unit"), F.sum("n").alias("n")), "words")

    head_words = _head_words(by_lang, most, least).withColumn("head", F.lit(True))
    common = counts.join(head_words.hint(MERGE), "word", "left").filter(F.col("head") | _common(counts) | (F.col("word") == END_WORD))
    common = common.select("word", "n", "unit", F.coalesce("head", F.lit(False)).alias("head")).toPandas()
    common = common.sort_values(["n", "word"], ascending=[False, True])
    words, n, tail = (common[c].to_numpy(np.int64) for c in ("word", "n", "unit"))
    own = np.flatnonzero(common["head"].to_numpy(bool))
    heads = len(own)
    units = np.full(len(words), -1)
    units[own] = np.arange(heads)
    # Totals per shared unit, and of the ends: a row each.
    totals = counts.groupBy("unit").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).toPandas()
    tokens, kinds = int(totals["n"].sum()), int(totals["kinds"].sum())
    in_unit, kinds_in_unit = np.zeros(TAILS + 1), np.zeros(TAILS + 1)
    in_unit[totals["unit"]], kinds_in_unit[totals["unit"]] = totals["n"], totals["kinds"]
    np.subtract.at(in_unit, tail[own], n[own])
    np.subtract.at(kinds_in_unit, tail[own], 1)
    # log10 of what a word's smoothed count is divided by; 0, the last, for units of one word.
    log_totals = np.append(np.log10(in_unit[:TAILS] + SMOOTH * (kinds_in_unit[:TAILS] + 1)), 0.0)
    base_total = float(np.log10(tokens + SMOOTH * (kinds + 1)))

    shared = spark.sparkContext.broadcast((words, n, units))
    kind = docs.select(doc_id.alias("doc_id")).schema["doc_id"].dataType
    fields = [("doc_id", kind), ("held_out", T.BooleanType()), ("place", T.LongType()), ("n_tokens", T.LongType()),
              ("known", T.LongType()), ("base", T.DoubleType()), ("within", T.DoubleType()), ("units", T.BinaryType()),
              ("words", T.ArrayType(T.LongType())), ("times", T.ArrayType(T.IntegerType()))]
    encoded = stage(
        rows.drop("lang").withColumn("place", F.monotonically_increasing_id()).mapInArrow(
            _encode_task(shared, heads, log_totals, base_total), T.StructType([T.StructField(*f) for f in fields])
        ),
        "encoded",
    )
    model = train_model(encoded.filter("NOT held_out").select("units"), heads, np.concatenate([n[own], in_unit]))

    rare = encoded.select("place", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "place", F.col("w.words").alias("word"), F.col("w.times").alias("times")
    )
    joined = rare.join(counts.select("word", "n").hint(MERGE), "word", "left")
    log_count = F.log10(F.coalesce("n", F.lit(0)) + SMOOTH) * F.col("times")
    sums = joined.groupBy("place").agg(
        F.sum(log_count).alias("rare_log"), F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("rare_known")
    )
    scored = encoded.select("doc_id", "held_out", "place", "n_tokens", "known", "base", "within", "units").mapInArrow(
        _score_task(spark.sparkContext.broadcast(model)),
        T.StructType([T.StructField(*f) for f in fields[:7]] + [T.StructField("model", T.DoubleType())]),
    )
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return scored.join(sums.hint(MERGE), "place", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rare_log).alias("base_score"),
        (F.col("model") + F.col("within") + rare_log).alias("score"),
    )
