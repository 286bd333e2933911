"""Maximal periodic runs of words, and texts with the repeats of each run removed.

A run is a stretch of consecutive words whose smallest period goes into it a given
number of times and that no neighbouring word extends. All runs of a text are found by
Kruskal's method over its suffixes. Suffixes start as classes of their own, and classes
that are neighbours in suffix order are united in the order of decreasing common prefix
(LCP). A class is an ordered set of positions, kept by union-find; the smaller set goes
into the larger. Two positions i < j that become neighbours when their classes are united
at LCP L seed a run if j - i goes into L: the words from i to j + L have period j - i, and
no smaller one, as a position in between would have been united before. If the words
before i and j differ as well, the run begins at i and ends before j + L. So each run is
found once, and at most n log n pairs are looked at.

Suffix order and LCPs come from ranks of 1, 2, 4, .. words, made by array operations over
all texts of a batch. Positions are left out that cannot seed: those in classes of as
many words as the shortest run's LCP that hold one position only, or whose positions all
follow the same word, as only differing words before two positions begin a run.

A task holds one batch of texts, of 2 MB or one text; a text is never divided between
tasks, and its ranks take 4 bytes a word for each doubling of its longest repeat.

Defined cases: NULL and empty text has no words and no runs, and its collapsed text is
empty; a NULL id stays NULL; repeated rows are rows of their own; an empty table gives no
rows. Words are compared as 64-bit hashes.
"""

from bisect import bisect_right
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlog.llm.frames import bounded_batches
from visitlog.llm.words import SAME, SPACES, hash_words, row_slices, text_bytes

EXPONENT, LENGTH = 4, 6
# Positions in one block of an ordered set.
BLOCK = 1000
RUN = "struct<start: long, length: long, period: long>"


class Positions:
    """An ordered set of positions in blocks, so that a position goes in without
    moving all that follow."""

    def __init__(self, position):
        self.blocks, self.firsts, self.size = [[position]], [position], 1

    def __iter__(self):
        for block in self.blocks:
            yield from block

    def add(self, position):
        """Put a new position in; its neighbours before and after, or None."""
        b = max(bisect_right(self.firsts, position) - 1, 0)
        block = self.blocks[b]
        at = bisect_right(block, position)
        if at:
            before = block[at - 1]
        else:
            before = self.blocks[b - 1][-1] if b else None
            self.firsts[b] = position
        if at < len(block):
            after = block[at]
        else:
            after = self.firsts[b + 1] if b + 1 < len(self.blocks) else None
        block.insert(at, position)
        self.size += 1
        if len(block) > BLOCK:
            self.blocks.insert(b + 1, block[BLOCK // 2 :])
            self.firsts.insert(b + 1, block[BLOCK // 2])
            del block[BLOCK // 2 :]
        return before, after


def newly_adjacent(suffixes, lcps):
    """Unite neighbouring suffixes by decreasing LCP; yields ``(i, j, lcp)`` for
    positions ``i < j`` of two classes that are neighbours in the united class."""
    parent = list(range(len(suffixes)))
    classes = [None] * len(suffixes)

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for edge in np.argsort(-lcps, kind="stable").tolist():
        lcp = int(lcps[edge])
        large, small = root(edge), root(edge + 1)
        for x in (large, small):
            if classes[x] is None:
                classes[x] = Positions(suffixes[x])
        if classes[large].size < classes[small].size:
            large, small = small, large
        into, added = classes[large], list(classes[small])
        parent[small], classes[small] = large, None
        for k, position in enumerate(added):
            before, after = into.add(position)
            # What went in just now is of the same class; so is what goes in next.
            if before is not None and not (k and before == added[k - 1]):
                yield before, position, lcp
            if after is not None and not (k + 1 < len(added) and added[k + 1] < after):
                yield position, after, lcp


def _ranked(keys):
    """Dense ranks of the keys, in their order."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    ranks = np.empty(len(keys), np.int32)
    ranks[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    return ranks


class Ranks:
    """Ranks of the stretches of 1, 2, 4, .. words from each place, text by text."""

    def __init__(self, hashes, bounds):
        sizes = np.diff(bounds)
        text = np.repeat(np.arange(len(sizes)), sizes)
        word = np.unique(hashes, return_inverse=True)[1]
        self.text, self.end = text, np.repeat(bounds[1:], sizes)
        self.levels = [_ranked(text * len(hashes) + word)]
        # The word before each place, -1 at the beginning of a text.
        first = np.arange(len(text)) == np.repeat(bounds[:-1], sizes)
        self.before = np.where(first, -1, np.roll(self.levels[0], 1))

    def ahead(self, ranks, steps):
        """1 + the rank so many steps further, 0 beyond the text."""
        place = np.arange(len(ranks)) + steps
        return np.where(place < self.end, ranks[np.minimum(place, len(ranks) - 1)] + 1, 0)

    def double(self):
        ranks = self.levels[-1].astype(np.int64)
        ahead = self.ahead(ranks, 1 << (len(self.levels) - 1))
        self.levels.append(_ranked(ranks * (len(ranks) + 1) + ahead))

    def apart(self):
        """Whether no two places have the same rank."""
        return int(self.levels[-1].max()) + 1 == len(self.text)

    def seeding(self, words):
        """Which texts have places that share so many words after different ones."""
        while 2 << (len(self.levels) - 1) <= words:
            self.double()
        size = 1 << (len(self.levels) - 1)
        ranks = self.levels[-1].astype(np.int64)
        whole = np.flatnonzero(np.arange(len(ranks)) + words <= self.end)
        keys = (ranks * (len(ranks) + 1) + self.ahead(ranks, words - size))[whole]
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        before, text = self.before[whole[order]], self.text[whole[order]]
        # In a class of equal keys, some neighbours differ if not all are the same.
        return np.unique(text[1:][same & (before[1:] != before[:-1])])

    def only(self, texts):
        """The same for some of the texts; also the places that are left."""
        chosen = np.zeros(self.text[-1] + 1 if len(self.text) else 0, bool)
        chosen[texts] = True
        places = np.flatnonzero(chosen[self.text])
        left = object.__new__(Ranks)
        left.text, left.before = self.text[places], self.before[places]
        left.end = np.searchsorted(left.text, left.text, "right")
        left.levels = [_ranked(level[places]) for level in self.levels]
        return left, places

    def suffixes(self):
        """Places in suffix order, and the LCP of each with the next one."""
        while not self.apart():
            self.double()
        order = np.empty(len(self.text), np.int64)
        order[self.levels[-1]] = np.arange(len(order))
        a, b = order[:-1].copy(), order[1:].copy()
        lcps, last = np.zeros(len(a), np.int64), len(order) - 1
        for level in range(len(self.levels) - 1, -1, -1):
            ranks = self.levels[level]
            inside = (a < self.end[order[:-1]]) & (b < self.end[order[1:]])
            step = np.where(inside & (ranks[np.minimum(a, last)] == ranks[np.minimum(b, last)]), 1 << level, 0)
            lcps, a, b = lcps + step, a + step, b + step
        return order, lcps


def find_runs(hashes, bounds, exponent=EXPONENT, length=LENGTH):
    """All runs of the texts with words ``hashes[bounds[i] : bounds[i + 1]]``.

    Returns arrays ``(text, start, length, period)`` in that order; a run is at least
    ``length`` words and ``exponent``, 2 or more, periods long."""
    nothing = (np.zeros(0, np.int64),) * 4
    if not len(hashes):
        return nothing
    # The least LCP of a run's first two periods.
    least = min(max(length - d, (exponent - 1) * d) for d in range(1, max(length, 2)))
    ranks = Ranks(hashes, bounds)
    texts = ranks.seeding(least)
    if not len(texts):
        return nothing
    ranks, places = ranks.only(texts)
    order, lcps = ranks.suffixes()
    # Classes of suffixes that share so many words, as stretches of the order.
    cuts = np.concatenate([[0], np.flatnonzero(lcps < least) + 1])
    before = ranks.before[order]
    mixed = np.flatnonzero(np.minimum.reduceat(before, cuts) != np.maximum.reduceat(before, cuts))
    cuts = np.append(cuts, len(order))
    found = [
        seed
        for c in mixed.tolist()
        for seed in newly_adjacent(order[cuts[c] : cuts[c + 1]].tolist(), lcps[cuts[c] : cuts[c + 1] - 1])
        if (exponent - 1) * (seed[1] - seed[0]) <= seed[2] and seed[1] - seed[0] + seed[2] >= length
    ]
    if not found:
        return nothing
    i, j, lcp = np.array(found, np.int64).T
    first = ranks.before[i] != ranks.before[j]
    i, j, lcp = i[first], j[first], lcp[first]
    text = ranks.text[i]
    start = places[i] - bounds[text]
    by = np.lexsort((j - i, start, text))
    return text[by], start[by], (j - i + lcp)[by], (j - i)[by]


def periodic_runs(docs, id_col="doc_id", text_col="text", exponent=EXPONENT, length=LENGTH):
    """One row per document: ``doc_id``, ``runs`` by start and period, and
    ``collapsed``: its words joined by one space, without those that a run holds after
    its first period."""
    bounded_batches(docs)
    docs = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    item = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def of_slice(batch):
        column = batch.column("text")
        data, offsets = text_bytes(column)
        hashes, bounds, _, _ = hash_words(data, offsets, SPACES, SAME)
        text, start, size, period = find_runs(hashes, bounds, exponent, length)
        lists = np.searchsorted(text, np.arange(len(column) + 1)).astype(np.int32)
        runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, size, period)], fields=list(item))
        joined = []
        for row in range(len(column)):
            # Bytes are split at just the six separators.
            words = data[offsets[row] : offsets[row + 1]].tobytes().split()
            own = slice(lists[row], lists[row + 1])
            if own.start < own.stop:
                inside = np.zeros(len(words) + 1, np.int64)
                np.add.at(inside, start[own] + period[own], 1)
                np.add.at(inside, start[own] + size[own], -1)
                words = compress(words, (np.cumsum(inside) == 0).tolist())
            joined.append(b" ".join(words))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(lists), runs), pa.array(joined, pa.binary()).cast(pa.string())],
            ["doc_id", "runs", "collapsed"],
        )

    def task(batches):
        for batch in batches:
            for begin, end in row_slices(batch.column("text")):
                yield of_slice(batch.slice(begin, end - begin))

    out = T.StructType.fromDDL(f"runs array<{RUN}>, collapsed string")
    return docs.mapInArrow(task, T.StructType(docs.select("doc_id").schema.fields + out.fields))


# The separators of words.
_SEPARATORS = r"[\x20\x09-\x0D]+"


def tiled(text, key):
    """The texts of every tenth key with a stretch of words repeated up to their end;
    where it begins and how long it is follow from the key's checksum."""
    h = F.crc32(key.cast("string"))
    words = F.array_remove(F.split(text, _SEPARATORS), "")
    n, g = F.size(words).cast("long"), F.floor(h / 10)
    begin = F.pmod(g, n)
    period = 1 + F.floor((n - begin) / (3 + g % 8))
    times = F.ceil((n - begin) / period).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(words, (begin + 1).cast("int"), period.cast("int")), times))
    whole = F.concat(F.slice(words, F.lit(1), begin.cast("int")), repeated)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.slice(whole, F.lit(1), n.cast("int")), " ")).otherwise(text)


def document_runs(docs, id_col="doc_id", text_col="text"):
    """One row per document with digests of its runs and of its collapsed text, and the
    run of most periods; every tenth text is tiled first."""
    identity = F.col(f"`{id_col}`")
    docs = docs.select(identity.alias("doc_id"), tiled(F.col(f"`{text_col}`").cast("string"), identity).alias("text"))
    found = periodic_runs(docs)
    longest = F.expr(
        f"aggregate(runs, CAST(NULL AS {RUN}),"
        " (best, r) -> IF(best IS NULL OR r.length * best.period > best.length * r.period, r, best))"
    )
    listed = F.transform(
        "runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    )
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start"),
        F.col("best.length"),
        F.col("best.period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
