"""Benchmark decontamination by Wu-Manber search over words.

All windows of ten consecutive words of the benchmark items are searched for at
once. A table of shifts, indexed by a hash of two neighbouring words, says how
far the search may jump ahead; where the shift is 0, the bucket of the window
ends with that hash selects the windows to test, and their words are compared
one by one. Items of fewer words are windows of their own length, searched for
in a table of that length.

The search is narrow: no row of the documents is shuffled. The benchmark reaches
the tasks in blocks of at most ``block_windows`` windows, one pass for each
block, so what is broadcast has a bound whatever the benchmark's size.

Defined cases: NULL or empty text has no words and is never hit; an item
without words (NULL too) matches nothing; the windows of items with a NULL id
count like all others, and such items together are one NULL among the items, which
no list of ids names; repeated rows are judged alike; an
empty benchmark hits nothing; other columns pass through unchanged.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlog.llm.frames import bounded_batches, free_name
from visitlog.llm.words import LOWER, PUNCTUATION, hash_words, mix, row_slices, text_bytes
from visitlog.session import stage

WINDOW = 10
BLOCK_WINDOWS = 200_000
SHIFT_BITS = 20
_SPLIT = bytes(32 if PUNCTUATION[b] else int(LOWER[b]) for b in range(256))


def item_words(text):
    return (text or "").encode("utf-8", "replace").translate(_SPLIT).split()


def windows_of(words, size=WINDOW):
    """The windows of an item; a shorter item is one window."""
    if len(words) <= size:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def _word_hashes(words):
    data, offsets = text_bytes(pa.array([b" ".join(words).decode("utf-8", "replace")]))
    return hash_words(data, offsets, PUNCTUATION, LOWER)[0]


def _blocks(hashes, width):
    """Hash of each run of ``width`` (1 or 2) words, by its last word."""
    if width == 1:
        return hashes
    return mix(hashes[:-1] * np.uint64(3) + hashes[1:])


class WindowSearch:
    """Shift table and buckets for windows that all have ``length`` words."""

    def __init__(self, length, windows):
        self.length = length
        self.width = min(2, length)
        self.shift = np.full(1 << SHIFT_BITS, length - self.width + 1, np.uint8)
        self.buckets = {}
        for window, items in windows.items():
            blocks = _blocks(_word_hashes(window), self.width)
            slots = blocks & np.uint64((1 << SHIFT_BITS) - 1)
            jumps = np.arange(len(blocks) - 1, -1, -1, dtype=np.uint8)
            np.minimum.at(self.shift, slots, jumps)
            self.buckets.setdefault(int(blocks[-1]), []).append((window, items))

    def find(self, hashes, word_at):
        """``(first word, items)`` of every occurrence in one text.

        ``word_at`` gives the bytes of the text's words in a range.
        """
        if len(hashes) < self.length:
            return
        blocks = _blocks(hashes, self.width)
        jumps = self.shift[blocks & np.uint64((1 << SHIFT_BITS) - 1)].tobytes()
        at = self.length - self.width
        while at < len(jumps):
            jump = jumps[at]
            if jump:
                at += jump
                continue
            for window, items in self.buckets.get(int(blocks[at]), ()):
                first = at + self.width - self.length
                if word_at(first, first + self.length) == window:
                    yield first, items
            at += 1


def _searches(rows):
    """A search for each length of window."""
    by_length = {}
    for item_id, text in rows:
        for window in windows_of(item_words(text)):
            by_length.setdefault(len(window), {}).setdefault(window, set()).add(item_id)
    return [WindowSearch(length, windows) for length, windows in sorted(by_length.items())]


def _item_blocks(benchmark, item_col, text_col, block_windows):
    """Items in runs that have at most ``block_windows`` windows or one item."""
    rows, windows = [], 0
    items = benchmark.select(F.col(f"`{item_col}`"), F.col(f"`{text_col}`").cast("string"))
    for item_id, text in items.toLocalIterator():
        n = len(windows_of(item_words(text)))
        if rows and windows + n > block_windows:
            yield rows
            rows, windows = [], 0
        rows.append((item_id, text))
        windows += n
    yield rows


def find_benchmark(docs, benchmark, text_col="text", item_col="item_id", item_text_col="text",
                   found="found", block_windows=BLOCK_WINDOWS):
    """``docs`` with the column ``found``: struct of ``n_words``, the hit words as
    ``spans`` (first word, word after the last one; sorted, not overlapping), and
    the sorted distinct ``items`` whose windows occur (as text, NULL last)."""
    bounded_batches(docs)
    found = free_name(docs, found)
    kind = T.StructType([
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ])
    out = docs.withColumn(found, F.lit(None).cast(kind))
    for number, rows in enumerate(_item_blocks(benchmark, item_col, item_text_col, block_windows)):
        if number:
            # Stored, so that one block of windows at a time is held, by driver and tasks.
            out = stage(out, "searched")
        rows = [(None if item_id is None else str(item_id), text) for item_id, text in rows]
        out = out.mapInArrow(_search_task(rows, text_col, found), out.schema)
    return out


def _search_task(rows, text_col, found):
    def task(batches):
        searches = _searches(rows)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            column = batch.column(at)
            before = batch.column(batch.schema.get_field_index(found)).to_pylist()
            results = []
            for begin, end in row_slices(column):
                results += _search_slice(searches, column.slice(begin, end - begin), before[begin:end])
            arrays = [
                pa.array(results, f.type) if f.name == found else batch.column(i)
                for i, f in enumerate(batch.schema)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return task


def _search_slice(searches, column, before):
    data, offsets = text_bytes(column)
    hashes, bounds, firsts, ends = hash_words(data, offsets, PUNCTUATION, LOWER)
    for row, (begin, end) in enumerate(zip(bounds[:-1], bounds[1:])):

        def word_at(i, j, begin=begin):
            raw = data[firsts[begin + i] : ends[begin + j - 1]].tobytes()
            return tuple(raw.translate(_SPLIT).split())

        old = before[row] or {"spans": [], "items": []}
        spans, items = [tuple(s) for s in old["spans"]], set(old["items"])
        for search in searches:
            for first, ids in search.find(hashes[begin:end], word_at):
                spans.append((first, first + search.length))
                items |= ids
        yield {"n_words": int(end - begin), "spans": _merged(spans), "items": sorted(items, key=lambda x: (x is None, x or ""))}


def _merged(spans):
    out = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def contamination(docs, benchmark, id_col="doc_id", text_col="text"):
    """One row per document: counted hits, items, their digest, and the verdict."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = find_benchmark(rows, benchmark)
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.size("found.spans") > 0).alias("contaminated"),
    )


def remove_contaminated(docs, benchmark, text_col="text"):
    """The documents in which no window of the benchmark occurs."""
    found = free_name(docs, "found")
    kept = find_benchmark(docs, benchmark, text_col, found=found)
    return kept.filter(F.size(F.col(found)["spans"]) == 0).drop(found)
