"""Words of whole texts as 64-bit hashes, computed over Arrow columns in numpy.

A word is hashed byte by byte from a fixed table of random values per byte and
place (tabulation hashing), so all words of a batch are hashed by array
operations. Two different words agree with probability 2**-64.
"""

import numpy as np
import pyarrow as pa

# Bytes of text that are worked on at once; bounds the memory of very long texts.
SEGMENT = 1 << 20
PLACES = 64


def mix(x):
    """A fixed bijection of 64-bit integers whose output bits look random."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(n, seed):
    """``n`` fixed 64-bit values."""
    with np.errstate(over="ignore"):
        return mix((np.arange(n, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


def byte_set(*ranges):
    """Which of the 256 bytes lie in the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# The separators of words, and lower case for A-Z only.
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
PUNCTUATION = byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME + 32 * byte_set((0x41, 0x5A)).astype(np.uint8)

_TABLE = random_words(PLACES * 256, 0x5EED)


def text_column(column):
    """A string column with 64-bit offsets, NULL as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def text_bytes(column):
    """The bytes of all texts one after another, and where each text begins."""
    column = text_column(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _segments(data, gaps):
    """Stretches of about ``SEGMENT`` bytes that end at a separator."""
    begin = 0
    while begin < len(data):
        end = begin + SEGMENT
        if end < len(data):
            step = 4096
            while end < len(data) and not (found := gaps[data[end : end + step]]).any():
                end += step
            end = end + int(found.argmax()) if end < len(data) else len(data)
        yield begin, min(end, len(data))
        begin = end


def word_spans(data, offsets, gaps):
    """First byte and byte after the last one of every word."""
    firsts, ends = [], []
    for begin, end in _segments(data, gaps):
        gap = gaps[data[begin:end]]
        new = np.zeros(end - begin + 1, bool)
        inside = offsets[np.searchsorted(offsets, begin) : np.searchsorted(offsets, end)]
        new[inside - begin] = True
        first = ~gap
        first[1:] &= gap[:-1] | new[1:-1]
        last = ~gap
        last[:-1] &= gap[1:] | new[1:-1]
        firsts.append(np.flatnonzero(first) + begin)
        ends.append(np.flatnonzero(last) + begin + 1)
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(firsts), np.concatenate(ends)


def hash_words(data, offsets, gaps=SPACES, lower=LOWER):
    """Hashes of all words, and where each text's words begin among them.

    Returns ``(hashes, bounds, firsts, ends)``; the words of text ``i`` are
    ``bounds[i]`` up to ``bounds[i + 1]``.
    """
    firsts, ends = word_spans(data, offsets, gaps)
    bounds = np.searchsorted(firsts, offsets)
    hashes = np.empty(len(firsts), np.uint64)
    lengths = ends - firsts
    at = 0
    while at < len(firsts):
        # As many words as fit in a segment, one at least.
        to = max(at + 1, int(np.searchsorted(ends, firsts[at] + SEGMENT)))
        length = lengths[at:to]
        starts = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(starts, length)
        letters = lower[data[place + np.repeat(firsts[at:to], length)]]
        value = _TABLE[((place & (PLACES - 1)) << 8) | letters]
        if length.max() > PLACES:
            value = value * (2 * (place // PLACES) + 1).astype(np.uint64)
        hashes[at:to] = np.add.reduceat(value, starts)
        at = to
    return mix(hashes + lengths.astype(np.uint64)), bounds, firsts, ends


def row_slices(column, size=2 * SEGMENT):
    """``(begin, end)`` of runs of rows with about ``size`` bytes of text."""
    _, offsets = text_bytes(column)
    begin = 0
    while begin < len(column):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + size)))
        yield begin, min(end, len(column))
        begin = end


def sums_between(flags, bounds):
    """How many of ``flags`` are set between neighbouring bounds."""
    running = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(running[bounds])
