"""Packing of token sequences into windows in the order of the documents.

The documents of a partition, one after another, are one stream of tokens, and a window
is a stretch of it. Dynamic programming chooses where windows end: at the ends of
documents, else of sentences, and where neither comes for long, at any token. With
``c(i)`` the least cost of a packing that ends at place ``p(i)``,

    c(i) = penalty(i) + least over j of  c(j) + padding(p(i) - p(j)),

where a window is padded to the capacity unless its length is a power of two. Without the
powers the least is that of ``c(j) + p(j)`` over a sliding range of places, which a
monotone queue gives in constant time; the few places that are a power of two away are
compared as well. The penalty counts what a cut through a document costs, as so many
tokens of padding.

A task holds a block of the stream and one batch of texts (4 MB or one text). Of a block's
windows all but the last ones are given out, and the next block begins where they end, so
padding comes of the blocks nowhere; only the end of a partition may leave a window short.
Rows are not shuffled, and no key decides where a document goes: hot sources and copies
are as any other rows, and a document may be longer than a block.

Tokens are those of the library for the vocabulary file. Words are split at white space,
which the vocabulary drops, and each different word of a batch is encoded once.

Defined cases: NULL and empty text has the end token only; repeated rows are documents of
their own; a NULL id stays NULL; an empty table gives no rows.
"""

import json
import os
import re
from collections import deque
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlog.llm.frames import bounded_batches
from visitlog.llm.words import text_column

VOCABULARY = "word_bpe_49k.json"
END = 1
CAPACITY = 2048
# Costs in tokens of padding: a cut at the end of a sentence, one anywhere else, and each
# window, so that no document gets a window of its own for having a power of two of tokens.
SENTENCE, ANYWHERE, WINDOW = 4, 16, 32
# Places for cuts are at most so many tokens apart.
STRIDE = 32
# Tokens of a block, and of its end that the next block packs again.
BLOCK, AGAIN = 1 << 19, 1 << 15
SEQUENCE_BITS = 33
# Words that a worker remembers, and their length; bounds its memory.
REMEMBERED, LONGEST = 1_000_000, 64

# How the vocabulary cuts normalized text into pieces; letters and signs for
# which that needs no tables of Unicode; and the same cut for those in lower case.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ž]+").fullmatch
PIECES = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^a-z0-9ß-öø-ž\n]+").findall
# Fixed value: what ends a sentence, and what may follow.
SENTENCE_END = r"[.!?…。！？][\"')\]}»”’]*$"


class WordEncoder:
    """Token ids of words, for vocabularies of lower-case pieces without white space.

    Words of plain letters and signs are cut into pieces here, and each different piece
    goes through the library's merges; other words go through the whole library. ``flat``
    holds the ids of all known words, ``sizes`` how many each has."""

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        cut, *rest = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        suffix = spec["model"].get("end_of_word_suffix")
        if steps != ["NFC", "Replace", "Lowercase"] or cut.get("pattern", {}).get("Regex") != CUT or not suffix:
            raise ValueError(f"{path} has other pieces than lower-case ones without white space")
        self.tokenizer = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None}))
        between = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *rest]}
        self.merges = Tokenizer.from_str(
            json.dumps(spec | {"truncation": None, "padding": None, "normalizer": None, "pre_tokenizer": between})
        )
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(special) if special else "(?!)").search
        self._forget()

    def _forget(self):
        self.known, self.passing = {}, []
        self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _of_texts(self, texts, tokenizer=None):
        """Sizes and ids of texts by themselves."""
        tokenizer = tokenizer or self.tokenizer
        each = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        return sizes, np.fromiter(chain.from_iterable(each), np.uint32, int(sizes.sum()))

    def _of_plain(self, words):
        """The same of plain words."""
        coded = pa.array(PIECES("\n".join(words).lower()), pa.string()).dictionary_encode()
        pieces, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        border = pieces.index("\n") if "\n" in pieces else -1
        texts = [" ".join(p for p in pieces[at : at + 100] if p != "\n") for at in range(0, len(pieces), 100)]
        flat = self._of_texts(texts, self.merges)[1]
        sizes = np.diff(np.flatnonzero(self.last[flat]), prepend=-1)
        if border >= 0:
            sizes = np.insert(sizes, border, 0)
        lengths = sizes[codes]
        word = np.cumsum(codes == border)
        return np.bincount(word, lengths, len(words)).astype(np.int64), gathered(flat, sizes, codes)

    def _learn(self, words):
        """Ids of words that are not known; long ones come last."""
        plain, odd = [], []
        for word in words:
            (plain if len(word) <= LONGEST and PLAIN(word) else odd).append(word)
        if self.special(" ".join(plain)):
            odd = [w for w in plain if self.special(w)] + odd
            plain = [w for w in plain if not self.special(w)]
        for some, of in ((plain, self._of_plain), (odd, self._of_texts)):
            if some:
                sizes, flat = of(some)
                self.known.update(zip(some, range(len(self.sizes), len(self.sizes) + len(some))))
                self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, flat])

    def codes(self, words):
        """The places of different words in ``sizes``, until the next call."""
        if len(self.known) > REMEMBERED:
            self._forget()
        # Long words of the last call are the last ones, and not remembered.
        kept = len(self.sizes) - len(self.passing)
        for word in self.passing:
            del self.known[word]
        self.flat, self.sizes = self.flat[: int(self.sizes[:kept].sum())], self.sizes[:kept]
        places = list(map(self.known.get, words))
        fresh = [w for w, place in zip(words, places) if place is None]
        self.passing = [w for w in fresh if len(w) > LONGEST]
        if self.passing:
            fresh = [w for w in fresh if len(w) <= LONGEST] + self.passing
        self._learn(fresh)
        return np.array([self.known[w] if place is None else place for w, place in zip(words, places)], np.int64)


def gathered(flat, sizes, codes):
    """The stretches of ``flat`` that the codes name, one after another."""
    lengths = sizes[codes]
    shift = (np.cumsum(sizes) - sizes)[codes] - (np.cumsum(lengths) - lengths)
    return flat[np.repeat(shift, lengths) + np.arange(lengths.sum())]


def encode_texts(encoder, column, end=END):
    """``(ids, bounds, places)``: the tokens of all texts, each with the end token; where
    each text begins among them; and the places after the ends of sentences."""
    words = pc.ascii_split_whitespace(text_column(column))
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    offsets = words.offsets.to_numpy()
    of_row = words.flatten()
    # White space at either end of a text leaves an empty word.
    full = pc.not_equal(of_row, "")
    bounds = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[offsets - offsets[0]]
    coded = of_row.filter(full).dictionary_encode()
    different = coded.dictionary
    places = encoder.codes(different.to_numpy(zero_copy_only=False).tolist())
    # The end token is one more word, after the last of each text.
    sizes = np.append(encoder.sizes, 1)
    flat = np.append(encoder.flat, np.uint32(end))
    stops = np.append(pc.match_substring_regex(different, SENTENCE_END).to_numpy(zero_copy_only=False), False)
    codes = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds[1:], len(different))
    stops, codes = stops[codes], np.append(places, len(sizes) - 1)[codes]
    after = np.cumsum(sizes[codes])
    return gathered(flat, sizes, codes), np.concatenate([[0], after[bounds[1:] + np.arange(len(column))]]), after[stops]


def best_cuts(places, penalties, capacity=CAPACITY, window=WINDOW):
    """Where the windows of a stream end, at least cost; the last place is its end.

    ``places`` ascend from above 0, neighbours at most ``capacity`` apart."""
    places = np.concatenate([[0], places])
    by_power = {}
    for power in range((capacity - 1).bit_length()):
        ahead = np.searchsorted(places, places + (1 << power))
        there = np.flatnonzero(ahead < len(places))
        there = there[places[ahead[there]] == places[there] + (1 << power)]
        for j, i in zip(there.tolist(), ahead[there].tolist()):
            by_power.setdefault(i, []).append(j)
    at, penalty = places.tolist(), [0, *penalties.tolist()]
    cost, back, queue = [0] * len(at), [0] * len(at), deque()
    keys = [0] * len(at)
    for i in range(1, len(at)):
        # The queue's keys c(j) + p(j) ascend; what is larger than a later one goes.
        key = keys[i - 1] = cost[i - 1] + at[i - 1]
        while queue and keys[queue[-1]] > key:
            queue.pop()
        queue.append(i - 1)
        least = at[i] - capacity
        while at[queue[0]] < least:
            queue.popleft()
        j = queue[0]
        best = keys[j] - least
        for other in by_power.get(i, ()):
            if cost[other] < best:
                best, j = cost[other], other
        cost[i], back[i] = best + penalty[i] + window, j
    ends, i = [], len(at) - 1
    while i:
        ends.append(at[i])
        i = back[i]
    return ends[::-1]


def _ascending(parts):
    """The different values of some arrays, in order."""
    places = np.sort(np.concatenate(parts), kind="stable")
    return places[np.concatenate([[True], places[1:] != places[:-1]])]


class OrderedPacker:
    """Windows of a stream of documents, block by block."""

    def __init__(self, capacity=CAPACITY, block=BLOCK, again=AGAIN):
        self.capacity, self.block, self.again = capacity, block, max(again, capacity)
        self.sequences = 0
        self.begin = self.end = 0
        self.ids, self.values = [], []
        # Ends and lengths of documents, and ends of sentences, by place in the stream.
        self.doc_ends, self.doc_sizes, self.places = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, values, ids, bounds, places):
        """More documents: their names, and what :func:`encode_texts` returns. Yields
        tables of pieces."""
        self.values.append(values)
        self.ids.append(ids)
        self.doc_ends = np.concatenate([self.doc_ends, bounds[1:] + self.end])
        self.doc_sizes = np.concatenate([self.doc_sizes, np.diff(bounds)])
        self.places = np.concatenate([self.places, places + self.end])
        self.end += len(ids)
        while self.end - self.begin >= self.block:
            yield self._pack(self.begin + self.block)

    def rest(self):
        while self.begin < self.end:
            yield self._pack(min(self.begin + self.block, self.end))

    def _candidates(self, end):
        """Places for cuts up to ``end``, and their penalties."""
        stops = [np.array([end])]
        stops += [x[np.searchsorted(x, self.begin, "right") : np.searchsorted(x, end, "right")] for x in (self.doc_ends, self.places)]
        if end == self.end:
            # The last windows may be short ones: powers of two, counted from the end.
            stops.append(np.arange(end - STRIDE, max(self.begin, end - self.capacity), -STRIDE))
        places = _ascending(stops)
        places = places[places > self.begin]
        stride = min(STRIDE, self.capacity)
        gaps = np.diff(places, prepend=self.begin)
        more = (gaps - 1) // stride
        filled = np.repeat(places - gaps, more) + stride * (1 + np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more))
        places = _ascending([places, filled])
        penalties = np.full(len(places), ANYWHERE)
        for at, cost in ((stops[2], SENTENCE), (stops[1], 0)):
            penalties[np.searchsorted(places, at)] = cost
        return places, penalties

    def _pack(self, end):
        places, penalties = self._candidates(end)
        ends = np.array(best_cuts(places - self.begin, penalties, self.capacity)) + self.begin
        if end < self.end or end - self.begin >= self.block:
            # The last ones were cut for the block's end, which is none of the stream.
            ends = ends[: max(1, np.searchsorted(ends, end - self.again, "right"))] if end < self.end else ends
        return self._given_out(ends)

    def _given_out(self, ends):
        docs = self.doc_ends[: np.searchsorted(self.doc_ends, ends[-1], "left") + 1]
        cuts = np.unique(np.concatenate([ends, docs[docs <= ends[-1]]]))
        starts = np.concatenate([[self.begin], cuts[:-1]])
        doc = np.searchsorted(self.doc_ends, starts, "right")
        sequence = np.searchsorted(ends, starts, "right")
        opens = np.concatenate([[self.begin], ends[:-1]])
        held = np.concatenate(self.ids) if len(self.ids) > 1 else self.ids[0]
        values = pa.concat_arrays(self.values)
        tokens = pa.Array.from_buffers(
            pa.large_binary(), len(starts),
            [None, pa.py_buffer(4 * np.concatenate([starts, cuts[-1:]]) - 4 * self.begin), pa.py_buffer(held.astype("<u4"))],
        )
        out = pa.RecordBatch.from_arrays(
            [
                values.take(pa.array(doc)),
                *(pa.array(x.astype(np.int64)) for x in (
                    starts - (self.doc_ends - self.doc_sizes)[doc], cuts - starts, self.doc_sizes[doc],
                    self.sequences + sequence, starts - opens[sequence],
                )),
                tokens.cast(pa.binary()),
            ],
            ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "tokens"],
        )
        self.sequences += len(ends)
        self.ids = [held[ends[-1] - self.begin :].copy()]
        done = int(np.searchsorted(self.doc_ends, ends[-1], "right"))
        self.values = [values.slice(done)]
        self.doc_ends, self.doc_sizes = self.doc_ends[done:], self.doc_sizes[done:]
        self.places = self.places[np.searchsorted(self.places, ends[-1], "right") :]
        self.begin = int(ends[-1])
        return out


def pack_in_order(docs, id_col="doc_id", text_col="text", capacity=CAPACITY, path=None, end=END):
    """One row per piece: ``doc_id``; ``start``, ``length``: its place in its document of
    ``doc_tokens`` tokens; ``sequence_id``, ``offset``: its window and place there; and
    ``tokens``: its ids, 4 bytes each, the lowest first.

    ``path`` names a vocabulary file that tasks can read; by default the public one."""
    bounded_batches(docs)
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def task(batches):
        import public_tokenizers

        encoder = WordEncoder(path or public_tokenizers.path(VOCABULARY))
        packer = OrderedPacker(capacity)
        packer.sequences = TaskContext.get().partitionId() << SEQUENCE_BITS
        for batch in batches:
            if batch.num_rows:
                yield from packer.add(batch.column("doc_id"), *encode_texts(encoder, batch.column("text"), end))
        yield from packer.rest()

    counts = [T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")]
    schema = T.StructType([*docs.select("doc_id").schema.fields, *counts, T.StructField("tokens", T.BinaryType())])
    return docs.mapInArrow(task, schema)


def pack_document_tokens(docs):
    """The pieces with a checksum in place of their ids."""
    return pack_in_order(docs).select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
