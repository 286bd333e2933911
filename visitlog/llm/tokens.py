"""Exact token counts of every prefix of a text, by dynamic programming.

A byte-pair encoding has one last token for each prefix of a piece of text: the
longest token that ends there and is compatible with the last token of what
comes before it. Two neighbouring tokens are compatible if encoding their joined
bytes gives just the two. So ``last[i]`` and ``count[i] = count[i - len] + 1``
follow from earlier places, and one pass over a piece yields the count at every
prefix. Truncation to a budget is a search in those counts; nothing is encoded
again.

The counts equal those of the library the vocabulary file is for: special
strings are split off first and count as one token, then the text is cut into
pieces, and each piece is encoded by itself.

Defined cases: NULL and empty text have 0 tokens; repeated rows count alike; an
empty table gives no rows; other columns pass through :func:`with_token_counts`.
"""

import bisect
import json
import re

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlog.llm.frames import bounded_batches, free_name

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
# Pieces and pairs of tokens that a worker remembers, and their length; bounds its memory.
REMEMBERED, LONGEST = 600_000, 64

# How the vocabulary's texts are cut into pieces, and the same for
# texts of plain letters, digits, signs and spaces, where it is twice as fast.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", regex.V0)
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ž]*")
SPACE_ONLY = regex.compile(r"\s+", regex.V0)
# Two spaces in a row, or spaces other than " " and line breaks.
UNEVEN = regex.compile(r"\s\s|[^\S \n]", regex.V0)
PLAIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def _byte_letters():
    """The letter that stands for each byte in the vocabulary: itself where it is
    printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(printable))
    return letters


class PrefixCounter:
    """Token counts at every prefix for one vocabulary file.

    A token is named by its place in the order of merges: bytes first, then
    merge by merge."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {letter: b for b, letter in _byte_letters().items()}

        def raw(token):
            return bytes(byte_of[c] for c in token)

        self.number = {bytes([b]): b for b in range(256)}
        self.halves = [(b, b) for b in range(256)]
        self.merged = {}
        for merge in spec["model"]["merges"]:
            left, right = map(raw, merge.split(" ") if isinstance(merge, str) else merge)
            pair = self.number[left], self.number[right]
            token = self.number.setdefault(left + right, len(self.halves))
            if token == len(self.halves):
                self.halves.append(pair)
                self.merged[pair] = token
        automaton = ahocorasick.Automaton()
        for token, number in self.number.items():
            automaton.add_word(token.decode("latin-1"), (len(token), number))
        automaton.make_automaton()
        self.endings = automaton.iter
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pairs, self.known, self.spaced, self.bare = {}, {}, {}, {}

    def _compatible(self, left, right):
        """Whether encoding the bytes of two tokens gives just the two.

        Undo merges, the latest of either side first, and look at the tokens
        that then meet at the border: if those merge earlier than what was
        undone, the border would have been crossed."""
        pair, before, fits = left << 32 | right, len(self.halves), True
        while True:
            if self.merged.get((left, right), before) < before:
                fits = False
                break
            if left < 256 and right < 256:
                break
            if left > right:
                before, left = left, self.halves[left][1]
            else:
                # Of two equal merges the left one comes first.
                before, right = right + 1, self.halves[right][0]
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        self.pairs[pair] = fits
        return fits

    def counts(self, piece):
        """Token count of each prefix of a piece's bytes, from 0 bytes on."""
        count, last, done = [0] * (len(piece) + 1), [0] * (len(piece) + 1), 0
        fits = self.pairs.get
        # All tokens that end at a place, from the longest to the shortest.
        for end, (size, token) in self.endings(piece.decode("latin-1")):
            end += 1
            if end == done:
                continue
            begin = end - size
            if begin:
                before = last[begin]
                fit = fits(before << 32 | token)
                if fit is None:
                    fit = self._compatible(before, token)
                if not fit:
                    continue
            last[end], count[end], done = token, count[begin] + 1, end
        return count

    def total(self, text):
        """Tokens of a text without special strings."""
        n = 0
        for piece in self.pieces(text):
            known = self.known.get(piece)
            if known is None:
                known = self.counts(piece.encode("utf-8", "surrogatepass"))[-1]
                if len(piece) <= LONGEST:
                    if len(self.known) >= REMEMBERED:
                        self.known.clear()
                    self.known[piece] = known
            n += known
        return n

    def pieces(self, text):
        if PLAIN.fullmatch(text):
            return PLAIN_PIECES.findall(text)
        return PIECES.findall(text)

    def _words(self, words, known, before):
        """Tokens of words that each follow ``before``, remembered in ``known``."""
        try:
            return sum(map(known.__getitem__, words))
        except KeyError:
            if len(known) >= REMEMBERED:
                known.clear()
            n = 0
            for word in words:
                size = known.get(word)
                if size is None:
                    size = self.total(before + word)
                    if len(word) <= LONGEST:
                        known[word] = size
                n += size
            return n

    def stretches(self, text):
        """``(stretch, is special)`` of a text cut at its special strings."""
        begin = 0
        for found in self.special.finditer(text) if self.special else ():
            if found.start() > begin:
                yield text[begin : found.start()], False
            yield found.group(), True
            begin = found.end()
        if begin < len(text):
            yield text[begin:], False

    def count(self, text):
        """Tokens of a whole text.

        A space or line break between two other characters always begins a new
        piece, so words can be counted by themselves."""
        n = 0
        for stretch, special in self.stretches(text):
            if special:
                n += 1
            elif UNEVEN.search(stretch):
                n += self.total(stretch)
            else:
                lines = [line.split(" ") for line in stretch.split("\n")]
                n += self._words([line[0] for line in lines], self.bare, "")
                n += sum(self._words(line[1:], self.spaced, " ") for line in lines)
                n += (len(lines) - 1) * self._words(["\n"], self.bare, "")
        return n

    def prefix_counts(self, text):
        """Tokens of ``text[:i]`` for every ``i`` from 0 to its length."""
        out, base, plain = [0], 0, ""
        for stretch, special in self.stretches(text):
            if special:
                # A special string that is cut off is ordinary text after what precedes it.
                out += [base + self.total(plain + stretch[:k]) for k in range(1, len(stretch))]
                base += (self.total(plain) if plain else 0) + 1
                out.append(base)
                plain = ""
            else:
                out += [base + n for n in self._plain(stretch)[1:]]
                plain = stretch
        return out

    def _plain(self, text):
        """Prefix counts of a text without special strings.

        The pieces before the one that is cut stay as they are, but for two
        things: spaces at the end of a text form one piece together, whose counts
        are those of its own prefixes, and a contraction that is cut is a quote and
        letters."""
        out, settled = [0], 0
        pieces, at = self.pieces(text), 0
        while at < len(pieces):
            first = at
            while at < len(pieces) and SPACE_ONLY.fullmatch(pieces[at]):
                at += 1
            piece = pieces[at] if at < len(pieces) else ""
            # A run of spaces, with the one that the next piece begins with.
            run = "".join(pieces[first:at]) + (" " if piece[:1] == " " else "")
            out += [settled + n for n in self._letter_counts(run)[1:]] if run else []
            settled += sum(self.total(p) for p in pieces[first:at])
            if piece:
                counts = self._letter_counts(piece)
                inner = [settled + n for n in counts[1:]]
                if piece in ("'re", "'ve", "'ll"):
                    inner[1] = settled + self.total(piece[:2])
                out += inner[1:] if piece[0] == " " else inner
                settled += counts[-1]
                at += 1
        return out

    def _letter_counts(self, piece):
        counts, places = self.counts(piece.encode("utf-8", "surrogatepass")), [0]
        for letter in piece:
            places.append(places[-1] + len(letter.encode("utf-8", "surrogatepass")))
        return [counts[p] for p in places]

    def fit(self, text, budget):
        """Length of the longest prefix of ``text`` with at most ``budget`` tokens
        such that no shorter prefix has more."""
        counts = self.prefix_counts(text)
        over = next((i for i, n in enumerate(counts) if n > budget), len(counts))
        return over - 1


_counters = {}


def counter(name):
    """The worker's counter for a public vocabulary; loaded once."""
    if name not in _counters:
        import public_tokenizers

        _counters[name] = PrefixCounter(public_tokenizers.path(name))
    return _counters[name]


def with_token_counts(docs, text_col="text", vocabulary=VOCABULARY, name="n_tokens", prefixes=None):
    """``docs`` with the token count of each whole text; narrow.

    ``prefixes`` names a second column for the counts at every prefix (an array
    as long as the text, plus one)."""
    bounded_batches(docs)
    name = free_name(docs, name)
    added = [T.StructField(name, T.LongType())]
    if prefixes:
        added.append(T.StructField(prefixes, T.ArrayType(T.IntegerType())))

    def task(batches):
        count = counter(vocabulary)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            each = [t.as_py() or "" for t in texts] if prefixes else None
            if prefixes:
                tables = [count.prefix_counts(t) for t in each]
                new = [pa.array([t[-1] for t in tables], pa.int64()), pa.array(tables, pa.list_(pa.int32()))]
            else:
                new = [pa.array([count.count(t) if t else 0 for t in texts.to_pylist()], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *[f.name for f in added]])

    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, *added]))


def tokens_within(prefix_counts, budget):
    """From stored prefix counts: the longest prefix within a budget, for counts that never fall."""
    return bisect.bisect_right(prefix_counts, budget) - 1


def count_tokens(docs, id_col="doc_id", text_col="text", limit=LIMIT, vocabulary=VOCABULARY):
    """One row per document: bytes, tokens, and whether they exceed ``limit``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return with_token_counts(rows, vocabulary=vocabulary).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
