"""Plain versions of the operators, for small tables."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return text.translate(A_TO_Z)


def shingle_set(text, n=5):
    words = SPACED.findall(lower(text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def linked(a, b):
    both = len(a & b)
    return bool(a and b) and 100 * both >= 75 * (len(a) + len(b) - both)


def near_duplicates(rows):
    """``{(doc_id, n_shingles, component_id, kept)}`` of ``(doc_id, text)`` rows."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    where, label = {}, list(range(len(sets)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for at, (_, s) in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(at)
    pairs = {p for group in where.values() for p in itertools.combinations(group, 2)}
    for a, b in pairs:
        if linked(sets[a][1], sets[b][1]):
            label[root(a)] = root(b)
    least = {}
    for at, (i, _) in enumerate(sets):
        least[root(at)] = min(least.get(root(at), i), i)
    return sorted((i, len(s), least[root(at)], i == least[root(at)]) for at, (i, s) in enumerate(sets))


def contamination(rows, items, window=10):
    """``{doc_id: (n_words, n_hit, n_items, digest, contaminated)}``."""
    windows = {}
    # Items without an id count as one item that the digest leaves out.
    for item_id, text in items:
        words = LETTERED.findall(lower(text or ""))
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(None if item_id is None else str(item_id))
    sizes = sorted({len(w) for w in windows})
    out = {}
    for doc_id, text in rows:
        words = LETTERED.findall(lower(text or ""))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                ids = windows.get(tuple(words[i : i + size]))
                if ids:
                    found |= ids
                    hit |= set(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(i for i in found if i is not None)).encode()).hexdigest()
        out[doc_id] = (len(words), len(hit), len(found), digest, bool(hit))
    return out


def quality_counts(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def captures(rows):
    """``{page_id: (payload_bytes, payload_digest, record_type, refers_to)}``."""
    last = {}
    for page_id, html in rows:
        last[html or ""] = max(last.get(html or "", page_id), page_id)
    out = {}
    for page_id, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and last[html or ""] != page_id
        out[page_id] = (
            len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
            last[html or ""] if revisit else None,
        )
    return out


def jump(key, shards):
    """One key of the published algorithm, with Python's integers."""
    key, b, j = key % (1 << 64), -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def held_out(doc_id, parts, rest):
    return zlib.crc32(str(doc_id).encode()) % parts == rest


def base_scores(rows):
    """``{doc_id: (n_tokens, n_known, train_tokens, base_score)}`` of unique ids."""
    import math

    tokens = {i: [*SPACED.findall(lower(t or "")), None] for i, t in rows}
    counts = Counter(w for i, ws in tokens.items() if not held_out(i, 10, 0) for w in ws)
    total = sum(counts.values())
    bottom = total + 0.1 * (len(counts) + 1)
    return {
        i: (len(ws), sum(w in counts for w in ws), total,
            sum(math.log10((counts.get(w, 0) + 0.1) / bottom) for w in ws))
        for i, ws in tokens.items()
    }
