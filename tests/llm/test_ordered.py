"""Order-preserving packing: tokens against the library, cuts against every choice."""

import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from visitlog.llm import ordered
from visitlog.llm.ordered import OrderedPacker, WordEncoder, best_cuts, encode_texts, pack_document_tokens, pack_in_order

PATH = public_tokenizers.path("word_bpe_49k.json")


@cache
def library():
    return Tokenizer.from_file(PATH)


@cache
def encoder():
    return WordEncoder(PATH)


def plain_ids(text):
    return library().encode(text or "", add_special_tokens=False).ids + [1]


def check_tokens(texts):
    ids, bounds, _ = encode_texts(encoder(), pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [plain_ids(t) for t in texts]


ODD = [
    None, "", " ", "\n\t x\u000by\u000cz \r", "Don't CAN'T we'll 'twas '' ''s !'s", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>",
    "x<|endoftext|> <|endoftext|>", "ΟΔΟΣ ὈΔΥΣΣΕΎΣ Σ", "é ́  nbsp wide\u0085next", "İstanbul ŉ ſ ß ÷ ×", "日本語 文。中文", "🙂🙂 🏳️‍🌈",
    "1234 5.6 v2x", "a\x01b \x01 \x01\x01", "\u001c\u001f \u0000 ﻿", "ａＢ ﬁ ① ²", "x" * 70, "y" * 5000 + " " + "z-" * 900, "I.B.M.\" (ok?) end.)",
]


def test_tokens_of_odd_texts():
    check_tokens(ODD)
    check_tokens(ODD[::-1])
    check_tokens([])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB'sdl é́İΣς \n\t.!<|>9_- 語endoftx") , max_size=30) | st.text(max_size=12), max_size=4))
def test_tokens_of_any_text(texts):
    check_tokens(texts)


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(ordered, "REMEMBERED", 3)
    for _ in range(3):
        check_tokens(["one two three four five", "six one " + "long" * 30])
        check_tokens(["two " + "long" * 30 + " seven"])


def test_ends_of_sentences():
    ids, bounds, places = encode_texts(encoder(), pa.array(["One two. Three? (Four!) five", "Six."]))
    first = [len(plain_ids(t)) - 1 for t in ("One two.", "One two. Three?", "One two. Three? (Four!)")]
    assert places.tolist() == [*first, bounds[1] + len(plain_ids("Six.")) - 1]


def cost(length, capacity, penalty, window):
    return window + penalty + (0 if length & (length - 1) == 0 else capacity - length)


def least(places, penalties, capacity, window):
    best, at = [0], [0, *places]
    for i in range(1, len(at)):
        best.append(min(
            best[j] + cost(at[i] - at[j], capacity, penalties[i - 1], window) for j in range(i) if at[i] - at[j] <= capacity
        ))
    return best[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 6)), min_size=1, max_size=50), st.sampled_from([9, 16, 20]), st.integers(0, 3))
def test_cuts_cost_least(steps, capacity, window):
    places, penalties = np.cumsum([s for s, _ in steps]), np.array([p for _, p in steps])
    ends = best_cuts(places, penalties, capacity, window)
    assert ends[-1] == places[-1] and set(ends) <= set(places.tolist())
    penalty = dict(zip(places.tolist(), penalties.tolist()))
    spent = sum(cost(b - a, capacity, penalty[b], window) for a, b in zip([0, *ends], ends))
    assert spent == least(places.tolist(), penalties.tolist(), capacity, window)


def check_pieces(rows, docs, capacity):
    """Every id is in one piece, windows are gapless and in order."""
    docs = [(i, ids) for i, ids in docs]
    at, doc, sequence, filled = 0, 0, -1, 0
    for i, start, length, doc_tokens, sequence_id, offset, tokens in rows:
        ids = docs[doc][1]
        assert (i, start, doc_tokens) == (docs[doc][0], at, len(ids)) and length > 0
        assert np.frombuffer(tokens, "<u4").tolist() == ids[at : at + length]
        assert (sequence_id, offset) in ((sequence, filled), (sequence + 1, 0))
        filled = offset + length
        sequence = sequence_id
        assert filled <= capacity
        at += length
        if at == len(ids):
            at, doc = 0, doc + 1
    assert (doc, at) == (len(docs), 0)


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.lists(st.integers(1, 300) | st.just(1), max_size=6), max_size=8), st.sampled_from([16, 100, 128]),
    st.sampled_from([130, 400, 5000]), st.randoms(use_true_random=False),
)
def test_stream_in_blocks(batches, capacity, block, dice):
    packer, docs, out = OrderedPacker(capacity, block, 64), [], []
    for sizes in batches:
        if not sizes:
            continue
        texts = [[dice.randrange(1 << 16) for _ in range(n)] for n in sizes]
        names = [len(docs) + k for k in range(len(sizes))]
        docs += zip(names, texts)
        bounds = np.cumsum([0, *sizes])
        places = np.array(sorted(dice.sample(range(1, int(bounds[-1]) + 1), int(bounds[-1]) // 9)), np.int64)
        ids = np.array([x for t in texts for x in t], np.uint32)
        out += packer.add(pa.array(names), ids, bounds, places)
    out += packer.rest()
    check_pieces([tuple(r.values()) for b in out for r in b.to_pylist()], docs, capacity)


@pytest.mark.parametrize("capacity", [2048, 100])
def test_given_documents(spark, small, capacity):
    docs = [(r.doc_id, plain_ids(r.text)) for r in small.coalesce(1).select("doc_id", "text").collect()]
    rows = [tuple(r) for r in pack_in_order(small.coalesce(1), capacity=capacity).collect()]
    check_pieces(rows, docs, capacity)
    filled = {}
    for r in rows:
        filled[r[4]] = filled.get(r[4], 0) + r[2]
    padding = sum(capacity - n for n in filled.values() if n & (n - 1))
    assert padding <= 0.01 * sum(filled.values()) * 2048 / capacity
    # Most documents are whole in a window as far as they fit.
    cut = {r[0] for r in rows if r[1] or r[2] < r[3]}
    assert len(cut) < len(docs) * 0.7 or capacity < 2048


def test_query(spark, small):
    got = {(r.doc_id, r.start): r for r in pack_document_tokens(small.repartition(3)).collect()}
    texts = {r.doc_id: plain_ids(r.text) for r in small.select("doc_id", "text").collect()}
    seen = dict.fromkeys(texts, 0)
    for (i, start), r in got.items():
        ids = np.array(texts[i][start : start + r.length], "<u4")
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(ids.tobytes()), len(texts[i]))
        seen[i] += r.length
    assert seen == {i: len(t) for i, t in texts.items()}
    windows = {}
    for r in got.values():
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_odd_rows(spark, odd_docs, no_docs):
    texts = [(r.doc_id, plain_ids(r.text)) for r in odd_docs.collect()]
    got = pack_in_order(odd_docs, capacity=256).collect()
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    want = {}
    for i, ids in texts:
        want[i] = want.get(i, 0) + len(ids)
    assert total == want
    assert pack_document_tokens(no_docs).collect() == []
    assert pack_document_tokens(no_docs).dtypes == pack_document_tokens(odd_docs).dtypes
