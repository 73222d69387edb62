"""Token counts and packing against the tokenizers' own libraries."""

from __future__ import annotations

import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import packing, token_counts
from quarry.llm.common import tokens_path
from tests.llm.helpers import ODD_TEXTS, documents, empty, prose

MODEL = tokens_path(token_counts.MODEL)
JSON = tokens_path(packing.TOKENIZER)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(JSON)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab =\n\té漢🙂▁<s>/0x'A1​", max_size=60))
def test_counts_equal_the_library(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL) if not hasattr(test_counts_equal_the_library, "sp") \
        else test_counts_equal_the_library.sp
    test_counts_equal_the_library.sp = sp
    assert token_counts.count_texts(MODEL, [text]) == [len(sp.encode(text))]


def test_counts_of_long_runs(pieces):
    texts = ["=" * 20_001, "ab" * 9_000, "a" * 12_345, "漢字" * 2_000, " " * 3_000, "é" * 7_001]
    assert token_counts.count_texts(MODEL, texts) == [len(pieces.encode(t)) for t in texts]


def test_forgetting_does_not_change_counts(pieces, monkeypatch):
    rng = random.Random(4)
    texts = [prose(rng, 40) for _ in range(30)]
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 5)
    got = [token_counts.count_texts(MODEL, [t])[0] for t in texts]
    assert got == [len(pieces.encode(t)) for t in texts]


def test_count_tokens_table(spark, pieces):
    df = documents(spark, ODD_TEXTS)
    got = token_counts.count_tokens(df).collect()
    assert len(got) == df.count()
    want = sorted((t.doc_id is not None and t.doc_id, len((t.text or "").encode()), len(pieces.encode(t.text or "")))
                  for t in df.collect())
    assert sorted((r.doc_id is not None and r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.count_tokens(empty(spark)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab =\n\té漢🙂<|endoftext|>'s1  ​", max_size=50), max_size=4))
def test_ids_equal_the_library(texts):
    tok = packing._tokenizer(JSON)
    assert packing.encode(JSON, texts) == [
        np.asarray(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 90), min_size=1, max_size=60))
def test_pack_block_fills_sequences_exactly(sizes):
    pieces = packing.pack_block(sizes, 32)
    covered, rows = defaultdict(list), defaultdict(list)
    for doc, start, n, seq, off in pieces:
        covered[doc].append((start, n))
        rows[seq].append((off, n))
    for doc, size in enumerate(sizes):
        at = 0
        for start, n in sorted(covered[doc]):
            assert start == at and n > 0
            at += n
        assert at == size
    for parts in rows.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 32 and at & (at - 1) == 0          # full, or a power of two: no padding


def test_packing_balances_cost():
    rng = random.Random(1)
    pieces = packing.pack_block([rng.randint(20, 700) for _ in range(400)], 2048)
    cost = defaultdict(float)
    used = defaultdict(int)
    for _, _, n, seq, _ in pieces:
        cost[seq] += packing.piece_cost(n)
        used[seq] += n
    full = [cost[s] for s in cost if used[s] == 2048]
    assert max(full) < 1.6 * (sum(full) / len(full))


def test_pack_table(spark, tokenizer):
    df = documents(spark, ODD_TEXTS)
    rows = packing.digest(packing.pack(df, block_tokens=500)).collect()
    by_doc = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 2048
    assert sum(r.length for r in rows) == sum(
        len(tokenizer.encode(t.text or "", add_special_tokens=False).ids) + 1 for t in df.collect())
    for i, text in enumerate(ODD_TEXTS):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for r in by_doc[i]:
            part = ids[r.start:r.start + r.length]
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
    assert packing.pack(empty(spark)).collect() == []
