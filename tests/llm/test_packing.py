"""Packing: every token in exactly one place, no gaps, no padding; ids as the tokenizer gives them."""

import zlib

import numpy as np
import pytest
from helpers import AWKWARD, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from logloom.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 300), min_size=1, max_size=40))
def test_pieces_tile_documents_and_sequences(sizes):
    pieces, left = packing.pack(sizes, length=64)
    assert not left
    for key, start, limit in ((0, 1, dict(enumerate(sizes))), (3, 4, None)):
        by = {}
        for p in pieces:
            by.setdefault(p[key], []).append((p[start], p[2]))
        for k, some in by.items():
            at = 0
            for s, n in sorted(some):
                assert s == at and n > 0
                at += n
            assert at == limit[k] if limit else at == 64 or at & (at - 1) == 0
    assert sum(p[2] for p in pieces) == sum(sizes)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 300), min_size=1, max_size=40))
def test_windows_that_are_not_the_last_are_full(sizes):
    pieces, left = packing.pack(sizes, length=64, last=False)
    by = {}
    for _, _, n, sequence, _ in pieces:
        by[sequence] = by.get(sequence, 0) + n
    assert all(n == 64 for n in by.values()) and sum(n for n, _, _ in left) == sum(sizes) % 64
    assert all(start + n == sizes[doc] for n, doc, start in left)


def test_few_documents_are_cut_and_few_sequences_are_short(spark):
    rows = [(i, prose(i, 20 + (i * 7919) % 900)) for i in range(400)]
    pieces = packing.pack_documents(documents(spark, rows).coalesce(1), PATH, length=2048, window=40_000).toPandas()
    size = pieces.groupby("sequence_id").length.sum()
    assert (size < 2048).sum() <= 11  # of the partition's end alone, not of each window
    cut = pieces.groupby("doc_id").agg(n=("length", "count"), tokens=("doc_tokens", "first"))
    assert (cut[cut.tokens <= 2048].n > 1).mean() < 0.12


def test_costs_are_balanced():
    sizes = [60] * 4 + [4] * 68
    cost = {}
    for _, _, n, sequence, _ in packing.pack(sizes, length=128, quadratic=1 / 64)[0]:
        cost[sequence] = cost.get(sequence, 0) + n + n * n / 64
    assert max(cost.values()) < 1.3 * min(cost.values())


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aBcé '.,!<|>endoftx\t\n\r\x1c1２ß‍́漢"), max_size=40))
def test_ids_are_the_tokenizers(text):
    encoder = packing.encoder(PATH)
    assert encoder.text(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_pack_documents(spark):
    rows = [(i, prose(i, 10 + 37 * i)) for i in range(40)] + [(3, prose(3, 9)), (50, "It's <|endoftext|> Ünï-code's"), *AWKWARD]
    pieces = packing.pack_documents(documents(spark, rows).repartition(3), PATH, length=2048, window=5000).toPandas()
    tokenizer = packing.encoder(PATH).tokenizer
    by_sequence = pieces.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert ((by_sequence.length.cumsum() - by_sequence.length.transform(lambda x: x)) == pieces.sort_values(["sequence_id", "offset"]).offset).all()
    assert all(n == 2048 or n & (n - 1) == 0 for n in by_sequence.length.sum())
    once = {i: t for i, t in rows if i is not None and i != 3}
    for i, t in once.items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        mine = pieces[pieces.doc_id == i].sort_values("start")
        assert mine.length.sum() == len(ids) and (mine.doc_tokens == len(ids)).all()
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(mine.start, mine.length)] == mine.ids_crc32.tolist()
    assert pieces[pieces.doc_id == 9001].length.tolist() == [1]
    assert len(set(pieces[pieces.doc_id == 3].doc_tokens)) == 2 and pieces.doc_id.isna().sum() > 0
    assert packing.pack_documents(documents(spark, []), PATH).count() == 0
