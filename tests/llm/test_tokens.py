"""Tokens: the transducer against the tokenizers library, packing against its invariants."""

import hashlib

import numpy as np
import pytest
from cases import SMALL, messy, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kestrel.llm import bpe_stream, tokenpack, varpack
from kestrel.llm.vocab import BYTE_BPE, BYTE_RANKS, PATTERN


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


@pytest.fixture(scope="module")
def tools():
    return bpe_stream.tools(bpe_stream.read_spec(BYTE_BPE))


PARTS = ["a", "b", " ", "  ", "\n", "the", "'s", "'re", "é", "1", "²", "ing", "　", "\x1c", "\x85", "ß", "<|endoftext|>", ".", "-", "́",
         "中", "😀", "\xa0", "'", "ll", "_", "﻿", "‍", "ǅ", "٣"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join))
def test_transducer_equals_library(text):
    encoder, spell, _ = bpe_stream.tools(bpe_stream.read_spec(BYTE_BPE))
    want = Tokenizer.from_file(BYTE_BPE) if not hasattr(test_transducer_equals_library, "t") else test_transducer_equals_library.t
    test_transducer_equals_library.t = want
    got = encoder.ids(text)
    assert got.tolist() == want.encode(text, add_special_tokens=False).ids
    back = bpe_stream.Decoder(spell)
    assert "".join(back.feed(got[i:i + 1]) for i in range(len(got))) + back.finish() == want.decode(got.tolist(), skip_special_tokens=False)


def test_long_runs_keep_a_bounded_buffer(library, tools):
    encoder, _, _ = tools
    r = np.random.default_rng(1)
    for letters in ("ab", "thein", "a", "erionst"):
        word = "".join(r.choice(list(letters), 6000))
        assert encoder.ids(word).tolist() == library.encode(word, add_special_tokens=False).ids
        t, out = bpe_stream.Transducer(encoder.v), []
        for b in word.encode():
            out += t.feed(bytes([b]))
            assert len(t.buffer) <= t.block
        assert [*out, *t.finish()] == encoder.ids(word).tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60).map("".join), st.sampled_from([1, 3, 8]))
def test_slices_change_nothing(text, size):
    encoder, _, _ = bpe_stream.tools(bpe_stream.read_spec(BYTE_BPE))
    old = bpe_stream.SLICE
    want = encoder.ids(text).tolist()
    bpe_stream.SLICE = size
    try:
        got = list(encoder.encode(text))
    finally:
        bpe_stream.SLICE = old
    assert np.concatenate([np.zeros(0, "<u4"), *got]).tolist() == want


def test_long_texts_are_read_in_slices(library, tools, monkeypatch):
    encoder, _, _ = tools
    monkeypatch.setattr(bpe_stream, "SLICE", 500)
    monkeypatch.setattr(bpe_stream, "SEND", 400)
    r = np.random.default_rng(6)
    words = " ".join("".join(r.choice(list("abcdeé1."), int(r.integers(1, 9)))) for _ in range(5000))
    run = "".join(r.choice(list("thein1.é"), 20000))            # no place to cut, many pieces
    for text in (words, run, words + "  " + run + " " + words, " " * 3000, "ab" * 9000):
        parts = list(encoder.encode(text))
        assert np.concatenate(parts).tolist() == library.encode(text, add_special_tokens=False).ids
        assert max(map(len, parts)) <= 1400 or text.startswith(" ")


def test_other_vocabularies_are_refused():
    import json

    import public_tokenizers
    with pytest.raises(ValueError, match="plain byte-level"):
        bpe_stream.Vocabulary(bpe_stream.read_spec(public_tokenizers.path("word_bpe_49k.json")))
    spec = json.loads(bpe_stream.read_spec(BYTE_BPE))
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}},
                   {"pre_tokenizer": None}, {"model": {**spec["model"], "dropout": 0.1}}, {"model": {**spec["model"], "ignore_merges": True}}):
        with pytest.raises(ValueError, match="plain byte-level"):
            bpe_stream.Vocabulary(json.dumps({**spec, **change}))


def test_bytes_that_are_no_text_decode_as_in_the_library(library, tools):
    _, spell, _ = tools
    for ids in ([127, 128, 200, 64], [161, 50256, 220], list(range(0, 400, 7))):
        back = bpe_stream.Decoder(spell)
        assert back.feed(np.array(ids)) + back.finish() == library.decode(ids, skip_special_tokens=False)


def test_round_trip_of_messy_rows(spark, library):
    docs = messy(spark)
    got = rows_of(bpe_stream.round_trip(docs, BYTE_BPE), "doc_id", "ids_sha256")
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest(), True))
    assert got == sorted(want, key=lambda r: (str(r[0]), r[2]))
    assert bpe_stream.round_trip(docs.limit(0), BYTE_BPE).count() == 0
    back = bpe_stream.decode(bpe_stream.encode(docs, BYTE_BPE), BYTE_BPE)
    assert sorted((r.doc_id or -1, r.text) for r in back.collect()) == sorted((r["doc_id"] or -1, r["text"] or "") for r in docs.collect())


def test_best_fit_never_overfills_and_shrinks():
    r = np.random.default_rng(2)
    for n in (0, 1, 5, 700):
        sizes = r.integers(1, 4097, n).tolist()
        bins, starts, caps = varpack.pack(sizes)
        seen: dict[int, list] = {}
        for b, s, size in zip(bins, starts, sizes):
            seen.setdefault(b, []).append((s, size))
        for b, members in seen.items():
            at = 0
            for s, size in sorted(members):
                assert s == at
                at += size
            assert caps[b] == min(c for c in varpack.CAPACITIES if c >= at)
        assert len(seen) == len(caps)


def test_small_supplies_open_small_rows():
    assert varpack.pack([100])[2] == [512]
    assert set(varpack.pack([400] * 200)[2]) >= {4096}


def test_capacity_tree_finds_the_least_that_suffices():
    r = np.random.default_rng(3)
    tree, open_rows = tokenpack.CapacityTree(100), []
    for step in range(2000):
        if r.random() < 0.55:
            space = int(r.integers(1, 101))
            tree.put(space, step)
            open_rows.append(space)
        else:
            least = int(r.integers(1, 101))
            got = tree.take(least)
            fits = [s for s in open_rows if s >= least]
            assert (got[0] if got else None) == (min(fits) if fits else None)
            if got:
                open_rows.remove(got[0])


def test_packing_keeps_every_token(spark):
    docs = messy(spark)
    encoder = varpack.tokenizer(varpack.read_ranks(BYTE_RANKS), PATTERN)
    want = sorted(encoder.encode_ordinary(r["text"] or "") for r in docs.collect())
    placed = varpack.pack_documents(docs, BYTE_RANKS, PATTERN).collect()
    assert sum(r.n_tokens for r in placed) == sum(map(len, want))
    assert all((r.seq_id is None) == (r.n_tokens == 0) for r in placed)
    matrix = tokenpack.packed_matrix(docs, BYTE_RANKS, PATTERN, row=64).collect()
    whole: list[tuple] = []
    for r in matrix:
        ids = np.frombuffer(r.ids, dtype="<u2")
        assert len(ids) == 64 and r.cu_seqlens[-1] == r.n_tokens and (ids[r.n_tokens:] == 50256).all()
        place = tokenpack.positions(r.cu_seqlens, 64)
        assert [i for i in range(64) if place[i] == 0] == list(r.position_resets)
        whole += [(d is None, d or 0, s, ids[a:b].tolist()) for d, s, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:])]
    assert sum(len(w[3]) for w in whole) == sum(map(len, want))
    one = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    for doc, text in one.items():
        parts = {s: ids for _, d, s, ids in whole if d == doc and not _}
        assert [t for s in sorted(parts) for t in parts[s]] == encoder.encode_ordinary(text or "")
    assert varpack.pack_documents(docs.limit(0), BYTE_RANKS, PATTERN).count() == 0
    assert tokenpack.packed_matrix(docs.limit(0), BYTE_RANKS, PATTERN).count() == 0


def test_queries_on_small_tables(spark):
    from kestrel.llm.queries import QUERIES
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert QUERIES["op3_bpe_transducer"](spark, SMALL).where("same").count() == n
    assert QUERIES["op6_variable_best_fit"](spark, SMALL).select("doc_id").distinct().count() == n
    packed = QUERIES["op10_packed_ids"](spark, SMALL).selectExpr("sum(n_tokens) t", "count(*) n").first()
    assert packed["t"] > 0.9 * 2048 * packed["n"]
