"""Operators 3, 7 and 8 against the tokenizer library, with exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_fixtures import make_docs, odd_rows  # noqa: F401
from rotorwatch.llm import counts, packing, pretokens, tokenfiles
from rotorwatch.llm.common import tokenizer_file

WORDS, BYTES = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")
POOL = [
    "the", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "It's", "é", "É", "ÀÉx", "…", "\u00a0", "\u2009", "e\u0301", "\u0301", ".", ",", "...", "123",
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "Σ", "ΑΣ", "İ", "ß", "×", "÷", "\x1c", "\x1f", "\x0b", "\x0c", "\x00", "\u3000",
    "日本", "😀", "ABC", "'LL", "’s", "\x85", "\u2028", "“q”", "-", "_", "ﬁ", "½", "²", "٣", "\u1680", "\u202f"]


@pytest.mark.parametrize("path,make", [(WORDS, pretokens.word_encoder), (BYTES, pretokens.byte_encoder)])
def test_ids_equal_the_librarys(path, make):
    rng = random.Random(5)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 14))) for _ in range(6000)] + ["", None, " ", "\n\n Foo  bar\n"]
    encoder, library = make(path), Tokenizer.from_file(path)
    for _, part in pretokens.text_slices(pa.array(texts), 9000):
        ids, borders = encoder.ids(part)
        for k, text in enumerate(part.to_pylist()):
            assert ids[borders[k]: borders[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("retain", [False, True])
def test_cache_is_bounded_and_refilled(monkeypatch, retain):
    monkeypatch.setattr(pretokens, "CACHE_ENTRIES", 50)
    encoder = pretokens.Encoder(WORDS, False, True, retain)
    library = Tokenizer.from_file(WORDS)
    for k in range(30):
        text = " ".join(f"w{k}{j} often w{k // 2} same{j % 3}" + "abcdefghij"[j] * 3 for j in range(10))
        assert encoder.ids(pa.array([text], pa.large_string()))[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_full_cache_keeps_what_recurred(monkeypatch):
    monkeypatch.setattr(pretokens, "CACHE_ENTRIES", 50)
    encoder = pretokens.Encoder(WORDS, False, True, retain=True)
    for k in range(30):
        encoder.ids(pa.array([" ".join(["often", *("x" * (k + 1) + "abcdefghij"[j] * 2 for j in range(10))])], pa.large_string()))
        assert b"often" in encoder.store.index and len(encoder.store.index) <= 2 * 50
    # all recur: the cache is emptied rather than kept beyond half its size
    many = pa.array([" ".join("y" + "abcdefghij"[j % 10] * (1 + j // 10) for j in range(60))], pa.large_string())
    for _ in range(4):
        encoder.ids(many)
        assert len(encoder.store.index) <= 120


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=200))
def test_byte_aligned_coding_round_trip(values):
    control, data = tokenfiles.pack_ranks(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert tokenfiles.unpack_ranks(control, data, len(values)).tolist() == values


def expected(rows):
    library = Tokenizer.from_file(WORDS)
    return [(d, library.encode(t or "", add_special_tokens=False).ids + [1]) for d, t, _ in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK_TOKENS", 100)
    files = tokenfiles.write_token_files(make_docs(odd_rows), WORDS)
    got = tokenfiles.read_token_files(spark, files).collect()
    assert sorted((str(r["doc_id"]), crc(np.frombuffer(r["ids"], "<u4")), r["n_tokens"]) for r in got) == sorted((str(d), crc(i), len(i)) for d, i in expected(odd_rows))
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == [None, None] + sorted(i for i in ids if i is not None)
    # the commonest id has rank 0, and ranks follow counts
    total = defaultdict(int)
    for _, i in expected(odd_rows):
        for x in i:
            total[x] += 1
    ranks = [r["id"] for r in spark.read.parquet(files.ranks).orderBy("rank").collect()]
    assert [total[i] for i in ranks] == sorted(total.values(), reverse=True)


def test_token_files_of_nothing(spark, make_docs):
    files = tokenfiles.write_token_files(make_docs([]), WORDS)
    assert tokenfiles.read_token_files(spark, files).count() == 0


def test_counts(make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(counts, "SLICE_ENTRIES", 4)
    library = Tokenizer.from_file(BYTES)
    got = counts.count_tokens(make_docs(odd_rows), BYTES).collect()
    want = [(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, _ in odd_rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert counts.count_tokens(make_docs([]), BYTES).count() == 0


def test_frequent_pretokens_are_bounded(make_docs):
    docs = make_docs([(k, " the" * 8 + f" w{k}", "a") for k in range(50)])
    for entries in (0, 1, 10, 1000):
        got = {bytes(r["pretoken"]): r["n"] for r in counts.frequent_pretokens(docs, entries=entries).collect()}
        assert len(got) <= entries and (entries == 0 or got[b" the"] == 400)
    assert counts.frequent_pretokens(make_docs([])).count() == 0


def check_packing(rows, pieces, capacity):
    ids = defaultdict(list)
    for d, i in expected(rows):
        ids[d].append(i)
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append((r["doc_tokens"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        assert len(r["ids"]) == 4 * r["length"] > 0
    for d, texts in ids.items():
        have = sorted((n, s, tuple(i)) for n, s, i in by_doc[d])
        assert sum(len(i) for _, _, i in have) == sum(map(len, texts))
        for text in texts:  # each text's pieces are there as often as the text is
            for n, s, i in have:
                if n == len(text) and len(texts) == 1:
                    assert tuple(text[s: s + len(i)]) == i
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0, "a sequence is full or a power of two"


def test_packing(make_docs, odd_rows):
    check_packing(odd_rows, packing.pack(make_docs(odd_rows), WORDS).collect(), 2048)
    check_packing(odd_rows, packing.pack(make_docs(odd_rows), WORDS, capacity=64).collect(), 64)
    assert packing.pack(make_docs([]), WORDS).count() == 0
    with pytest.raises(ValueError):
        packing.pack(make_docs([]), WORDS, capacity=1000)


def test_packing_classes():
    doc, kind, start, length = packing.pieces(np.array([2048 * 2 + 1024 + 70, 63, 64]), 2048, 6)
    assert list(zip(doc, kind, start, length, strict=True)) == [(0, 0, 0, 2048), (0, 0, 2048, 2048), (0, 1, 4096, 1024), (0, 5, 5120, 64), (0, 6, 5184, 6), (1, 6, 0, 63), (2, 5, 0, 64)]


def test_packing_a_bad_number_of_pieces_at_the_end():
    piece, skip, size, sequence, offset = packing.place(np.array([64] * 5), 128, last=True)
    assert (size.tolist(), sequence.tolist(), offset.tolist()) == ([64] * 5, [0, 0, 1, 1, 2], [0, 64, 0, 64, 0])
    piece, skip, size, sequence, offset = packing.place(np.array([100, 50]), 128, last=False)
    assert (piece.tolist(), skip.tolist(), size.tolist(), sequence.tolist()) == ([0, 1], [0, 0], [100, 28], [0, 0])
