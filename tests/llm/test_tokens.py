from __future__ import annotations

import functools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from webtext.llm import encode, idfile, pieces, rangecoder, tokencount
from webtext.llm.queries import QUERIES
from webtext.session import fresh_dir

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50256), min_size=1, max_size=60), min_size=1, max_size=6))
def test_range_coder_round_trip(blocks):
    blocks = [np.array(b, np.int64) for b in blocks]
    codes = rangecoder.encode(blocks, 50257)
    back = rangecoder.decode(codes, np.array([len(b) for b in blocks]), 50257)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))
    alone = [rangecoder.decode([c], np.array([len(b)]), 50257)[0] for c, b in zip(codes, blocks)]
    assert all(np.array_equal(a, b) for a, b in zip(blocks, alone))


def test_range_coder_learns():
    draw = np.random.default_rng(1)
    repeated = np.tile(draw.integers(0, 50257, 50), 60)
    uniform = draw.integers(0, 50257, 3000)
    skewed = (draw.exponential(30, 3000)).astype(int)
    sizes = [len(c) for c in rangecoder.encode([repeated, uniform, skewed], 50257)]
    assert sizes[0] < 700 and sizes[1] < 6600 and sizes[2] < 3300
    assert np.array_equal(rangecoder.decode(rangecoder.encode([skewed], 50257), np.array([3000]), 50257)[0], skewed)


def test_frames_find_damage():
    frame = ([1, None], np.array([3, 5000]), np.arange(5003, dtype=np.uint32))
    (data,) = idfile.pack_frames([frame], 50257)
    keys, counts, ids = idfile.unpack_frames([data])[0]
    assert keys == [1, None] and counts.tolist() == [3, 5000] and np.array_equal(ids, frame[2])
    for place in (5, len(data) - 9):
        broken = bytearray(data)
        broken[place] ^= 64
        with pytest.raises(ValueError):
            idfile.unpack_frames([bytes(broken)])


@functools.cache
def byte_library():
    library = Tokenizer.from_file(BYTE)
    return library


def expected_ids(text):
    return np.array([*byte_library().encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def test_files_of_odd_documents(spark, odd):
    path = fresh_dir(spark, "ids-test")
    idfile.write(odd, path, BYTE, 0)
    got = idfile.read(spark, path).orderBy("start").collect()
    want = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [r.doc_id for r in want]
    at = 0
    for row, source in zip(got, want):
        ids = expected_ids(source.text)
        assert row.start == at and row.n_tokens == len(ids) and bytes(row.ids) == ids.tobytes()
        at += len(ids)


def test_files_of_an_empty_table(spark, none):
    path = fresh_dir(spark, "ids-test")
    idfile.write(none, path, BYTE, 0)
    assert idfile.read(spark, path).count() == 0


def test_op4(spark, data, documents):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op4_token_id_output"](spark, data).collect()}
    at = 0
    for row in documents.orderBy("doc_id").collect():
        ids = expected_ids(row.text)
        assert got[row.doc_id] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def brute_counts(text, rule):
    sizes = [len(t) for t in byte_library().encode(text, add_special_tokens=False).tokens]
    owner, line = [], 0
    data = text.encode()
    for byte in data:
        owner.append(line)
        line += byte == 10
    counts = [0] * (max(owner, default=0) + 1)
    at = 0
    for size in sizes:
        held = owner[at : at + size]
        at += size
        counts[{"first": held[0], "last": held[-1], "most": max(sorted(set(held)), key=held.count)}[rule]] += 1
    return counts


@pytest.mark.parametrize("rule", tokencount.RULES)
def test_line_counts(odd, rule):
    rows = tokencount.count_tokens(odd.filter("doc_id IS NOT NULL AND doc_id <> 1"), BYTE, rule=rule).collect()
    for source in odd.filter("doc_id > 1").collect():
        own = sorted((r for r in rows if r.doc_id == source.doc_id), key=lambda r: r.section)
        text = source.text or ""
        assert [r.n_tokens for r in own] == brute_counts(text, rule)
        assert own[0].start == 0 and own[-1].end == len(text)
        assert all(a.end == b.start and text[a.end - 1] == "\n" for a, b in zip(own, own[1:]))


def test_field_counts_and_edges(odd, none):
    rows = tokencount.count_tokens(odd.filter("doc_id = 2"), BYTE, ("lang", "text", "source"), by="field").collect()
    assert [(r.section, r.start, r.end) for r in sorted(rows, key=lambda r: r.section)] == [(0, 0, 3), (1, 3, 4), (2, 4, 5)]
    assert tokencount.count_tokens(none, BYTE).count() == 0
    assert tokencount.count_tokens(odd.filter("doc_id = 1"), BYTE).count() == 2
    with pytest.raises(ValueError):
        tokencount.count_tokens(odd, BYTE, rule="half")


MARKED = ["a<|endoftext|>b", "<|startoftext|>One  two\n<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext", "plain words", "日本<|endoftext|> é"]


@pytest.mark.parametrize("file", [BYTE, public_tokenizers.path("word_bpe_49k.json")])
def test_added_tokens_equal_the_unchanged_library(file):
    library = Tokenizer.from_file(file)
    ids, counts = encode.Encoder(file).encode(MARKED)
    got = [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [library.encode(text, add_special_tokens=False).ids for text in MARKED]


def test_files_and_line_counts_with_added_tokens(spark):
    library = Tokenizer.from_file(BYTE)
    df = spark.createDataFrame(list(enumerate(MARKED)), "doc_id bigint, text string")
    path = fresh_dir(spark, "ids-test")
    idfile.write(df, path, BYTE, 0)
    got = [list(np.frombuffer(r.ids, "<u4")) for r in idfile.read(spark, path).orderBy("start").collect()]
    want = [library.encode(text, add_special_tokens=False).ids for text in MARKED]
    assert got == [[*ids, 0] for ids in want]
    totals = {r.doc_id: r.n for r in tokencount.count_tokens(df, BYTE).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    assert totals == {i: len(ids) for i, ids in enumerate(want)}


def test_op8(spark, data, documents):
    got = {}
    for r in QUERIES["op8_token_counts"](spark, data).orderBy("section").collect():
        got.setdefault(r.doc_id, []).append(r.n_tokens)
    assert got == {row.doc_id: brute_counts(row.text or "", "first") for row in documents.collect()}


ALPHABET = st.text(st.sampled_from("abtheionédß日🎉\r\n;)x ▁ "), max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=6))
def test_pieces_without_dropout_equal_library(texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    encoder = pieces._encoder(PIECE, 0.0, 0)
    ids, counts = encoder.encode(texts, [0] * len(texts))
    for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        if pieces.BLANK not in text:
            assert list(got) == library.encode(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=6), st.sampled_from([0.0, 0.1, 0.5, 0.9]))
def test_pieces_are_lossless_and_steps_equal_agenda(texts, dropout):
    encoder = pieces._encoder(PIECE, dropout, 3)
    ids, counts = encoder.encode(texts, [1] * len(texts))
    data, sizes = encoder.model.decode(ids, counts)
    assert [part.tobytes().decode() for part in np.split(data, np.cumsum(sizes)[:-1])] == texts
    bare = [t.replace(pieces.BLANK, "").replace("\n", "").replace(" ", "") for t in texts]
    words = ["!" + t for t in bare if t] or ["!x"]
    flat, per = encoder.encode_words(words)
    kept, pieces._LONG = pieces._LONG, -1
    try:
        other, other_per = encoder.encode_words(words)
    finally:
        pieces._LONG = kept
    assert np.array_equal(flat, other) and np.array_equal(per, other_per)


def test_pieces_vary_by_seed_and_variant():
    texts = ["information retrieval and understanding of international organisations"]

    def ids(seed, variant, dropout=0.3):
        return tuple(pieces._encoder(PIECE, dropout, seed).encode(texts, [variant])[0].tolist())

    assert ids(1, 0) == ids(1, 0)
    assert len({ids(s, v) for s in range(4) for v in range(4)}) > 8
    assert ids(1, 0, 0.0) == ids(2, 3, 0.0)


def test_pieces_of_odd_documents(odd, none):
    rows = pieces.decode(pieces.encode(odd, PIECE), PIECE).collect()
    assert sorted(((r.doc_id or -1), r.text) for r in rows) == sorted(((r.doc_id or -1), r.text or "") for r in odd.collect())
    assert pieces.decode(pieces.encode(none, PIECE), PIECE).count() == 0


def test_op9(spark, data, documents):
    got = {r.doc_id: r for r in QUERIES["op9_sentencepiece"](spark, data).collect()}
    for row in documents.collect():
        assert got[row.doc_id].text_crc32 == zlib.crc32((row.text or "").encode()) and (got[row.doc_id].n_ids > 0) == bool(row.text)
