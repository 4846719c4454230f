from __future__ import annotations

import itertools
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, pre_tokenizers

from webtext.llm import packing
from webtext.llm.encode import Encoder
from webtext.llm.queries import QUERIES

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def fewest(lengths, capacity):
    """Fewest bins by trying all ways."""
    best = len(lengths)

    def place(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(lengths):
            best = len(rooms)
            return
        for i in {room: i for i, room in enumerate(rooms) if room >= lengths[at]}.values():
            place(at + 1, [*rooms[:i], rooms[i] - lengths[at], *rooms[i + 1 :]])
        place(at + 1, [*rooms, capacity - lengths[at]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_search_is_optimal_on_small_input(lengths):
    counts = {x: lengths.count(x) for x in lengths}
    kinds = packing.Search(counts, 20).solve()
    assert sum(n for n, _ in kinds) == fewest(sorted(lengths, reverse=True), 20)
    used = list(itertools.chain.from_iterable(filling * n for n, filling in kinds))
    assert sorted(used) == sorted(lengths) and all(sum(f) <= 20 for _, f in kinds)


def test_search_reaches_the_bound_on_many():
    lengths, counts = np.unique(np.random.default_rng(3).exponential(900, 20_000).astype(int) % 4096 + 1, return_counts=True)
    search = packing.Search(dict(zip(lengths.tolist(), counts.tolist())), 4096)
    assert sum(n for n, _ in search.solve()) == search.lower_bound(search.counts)


def test_search_refuses_lengths_outside():
    with pytest.raises(ValueError):
        packing.Search({5000: 1}, 4096)


@pytest.mark.parametrize("file", [WORD, BYTE])
def test_encoder_equals_library(file, documents):
    texts = [row[0] or "" for row in documents.select("text").collect()]
    texts += ["", "  a  b\n\n c", "x\x85y\xa0z", "İstanbul ΑΣ", "a\x1cb", "it's we'LL Don't '", "½²ªº 12345 a_b", "<|endoftext|> hi", "日本語", " \n \t", "é ĳ ŉ"]
    library = Tokenizer.from_file(file)
    ids, counts = Encoder(file).encode(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [list(part) for part in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_encoder_forgets_and_stays_right():
    encoder = Encoder(BYTE)
    encoder.cached = 3
    for texts in (["a b c d e"], ["a b", "c d"], ["x y z w v u"], ["a b"]):
        ids, _ = encoder.encode(texts)
        assert list(ids) == [i for t in texts for i in encoder.whole.encode(t, add_special_tokens=False).ids]


def check_places(rows, capacity):
    by = {}
    for row in rows:
        by.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_pieces_of_odd_documents(odd):
    packed = packing.packed_documents(odd, WORD, 1, 64)
    rows = packed.collect()
    check_places(rows, 64)
    library = Tokenizer.from_file(WORD)
    want = sorted(
        (row.doc_id or -1, np.array([*library.encode(row.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for row in odd.collect()
    )
    whole = {}
    for row in sorted(rows, key=lambda r: r.start):
        assert row.start == 64 * row.piece and row.length == len(row.ids) // 4
        whole.setdefault(row.doc_id or -1, {}).setdefault(row.piece, []).append(bytes(row.ids))
    got = sorted((key, b"".join(parts[p][i] for p in sorted(parts))) for key, parts in whole.items() for i in range(len(parts[0])))
    assert got == want


def test_empty_table(none):
    packed = packing.packed_documents(none, WORD, 1, 64)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"] and packed.count() == 0


def test_query(spark, data, documents):
    rows = QUERIES["op1_best_fit_packing"](spark, data).collect()
    check_places(rows, 4096)
    total = sum(row.length for row in rows)
    assert len({row.sequence_id for row in rows}) == -(-total // 4096)
    library = Tokenizer.from_file(WORD)
    texts = {row.doc_id: row.text or "" for row in documents.collect()}
    for row in rows:
        ids = np.array([*library.encode(texts[row.doc_id], add_special_tokens=False).ids, 1], "<u4")[row.start : row.start + row.length]
        assert row.ids_crc32 == zlib.crc32(ids.tobytes())


@pytest.mark.parametrize("file", [WORD, BYTE])
def test_new_words_are_merged_without_the_whole_library(file):
    """The ids of the library's own way, in less time."""
    encoder, draw = Encoder(file), random.Random(4)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(3, 11))) for _ in range(30_000)]
    words += ["é", "ÿþ", "\xad\xa0\x7f", "\x00\n", "'", "ab3", "ªº"] + ([" a", "  ", " 1", " .;"] if file == BYTE else [])
    plain = Tokenizer(encoder.whole.model)
    plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def timed(run):
        begin = time.process_time()
        return run(), time.process_time() - begin

    (flat, counts), took = timed(lambda: encoder.encode_words(words))
    want, whole = timed(lambda: [e.ids for e in plain.encode_batch_fast(words, add_special_tokens=False)])
    assert [list(part) for part in np.split(flat, np.cumsum(counts)[:-1])] == want
    assert took < 0.8 * whole


def test_a_failed_look_up_leaves_no_numbers(monkeypatch):
    encoder = Encoder(WORD)
    encoder.encode(["one two"])
    with monkeypatch.context() as patch, pytest.raises(MemoryError):
        patch.setattr(encoder, "encode_words", lambda words: (_ for _ in ()).throw(MemoryError()))
        encoder.encode(["one three"])
    assert list(encoder.encode(["three two"])[0]) == encoder.whole.encode("three two", add_special_tokens=False).ids
