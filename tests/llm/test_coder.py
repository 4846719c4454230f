"""The coder of token ids, and the words of the byte vocabulary."""

from __future__ import annotations

import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from webtext.llm import encode, idfile, rangecoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def ids(documents):
    texts = [row.text or "" for row in documents.select("text").collect()]
    flat, _ = encode.Encoder(BYTE).encode_ended(texts, 0)
    return flat


def cut(ids, size):
    return [ids[i : i + size] for i in range(0, len(ids), size)]


def test_codes_are_smaller_than_deflate(ids):
    """Blocks of the same ids as 16-bit numbers, which flatters deflate."""
    blocks = cut(ids, idfile.BLOCK)
    own = sum(map(len, rangecoder.encode(blocks, 50257)))
    assert own < sum(len(zlib.compress(block.astype("<u2").tobytes())) for block in blocks)


def test_coding_takes_little_time(ids):
    """Against a sort of each block's ids in Python; a coder that learned after every id took twelve times as long as that."""
    blocks = cut(np.resize(ids, 512 * 2048), 2048)
    sizes = np.full(len(blocks), 2048)

    def timed(run):
        begin = time.process_time()
        return run(), time.process_time() - begin

    lists = [block.tolist() for block in blocks]
    _, plain = timed(lambda: [{x: i for i, x in enumerate(sorted(part))} for part in lists])
    codes, written = timed(lambda: rangecoder.encode(blocks, 50257))
    back, read = timed(lambda: rangecoder.decode(codes, sizes, 50257))
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))
    assert written + read < 6 * plain


@pytest.mark.parametrize("vocabulary", [1, 2, 300, 50257, 1 << 18])
def test_blocks_of_any_length_and_vocabulary(vocabulary):
    draw = np.random.default_rng(5)
    sizes = [1, 15, 16, 17, 63, 64, 65, 1023, 1024, 1025, 5000, 1, 700]
    blocks = [np.minimum(draw.exponential(vocabulary / 8 + 1, n).astype(np.int64), vocabulary - 1) for n in sizes]
    blocks.append(np.full(3000, vocabulary - 1))
    codes = rangecoder.encode(blocks, vocabulary)
    back = rangecoder.decode(codes, np.array([len(b) for b in blocks]), vocabulary)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))
    for code, block in zip(codes, blocks):
        assert np.array_equal(rangecoder.decode([code], np.array([len(block)]), vocabulary)[0], block)


def test_damaged_codes_end():
    draw = np.random.default_rng(6)
    blocks = [draw.integers(0, 50257, 2000) for _ in range(8)]
    codes = [bytes(draw.integers(0, 256, len(code), dtype=np.uint8)) for code in rangecoder.encode(blocks, 50257)]
    assert [len(ids) for ids in rangecoder.decode([*codes, b"", b"\xff" * 40], np.full(10, 2000), 50257)] == [2000] * 10


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abrelvstmdRLé ²5''''  \n\t\xa0\x85!.ª\x00"), min_size=1, max_size=16), min_size=1, max_size=4))
def test_byte_words_follow_the_rule(texts):
    data, sizes = "".join(texts).encode("latin-1"), np.array([len(text) for text in texts])
    begins = [*encode.byte_words(data, np.cumsum(sizes) - sizes).tolist(), len(data)]
    got = [data[i:j].decode("latin-1") for i, j in zip(begins, begins[1:])]
    assert got == [word for text in texts for word in re.findall(encode.BYTE_RULE, text)]


def test_frames_end_with_the_document_that_fills_them(spark, tmp_path):
    """Many documents of one slice of texts are not one frame."""
    df = spark.createDataFrame([(i, "one two three " * 800) for i in range(160)], "doc_id bigint, text string").coalesce(1)
    path = str(tmp_path / "ids")
    idfile.write(df, path, BYTE, 0)
    frames = [row.n_ids for row in spark.read.schema(idfile.FILE).parquet(path).collect()]
    longest = 800 * 4 + 2
    assert len(frames) > 1 and max(frames) < idfile.FRAME + longest
    assert sorted(row.doc_id for row in idfile.read(spark, path).collect()) == list(range(160))
