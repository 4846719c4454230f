"""SentencePiece encoding with seeded merge-dropout, and decoding.

A merge-type model joins two neighbouring pieces if the joined piece is in its vocabulary, the best
score first, the leftmost in a tie. With dropout each candidate merge is skipped with probability
``dropout``, by a hash keyed with the seed, the variant, the word and the place of the merge in the
word. So the same input always gives the same ids, and another seed gives other segmentations of the
same text. A document's variant is a hash of its key modulo ``variants``: a word is cut differently
in documents of different variants. Words of equal text and variant are encoded once per worker;
all new words are worked on together, one merge of every word per step. ``agenda`` is the same for a
single word with a heap, and takes the words too long for steps.

Every segmentation decodes to the text: characters outside the vocabulary become byte pieces, and
so does U+2581, which the model itself uses for the blank. Without dropout the ids are those of the
``sentencepiece`` library (but for texts with U+2581).

Defined results: null text is empty; empty text has no ids; a null key has the variant of its hash;
equal rows are encoded each.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.llm.encode import WordStore
from webtext.llm.rows import binary_column, ranges, slices, texts_of
from webtext.llm.words import mix

BLANK = "▁"
#: Stands for U+2581 of a text; no text read by Spark can hold it.
_LITERAL = "\ud800"
_LONG = 64
_WORD = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")
_NO_MERGE = 1 << 30
_MASK = (1 << 64) - 1


class Model:
    """Pieces of a merge-type model file and its merges."""

    def __init__(self, file: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=file)
        size = library.vocab_size()
        self.pieces = [library.id_to_piece(i) for i in range(size)]
        self.byte_ids = np.full(256, -1, np.int64)
        plain: dict[str, int] = {}
        self.bytes: list[bytes] = []
        for i, piece in enumerate(self.pieces):
            if library.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif library.is_control(i) or library.is_unknown(i) or library.is_unused(i):
                self.bytes.append(b"")
            else:
                plain[piece] = i
                self.bytes.append(piece.replace(BLANK, " ").encode())
        if any(BLANK in piece.lstrip(BLANK) or "\n" in piece for piece in plain):
            raise ValueError("pieces of this model cross words")
        self.ids = plain
        self.single = {piece: i for piece, i in plain.items() if len(piece) == 1}
        order = {score: rank for rank, score in enumerate(sorted({library.get_score(i) for i in plain.values()}, reverse=True))}
        pairs = [
            (plain[piece[:at]] * size + plain[piece[at:]], i, order[library.get_score(i)])
            for piece, i in plain.items()
            for at in range(1, len(piece))
            if piece[:at] in plain and piece[at:] in plain
        ]
        self.size = size
        self.left_right, self.merged, self.rank = (np.array(column, np.int64) for column in zip(*sorted(pairs)))
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.begins = np.cumsum(self.lengths) - self.lengths

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged id and rank of neighbours; ids below 0 never merge."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.left_right, wanted), len(self.left_right) - 1)
        found = (self.left_right[at] == wanted) & (left >= 0) & (right >= 0)
        return self.merged[at], np.where(found, self.rank[at], _NO_MERGE)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of the texts of ``counts`` ids each, one after another, and the number of bytes of each."""
        lengths = self.lengths[ids]
        data = self.flat[ranges(self.begins[ids], lengths)]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        at = np.concatenate(([0], np.cumsum(counts)))
        sizes = ends[at[1:]] - ends[at[:-1]]
        filled = sizes > 0  # each such text begins with the blank that encoding puts in front
        data = np.delete(data, (np.cumsum(sizes) - sizes)[filled])
        return data, sizes - filled


def _skip(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, limit: np.uint64) -> np.ndarray:
    place = (start.astype(np.uint64) << np.uint64(42)) ^ (middle.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)
    return mix(key ^ mix(place)) < limit


def agenda(model: Model, word: str, key: int, limit: int) -> list[int]:
    """Pieces of one word by a heap of candidate merges; ids below 0 stand for characters without a piece."""
    ids = [model.single.get(c, -1 - i) for i, c in enumerate(word)]
    starts, ends = list(range(len(word))), list(range(1, len(word) + 1))
    before, after = list(range(-1, len(word) - 1)), [*range(1, len(word)), -1]
    alive = [True] * len(word)
    heap: list[tuple[int, ...]] = []

    def offer(left: int, right: int) -> None:
        if left < 0 or right < 0 or ids[left] < 0 or ids[right] < 0:
            return
        merged, rank = model.look_up(np.array([ids[left]]), np.array([ids[right]]))
        if rank[0] == _NO_MERGE:
            return
        if limit and _skip(np.array([key], np.uint64), np.array([starts[left]]), np.array([starts[right]]), np.array([ends[right]]), np.uint64(limit))[0]:
            return
        heapq.heappush(heap, (int(rank[0]), starts[left], left, right, int(merged[0]), ids[left], ids[right]))

    for i in range(len(word) - 1):
        offer(i, i + 1)
    while heap:
        _, _, left, right, merged, was_left, was_right = heapq.heappop(heap)
        if not (alive[left] and alive[right]) or after[left] != right or (ids[left], ids[right]) != (was_left, was_right):
            continue
        ids[left], ends[left], alive[right] = merged, ends[right], False
        after[left] = after[right]
        if after[right] >= 0:
            before[after[right]] = left
        offer(before[left], left)
        offer(left, after[left])
    return [ids[i] for i in range(len(word)) if alive[i]]


def steps(model: Model, codes: np.ndarray, sizes: np.ndarray, keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(word, start, id)`` of the pieces of all words; one merge of every word per step.

    ``codes`` holds the ids of the characters of all words (below 0: no piece), ``sizes`` their number per word.
    """
    word = np.repeat(np.arange(len(sizes)), sizes)
    start = ranges(np.zeros(len(sizes), np.int64), sizes)
    ids, end = codes.copy(), start + 1
    bound = np.uint64(limit)

    def candidates(at: np.ndarray) -> None:
        merged, found = model.look_up(ids[at], ids[at + 1])
        if limit:
            open_ = np.flatnonzero(found < _NO_MERGE)
            own = at[open_]
            skipped = _skip(keys[word[own]], start[own], start[own + 1], end[own + 1], bound)
            found[open_[skipped]] = _NO_MERGE
        rank[at], joined[at] = found, merged

    rank, joined = np.full(len(ids), _NO_MERGE, np.int64), np.zeros(len(ids), np.int64)
    inner = np.flatnonzero(word[:-1] == word[1:])
    candidates(inner)
    out = []
    while len(ids):
        n = len(ids)
        heads = np.flatnonzero(np.diff(word, prepend=-1))
        best = np.minimum.reduceat(rank * n + np.arange(n), heads)
        active = best < _NO_MERGE * n
        if not active.all():
            ended = np.repeat(~active, np.diff(heads, append=n))
            out.append((word[ended], start[ended], ids[ended]))
            go = ~ended
            shift = np.cumsum(ended)
            at = best[active] % n
            at = at - shift[at]
            word, start, end, ids, rank, joined = word[go], start[go], end[go], ids[go], rank[go], joined[go]
            if not len(ids):
                break
        else:
            at = best % n
        ids[at], end[at] = joined[at], end[at + 1]
        rank[at] = rank[at + 1]  # no merge if the right one was the word's last piece
        stay = np.ones(len(ids), bool)
        stay[at + 1] = False
        new_at = at - np.arange(len(at))
        word, start, end, ids, rank, joined = word[stay], start[stay], end[stay], ids[stay], rank[stay], joined[stay]
        left = new_at[new_at > 0] - 1
        again = np.concatenate((new_at, left))
        again = again[again + 1 < len(word)]
        candidates(again[word[again] == word[again + 1]])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word, start, ids = (np.concatenate(column) for column in zip(*out))
    order = np.lexsort((start, word))
    return word[order], start[order], ids[order]


_loaded: dict[str, Model] = {}


def _model(file: str) -> Model:
    if file not in _loaded:
        _loaded[file] = Model(file)
    return _loaded[file]


class Pieces(WordStore):
    """Encodes texts; words are known by variant and text."""

    def __init__(self, file: str, dropout: float = 0.0, seed: int = 0):
        if not 0 <= dropout < 1:
            raise ValueError("dropout must lie in [0, 1)")
        super().__init__()
        self.model = _model(file)
        self.limit = int(dropout * 2.0**64)
        self.seed = seed
        self.by_point: dict[int, int] = {ord(piece): i for piece, i in self.model.single.items()}

    def _key(self, word: str) -> int:
        return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"), seed=self.seed & _MASK)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``words`` begin with the variant's character."""
        bodies = [word[1:] for word in words]
        keys = np.fromiter(map(self._key, words), np.uint64, len(words)) if self.limit else np.zeros(len(words), np.uint64)
        short = [i for i, body in enumerate(bodies) if len(body) <= _LONG]
        text = "".join(bodies[i] for i in short)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        values, inverse = np.unique(points, return_inverse=True)
        codes = np.array([self.by_point.get(int(p), -1) for p in values], np.int64)[inverse] if len(values) else np.zeros(0, np.int64)
        sizes = np.fromiter((len(bodies[i]) for i in short), np.int64, len(short))
        word, start, ids = steps(self.model, codes, sizes, keys[short], self.limit)
        # a piece below 0 is one character: its UTF-8 bytes as byte pieces
        result: list[np.ndarray | None] = [None] * len(words)
        unknown = np.flatnonzero(ids < 0)
        counts = np.ones(len(ids), np.int64)
        if len(unknown):
            offsets = np.cumsum(sizes) - sizes
            spelled = [self._spell(text[offsets[word[i]] + start[i]]) for i in unknown]
            counts[unknown] = [len(s) for s in spelled]
            flat = np.repeat(ids, counts)
            flat[ranges((np.cumsum(counts) - counts)[unknown], counts[unknown])] = np.concatenate(spelled)
        else:
            flat = ids
        per = np.bincount(word, counts, len(short)).astype(np.int64)
        if len(short) == len(words):
            return flat.astype(np.uint32), per
        for i, part in zip(short, np.split(flat, np.cumsum(per)[:-1])):
            result[i] = part
        for i, body in enumerate(bodies):
            if result[i] is None:
                found = agenda(self.model, body, int(keys[i]), self.limit)
                result[i] = np.concatenate([[x] if x >= 0 else self._spell(body[-1 - x]) for x in found])
        return np.concatenate(result).astype(np.uint32), np.array([len(r) for r in result], np.int64)

    def _spell(self, character: str) -> np.ndarray:
        data = (BLANK if character == _LITERAL else character).encode("utf-8", "surrogatepass")
        return self.model.byte_ids[np.frombuffer(data, np.uint8)]

    def encode(self, texts: list[str], variants: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        words = []
        for text, variant in zip(texts, variants):
            mark = chr(variant + 32)
            marked = BLANK + text.replace(BLANK, _LITERAL).replace(" ", BLANK) if text else ""
            words.append([mark + word for word in _WORD.findall(marked)])
        ids, lengths = self.look_up([word for text in words for word in text])
        ends = np.concatenate(([0], np.cumsum(lengths)))
        at = np.concatenate(([0], np.cumsum([len(text) for text in words]).astype(np.int64)))
        return ids, ends[at[1:]] - ends[at[:-1]]


_encoders: dict[tuple, Pieces] = {}


def _encoder(file: str, dropout: float, seed: int) -> Pieces:
    if (file, dropout, seed) not in _encoders:
        _encoders[(file, dropout, seed)] = Pieces(file, dropout, seed)
    return _encoders[(file, dropout, seed)]


def encode(docs: DataFrame, file: str, dropout: float = 0.1, seed: int = 1, variants: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids)``: little-endian unsigned 32-bit ids."""
    variant = F.pmod(F.xxhash64(F.col(key)), F.lit(variants)).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file, dropout, seed)
        for part in slices(batches, "text"):
            ids, counts = encoder.encode(texts_of(part), part.column("variant").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), binary_column(ids.astype("<u4"), counts)], names=["doc_id", "ids"])

    chosen = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"), variant.alias("variant"))
    return chosen.mapInArrow(run, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, file: str) -> DataFrame:
    """``(doc_id, ids, text)``: the text of each row's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(file)
        for part in slices(batches, "ids", 4_000_000):
            rows = part.column("ids").to_pylist()
            counts = np.array([len(row) // 4 for row in rows], np.int64)
            data, sizes = model.decode(np.frombuffer(b"".join(rows), "<u4"), counts)
            ends = np.zeros(len(sizes) + 1, np.int32)
            np.cumsum(sizes, out=ends[1:])
            text = pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), text], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, text string")
