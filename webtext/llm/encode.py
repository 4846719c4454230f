"""Token ids by the ``tokenizers`` library, each distinct word encoded once per worker.

Both vocabularies split a text into words before any merge, and a word's ids depend on nothing but
the word. So a text is split by the vocabulary's own rule, new words go to the library's merges, and
known ones are looked up. Texts with characters outside the range in which Python and
the library agree on letters and white space go to the library whole, and so do texts with an added
token of the file (such as ``<|endoftext|>``), which the library takes as one id.

The byte vocabulary's words are the whole text, one after another, so they are cut with array
operations over all texts at hand, and only the distinct ones become Python strings.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa

from webtext.llm.rows import ranges, tidy, worker_caches

# Below this code point both sides agree, but for four separators that only Python takes as white space.
_SAFE_END = 0x100
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def _odd(text: str) -> bool:
    if text.isascii():
        return any(c in text for c in _SEPARATORS)
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return True
    return any(c in text for c in _SEPARATORS)


def _letters(kinds: str) -> str:
    found = [chr(c) for c in range(_SAFE_END) if unicodedata.category(chr(c))[0] in kinds]
    return "".join(re.escape(c) for c in found)


# The two vocabularies' rules for splitting a text into words (byte_words follows BYTE_RULE).
_SPACE = "\t-\r\x20\x85\xa0"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_L, _N = _letters("L"), _letters("N")
BYTE_RULE = rf"{_SHORT}| ?[{_L}]+| ?[{_N}]+| ?[^{_SPACE}{_L}{_N}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
WORD_RULE = rf"{_SHORT}|[{_L}]+|[{_N}]|[^{_SPACE}{_L}{_N}]+"

# What a code point below _SAFE_END is to BYTE_RULE: letter 1, number 2, white space 3, other 0.
_KINDS = bytes(
    3 if re.match(f"[{_SPACE}]", chr(c)) else {"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 0) for c in range(_SAFE_END)
)


def byte_words(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Where the words of BYTE_RULE begin in texts of one byte per code point, which lie one after another from ``starts`` on.

    No text is empty.
    """
    points, kind = np.frombuffer(data, np.uint8), np.frombuffer(data.translate(_KINDS), np.uint8)
    space = kind == 3
    begin = np.empty(len(points), bool)
    begin[1:] = (kind[1:] != kind[:-1]) & (points[:-1] != 32)  # a blank goes with the word behind it
    last = space[:-1] & ~space[1:]  # of white space in front of a word, the last one stands alone or goes with it
    last[starts[1:] - 1] = False
    begin[:-1] |= last
    begin[starts] = True
    quotes = np.flatnonzero(points == 39)
    quotes = quotes[begin[quotes]]
    if len(quotes):
        limits = np.append(starts, len(points))[np.searchsorted(starts, quotes, side="right")]
        one, two = (np.where(quotes + i < limits, points.take(quotes + i, mode="clip"), 0) for i in (1, 2))
        short = np.isin(one, list(b"stmd"))
        long = np.isin(one.astype(np.int64) * 256 + two, [int.from_bytes(pair) for pair in (b"re", b"ve", b"ll")])
        begin[quotes[short | long] + 1] = False
        behind = quotes + 2 + long
        begin[behind[(short | long) & (behind < limits)]] = True
    return np.flatnonzero(begin)


class WordStore:
    """Ids of words that were met, and a look-up of many at once. Of ``cached`` words the half that was used least is dropped."""

    def __init__(self, cached: int = 300_000):
        self.cached = cached
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = defaultdict(count().__next__)  # a word that is asked for gets the next number
        self.begins, self.counts, self.uses = np.zeros(1024, np.int64), np.zeros(1024, np.int32), np.zeros(0, np.int64)
        self.store, self.stored = np.zeros(4096, np.uint32), 0

    def _drop(self) -> None:
        """Keeps the words that were used most, and counts their uses half from now on."""
        stay = np.sort(np.argsort(-self.uses, kind="stable")[: self.cached // 2])
        begins, counts, uses = self.begins[stay], self.counts[stay], self.uses[stay] // 2
        words = list(islice(self.known, int(stay[-1]) + 1 if len(stay) else 0))
        store = self.store[ranges(begins, counts)]
        self._forget()
        self.known = defaultdict(count(len(stay)).__next__, zip(map(words.__getitem__, stay.tolist()), range(len(stay))))
        self.begins, self.counts, self.uses = np.cumsum(counts, dtype=np.int64) - counts, counts, uses
        self.store, self.stored = store, len(store)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of new words one after another, and the number of ids of each."""
        raise NotImplementedError

    def _learn(self, words: list[str]) -> None:
        """Stores the ids of ``words``, which have the last numbers in this order."""
        flat, counts = self.encode_words(words)
        first = len(self.known) - len(words)
        if len(self.counts) < len(self.known):
            self.begins, self.counts = (np.resize(x, max(2 * len(x), len(self.known))) for x in (self.begins, self.counts))
        if len(self.store) < self.stored + len(flat):
            self.store = np.resize(self.store, max(2 * len(self.store), self.stored + len(flat)))
        self.counts[first : first + len(words)] = counts
        self.begins[first : first + len(words)] = self.stored + np.cumsum(counts) - counts
        self.store[self.stored : self.stored + len(flat)] = flat
        self.stored += len(flat)

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``words`` one after another, and the number of ids of each."""
        try:
            first = len(self.known)
            at = list(map(self.known.__getitem__, words))
            if len(self.known) > self.cached and first:
                self._drop()
                first = len(self.known)
                at = list(map(self.known.__getitem__, words))
            new = len(self.known) - first
            if new:
                self._learn(list(islice(reversed(self.known), new))[::-1])
        except BaseException:
            self._forget()  # numbers without ids must not stay for the next task of this worker
            raise
        at = np.array(at, np.int64)
        uses = np.bincount(at, minlength=len(self.known))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        lengths = self.counts[at].astype(np.int64)
        return self.store[ranges(self.begins[at], lengths)], lengths


# The characters that stand for bytes in the vocabularies; others follow from U+0100 on.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SIGNS = {byte: 0x100 + i for i, byte in enumerate(byte for byte in range(0x100) if byte not in set(_PLAIN))}
_BLANK = chr(_SIGNS[32])


def _signs(word: str) -> str:
    """The word's UTF-8 bytes as the characters that stand for them."""
    if word[0] == " " and word.isascii() and word[1:].isalnum():
        return _BLANK + word[1:]
    return word.encode().decode("latin-1").translate(_SIGNS)


class Encoder(WordStore):
    """Encodes lists of texts with one vocabulary file: ``byte_bpe_*.json`` or ``word_bpe_*.json``."""

    def __init__(self, file: str, cached: int = 300_000):
        super().__init__(cached)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(file)
        self.added = {token.content for token in self.whole.get_added_tokens_decoder().values()}
        self.merges = self.whole.model
        self.lower = self.whole.normalizer is not None
        self.split = re.compile(WORD_RULE).findall

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        merged = self.merges.tokenize
        ids = [[token.id for token in merged(word if word.isascii() and word.isalnum() else _signs(word))] for word in words]
        counts = np.fromiter(map(len, ids), np.int32, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum())), counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another (uint32) and the number of ids of each text (int64)."""
        odd = [i for i, text in enumerate(texts) if _odd(text) or any(token in text for token in self.added)]
        skipped = set(odd)
        plain = ["" if i in skipped else text for i, text in enumerate(texts)]
        ids, counts = self._rule_words(plain) if self.lower else self._byte_words(plain)
        if odd:
            whole = [np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, np.uint32) for i in odd]
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i, got in zip(odd, whole):
                parts[i], counts[i] = got, len(got)
            ids = np.concatenate(parts)
        return ids, counts

    def _rule_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [self.split(text.lower()) for text in texts]
        ids, lengths = self.look_up([word for text in words for word in text])
        per_text = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.concatenate(([0], np.cumsum(lengths)))
        text_ends = np.concatenate(([0], np.cumsum(per_text)))
        return ids, ends[text_ends[1:]] - ends[text_ends[:-1]]

    def _byte_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "".join(texts)
        data = joined.encode("latin-1")
        if not data:
            return np.zeros(0, np.uint32), sizes
        text_ends = np.cumsum(sizes)
        begins = byte_words(data, (text_ends - sizes)[sizes > 0])
        bounds = np.append(begins, len(data)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        offsets, values = words.dictionary.buffers()[1:]
        cuts = np.frombuffer(offsets, np.int64, len(words.dictionary) + 1).tolist()
        known = values.to_pybytes().decode("latin-1")
        distinct, distinct_counts = self.look_up([known[i:j] for i, j in zip(cuts, cuts[1:])])
        which = words.indices.to_numpy()
        lengths = distinct_counts[which]
        ids = distinct[ranges((np.cumsum(distinct_counts) - distinct_counts)[which], lengths)]
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.searchsorted(begins, text_ends)]
        return ids, np.diff(ends, prepend=0)

    def encode_ended(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same with ``end_id`` appended to each text."""
        ids, counts = self.encode(texts)
        return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1


def encoder(file: str, cached: int = 300_000) -> Encoder:
    """One encoder per worker process, file and number of known words; its words stay known from task to task."""
    if (Encoder, file, cached) not in worker_caches:
        tidy()
        worker_caches[Encoder, file, cached] = Encoder(file, cached)
    return worker_caches[Encoder, file, cached]
