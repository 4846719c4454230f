"""Language of texts and of the spans within them.

The script of a word narrows the candidate languages to those seen with that script. Each word gets
a score per candidate, the log-likelihood of its character trigrams, and Viterbi with a penalty for
every switch of language labels the words of a text, so a mixed text falls into spans. The
prediction is the language of the most letters, its score their share of all letters.

The model is counted on about ``docs_per_language`` documents per language, picked by hash; it has
at most ``2**BITS`` numbers per language. Every text is labelled whole.

Defined results: null text and text without a letter are ``und`` with score 0; letters in a script
that no learnt language uses get the language around them but do not raise the score; ties go to the
language that sorts first; rows with a null language teach nothing; equal rows are predicted each;
with nothing learnt every text is ``und``.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.llm.rows import emptied, kept, slices, texts_of
from webtext.llm.words import Numbered, mix

BITS = 16
# Python's word characters hold numbers beyond decimal digits (½, ², Ⅷ), which are no letters.
_WORDS = re.compile(r"[^\W\d_]+")
_NUMBERS = "".join(re.escape(chr(c)) for c in range(0x110000) if chr(c).isnumeric() and unicodedata.category(chr(c))[0] != "L")
LETTERS = re.compile(rf"[^\W\d_{_NUMBERS}]+")


def letter_words(text: str) -> list[str]:
    """Runs of letters. The exact pattern is slow, so it is for the few texts in which the plain one finds a number."""
    words = _WORDS.findall(text)
    return words if "".join(words).isalpha() else LETTERS.findall(text)


# First code points of runs of one script (0: Latin and other, as Unicode blocks lie).
SCRIPT_STARTS = np.array([0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0xE00, 0xE80, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x3100, 0x3400, 0xAC00, 0xD800])
SCRIPT_NAMES = ["latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "other-a", "indic", "thai", "other-b", "georgian", "hangul-a", "other-c", "latin-b", "greek-b", "other-d", "kana", "other-e", "han", "hangul", "other-f"]
_SAME = {"latin-b": "latin", "greek-b": "greek", "hangul-a": "hangul"}
_SCRIPT_OF = np.array([SCRIPT_NAMES.index(_SAME.get(name, name)) for name in SCRIPT_NAMES])


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets of all words one after another, where each word's begin, and each word's script."""
    text = "".join(f"\x02{word}\x03" for word in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.cumsum(sizes + 2) - sizes - 2
    first = codes[begins + 1]
    scripts = _SCRIPT_OF[np.searchsorted(SCRIPT_STARTS, first, side="right") - 1]
    packed = (codes[:-2] << np.uint64(42)) + (codes[1:-1] << np.uint64(21)) + codes[2:]
    keep = np.ones(len(codes), bool)
    keep[begins + sizes + 1] = False  # a trigram may not begin at a word's last two places
    keep[begins + sizes] = False
    return (mix(packed[keep[:-2]]) >> np.uint64(64 - BITS)).astype(np.int64), np.cumsum(sizes) - sizes, scripts


@dataclass(frozen=True)
class Model:
    languages: list[str]
    logs: np.ndarray  # (2**BITS, languages)
    scripts: np.ndarray  # (scripts, languages) bool
    penalty: float = 8.0

    def predict(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """``(doc_id, lang_pred, score)``."""
        schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
        model = docs.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            labeller = Labeller(model.value)
            for part in slices(batches, "text"):
                names, scores = labeller.predict(texts_of(part))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], schema=schema)

        chosen = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        return chosen.mapInArrow(run, "doc_id bigint, lang_pred string, score double")

    def certain(self, docs: DataFrame, least: float, text: str = "text", into: str | None = None) -> DataFrame:
        """The rows of ``docs`` in which words labelled with any language hold at least the share ``least`` of the letters.

        A text without letters goes; an even mix of known languages stays. A null counts as a text without letters.
        The text column ``into`` of ``docs``, if named, gets the predicted language.
        """
        model = docs.sparkSession.sparkContext.broadcast(self)

        def judge():
            labeller = Labeller(model.value)

            def decide(texts: list[str]):
                per, total = labeller.letters(texts)
                found = (total > 0) & (per.sum(axis=1) >= least * total)
                return found if into is None else (found, labeller.named(per, total)[0])

            return decide

        return kept(docs, text, judge, into)

    def spans(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """``(doc_id, start, end, lang)``: runs of words of one language, in code points, end exclusive."""
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
        model = docs.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            labeller = Labeller(model.value)
            for part in slices(batches, "text"):
                rows = []
                texts = texts_of(part)
                for doc_id, found in zip(part.column("doc_id").to_pylist(), labeller.spans(texts)):
                    rows += [(doc_id, *span) for span in found]
                columns = zip(*rows) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        chosen = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        return chosen.mapInArrow(run, "doc_id bigint, start bigint, end bigint, lang string")


class Labeller:
    """Labels words within a task; knows the scores of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.numbered = Numbered(max(10_000, 600_000 // max(1, len(model.languages))))
        self._forget()

    def _forget(self) -> None:
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)
        self.certain = np.zeros(0, bool)

    def _word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at, new, forgot = self.numbered.number(words)
        if forgot:
            self._forget()
        if new:
            buckets, begins, scripts = grams(new)
            scores = np.add.reduceat(self.model.logs[buckets], begins, axis=0)
            allowed = self.model.scripts[scripts]
            known = allowed.any(axis=1)
            scores = np.where(known[:, None], np.where(allowed, scores, scores - 1000.0), 0.0)
            self.scores = np.concatenate((self.scores, scores.astype(np.float32)))
            self.certain = np.concatenate((self.certain, known))
        return self.scores[at], self.certain[at]

    def label(self, words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language number of each word, and whether its script is known; ``counts`` words belong to each text."""
        scores, certain = self._word_scores(words)
        return viterbi(scores, counts, self.model.penalty), certain

    def letters(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters of each text in words of known scripts by language, and all its letters."""
        words = [letter_words(text.lower()) for text in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        k = len(self.model.languages)
        flat = [word for text in words for word in text]
        letters = np.fromiter(map(len, flat), np.int64, len(flat))
        doc = np.repeat(np.arange(len(texts)), counts)
        total = np.bincount(doc, letters, len(texts))
        if not k or not len(flat):
            return np.zeros((len(texts), k)), total
        labels, certain = self.label(flat, counts)
        return np.bincount(doc * k + labels, letters * certain, len(texts) * k).reshape(-1, k), total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        return self.named(*self.letters(texts))

    def named(self, per: np.ndarray, total: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of the most letters and its share, from the letters by language and all letters of each text."""
        if not per.size:
            return ["und"] * len(total), np.zeros(len(total))
        best = per.argmax(axis=1)
        scores = per[np.arange(len(total)), best] / np.maximum(total, 1)
        return [self.model.languages[b] if n else "und" for b, n in zip(best, total)], scores

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        found = [[(m.start(), m.end(), m.group().lower()) for m in LETTERS.finditer(text)] for text in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        if not len(self.model.languages) or not counts.sum():
            return [[] for _ in texts]
        labels, _ = self.label([word for text in found for _, _, word in text], counts)
        result, at = [], 0
        for text in found:
            spans: list[tuple[int, int, str]] = []
            for begin, end, _ in text:
                lang = self.model.languages[labels[at]]
                at += 1
                if spans and spans[-1][2] == lang:
                    spans[-1] = (spans[-1][0], end, lang)
                else:
                    spans.append((begin, end, lang))
            result.append(spans)
        return result


#: Words of a sequence that are stepped through at once.
_BLOCK = 64


class _Steps:
    """Forward steps of many sequences of rows of ``scores`` together; the longest come first."""

    def __init__(self, scores: np.ndarray, begins: np.ndarray, sizes: np.ndarray, penalty: float):
        self.order = np.argsort(-sizes, kind="stable")
        self.scores, self.begins, self.penalty = scores, begins[self.order], penalty
        longest = int(sizes.max()) if len(sizes) else 0
        self.active = np.searchsorted(-sizes[self.order], -np.arange(1, longest + 1), side="right")  # sequences with a row t

    def forward(self, start: np.ndarray, kept: list | None = None) -> np.ndarray:
        """Best values at each sequence's end for ``start`` values before its first row; ``kept`` takes what the way back needs."""
        path = (start[self.order] + self.scores[self.begins]).astype(np.float64)
        for t in range(1, len(self.active)):
            n = self.active[t]
            own = path[:n]
            source = own.argmax(axis=1)
            jump = own[np.arange(n), source] - self.penalty
            switch = jump[:, None] > own
            path[:n] = np.where(switch, jump[:, None], own) + self.scores[self.begins[:n] + t]
            if kept is not None:
                kept.append((switch, source))
        result = np.empty_like(path)
        result[self.order] = path
        return result

    def back(self, end: np.ndarray, kept: list, labels: np.ndarray) -> None:
        """Writes the labels of the sequences that end with the labels ``end``."""
        state = end[self.order]
        for t in range(len(self.active) - 1, -1, -1):
            n = self.active[t]
            labels[self.begins[:n] + t] = state[:n]
            if t:
                switch, source = kept[t - 1]
                state[:n] = np.where(switch[np.arange(n), state[:n]], source, state[:n])


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each row of ``scores`` for sequences of ``counts`` rows.

    Sequences are cut into blocks, and all blocks step together: the first of a sequence once, any other for every label
    before it. Then sequences step from block to block, which settles the label before each block, and blocks are labelled.
    """
    k = scores.shape[1]
    labels = np.zeros(len(scores), np.int64)
    counts = counts[counts > 0]
    if not len(counts):
        return labels
    blocks = -(-counts // _BLOCK)
    of = np.repeat(np.arange(len(counts)), blocks)
    number = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begins = (np.cumsum(counts) - counts)[of] + number * _BLOCK
    sizes = np.minimum(counts[of] - number * _BLOCK, _BLOCK)
    enter = np.where(np.eye(k, dtype=bool), 0.0, -penalty)
    first, later = np.flatnonzero(number == 0), np.flatnonzero(number)
    value = _Steps(scores, begins[first], sizes[first], penalty).forward(np.zeros((len(first), k)))
    entered, left = np.zeros(len(of), np.int64), np.zeros(len(of), np.int64)
    if len(later):
        many = _Steps(scores, np.repeat(begins[later], k), np.repeat(sizes[later], k), penalty)
        across = np.zeros((len(of), k, k))
        across[later] = many.forward(np.tile(enter, (len(later), 1))).reshape(-1, k, k)
        order = np.argsort(-blocks, kind="stable")
        begin, active = first[order], np.searchsorted(-blocks[order], -np.arange(1, blocks.max() + 1), side="right")
        value, came = value[order], []
        for b in range(1, len(active)):
            n = active[b]
            sums = value[:n, :, None] + across[begin[:n] + b]
            came.append(sums.argmax(axis=1))
            value[:n] = sums.max(axis=1)
        state = value.argmax(axis=1)
        for b in range(len(active) - 1, -1, -1):
            n = active[b]
            left[begin[:n] + b] = state[:n]
            if b:
                state[:n] = came[b - 1][np.arange(n), state[:n]]
                entered[begin[:n] + b] = state[:n]
    else:
        left[first] = value.argmax(axis=1)
    start = enter[entered]
    start[first] = 0.0
    steps, kept = _Steps(scores, begins, sizes, penalty), []
    steps.forward(start, kept)
    steps.back(left, kept, labels)
    return labels


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", docs_per_language: int = 2_000, penalty: float = 8.0) -> Model:
    """Counts trigrams and scripts of the languages of ``docs``."""
    usable = docs.filter(F.col(lang).isNotNull()).select(
        F.xxhash64(F.col(key), F.lit(41)).alias("place"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    sizes = {row[0]: row[1] for row in usable.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros((len(SCRIPT_NAMES), 0), bool), penalty)
    languages = sorted(sizes)
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, min(1.0, docs_per_language / n)).otherwise(share)
    picked = usable.filter(F.pmod("place", F.lit(1_000_003)) < share * 1_000_003).select("text", "lang")
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emptied()
        per: dict[str, np.ndarray] = defaultdict(lambda: np.zeros((1 << BITS) + len(SCRIPT_NAMES), np.int64))
        for part in slices(batches, "text"):
            words: dict[str, list[str]] = defaultdict(list)
            for value, name in zip(texts_of(part), part.column("lang").to_pylist()):
                words[name] += letter_words(value.lower())
            for name, own in words.items():
                if own:
                    buckets, _, scripts = grams(own)
                    per[name] += np.concatenate((np.bincount(buckets, minlength=1 << BITS), np.bincount(scripts, minlength=len(SCRIPT_NAMES))))
        for name, counts in per.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], schema=schema)

    counted = picked.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(((1 << BITS) + len(SCRIPT_NAMES), len(languages)))
    rows = counted.toPandas()  # at most 2**BITS numbers per language
    place = {name: i for i, name in enumerate(languages)}
    counts[rows["bucket"].to_numpy(), rows["lang"].map(place).to_numpy(dtype=int)] = rows["n"].to_numpy()
    seen, scripts = counts[: 1 << BITS], counts[1 << BITS :]
    logs = np.log((seen + 0.1) / (seen.sum(axis=0) + 0.1 * (1 << BITS)))
    return Model(languages, logs, scripts > 0.01 * np.maximum(1, scripts.sum(axis=0)), penalty)
