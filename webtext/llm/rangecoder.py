"""Adaptive context-mixing range coder for token ids, many blocks at a time.

A block is coded on its own: its model starts empty, and its ids have a checksum. For each id the
model makes a guess from what followed the last two ids and the last one earlier in the block
(orders 2 and 1). Three adaptive probabilities that the guess is right, by the confidence of either
order and by how often the guessed id occurred (order 0), are mixed with weights that learn. An id
that was not guessed is coded with the order-0 counts of the block so far, or, if they lack it, with
a fixed falling prior; how likely that is adapts too, by how the id before was coded.

The model learns in steps: it stands still while a segment of 16 to 128 ids is coded, and
then learns from all of them at once. So the writer works on whole segments with array operations,
and the reader, who needs every id for the next one's context, only looks up. The order-0 counts
are the sorted ids themselves, taken anew whenever their number has doubled, and later of the last
``_MOST`` ids: a place among them is an id, its first place and its count are its span. Blocks are independent, so that one step decodes
the next id of every block at hand.

All arithmetic is in integers, so a block decodes to the same ids whatever blocks it stands with.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np

from webtext.llm.rows import ranges

_LANES = 2048  # blocks that are worked on at once
_SEGMENT, _FIRST, _MOST = 64, 16, 512  # ids between two lessons (later twice as many); least and greatest number of ids in the order-0 counts
_RATE = 12  # bits by which the weights' steps are smaller than their gradients
_SLOTS = (9, 10)  # bits of the places for contexts of order 1 and 2
_HASH = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_HIST, _NEW, _HIT = 0, 1, 2  # how an id is coded: by the counts, by the prior, by the guess
_STATE, _HIGH = 56, np.uint64(40)
_LOW1, _LOW2 = np.uint64(1 << 40), np.uint64(1 << 24)  # below these widths, one or two words of 16 bits go out
_TWELVE, _FULL, _A, _WORD, _HIGH32, _MASK, _MASK22 = np.uint64(12), np.uint64(4096), np.uint64(24), np.uint64(16), np.uint64(32), np.uint64(0xFFFF), np.uint64((1 << 22) - 1)
_KEPT = np.array([(1 << 57) - 1, (1 << 40) - 1, (1 << 24) - 1], np.uint64)

# ln(p / (1 - p)) in steps of 1/256 for p in 1/4096, and back.
_HALF = 2048
_STRETCH = np.array([round(256 * math.log((p + 0.5) / (4095.5 - p))) for p in range(4096)], np.int32)
_SQUASH = np.array([min(4064, max(32, round(4096 / (1 + math.exp(-x / 256))))) for x in range(-_HALF, _HALF)], np.uint64)


@functools.lru_cache(4)
def _prior(vocabulary: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Bits of the total, begin and width of each id, and id << 44 | begin << 22 | width of each place."""
    if vocabulary > 1 << 20:
        raise ValueError("at most 2**20 different ids")
    bits = max(12, (vocabulary - 1).bit_length() + 2)
    falling = 150_000 // (np.arange(vocabulary, dtype=np.int64) + 300) + 1
    width = 1 + falling * ((1 << bits) - vocabulary) // int(falling.sum())
    width[0] += (1 << bits) - int(width.sum())
    begin = np.cumsum(width) - width
    return bits, begin.astype(np.uint32), width.astype(np.uint32), np.repeat((np.arange(vocabulary) << 44 | begin << 22 | width).astype(np.uint64), width)


def _either(chosen: np.ndarray, yes: np.ndarray, no: np.ndarray) -> np.ndarray:
    """``np.where`` for uint32 without branches: several times as fast where the choice is irregular."""
    mask = -chosen.astype(np.uint32)
    mask &= yes ^ no
    mask ^= no
    return mask


class Model:
    """State of ``lanes`` blocks; the first n of them are active in a segment."""

    def __init__(self, lanes: int, vocabulary: int):
        self.bits, self.begin, self.width, self.at = _prior(vocabulary)
        self.lane = np.arange(lanes, dtype=np.int64)
        self.tables = [np.zeros(lanes << bits, np.uint32) for bits in _SLOTS]  # id << 7 | confidence << 5 (order 1) or 3 (order 2) | level
        self.offsets = [(self.lane << bits).view(np.uint64) for bits in _SLOTS]
        self.hits = [np.zeros((size, lanes), np.int32) for size in (8, 8, 4)]
        self.seen = [np.zeros((size, lanes), np.int32) for size in (8, 8, 4)]
        self.weights = np.full((3, lanes), 26_000, np.int32)
        self.fresh, self.missed = np.zeros((3, lanes), np.int32), np.zeros((3, lanes), np.int32)
        self.escape = np.full(3 * lanes, 4096, np.uint64)  # by how the id before was coded, and lane
        self.total = self.spare = np.uint64(self.bits)
        self.history = 0  # ids in the order-0 counts of each block; so many bits are spare in a total of theirs
        self._mix()

    def _mix(self) -> None:
        """The chance, in 1/4096, that a guess is right in each of 128 contexts: k1, k2, whether the guesses differ, level."""
        self.inputs = [_STRETCH[(10 * h + 4) * 4096 // (10 * s + 20)] for h, s in zip(self.hits, self.seen)]
        one, two, none = (i * w for i, w in zip(self.inputs, self.weights))
        n = len(self.lane)
        dot = one.reshape(4, 1, 2, 1, n) + two.reshape(1, 4, 2, 1, n) + none.reshape(1, 1, 1, 4, n)
        dot >>= 16
        dot += _HALF
        self.chances = _SQUASH.take(dot.reshape(-1), mode="clip")

    def places(self, last: np.ndarray, before: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the contexts; ids are uint64, along the last axis stand the lanes."""
        hashed = last * _HASH[0]
        one = (hashed >> np.uint64(64 - _SLOTS[0])) + self.offsets[0][:n]
        hashed += before * _HASH[1]
        return one.view(np.int64), ((hashed >> np.uint64(64 - _SLOTS[1])) + self.offsets[1][:n]).view(np.int64)

    def guess(self, at1: np.ndarray, at2: np.ndarray, n: int, either: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Entries of both orders, the chosen one, and the context (of 128 for each lane) of its chance."""
        one, two = self.tables[0].take(at1, mode="clip"), self.tables[1].take(at2, mode="clip")
        k1, k2 = one & 96, two & 24
        chosen = either(k2 << 2 >= k1, two, one)
        k1 += k2
        differ = np.minimum((one ^ two) >> 7, 1)
        differ <<= 2
        k1 += differ
        k1 += chosen & 3
        context = k1.astype(np.int64)
        context *= n
        context += self.lane
        return one, two, chosen, context

    def count(self, data: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Takes the order-0 counts of ``data`` (ids by lane): the sorted ids, and first place * 65536 + count of each."""
        size = data.shape[1]
        ids = np.sort(data, axis=1)
        change = np.ones((n, size), bool)
        np.not_equal(ids[:, 1:], ids[:, :-1], out=change[:, 1:])
        begins = np.flatnonzero(change)
        counts = np.diff(begins, append=n * size)
        self.history, self.spare = size, self.total - np.uint64(size.bit_length() - 1)
        self._escape()
        return ids, np.repeat((((begins & (size - 1)) << 16) + counts).astype(np.uint32), counts).reshape(n, size)

    def level(self, count: np.ndarray) -> np.ndarray:
        """How often an id with this count occurs: 0 (not at all) to 3."""
        high = max(2, self.history >> 6), max(3, self.history >> 4)
        return ((count > 0).view(np.uint8) + (count >= high[0]).view(np.uint8) + (count >= high[1]).view(np.uint8)).astype(np.uint32)

    def learn(self, n: int, ids: np.ndarray, at: tuple, entries: tuple, context: np.ndarray, kind: np.ndarray, kind_before: np.ndarray, count: np.ndarray) -> None:
        """Learns from a segment: arrays of ids in turn by lanes."""
        one, two, chosen = entries
        hit = kind == _HIT
        told = (ids << 7) | _either(hit, chosen & 3, self.level(_either(kind == _HIST, count, np.uint32(0))))
        for table, places, was, bit in ((self.tables[0], at[0], one, 5), (self.tables[1], at[1], two, 3)):
            once, k = np.uint32(1 << bit), was & (3 << bit)
            same = ((was ^ told) < 128) & (k > 0)
            entry = _either(same, told + np.minimum(k + once, 3 * once), _either(k > once, was - once, told + once))
            table[places.reshape(-1)] = entry.reshape(-1)  # of equal places the last one stays
        both = np.bincount((context + hit * np.int64(n << 7)).reshape(-1), minlength=n << 8).reshape(2, -1)
        right, seen = both[1], both[0] + both[1]
        error = (right << 12) - seen * self.chances.view(np.int64)
        shape, axes = (4, 4, 2, 4, n), ((1, 3), (0, 3), (0, 1, 2))
        for i, axis in enumerate(axes):
            lost, *more = (x.reshape(shape).sum(axis=axis).reshape(-1, n) for x in (error, right, seen))
            self.weights[i] = np.clip(self.weights[i] + ((lost * self.inputs[i]).sum(axis=0) >> _RATE), -300_000, 300_000)
            held = self.hits[i], self.seen[i]
            for old, new in zip(held, more):
                old += new.astype(np.int32)
            full = held[1] > 512
            for old in held:
                old >>= full
        self._mix()
        group = np.int64(3 * n) * kind + np.int64(n) * kind_before + self.lane
        kinds = np.bincount(group.reshape(-1), minlength=9 * n).reshape(3, 3, n).astype(np.int32) << 6
        for old, new in ((self.fresh, kinds[_NEW]), (self.missed, kinds[_NEW] + kinds[_HIST])):
            old -= old >> 2
            old += new
        self._escape()

    def keep(self, n: int) -> None:
        """Only the first n lanes go on."""
        if n < len(self.lane):
            self.lane, self.weights = self.lane[:n], self.weights[:, :n]
            self.hits, self.seen = [h[:, :n] for h in self.hits], [s[:, :n] for s in self.seen]
            self.fresh, self.missed = self.fresh[:, :n], self.missed[:, :n]
            self._mix()
            self._escape()

    def _escape(self) -> None:
        """The chance, in 1/4096, that an id that was not guessed is none of the order-0 counts."""
        if not self.history:
            self.escape = np.full(3 * len(self.lane), 4096, np.uint64)
        else:
            self.escape = np.clip((self.fresh + 32) * 4096 // (self.missed + 64), 32, 4064).astype(np.uint64).reshape(-1)


def _segments(longest: int) -> Iterator[tuple[int, int]]:
    begin = 0
    while begin < longest:
        end = min(longest, 2 * begin if begin else _FIRST, begin + (_SEGMENT if begin < 1024 else 2 * _SEGMENT))
        yield begin, end
        begin = end


def _counted(begin: int) -> int:
    """How many ids the order-0 counts that are taken at this place hold, and hold good for; 0 if none are taken."""
    if begin >= _MOST:
        return 0 if begin % _MOST else _MOST
    return begin if begin >= _FIRST and begin & (begin - 1) == 0 else 0


def _spans(chance: np.ndarray, escape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the spans of guess and prior in 1/2**24; the rest goes to the order-0 counts."""
    guessed = chance << _TWELVE
    prior = _FULL - chance
    prior *= escape
    prior += guessed
    return guessed, prior


def _groups(sizes: np.ndarray, most: int) -> list[np.ndarray]:
    """Numbers of the blocks in order of falling size, at most ``most`` together."""
    order = np.argsort(-sizes, kind="stable")
    return np.array_split(order, -(-len(order) // most))


def _active(sizes: np.ndarray) -> list[int]:
    """How many blocks have an id at each place; sizes fall."""
    return np.searchsorted(-sizes, -np.arange(int(sizes.max())), side="left").tolist()


def encode(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """The code of each block of ids below ``vocabulary``; no block is empty."""
    result: list[bytes] = [b""] * len(blocks)
    for group in _groups(np.array([len(block) for block in blocks], np.int64), _LANES):
        for i, code in zip(group.tolist(), _encode([blocks[i] for i in group.tolist()], vocabulary)):
            result[i] = code
    return result


def _encode(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    sizes = np.array([len(block) for block in blocks], np.int64)
    longest, lanes = int(sizes.max()), len(blocks)
    by_lane = np.zeros((lanes, longest), np.uint32)
    for lane, block in enumerate(blocks):
        by_lane[lane, : len(block)] = block
    data = np.zeros((longest + 2, lanes), np.uint32)
    data[2:] = by_lane.T  # two ids 0 stand before the first
    model = Model(lanes, vocabulary)
    held = np.zeros(vocabulary, np.uint32)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, (1 << _STATE) - 1, np.uint64)
    put: list[tuple[np.ndarray, np.ndarray]] = []
    active = _active(sizes)
    found, known = np.zeros((0, lanes), np.uint32), 0
    kind_last = np.zeros(lanes, np.uint8)
    for begin, end in _segments(longest):
        n = active[begin]
        model.keep(n)
        if history := _counted(begin):
            sorted_ids, spans = model.count(by_lane[:n, begin - history : begin], n)
            rows = by_lane[:n, begin : begin + history]
            looked = np.empty(rows.shape, np.uint32)
            for lane in range(n):
                own = sorted_ids[lane]
                held[own] = spans[lane]
                held.take(rows[lane], out=looked[lane], mode="clip")
                held[own] = 0
            found, known = np.ascontiguousarray(looked.T), begin
        ids = data[begin + 2 : end + 2, :n]
        at = model.places(data[begin + 1 : end + 1, :n].astype(np.uint64), data[begin:end, :n], n)
        one, two, chosen, context = model.guess(*at, n, _either)
        span = found[begin - known : end - known, :n] if model.history else np.zeros(ids.shape, np.uint32)
        count = span & 0xFFFF
        hit, new = (chosen >> 7) == ids, count == 0
        kind = np.maximum(new.view(np.uint8), hit.view(np.uint8) << 1)
        kind_before = np.concatenate((kind_last[None, :n], kind[:-1]))
        guessed, prior = (x.astype(np.uint32) for x in _spans(model.chances.take(context), model.escape.take(np.int64(n) * kind_before + model.lane)))
        nothing = np.uint32(0)
        start = _either(hit, nothing, _either(new, guessed, prior))
        size = _either(hit | new, _either(hit, guessed, prior), np.uint32(1 << 24)) - start
        inner = _either(hit, nothing, span >> 16) << np.uint32(model.spare)
        part = _either(hit, np.uint32(model.history or 1), count) << np.uint32(model.spare)
        is_new = np.flatnonzero(kind == _NEW)
        asked = ids.reshape(-1).take(is_new)
        inner.reshape(-1)[is_new], part.reshape(-1)[is_new] = model.begin.take(asked), model.width.take(asked)
        start, size, inner, part = (x.astype(np.uint64) for x in (start, size, inner, part))
        tops, taken = np.zeros((end - begin, n), np.uint64), np.zeros((end - begin, n), np.uint8)
        for t in range(end - begin):
            m = active[begin + t]
            lo, wi = low[:m], width[:m]
            unit = wi >> _A
            lo += unit * start[t, :m]
            unit *= size[t, :m]
            unit >>= model.total
            lo += unit * inner[t, :m]
            np.multiply(unit, part[t, :m], out=wi)
            words = np.add((wi < _LOW1).view(np.uint8), (wi < _LOW2).view(np.uint8), out=taken[t, :m])
            np.right_shift(lo, _A, out=tops[t, :m])
            lo &= _KEPT.take(words, mode="clip")
            moved = words << 4
            lo <<= moved
            wi <<= moved
        # Of each step none, one or both of its words go out; with a carry the first one has 17 bits.
        words = np.stack((tops.T >> _WORD, tops.T & _MASK), axis=2).astype(np.uint32)
        which = np.stack((taken.T > 0, taken.T > 1), axis=2)
        many = taken.sum(axis=0, dtype=np.int64)
        put.append((words[which], many))
        model.learn(n, ids, at, (one, two, chosen), context, kind, kind_before, count)
        kind_last = kind[-1]
    sums = np.zeros(lanes, np.int64)
    for _, many in put:
        sums[: len(many)] += many
    filled = np.cumsum(sums) - sums
    out = np.empty(int(sums.sum()), np.uint32)
    for flat, many in put:
        out[ranges(filled[: len(many)], many)] = flat
        filled[: len(many)] += many
    return [_bytes(row, *state) for row, *state in zip(np.split(out, np.cumsum(sums)[:-1]), low.tolist(), width.tolist())]


def _bytes(words: np.ndarray, low: int, width: int) -> bytes:
    """The words with their carries, and of the numbers that may follow the one with the most zeros at its end."""
    last = low + width - 1
    tail = next((last >> shift << shift for shift in range(48, 0, -8) if last >> shift << shift >= low), last)
    whole = int.from_bytes((words & 0xFFFF).astype(">u2").tobytes(), "big") + (int.from_bytes((words >> 16).astype(">u2").tobytes(), "big") << 16)
    return ((whole << _STATE) + tail).to_bytes(2 * len(words) + 7, "big").rstrip(b"\x00")


def decode(codes: list[bytes], sizes: np.ndarray, vocabulary: int) -> list[np.ndarray]:
    """The ids of each block."""
    sizes = np.asarray(sizes, np.int64)
    result: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(codes)
    for group in _groups(sizes, _LANES):
        data = _decode([codes[i] for i in group.tolist()], sizes[group], vocabulary)
        for lane, i in enumerate(group.tolist()):
            result[i] = data[lane, : sizes[i]].copy()
    return result


def _decode(codes: list[bytes], sizes: np.ndarray, vocabulary: int) -> np.ndarray:
    longest, lanes = int(sizes.max()), len(codes)
    room = 7 + 2 * max(4, (max(map(len, codes)) >> 1) + 2)
    raw = np.frombuffer(b"".join(code.ljust(room, b"\x00") for code in codes), np.uint8).reshape(lanes, room)
    value = np.zeros(lanes, np.uint64)
    for byte in range(7):
        value = (value << np.uint64(8)) | raw[:, byte]
    words = np.ascontiguousarray(raw[:, 7:]).view(">u2").astype(np.uint32)
    words[:, :-1] = (words[:, :-1] << 16) | words[:, 1:]  # each word with the next one behind it
    room, words = words.shape[1], words.reshape(-1)
    read = np.arange(lanes, dtype=np.int64) * room
    model = Model(lanes, vocabulary)
    width = np.full(lanes, (1 << _STATE) - 1, np.uint64)
    active, data = _active(sizes), np.zeros((longest, lanes), np.uint32)
    last, before = np.zeros(lanes, np.uint64), np.zeros(lanes, np.uint64)
    spans = np.zeros(0, np.uint64)
    kind_before, top, all_of, whole = np.zeros(lanes, np.uint8), np.uint64((1 << model.bits) - 1), np.uint64(1 << model.bits), np.uint64(1 << 24)
    for begin, end in _segments(longest):
        n = active[begin]
        model.keep(n)
        if history := _counted(begin):
            sorted_ids, spans = model.count(data[begin - history : begin, :n].T, n)
            spans = ((sorted_ids.astype(np.uint64) << np.uint64(32)) | spans).reshape(-1)
        value, width, read, kind_before, last, before = (x[:n] for x in (value, width, read, kind_before, last, before))
        lane, history, wide = model.lane, model.history, np.int64(n)
        base, limit = lane * history, np.uint64(max(history - 1, 0))
        kept, spare = [], model.spare
        for t in range(begin, end):
            at1, at2 = model.places(last, before, n)
            one, two, chosen, context = model.guess(at1, at2, n, np.where)
            guessed, prior = _spans(model.chances.take(context, mode="clip"), model.escape.take(wide * kind_before + lane, mode="clip"))
            unit = width >> _A
            hit = value < unit * guessed
            new = value < unit * prior  # hits too
            if not history:
                new[:] = True  # in a damaged code the value may lie behind the last span
            kind = new.view(np.uint8) + hit.view(np.uint8)
            start = np.where(new, guessed, prior)
            size = np.where(new, prior, whole)
            size -= start
            hits, fresh = np.flatnonzero(hit), np.flatnonzero(kind == _NEW)
            start[hits], size[hits] = 0, guessed.take(hits)
            start *= unit
            value = value - start
            unit *= size
            unit >>= model.total
            place = value // unit
            if history:
                span = spans.take(np.minimum(place >> spare, limit).view(np.int64) + base, mode="clip")
                ids = span >> _HIGH32
                inner, part = (span >> _WORD) & _MASK, span & _MASK
                count = part.astype(np.uint32)
                inner <<= spare
                part <<= spare
            else:
                ids, inner, part, count = (np.zeros(n, kind_of) for kind_of in (np.uint64, np.uint64, np.uint64, np.uint32))
            if len(fresh):
                named = model.at.take(np.minimum(place.take(fresh), top).view(np.int64))
                ids[fresh], inner[fresh], part[fresh] = named >> np.uint64(44), (named >> np.uint64(22)) & _MASK22, named & _MASK22
            ids[hits], inner[hits], part[hits] = chosen.take(hits) >> 7, 0, all_of
            value -= unit * inner
            width = unit * part
            taken = ((width < _LOW1).view(np.uint8) + (width < _LOW2).view(np.uint8)).astype(np.int64)
            coming = words.take(read, mode="clip").astype(np.uint64)
            read = read + taken
            taken <<= 4
            moved = taken.view(np.uint64)
            width <<= moved
            value <<= moved
            coming >>= _HIGH32 - moved
            value |= coming
            data[t, :n] = ids
            last, before = ids, last
            kept.append((at1, at2, one, two, chosen, context, kind, kind_before, count))
            kind_before = kind
        at1, at2, one, two, chosen, context, kind, kinds_before, count = (np.stack(x) for x in zip(*kept))
        model.learn(n, data[begin:end, :n], (at1, at2), (one, two, chosen), context, kind, kinds_before, count)
    return np.ascontiguousarray(data.T)
