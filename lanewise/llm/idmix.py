"""Context mixing of whole token ids and range coding, for groups of blocks that share a table.

Model, per block: the id last seen after the two ids before (order 2) and after the one
before (order 1), each in a table that starts empty. Order 0 is the table of the group:
how often each id occurs in its blocks, counted before they are coded and stored once. An
id's probability is the sum of the three: order 0's times its weight, plus the weights of
the predictions that name it. All weights of a step add up to ``PARTS``, so the total is a
power of two and an id takes one step of the range coder. The share of the id that each
prediction explained moves its weight, kept in every block for each combination of recent
success of both predictions.

Numpy codes many blocks side by side, one id of each at a time. Numbers are integers but
for one quotient of doubles, which IEEE 754 fixes, so every machine decodes what any other
encoded. With its table a block is decoded without the others of its group.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np

from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)

SCALE = 20  # order 0's frequencies add up to 2 ** SCALE at least
PARTS = 10  # weights of a step add up to 2 ** PARTS
FINE = 15  # bits of a weight as it is kept
RATE = 6  # a weight moves by 2 ** -RATE of its distance
SURE = np.float64(32512)  # a weight at most, of 2 ** FINE: order 0 always keeps a part
SLOTS = 11  # bits of a slot of a prediction table
HASH_ONE, HASH_TWO = 2654435769, 2246822519
SOME = 1 << 16  # ids counted at once
AHEAD = 16  # steps for which the encoder finds places at once
LEAST, WORD, STATE = 36, 24, 60  # bits: of a range between ids, of a word, of the first range

#: Success of a prediction: 0 there is none, 1 it is new or failed, up to 4 it held three times.
#: What is added to an entry (id * 8 + success) or, up to success 1, to the new id * 8; from 8 on if it held.
MOVE = np.array([1, 1, -1, -1, -2, 0, 0, 0, 1, 2, 1, 1, 0, 0, 0, 0], np.int32)
#: Weights of a prediction before anything is known, by its success.
START = np.array([0, 3000, 13000, 20000, 25000, 0, 0, 0])


def _weights() -> np.ndarray:
    """Order 2's and order 1's first weights by success of both and whether they name one id."""
    context = np.arange(128)
    two, one = START[context >> 4], START[context >> 1 & 7]
    same = context & 1 == 1
    # apart they leave order 0 a third of the rest at least
    high = np.where(same, np.maximum(two, two + one >> 1), np.where(one > 0, two * 2 // 3, two))
    low = np.where(same, 0, ((1 << FINE) - two) * one >> FINE)
    return (high << 16 | low).astype(np.int32)


FIRST = _weights()
#: Places of both predictions' success in a context, and of their weights in a number.
SIDES, HALVES, EIGHT = np.array([[2], [16]], np.int32), np.array([[0], [16]], np.int32), np.int32(8)


@dataclass
class Table:
    """Ids that occur in a group, ascending, and their frequencies; 2 ** ``bits`` together."""

    ids: np.ndarray
    frequencies: np.ndarray
    bits: int = field(init=False)

    def __post_init__(self) -> None:
        self.bits = int(self.frequencies.sum()).bit_length() - 1
        kind = self.kind = np.int32 if self.bits + PARTS < 31 else np.int64
        order = np.argsort(-self.frequencies, kind="stable")  # frequent ids lie close together
        self.symbols = self.ids[order].astype(np.uint32)
        self.own = self.frequencies[order].astype(kind)
        # one entry more: no prediction is the symbol after the last
        self.upto = np.append(np.cumsum(self.own), 1 << self.bits).astype(kind)
        self.below = self.upto[:-1] - self.own
        self.none = len(self.ids)

    @classmethod
    def of(cls, ids: np.ndarray) -> tuple[Table, np.ndarray]:
        """The table of some ids, and their symbols."""
        top = int(ids.max())
        # some ids at a time, so that wider copies of them stay in the cache
        parts = [slice(at, at + SOME) for at in range(0, len(ids), SOME)]
        if top < 1 << 20:
            counts = np.zeros(top + 1, np.int64)
            for part in parts:
                some = np.bincount(ids[part])
                counts[: len(some)] += some
            found = np.flatnonzero(counts)
            counts = counts[found]
        else:
            found, place, counts = np.unique(ids, return_inverse=True, return_counts=True)
        bits = max(SCALE, len(found).bit_length() + 1)
        frequencies = 1 + counts * ((1 << bits) - len(found)) // len(ids)
        frequencies[counts.argmax()] += (1 << bits) - frequencies.sum()
        rank = np.empty(len(found), np.int32)
        rank[np.argsort(-frequencies, kind="stable")] = np.arange(len(found))
        if top < 1 << 20:
            by_id = np.zeros(top + 1, np.int32)
            by_id[found] = rank
            symbols = np.empty(len(ids), np.int32)
            for part in parts:
                symbols[part] = by_id.take(ids[part])
            return cls(found, frequencies), symbols
        return cls(found, frequencies), rank.take(place)

    def pack(self) -> bytes:
        steps = np.diff(self.ids, prepend=0).astype("<u4")
        columns = np.stack([steps, self.frequencies.astype("<u4")]).view(np.uint8).reshape(2, -1, 4)
        # bytes of one weight together: most are zero
        return zlib.compress(columns.transpose(0, 2, 1).tobytes(), 6)

    @classmethod
    def unpack(cls, data: bytes) -> Table:
        columns = np.frombuffer(zlib.decompress(data), np.uint8).reshape(2, 4, -1).transpose(0, 2, 1)
        steps, frequencies = np.ascontiguousarray(columns).view("<u4")[:, :, 0].astype(np.int64)
        return cls(np.cumsum(steps), frequencies)

    def lookup(self) -> np.ndarray:
        """The symbol of each unit of frequency."""
        kind = np.uint16 if self.none < 1 << 16 else np.int32
        return np.repeat(np.arange(self.none, dtype=kind), self.own)


class Mixer:
    """Adaptive state of ``n`` blocks; orders 1 and 2 are rows 0 and 1.

    A table's entries for one context lie side by side for all blocks.
    """

    def __init__(self, n: int, table: Table):
        self.table, self.kind = table, table.kind
        self.shift = max(1, n - 1).bit_length()
        room = 1 << self.shift
        self.lane = np.arange(room)
        self.lanes = np.stack([self.lane, self.lane + (room << SLOTS)])
        self.seen = np.full(2 * room << SLOTS, table.none << 3, np.int32)
        self.weights = np.repeat(FIRST, room)
        self.mask = (1 << SLOTS) - 1 << self.shift
        self.down = 32 - SLOTS - self.shift
        if self.down < 0:
            raise ValueError("too many blocks side by side")

    def places(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Where both predictions of the next ids lie, by the symbols last coded and those before; a row a step."""
        steps, a = last.shape
        at = np.empty((steps, 2, a), np.int64)
        np.multiply(last, HASH_ONE, out=at[:, 0])
        np.multiply(before, HASH_TWO, out=at[:, 1])
        at[:, 1] += at[:, 0]
        at >>= self.down
        at &= self.mask
        at |= self.lanes[:, :a]
        return at

    def begin(self, at: np.ndarray) -> None:
        """Predictions for the next id of the first blocks, their masses, and order 0's part."""
        self.at = at
        entry = self.entry = self.seen.take(at)
        guess = self.guess = entry >> 3
        self.sure = entry & 7
        named = self.sure * SIDES
        context = named[0] + named[1]
        context += guess[0] == guess[1]
        spot = self.spot = context.astype(np.int64)
        spot <<= self.shift
        spot |= self.lane[: len(spot)]
        weight = self.weight = self.weights.take(spot) >> HALVES
        weight &= 0xFFFF
        mass = (weight >> FINE - PARTS).astype(self.kind, copy=False)
        self.part = (1 << PARTS) - mass[0]
        self.part -= mass[1]
        mass <<= self.table.bits
        self.mass = mass

    def spans(self, symbol: np.ndarray, below: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the mixture puts the symbols that order 0 has at ``below`` and ``own``: frequencies below, and own."""
        low = below * self.part
        more = self.mass * (self.guess < symbol)
        low += more[0]
        low += more[1]
        self.fits = self.guess == symbol
        held = self.held = self.mass * self.fits
        self.own = own * self.part
        self.own += held[0]
        self.own += held[1]
        return low, self.own

    def find(self, value: np.ndarray, lookup: np.ndarray) -> np.ndarray:
        """The symbols in whose spans the values lie."""
        guess, mass = self.guess, self.mass
        # back to order 0's own frequencies: a mass ends the span of its symbol
        past = value - self.table.upto.take(guess) * self.part
        past -= mass[::-1] * (guess[::-1] < guess)
        past += 1
        np.maximum(past, 0, out=past)
        np.minimum(past, mass, out=past)
        own = value - past[0]
        own -= past[1]
        return lookup.take(((own + 0.5) / self.part).astype(np.int64)).astype(np.int32)

    def learn(self, symbol: np.ndarray) -> None:
        """Moves weights by the share of the id each prediction explained, and remembers the id."""
        share = self.held / self.own
        share *= SURE
        move = share.astype(np.int32)
        weight = self.weight
        move -= weight
        move >>= RATE
        weight += move
        packed = weight[1] << 16
        packed |= weight[0]
        self.weights[self.spot] = packed
        # the new id where an entry is new or failed
        after = (symbol << 3) - self.entry
        after *= self.sure < 2
        after += self.entry
        success = self.fits * EIGHT
        success += self.sure
        after += MOVE.take(success)
        self.seen[self.at] = after


class Writer:
    """A range coder for each block; words may exceed their bits until the carries are settled."""

    def __init__(self, n: int, room: int, bits: int):
        self.bits = bits
        self.low, self.range = np.zeros(n, np.int64), np.full(n, (1 << STATE) - 1, np.int64)
        self.words, self.first = np.zeros((n, room), np.int32), np.arange(n) * room
        self.flat, self.at = self.words.reshape(-1), self.first.copy()

    def put(self, a: int, low: np.ndarray, own: np.ndarray) -> None:
        r = self.range[:a] >> self.bits
        self.low[:a] += r * low
        r *= own
        small = (r < 1 << LEAST).nonzero()[0]
        while len(small):
            self._emit(small)
            r[small] = wider = r.take(small) << WORD
            small = small[wider < 1 << LEAST]
        self.range[:a] = r

    def _emit(self, lanes: np.ndarray) -> None:
        low, at = self.low.take(lanes), self.at.take(lanes)
        self.flat[at] = low >> LEAST
        self.at[lanes] = at + 1
        self.low[lanes] = (low & (1 << LEAST) - 1) << WORD

    def close(self) -> list[bytes]:
        every = np.arange(len(self.low))
        for _ in range(3):
            self._emit(every)
        words = self.words[:, : int((self.at - self.first).max())]
        while (carry := words >> WORD).any():
            words &= (1 << WORD) - 1
            words[:, :-1] += carry[:, 1:]
        ends = self.at - self.first
        size = WORD // 8
        return [w[:n].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :size].tobytes() for w, n in zip(words, ends.tolist())]


class Reader:
    """The inverse of ``Writer``."""

    def __init__(self, coded: list[bytes], bits: int):
        size, n = WORD // 8, len(coded)
        self.bits = bits
        room = max(map(len, coded)) // size + 4
        parts = np.zeros((n, room, 4), np.uint8)
        for i, c in enumerate(coded):
            parts[i, : len(c) // size, :size] = np.frombuffer(c, np.uint8).reshape(-1, size)
        words = parts.view("<i4").reshape(n, room).astype(np.int32, copy=False)
        self.range = np.full(n, (1 << STATE) - 1, np.int64)
        first, second, third = (words[:, k].astype(np.int64) for k in range(3))
        # the state begins with two words and a part of the third; all later words are cut as it ends there
        rest = 2 * WORD - (STATE - WORD)
        self.code = first << STATE - WORD | second << STATE - 2 * WORD | third >> rest
        self.flat = (words & (1 << rest) - 1) << WORD - rest
        self.flat[:, :-1] |= words[:, 1:] >> rest
        self.flat, self.at = self.flat.reshape(-1), np.arange(n) * room + 2

    def value(self, a: int) -> np.ndarray:
        self.step = self.range[:a] >> self.bits
        code = self.code[:a]
        value = (code / self.step).astype(np.int64)
        # doubles are off by one at most, and seldom; what is below 0 is far above as an unsigned number
        left = code - value * self.step
        if (left.view(np.uint64) >= self.step.view(np.uint64)).any():
            value -= left < 0
            value += left >= self.step
        return value

    def take(self, a: int, low: np.ndarray, own: np.ndarray) -> None:
        code = self.code[:a] - self.step * low
        r = self.step * own
        small = (r < 1 << LEAST).nonzero()[0]
        while len(small):
            at = self.at.take(small)
            code[small] = code.take(small) << WORD | self.flat.take(at)
            self.at[small] = at + 1
            r[small] = wider = r.take(small) << WORD
            small = small[wider < 1 << LEAST]
        self.code[:a] = code
        self.range[:a] = r


def _steps(sizes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Blocks by descending size, and how many of them still have an id at each step."""
    order = np.argsort(-sizes, kind="stable")
    steps = np.arange(int(sizes.max()))
    return order, (len(sizes) - np.searchsorted(np.sort(sizes), steps, side="right")).tolist()


def encode(blocks: list[np.ndarray]) -> tuple[Table, list[bytes]]:
    """The table of a group of blocks of ids, and code words of each."""
    sizes = np.array([len(b) for b in blocks])
    order, actives = _steps(sizes)
    table, symbols = Table.of(np.concatenate([blocks[i] for i in order]))
    n, steps = len(blocks), len(actives)
    by_block = np.zeros((n, steps + 2), np.int32)  # two steps before the first
    at = 0
    for row, size in zip(by_block, sizes[order].tolist()):
        row[2 : size + 2] = symbols[at : at + size]
        at += size
    ids = np.ascontiguousarray(by_block.T)
    del by_block, symbols
    bits = table.bits + PARTS
    model, out = Mixer(n, table), Writer(n, steps * bits // WORD + 8, bits)
    for begin in range(0, steps, AHEAD):
        # all that depends on the ids alone is done for some steps at once
        now = ids[begin + 2 : begin + AHEAD + 2]
        wide = ids[begin : begin + len(now) + 1].astype(np.int64)
        places, below, own = model.places(wide[1:], wide[:-1]), table.below.take(now), table.own.take(now)
        for k, a in enumerate(actives[begin : begin + AHEAD]):
            model.begin(places[k, :, :a])
            out.put(a, *model.spans(now[k, :a], below[k, :a], own[k, :a]))
            model.learn(now[k, :a])
    back = [b""] * n
    for i, words in zip(order, out.close()):
        back[i] = words
    return table, back


def decode(table: Table, coded: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of blocks of the given sizes, coded with ``table``."""
    size = np.array(sizes)
    order, actives = _steps(size)
    n, steps = len(coded), len(actives)
    ids = np.zeros((steps, n), np.int32)
    lookup = table.lookup()
    model, code = Mixer(n, table), Reader([coded[i] for i in order], table.bits + PARTS)
    last = before = np.zeros((1, n), np.int64)
    for step, a in enumerate(actives):
        model.begin(model.places(last[:, :a], before[:, :a])[0])
        now = model.find(code.value(a).astype(table.kind), lookup)
        code.take(a, *model.spans(now, table.below.take(now), table.own.take(now)))
        model.learn(now)
        ids[step, :a] = now
        last, before = now.astype(np.int64)[None], last
    by_block = np.ascontiguousarray(ids.T)
    back: list[np.ndarray] = [np.empty(0, np.uint32)] * n
    for i, row in zip(order, by_block):
        back[i] = table.symbols.take(row[: size[i]])
    return back
