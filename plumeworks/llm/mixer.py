"""Kernel of the bit-wise language model: code of the symbols, hashed contexts, counts, and mixing.

A text is its bytes and an end symbol, each coded by a prefix code made from the symbols' counts behind the byte before; every bit of
a code word is predicted on its own. A predictor looks up, in its hashed table, how often the bit was 1 in the same context: the two, four or six
bytes before, with the node of the code tree reached. The predictions, as log odds, are summed with weights
chosen by the depth in the tree (the gate), learned online along the gradient of the coding cost. Within a text each gate's sum is
refined by a gain, which starts at 1 and moves along the same gradient after each stretch of ``CHUNK`` symbols, anew every ``LANE``
symbols. Bits of many lanes are handled side by side, and no bit is predicted by anything that follows it.
"""

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np

END = 256
ORDERS = (2, 4, 6)
INPUTS = len(ORDERS)
#: Slots per table (a power of two) and slots per packed row.
SLOT_BITS, RANGE_BITS = 22, 12
SLOTS, RANGE = 1 << SLOT_BITS, 1 << RANGE_BITS
CHUNK, LANE = 512, 4096
#: Symbols scored and counted at once, and the longest piece of a text: behind a cut the bytes before are known.
BATCH, COUNT_BATCH, PIECE = 1 << 18, 1 << 16, 1 << 17
#: Pairs of context and symbol that are sorted at once.
SORTED = 1 << 21
RATE, LEARN_RATE = 0.002, 0.02
#: A table entry is the log odds in sixteenths, as a signed byte.
SCALE, PRIOR = 16, 0.4
_HISTORY, _SYMBOL_BITS, _RANK_BITS = 8, 17, 10
_U = np.uint64
_MULTIPLIERS = [_U(0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64)) for k in range(INPUTS)]


class Code:
    """Prefix codes of the 257 symbols, one for each byte before, from counts (byte before, symbol).

    ``length`` is by (byte before, symbol), flat; ``steps`` is this by depth: twice the node, and the bit, or -1 behind the end of the code word.
    """

    def __init__(self, counts):
        codes = [self._steps(row) for row in counts]
        self.length = np.array([len(x) for steps in codes for x in steps], np.int8)
        #: The most frequent pairs of byte and symbol, and the place of every pair among all.
        self.frequent = np.argsort(-np.ravel(counts), kind="stable")
        self.rank = np.empty(len(self.frequent), np.int64)
        self.rank[self.frequent] = np.arange(len(self.frequent))
        self.frequent = self.frequent[: 1 << _RANK_BITS]
        self.depth, self.least = int(self.length.max()), int(self.length.min())
        self.steps = np.full((self.depth, len(self.length)), -1, np.int16)
        for at, path in enumerate(x for steps in codes for x in steps):
            for d, (node, bit) in enumerate(path):
                self.steps[d, at] = 2 * node + bit

    @staticmethod
    def _steps(counts):
        """``(node, bit)`` pairs from the root to every symbol; nodes are numbered from the root, level by level."""
        heap = [(int(n) + 1, s, s) for s, n in enumerate(counts)]
        heapq.heapify(heap)
        while len(heap) > 1:
            (n, s, a), (m, t, b) = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (n + m, min(s, t), (a, b)))
        steps: list[list[tuple[int, int]]] = [[] for _ in counts]
        level, number = [(heap[0][2], [])], 0
        while level:
            below = []
            for tree, path in level:
                if isinstance(tree, tuple):
                    below += [(kid, [*path, (number, bit)]) for bit, kid in enumerate(tree)]
                    number += 1
                else:
                    steps[tree] = path
            level = below
        return steps


def pieces(texts: Iterable[bytes]) -> Iterator[tuple[int, bytes, bytes, bool]]:
    """``(place of the text, bytes before, bytes, whether the text ends here)``."""
    for k, text in enumerate(texts):
        for at in range(0, max(len(text), 1), PIECE):
            yield k, text[max(at - _HISTORY, 0) : at].rjust(_HISTORY, b"\0"), text[at : at + PIECE], at + PIECE >= len(text)


def batches(found: Iterable[tuple[int, bytes, bytes, bool]], most=None):
    held, size = [], 0
    for piece in found:
        if held and size + len(piece[2]) > (most or BATCH):
            yield held
            held, size = [], 0
        held.append(piece)
        size += len(piece[2]) + 1
    if held:
        yield held


class Layout:
    """Symbols of some pieces in the order of (chunk, lane), and their hashed contexts."""

    def __init__(self, held, lanes=True):
        buffer = b"".join([x for _, before, data, last in held for x in (before, data, b"\0" if last else b"")]) + bytes(_HISTORY)
        self.raw = np.frombuffer(buffer, np.uint8)
        sizes = np.array([len(data) + last for _, _, data, last in held], np.int64)
        starts = np.cumsum(sizes + _HISTORY) - sizes
        ends_here = (starts + sizes - 1)[[last for _, _, _, last in held]]
        if not lanes:
            self.at = np.arange(sizes.sum()) + np.repeat(_HISTORY * np.arange(1, len(held) + 1), sizes)
        else:
            per_piece = -(-sizes // CHUNK)
            piece = np.repeat(np.arange(len(held)), per_piece)
            number = np.arange(len(piece)) - np.repeat(np.cumsum(per_piece) - per_piece, per_piece)
            per_piece_lanes = -(-sizes // LANE)
            lane = np.repeat(np.cumsum(per_piece_lanes) - per_piece_lanes, per_piece) + number // (LANE // CHUNK)
            step = number % (LANE // CHUNK)
            order = np.lexsort((lane, step))
            piece, number, lane, step = piece[order], number[order], lane[order], step[order]
            long = np.minimum(sizes[piece] - number * CHUNK, CHUNK)
            ends = np.cumsum(long)
            self.at = np.repeat(starts[piece] + number * CHUNK - (ends - long), long) + np.arange(ends[-1] if len(ends) else 0)
            self.lane = np.repeat(lane, long)
            self.bounds = np.concatenate([[0], ends[np.flatnonzero(np.diff(step))], ends[-1:]]).astype(np.int64)
            self.lane_text = np.repeat([x[0] for x in held], per_piece_lanes)
        symbols = self.raw.astype(np.int32)
        symbols[ends_here] = END
        symbols[1:] += (END + 1) * self.raw[:-1].astype(np.int32)
        #: Symbol and byte before, as one number.
        self.symbols = symbols[self.at]
        self.before = np.ndarray((len(self.raw) - _HISTORY,), "<u8", self.raw, 0, (1,))[self.at - _HISTORY]

    def context(self, k: int) -> np.ndarray:
        """Hashes of the k-th context of all symbols."""
        value = self.before >> _U(64 - 8 * ORDERS[k])
        value ^= value >> _U(29)
        value *= _MULTIPLIERS[k]
        value >>= _U(64 - SLOT_BITS)
        return value.view(np.int64)

    def bits(self, code: Code):
        """``(depth, places, steps)`` for each depth of the code, places in the order of the symbols; all places are None."""
        places, symbols = None, self.symbols
        for d in range(code.depth):
            steps = code.steps[d].take(symbols)
            if d >= code.least:
                kept = np.flatnonzero(steps >= 0)
                places, symbols, steps = kept if places is None else places.take(kept), symbols.take(kept), steps.take(kept)
            if not len(symbols):
                break
            yield d, places, steps


def pair_counts(texts: list[bytes]) -> np.ndarray:
    """Counts of (byte before, symbol) in some texts, flat. A zero byte stands before each text and, at first, for its end."""
    data = np.frombuffer(b"\0".join([b"", *texts, b""]), np.uint8).astype(np.int32)
    total = np.bincount(data[:-1] * (END + 1) + data[1:], minlength=256 * (END + 1))
    last = np.bincount([text[-1] if text else 0 for text in texts], minlength=256) if texts else np.zeros(256, np.int64)
    total[:: END + 1] -= last
    total[END :: END + 1] += last
    return total


def count(texts: list[bytes], code: Code) -> Iterator[tuple[int, int, bytes]]:
    """``(table, range, packed counts)`` of the bits of the texts, which have fewer than 2**31 bits in all.

    Pairs of a context and a symbol are sorted and counted first, so only distinct pairs are spread over the bits of the symbol.
    """
    totals = [np.zeros((SLOTS, 2), np.int32) for _ in range(INPUTS)]
    keys, n = np.empty((INPUTS, SORTED), np.uint32), 0
    others: list[list[np.ndarray]] = [[] for _ in range(INPUTS)]

    def add():
        for own, rare, total in zip(keys, others, totals):
            _add_frequent(own[:n], code, total)
            _add_pairs(np.concatenate([np.empty(0, np.int64), *rare]), code, total)
            rare.clear()

    for held in batches(pieces(texts), COUNT_BATCH):
        layout = Layout(held, lanes=False)
        ranks = code.rank.take(layout.symbols)
        few = np.flatnonzero(ranks >> _RANK_BITS)
        size = len(ranks) - len(few)
        if n + size > SORTED:
            add()
            n = 0
        for k in range(INPUTS):
            contexts = layout.context(k)
            others[k].append(contexts.take(few) << _SYMBOL_BITS | layout.symbols.take(few))
            pairs = contexts << _RANK_BITS | ranks
            keys[k, n : n + size] = np.delete(pairs, few) if len(few) else pairs
        n += size
    add()
    for k, total in enumerate(totals):
        pairs = total.reshape(-1, RANGE, 2)
        for r in np.flatnonzero((total[:, 0] | total[:, 1]).reshape(-1, RANGE).any(axis=1)):
            yield k, int(r), pack(pairs[r])


def _counted(keys):
    """Distinct keys, in order, and how often each comes; the keys are sorted in place."""
    keys.sort()
    firsts = np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]]))
    return keys[firsts].astype(np.int64), np.diff(firsts, append=len(keys)).astype(np.int32)


def _add_frequent(keys, code, total):
    """Adds the bits of pairs of a context and the rank of a frequent pair, as one small number each."""
    keys, times = _counted(keys)
    _add_bits(keys >> _RANK_BITS, code.frequent[keys & ((1 << _RANK_BITS) - 1)], times, code, total)


def _add_pairs(keys, code, total):
    """Adds the bits of pairs of a context and any symbol."""
    keys, times = _counted(keys)
    _add_bits(keys >> _SYMBOL_BITS, keys & ((1 << _SYMBOL_BITS) - 1), times, code, total)


def _add_bits(contexts, symbols, times, code, total):
    flat, twice = total.reshape(-1), contexts * 2
    for d in range(code.depth):
        steps = code.steps[d].take(symbols)
        if d >= code.least:
            kept = np.flatnonzero(steps >= 0)
            twice, symbols, times, steps = twice.take(kept), symbols.take(kept), times.take(kept), steps.take(kept)
        np.add.at(flat, (twice + steps) & (2 * SLOTS - 1), times)


def _bytes(values) -> tuple[bytes, bytes]:
    """Small numbers as bytes, those from 255 on beside them."""
    large = values[values >= 255]
    return np.minimum(values, 255).astype(np.uint8).tobytes(), large.astype("<u4").tobytes()


def pack(pairs: np.ndarray) -> bytes:
    """Counts of zeros and ones of a range of slots, sparse."""
    held = np.flatnonzero(pairs[:, 0] | pairs[:, 1])
    small, large = zip(_bytes(np.diff(held, prepend=0)), _bytes(pairs[held, 0]), _bytes(pairs[held, 1]))
    return zlib.compress(len(held).to_bytes(4, "little") + b"".join(small) + b"".join(large), 1)


def add_packed(data: bytes, total: np.ndarray) -> None:
    raw = zlib.decompress(data)
    n = int.from_bytes(raw[:4], "little")
    values = np.frombuffer(raw, np.uint8, 3 * n, 4).astype(np.int64)
    values[values == 255] = np.frombuffer(raw, "<u4", -1, 4 + 3 * n)
    steps, zeros, ones = values.reshape(3, n)
    held = np.cumsum(steps)
    total[held, 0] += zeros
    total[held, 1] += ones


def odds(pairs: np.ndarray) -> bytes:
    """Table entries from counts."""
    x = SCALE * np.log((pairs[:, 1] + PRIOR) / (pairs[:, 0] + PRIOR))
    return np.clip(np.rint(x), -127, 127).astype(np.int8).tobytes()


def first_weights(code: Code) -> np.ndarray:
    return np.full((code.depth, INPUTS), 0.35, np.float32)


def mix(texts: list[bytes], code: Code, tables: np.ndarray, weights: np.ndarray, learn=False):
    """Log probability (natural) of each text; ``weights`` (depth, input) are moved if they are to learn."""
    totals = np.zeros(len(texts))
    for held in batches(pieces(texts)):
        layout = Layout(held)
        contexts = [layout.context(k) for k in range(INPUTS)]
        lanes = len(layout.lane_text)
        depths = []
        for d, places, steps in layout.bits(code):
            odds_of = np.empty((INPUTS, len(steps)), np.int8)
            sign = (2 * (steps & 1) - 1).astype(np.float32)
            steps >>= 1
            for k, hashes in enumerate(contexts):
                slots = hashes + steps if places is None else hashes.take(places)
                if places is not None:
                    slots += steps
                slots &= SLOTS - 1
                np.take(tables[k], slots, out=odds_of[k], mode="clip")
            bounds = layout.bounds if places is None else np.searchsorted(places, layout.bounds)
            if learn:
                depths.append((d, odds_of, sign, bounds))
                continue
            mixed = _summed(odds_of, weights[d])
            mixed *= sign
            depths.append((mixed, (layout.lane if places is None else layout.lane.take(places)) + d * lanes, bounds))
        if learn:
            _learn_steps(depths, weights, len(layout.bounds) - 1)
            continue
        #: By depth and lane, flat. The bits of a step, of all depths, are handled at once.
        gain, cost = np.ones(code.depth * lanes, np.float32), np.zeros(code.depth * lanes)
        for step in range(len(layout.bounds) - 1):
            plain, on = (np.concatenate([x[k][x[2][step] : x[2][step + 1]] for x in depths]) for k in (0, 1))
            z = gain.take(on)
            z *= plain
            np.clip(z, -12, 12, out=z)
            miss = np.exp(np.negative(z, out=z), out=z)
            both = miss + 1
            miss /= both
            miss *= plain
            runs = np.flatnonzero(np.concatenate([[True], on[1:] != on[:-1]]))
            places_of = on.take(runs)
            cost[places_of] -= np.add.reduceat(np.log(both, out=both), runs)
            gain[places_of] += np.float32(RATE) * np.add.reduceat(miss, runs)
        cost = cost.reshape(-1, lanes).sum(axis=0)
        totals += np.bincount(layout.lane_text, cost, minlength=len(texts))
    return totals


def _learn_steps(depths, weights, steps):
    """Moves the weights along the gradient of the coding cost, depth by depth within a step."""
    for step in range(steps):
        for d, odds_of, sign, bounds in depths:
            a, b = bounds[step], bounds[step + 1]
            if a == b:
                continue
            z = _summed(odds_of[:, a:b], weights[d]) * sign[a:b]
            wrong = sign[a:b] / (np.exp(np.clip(z, -12, 12)) + 1)
            for k in range(INPUTS):
                weights[d, k] += LEARN_RATE / SCALE / 8 / (b - a) ** 0.5 * float((odds_of[k, a:b] * wrong).sum())


def _summed(odds_of, weights):
    """Weighted sum of the table entries, as log odds."""
    total = np.multiply(odds_of[0], np.float32(weights[0] / SCALE), dtype=np.float32)
    part = np.empty_like(total)
    for entries, w in zip(odds_of[1:], weights[1:]):
        np.multiply(entries, np.float32(w / SCALE), out=part, dtype=np.float32)
        total += part
    return total
