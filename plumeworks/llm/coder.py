"""Adaptive range coder of token ids: independent blocks, coded side by side in numpy.

A block starts from empty tables and codes each id in up to three decisions. The contexts of order 2 (two ids before) and
order 1 (one id before) each predict the id that last followed them; order 0 predicts, for a low byte, the id that last had it.
First comes which prediction holds (order 2, order 1, order 0, none): three adaptive estimates of it, one per order and chosen
by the confidence of that order's context, are mixed by weights that follow how well each did (Bayesian updating with some
forgetting). Then, unless order 2 or 1 held, comes the low byte, and if no prediction held the high byte, both by adaptive
frequencies. Everything is integer or correctly rounded float32 arithmetic, so encoder and decoder agree on any machine.
"""

import zlib

import numpy as np

BLOCK = 2048
#: Ids coded side by side at most: bounds the memory of a task.
LANES = 2048
_SLOTS1, _SLOTS2 = 1024, 2048
_KINDS, _BITS = 4, 12
_RATE, _FORGET = np.float32(1 / 24), np.float32(0.02)
_REBUILD = 64
_MASK48, _U = (1 << 48) - 1, np.uint64


class _Model:
    """The tables of all lanes. A slot of order 1 or 2 holds an id in its low 16 bits and its confidence, 0 to 7, above."""

    def __init__(self, lanes: int):
        self.rows = np.arange(lanes)
        self.slot1, self.slot2 = np.zeros(lanes * _SLOTS1, np.uint32), np.zeros(lanes * _SLOTS2, np.uint32)
        self.id0 = np.zeros(lanes * 256, np.uint16)
        self.est = [np.full((lanes * n, _KINDS), 0.25, np.float32) for n in (1, 16, 8)]
        self.weight = np.full((lanes, 3), 1 / 3, np.float32)
        self.bytes = [np.ones((lanes, 256), np.uint16) for _ in range(2)]
        self.tops = [np.zeros((lanes, 257), np.uint16) for _ in range(2)]
        self.base1, self.base2 = self.rows * _SLOTS1, self.rows * _SLOTS2
        self.prev1, self.prev2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def of(self, which: int):
        return self.bytes[which].ravel(), self.tops[which].ravel()

    def rebuild(self):
        """Running totals of the byte frequencies, summed anew every few ids; they stay below 2^16 in a block."""
        for counts, tops in zip(self.bytes, self.tops):
            np.cumsum(counts, 1, np.uint16, tops[:, 1:])

    def predict(self, n: int):
        """Slots, predicted ids and the running integer frequencies of the four kinds for the first ``n`` lanes."""
        rows = self.rows[:n]
        p1 = self.prev1[:n]
        mixed = p1 * 40503
        s1 = self.base1[:n] + ((mixed >> 6) & (_SLOTS1 - 1))
        mixed += self.prev2[:n] * 30011
        s2 = self.base2[:n] + ((mixed >> 5) & (_SLOTS2 - 1))
        v1, v2 = self.slot1.take(s1).astype(np.int64), self.slot2.take(s2).astype(np.int64)
        c1, c2 = v1 & 0xFFFF, v2 & 0xFFFF
        k1, k2 = v1 >> 16, v2 >> 16
        ctx = (rows, rows * 16 + k1 + 8 * (c1 == c2), rows * 8 + k2)
        est = [e.take(k, 0) for e, k in zip(self.est, ctx)]
        w = self.weight[:n]
        p = est[0] * w[:, 0:1]
        p += est[1] * w[:, 1:2]
        p += est[2] * w[:, 2:3]
        p *= np.float32((1 << _BITS) - 8)
        to = p.astype(np.int64)
        to += 1
        to[:, 1] += to[:, 0]
        to[:, 2] += to[:, 1]
        to[:, 3] = 1 << _BITS
        return (s1, k1, c1), (s2, k2, c2), ctx, est, to

    def update(self, n, x, kind, one, two, ctx, est):
        rows = self.rows[:n]
        w, flat = self.weight[:n], rows * _KINDS + kind
        for k in range(3):
            w[:, k] *= est[k].ravel().take(flat)
            est[k] *= np.float32(1) - _RATE
            est[k].ravel()[flat] += _RATE
            self.est[k][ctx[k]] = est[k]
        w /= w[:, 0:1] + w[:, 1:2] + w[:, 2:3]
        w *= np.float32(1) - _FORGET
        w += _FORGET / np.float32(3)
        for table, (slots, sure, guess) in ((self.slot1, one), (self.slot2, two)):
            table[slots] = x | (np.minimum(sure + 1, 7) * (guess == x) << 16)
        self.id0[rows * 256 + (x & 255)] = x
        self.prev2[:n] = self.prev1[:n]
        self.prev1[:n] = x


class _Encoder:
    def __init__(self, lanes: int, words: int):
        self.low, self.range = np.zeros(lanes, _U), np.full(lanes, _MASK48, _U)
        self.out, self.at = np.zeros((lanes, words), np.uint16), np.zeros(lanes, np.int64)

    def put(self, lanes, start, freq, total, shift=None):
        """Codes an interval on some lanes; the total is a power of two or a value per lane."""
        low, span = self.low[lanes], self.range[lanes]
        unit = span >> _U(shift) if shift else span // total.astype(_U)
        low = low + unit * start.astype(_U)
        span = unit * freq.astype(_U)
        while True:
            same = (low ^ (low + span)) < _U(1 << 32)
            tight = ~same & (span < _U(1 << 16))
            go = np.flatnonzero(same | tight)
            if not len(go):
                break
            span[tight] = (~low[tight] + _U(1)) & _U(0xFFFF)
            who = go if isinstance(lanes, slice) else lanes[go]
            self.out[who, self.at[who]] = low[go] >> _U(32)
            self.at[who] += 1
            low[go] = (low[go] << _U(16)) & _U(_MASK48)
            span[go] <<= _U(16)
        self.low[lanes], self.range[lanes] = low, span

    def finish(self) -> list[bytes]:
        for k in (32, 16, 0):
            self.out[np.arange(len(self.at)), self.at] = (self.low >> _U(k)) & _U(0xFFFF)
            self.at += 1
        return [row[:n].astype("<u2").tobytes() for row, n in zip(self.out, self.at)]


class _Decoder:
    def __init__(self, blocks: list[bytes]):
        words = max(len(b) // 2 for b in blocks) + 4
        self.inp = np.zeros((len(blocks), words), np.uint16)
        for row, b in zip(self.inp, blocks):
            row[: len(b) // 2] = np.frombuffer(b, "<u2")
        self.low, self.range = np.zeros(len(blocks), _U), np.full(len(blocks), _MASK48, _U)
        first = self.inp[:, :3].astype(_U)
        self.code, self.at = (first[:, 0] << _U(32)) | (first[:, 1] << _U(16)) | first[:, 2], np.full(len(blocks), 3)

    def point(self, lanes, total, shift=None):
        span = self.range[lanes]
        self.unit = span >> _U(shift) if shift else span // total.astype(_U)
        return ((self.code[lanes] - self.low[lanes]) // self.unit).astype(np.int64)

    def drop(self, lanes, start, freq):
        low = self.low[lanes] + self.unit * start.astype(_U)
        span, code = self.unit * freq.astype(_U), self.code[lanes]
        while True:
            same = (low ^ (low + span)) < _U(1 << 32)
            tight = ~same & (span < _U(1 << 16))
            go = np.flatnonzero(same | tight)
            if not len(go):
                break
            span[tight] = (~low[tight] + _U(1)) & _U(0xFFFF)
            who = go if isinstance(lanes, slice) else lanes[go]
            code[go] = ((code[go] << _U(16)) & _U(_MASK48)) | self.inp[who, np.minimum(self.at[who], self.inp.shape[1] - 1)]
            self.at[who] += 1
            low[go] = (low[go] << _U(16)) & _U(_MASK48)
            span[go] <<= _U(16)
        self.low[lanes], self.range[lanes], self.code[lanes] = low, span, code


def _lengths(n: int, block: int) -> np.ndarray:
    return np.array([block] * (n // block) + [n % block] * bool(n % block), np.int64)


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A container of independent blocks: count, block size, then per block its coded length and crc32, then the blocks."""
    ids = np.asarray(ids, np.int64)
    if len(ids) and (ids.min() < 0 or ids.max() > 0xFFFF):
        raise ValueError("ids must fit 16 bits")
    lengths = _lengths(len(ids), block)
    coded = []
    for at in range(0, len(lengths), LANES):
        own = lengths[at : at + LANES]
        coded += _encode_lanes(ids[at * block : at * block + int(own.sum())], own, block)
    sums = [zlib.crc32(ids[k * block : (k + 1) * block].astype("<u4").tobytes()) for k in range(len(lengths))]
    head = np.array([len(ids), block, len(lengths)], "<u8").tobytes()
    return head + np.array([[len(c), s] for c, s in zip(coded, sums)], "<u4").tobytes() + b"".join(coded)


def _encode_lanes(ids, lengths, block) -> list[bytes]:
    lanes = len(lengths)
    grid = np.zeros((lanes, block), np.int64)
    grid.ravel()[: len(ids)] = ids
    model, coder = _Model(lanes), _Encoder(lanes, 4 * block + 8)
    for t in range(int(lengths[0])):
        n = lanes if t < lengths[-1] else lanes - 1
        if t % _REBUILD == 0:
            model.rebuild()
        x = grid[:n, t]
        one, two, ctx, est, to = model.predict(n)
        rows = model.rows[:n]
        c0 = model.id0.take(rows * 256 + (x & 255))
        kind = np.where(two[2] == x, 0, np.where(one[2] == x, 1, np.where(c0 == x, 2, 3)))
        start = np.where(kind, to.ravel().take(rows * _KINDS + kind - (kind > 0)), 0)
        coder.put(slice(0, n), start, to.ravel().take(rows * _KINDS + kind) - start, None, _BITS)
        model.update(n, x, kind, one, two, ctx, est)
        for least, byte, counts, tops in ((2, x & 255, *model.of(0)), (3, x >> 8, *model.of(1))):
            who = np.flatnonzero(kind >= least)
            if len(who):
                b = byte[who]
                at = who * 257 + b
                start = tops.take(at)
                coder.put(who, start, tops.take(at + 1) - start, tops.take(who * 257 + 256))
                counts[who * 256 + b] += 4
    return coder.finish()


def decode(data: bytes) -> np.ndarray:
    """The ids; raises ValueError if a block does not have its checksum."""
    n, block, count = (int(v) for v in np.frombuffer(data, "<u8", 3))
    index = np.frombuffer(data, "<u4", 2 * count, 24).reshape(count, 2)
    lengths, ends = _lengths(n, block), 24 + 8 * count + np.concatenate([[0], np.cumsum(index[:, 0], dtype=np.int64)])
    out = np.zeros((count, block), np.uint32)
    for at in range(0, count, LANES):
        blocks = [data[ends[k] : ends[k + 1]] for k in range(at, min(count, at + LANES))]
        _decode_lanes(blocks, lengths[at : at + LANES], out[at : at + LANES])
    for k in range(count):
        if zlib.crc32(out[k, : lengths[k]].astype("<u4").tobytes()) != index[k, 1]:
            raise ValueError(f"block {k} is damaged")
    return out.ravel()[:n]


def _search(tops, base, point):
    """The byte of each lane whose share of the running totals holds the point."""
    at, step = base.copy(), 128
    while step:
        at += step * (tops.take(at + step) <= point)
        step >>= 1
    return at - base


def _decode_lanes(blocks, lengths, out):
    lanes = len(lengths)
    model, coder = _Model(lanes), _Decoder(blocks)
    for t in range(int(lengths[0])):
        n = lanes if t < lengths[-1] else lanes - 1
        if t % _REBUILD == 0:
            model.rebuild()
        one, two, ctx, est, to = model.predict(n)
        rows = model.rows[:n]
        point = coder.point(slice(0, n), None, _BITS)
        kind = (point >= to[:, 0]).astype(np.int64) + (point >= to[:, 1]) + (point >= to[:, 2])
        start = np.where(kind, to.ravel().take(rows * _KINDS + kind - (kind > 0)), 0)
        coder.drop(slice(0, n), start, to.ravel().take(rows * _KINDS + kind) - start)
        x = np.where(kind == 0, two[2], one[2])
        low = np.zeros(n, np.int64)
        for least, counts, tops in ((2, *model.of(0)), (3, *model.of(1))):
            who = np.flatnonzero(kind >= least)
            if len(who):
                b = _search(tops, who * 257, coder.point(who, tops.take(who * 257 + 256)))
                at = who * 257 + b
                start = tops.take(at)
                coder.drop(who, start, tops.take(at + 1) - start)
                counts[who * 256 + b] += 4
                if least == 2:
                    low[who] = b
                    x[who] = model.id0.take(who * 256 + b)
                else:
                    x[who] = (b << 8) | low[who]
        model.update(n, x, kind, one, two, ctx, est)
        out[:n, t] = x
