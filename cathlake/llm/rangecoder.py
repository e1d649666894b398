"""Token ids in blocks of an adaptive context-mixing range coder.

Model. The next id is predicted in three orders:

* order 2: the id expected after the last two ids (hashed table),
* order 1: the id expected after the last id (table by id),
* order 0: adaptive frequencies of all ids of the block so far.

An expectation carries a confidence of 0 to 7: a hit raises it, a miss halves
it, and at 0 the id is replaced. The mixture is

    P(id) = w2 [id = order 2] + w1 [id = order 1] + w0 P0(id),

where the weights are themselves adaptive frequencies, one set per pair of
confidences, agreement of the two expectations, and order-0 rank of the
order-2 id. The share w0 keeps its whole table, so every id stays codable.

Coder. A range coder with 48 bits and 16-bit words codes which part of the
mixture holds the id, and, in the order-0 part, the id itself. A block of ids
is laid out as lanes of ``STEPS`` consecutive ids. All lanes of a block take
one step at a time, share the model, and write a stream of their own; numpy
works on whole lanes. The model and all streams start anew in each block, so
blocks are read independently of each other.

Arithmetic is on integers only, so encoder and decoder agree on any machine.
Where lanes of one step update the same entry, the last lane's value stays.

Block layout, little-endian: ``HEADER``, ``CRC``, documents begun in the block
(flags, ids, lengths), words per lane, words.
"""

from __future__ import annotations

import struct

import numpy as np

ALPHABET = 1 << 16     # ids are below this
STEPS = 256            # consecutive ids in a lane
BLOCK = 4096 * STEPS   # ids in a full block
SLOT_BITS = 18         # order-2 table
TOTAL0 = 20            # bits of the order-0 total
WEIGHT = 16            # bits of the mixture's total
MAGIC = b"CMRC"
VERSION = 1
HEADER = struct.Struct("<4sHHIIIIII")  # magic, version, 0, alphabet, ids, documents, lanes, words, CRC-32 of the ids
CRC = struct.Struct("<I")  # CRC-32 of the header and all that follows

_TOP, _LOW = np.int64(1 << 48), np.int64((1 << 32) - 1)
_REFRESH = {1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192}
_RANKS = 4
_CLASSES = 8 * 8 * 2 * _RANKS


class _Model:
    """Tables shared by the lanes of a block."""

    def __init__(self, lanes: int, alphabet: int, decode: bool):
        self.expect2 = np.zeros(1 << SLOT_BITS, np.int64)   # confidence << 16 | id
        self.expect1 = np.zeros(ALPHABET, np.int64)
        self.p1, self.p2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.votes = np.tile(np.array([6, 3, 7], np.int64), _CLASSES)
        self.new = np.zeros_like(self.votes)
        self.alphabet, self.decode = alphabet, decode
        self.counts, self.counted = np.zeros(alphabet, np.int64), 0
        self.mix()
        self.order0()

    def mix(self):
        """Start and width of the three parts by class; no width is ever zero."""
        v = self.votes.reshape(-1, 3)
        ends = np.cumsum(v, 1)
        cut = np.zeros((_CLASSES, 4), np.int64)
        cut[:, 1:3] = ends[:, :2] * ((1 << WEIGHT) - 3) // ends[:, 2:] + np.array([1, 2])
        cut[:, 3] = 1 << WEIGHT
        self.part_start = cut[:, :3].reshape(-1)
        self.part_width = np.diff(cut, axis=1).reshape(-1)
        self.cut1, self.cut2 = cut[:, 1].copy(), cut[:, 2].copy()

    def order0(self):
        free = (1 << TOTAL0) - self.alphabet
        freq = 1 + self.counts * free // max(int(self.counts.sum()), 1)
        freq[0] += (1 << TOTAL0) - int(freq.sum())
        self.start0, self.freq0 = np.cumsum(freq) - freq, freq
        self.rank = 2 * ((freq > 64).astype(np.int64) + (freq > 512) + (freq > 4096))
        if self.decode:
            self.symbol0 = np.repeat(np.arange(self.alphabet, dtype=np.uint16), freq)

    def begin(self, t: int, steps: np.ndarray):
        """What a step starts from: order 0 and the weights follow at fixed steps."""
        if t in _REFRESH:
            new = steps[self.counted:t, :steps.shape[1] - 1]  # the last lane may be short
            self.counts += np.bincount(new.reshape(-1), minlength=self.alphabet)
            self.counted = t
            self.order0()
        if t < 16 or t % 8 == 0:
            self.votes += self.new * 8
            self.new[:] = 0
            if self.votes.max() > 1 << 20:
                self.votes = (self.votes >> 1) + 1
            self.mix()

    def look(self, n: int):
        """Slots, confidences, expected ids and classes of the lanes' contexts."""
        p1 = self.p1[:n]
        slot = ((self.p2[:n] * 40503) ^ (p1 * 60493)) & ((1 << SLOT_BITS) - 1)
        e2, e1 = self.expect2.take(slot, mode="clip"), self.expect1.take(p1, mode="clip")
        c2, c1 = e2 & 0xFFFF, e1 & 0xFFFF
        e2 >>= 16
        e1 >>= 16
        kind = self.rank.take(c2, mode="clip")
        kind += e2 << 6
        kind += e1 << 3
        kind += c1 == c2
        return slot, e2, e1, c2, c1, kind

    def learn(self, ids, slot, e2, e1, c2, c1, hit2, hit1, kind3):
        n = len(ids)
        self.expect2[slot] = _moved(e2, c2, ids, hit2)
        self.expect1[self.p1[:n]] = _moved(e1, c1, ids, hit1)
        self.p2[:n] = self.p1[:n]
        self.p1[:n] = ids
        self.new += np.bincount(kind3, minlength=3 * _CLASSES)


_NEXT = np.array([[c >> 1, min(c + 1, 7)] for c in range(8)]).reshape(-1) << 16


def _moved(confidence, expected, ids, hit):
    """Next entries: hits gain confidence, misses lose half of it, the unsure take the id."""
    confidence <<= 1
    confidence += hit
    return np.where(confidence == 0, ids, expected + _NEXT.take(confidence, mode="clip"))


def encode_ids(ids: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray]:
    """Words per lane and the words of all lanes."""
    n = len(ids)
    lanes = -(-n // STEPS)
    steps = np.zeros(lanes * STEPS, np.int64)
    steps[:n] = ids
    steps = np.ascontiguousarray(steps.reshape(lanes, STEPS).T)
    short = n - (lanes - 1) * STEPS  # length of the last lane
    model = _Model(lanes, alphabet, False)
    low, rng = np.zeros(lanes, np.int64), np.full(lanes, _TOP - 1)
    width = 2 * STEPS + 4  # at most one word a decision, and the rest at the end
    out = np.zeros((width, lanes), np.int32)
    flat, at = out.reshape(-1), np.arange(lanes)

    def emit(j):
        v, k = low[j], at[j]
        flat[k] = v >> 32  # may exceed 16 bits: carries are settled at the end
        low[j] = (v & _LOW) << 16
        rng[j] <<= 16
        at[j] = k + lanes

    for t in range(STEPS):
        m = lanes if t < short else lanes - 1
        if not m:
            break
        x = steps[t, :m]
        model.begin(t, steps)
        slot, e2, e1, c2, c1, kind = model.look(m)
        hit2, hit1 = x == c2, x == c1
        part = (~hit2).view(np.int8) * (2 - hit1.view(np.int8))  # 0: order 2, 1: order 1, 2: order 0
        kind *= 3
        kind += part
        r = rng[:m] >> WEIGHT
        low[:m] += r * model.part_start.take(kind, mode="clip")
        rng[:m] = r * model.part_width.take(kind, mode="clip")
        emit(np.flatnonzero(rng[:m] <= _LOW))
        i = np.flatnonzero(part == 2)
        r, s = rng[i] >> TOTAL0, x[i]
        low[i] += r * model.start0[s]
        r *= model.freq0[s]
        rng[i] = r
        emit(i[r <= _LOW])
        model.learn(x, slot, e2, e1, c2, c1, hit2, hit1, kind)
    # Two more words settle where in its range each lane ends, whatever words follow.
    low = (low + 0xFFFF) & ~np.int64(0xFFFF)
    for _ in range(2):
        flat[at] = low >> 32
        low = (low & _LOW) << 16
        at += lanes
    lens = at // lanes
    for c in range(int(lens.max()) - 1, 0, -1):
        out[c - 1] += out[c] >> 16
    out = np.ascontiguousarray((out[:lens.max()] & 0xFFFF).astype("<u2").T)
    return lens.astype("<u2"), out[np.arange(out.shape[1])[None, :] < lens[:, None]]


def decode_ids(n: int, alphabet: int, lens: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The ids that ``encode_ids`` coded."""
    lanes = len(lens)
    short = n - (lanes - 1) * STEPS
    model = _Model(lanes, alphabet, True)
    words = np.concatenate([words.astype(np.int64), np.zeros(4, np.int64)])
    at = np.cumsum(lens.astype(np.int64)) - lens
    code = (words[at] << 32) | (words[at + 1] << 16) | words[at + 2]
    at += 3
    rng = np.full(lanes, _TOP - 1)
    steps = np.zeros((STEPS, lanes), np.int64)

    def pull(j):
        k = at[j]
        code[j] = (code[j] << 16) | words.take(k, mode="clip")
        rng[j] <<= 16
        at[j] = k + 1

    for t in range(STEPS):
        m = lanes if t < short else lanes - 1
        if not m:
            break
        model.begin(t, steps)
        slot, e2, e1, c2, c1, kind = model.look(m)
        r, v = rng[:m] >> WEIGHT, code[:m]
        past1, other = v >= r * model.cut1.take(kind, mode="clip"), v >= r * model.cut2.take(kind, mode="clip")
        kind *= 3
        kind += past1
        kind += other
        v -= r * model.part_start.take(kind, mode="clip")
        rng[:m] = r * model.part_width.take(kind, mode="clip")
        x = np.where(past1, c1, c2)
        pull(np.flatnonzero(rng[:m] <= _LOW))
        i = np.flatnonzero(other)
        r, v = rng[i] >> TOTAL0, code[i]
        s = model.symbol0.take(v // r, mode="clip")
        code[i] = v - r * model.start0[s]
        r *= model.freq0[s]
        rng[i] = r
        pull(i[r <= _LOW])
        x[i] = s
        steps[t, :m] = x
        model.learn(x, slot, e2, e1, c2, c1, x == c2, x == c1, kind)
    return steps.T.reshape(-1)[:n]
