"""Adaptive context-mixing range coder of token ids, for many blocks in lockstep.

A block of ids is coded on its own, from a fresh state. Before every id three
predictions are mixed:

- order 0: the frequencies of ids in the file (its header has them);
- order 1: the id that the id before was followed by last, by the block so far;
- order 2: the same for the two ids before.

The order-1 and order-2 tables keep a confidence with each prediction; how often
a prediction of a confidence comes true is learned as the block goes and gives
its share of the probability. The rest goes to order 0. With shares a0, a1, a2
the cumulative frequency of id x is a0 * C0(x) + a1 * [p1 < x] + a2 * [p2 < x],
out of 2**TOTAL_BITS, which drives a range coder with a 64-bit low and range that
puts out 32 bits at a time; where low overflows, one is carried into the words
before it.

Encoder and decoder run the same model on all blocks at once (one numpy lane a
block), so a step costs a fixed number of array operations, on 32-bit numbers but
for low and range.
"""

from __future__ import annotations

import numpy as np

#: Ids of a block; a file of some million ids then fills the lanes.
BLOCK = 2048
#: Blocks that run in lockstep, at most.
LANES = 4096
TOTAL_BITS, ORDER0_BITS = 24, 17
_TABLE1, _TABLE2 = 11, 11  # bits of the prediction tables of a block
_CONF = 15
#: Confidence after a miss (even places) or a hit, in the bits above the id; at 0 the prediction is replaced.
_NEXT = np.array([c >> 1 if not hit else min(c + 1, _CONF) for c in range(_CONF + 1) for hit in (0, 1)], np.int32) << 16
_ID = np.int32(0xFFFF)
_TOP = np.int32(1 << TOTAL_BITS)
#: Order 0 keeps a share of one at least, for each of its parts.
_MOST = np.int32((1 << TOTAL_BITS) - (1 << ORDER0_BITS))
_U32, _S32, _UNIT = np.uint64(1 << 32), np.uint64(32), np.uint64(TOTAL_BITS)
#: Steps whose contexts and frequencies the encoder looks up together.
_TOGETHER = 32


def order0(counts: np.ndarray) -> np.ndarray:
    """Counts of ids as frequencies out of 2**ORDER0_BITS, at least 1 for each id that occurs."""
    total, out_of = int(counts.sum()), 1 << ORDER0_BITS
    used = np.flatnonzero(counts)
    freq = np.zeros(len(counts), np.int64)
    if not len(used):
        return freq
    if len(used) > out_of:
        raise ValueError("too many different ids")
    freq[used] = 1 + counts[used] * (out_of - len(used)) // total
    freq[used[counts[used].argmax()]] += out_of - int(freq.sum())
    return freq


class _Model:
    """State of the mixing model, one lane a block."""

    def __init__(self, lanes: int, freq: np.ndarray):
        self.freq = freq.astype(np.int32)
        self.cum = np.zeros(len(freq) + 1, np.int32)
        np.cumsum(freq, out=self.cum[1:])
        self.t1 = np.zeros(lanes << _TABLE1, np.int32)
        self.t2 = np.zeros(lanes << _TABLE2, np.int32)
        self.w1 = np.full(lanes * 2 * (_CONF + 1), 1 << 12, np.int32)
        self.w2 = np.full(lanes * (_CONF + 1), 1 << 12, np.int32)
        lane = np.arange(lanes, dtype=np.int64)
        self.base1, self.base2 = lane << _TABLE1, lane << _TABLE2
        self.state1, self.state2 = lane * 2 * (_CONF + 1), lane * (_CONF + 1)

    def places(self, last: np.ndarray, last2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Table places of the contexts, by the ids before (32-bit, lanes last)."""
        n = last.shape[-1]
        one = last * np.uint32(0x9E3779B1) >> np.uint32(32 - _TABLE1)
        two = ((last * np.uint32(0x85EBCA6B)) ^ (last2 * np.uint32(0xC2B2AE35))) * np.uint32(0x9E3779B1) >> np.uint32(32 - _TABLE2)
        return one + self.base1[:n], two + self.base2[:n]

    def predict(self, at1: np.ndarray, at2: np.ndarray) -> None:
        """Predictions and shares of the lanes whose contexts are at these places."""
        n = len(at1)
        self.at1, self.at2 = at1, at2
        self.c1, self.c2 = self.t1.take(at1, mode="clip"), self.t2.take(at2, mode="clip")
        self.p1, self.p2 = self.c1 & _ID, self.c2 & _ID
        self.c1 >>= 16
        self.c2 >>= 16
        self.s2 = self.state2[:n] + self.c2
        self.c1 <<= 1
        self.c2 <<= 1
        self.s1 = self.state1[:n] + self.c1
        self.s1 += self.p1 == self.p2
        self.k1, self.k2 = self.w1.take(self.s1, mode="clip"), self.w2.take(self.s2, mode="clip")
        self.a2 = self.k2 << (TOTAL_BITS - 16)
        np.minimum(self.a2, _MOST, out=self.a2)
        rest = _TOP - self.a2
        self.a0 = rest >> 16
        self.a0 *= self.k1
        np.subtract(rest, self.a0, out=self.a0)
        self.a0 >>= ORDER0_BITS
        np.maximum(self.a0, 1, out=self.a0)
        self.a1 = self.a0 << ORDER0_BITS
        np.subtract(rest, self.a1, out=self.a1)

    def interval(self, x: np.ndarray, cum: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the ids ``x`` of the given order-0 places; notes which predictions hit."""
        start = self.a0 * cum
        start += self.a1 * (self.p1 < x)
        start += self.a2 * (self.p2 < x)
        self.h1, self.h2 = self.p1 == x, self.p2 == x
        size = self.a0 * freq
        size += self.a1 * self.h1
        size += self.a2 * self.h2
        return start, size

    def learn(self, x: np.ndarray) -> None:
        """After ``interval``: shares and tables move towards what came."""
        for table, at, p, c, w, s, k, hit in (
            (self.t1, self.at1, self.p1, self.c1, self.w1, self.s1, self.k1, self.h1),
            (self.t2, self.at2, self.p2, self.c2, self.w2, self.s2, self.k2, self.h2),
        ):
            hit = hit.view(np.int8)
            share = hit * np.int32(65535)
            share -= k
            share >>= 5
            share += k
            w[s] = share
            c += hit
            more = _NEXT.take(c, mode="clip")
            entry = np.where(more > 0, p, x)
            entry |= more
            table[at] = entry


def _carried(words: np.ndarray, carries: np.ndarray, used: np.ndarray) -> None:
    """Adds each noted carry to the word before it, and on through full words."""
    lane, at = np.nonzero(carries)
    for k, j in zip(lane.tolist(), (at - 1).tolist()):
        row = words[k]
        while row[j] == 0xFFFFFFFF:
            row[j] = 0
            j -= 1
        row[j] += np.uint32(1)


def encode_blocks(blocks: list[np.ndarray], freq: np.ndarray) -> list[bytes]:
    """Code of every block; blocks come longest first."""
    lengths = np.array([len(b) for b in blocks])
    lanes, steps = len(blocks), int(lengths[0]) if len(blocks) else 0
    ids = np.zeros((steps + 2, lanes), np.uint32)  # two zeros stand before a block
    for k, b in enumerate(blocks):
        ids[2 : len(b) + 2, k] = b
    m = _Model(lanes, freq)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0))
    words, used = np.zeros((lanes, steps + 4), np.uint32), np.zeros(lanes, np.int64)
    carries = np.zeros((lanes, steps + 4), bool)
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    for t0 in range(0, steps, _TOGETHER):
        t1 = min(t0 + _TOGETHER, steps)
        at1, at2 = m.places(ids[t0 + 1 : t1 + 1], ids[t0:t1])
        xs = ids[t0 + 2 : t1 + 2].astype(np.int32)
        cums, freqs = m.cum.take(xs, mode="clip"), m.freq.take(xs, mode="clip")
        for j in range(t1 - t0):
            n = int(active[t0 + j])
            x = xs[j, :n]
            m.predict(at1[j, :n], at2[j, :n])
            start, size = m.interval(x, cums[j, :n], freqs[j, :n])
            own, left = low[:n], span[:n]
            left >>= _UNIT
            step = left * start.view(np.uint32)
            own += step
            left *= size.view(np.uint32)
            m.learn(x)
            over = np.flatnonzero(own < step)
            if len(over):
                carries[over, used[over]] = True
            at = np.flatnonzero(left < _U32)
            if len(at):
                moved = own[at]
                words[at, used[at]] = moved >> _S32
                used[at] += 1
                own[at] = moved << _S32
                left[at] <<= _S32
    for shift in (_S32, np.uint64(0)):  # the rest of low
        words[np.arange(lanes), used] = (low >> shift) & np.uint64(0xFFFFFFFF)
        used += 1
    _carried(words, carries, used)
    return [words[k, : used[k]].astype("<u4").tobytes() for k in range(lanes)]


def decode_blocks(codes: list[bytes], lengths: np.ndarray, freq: np.ndarray) -> list[np.ndarray]:
    """Ids of every block; blocks come longest first."""
    lanes, steps = len(codes), int(lengths[0]) if len(codes) else 0
    words = np.zeros((lanes, max((len(c) // 4 for c in codes), default=0) + 4), np.uint64)
    for k, c in enumerate(codes):
        words[k, : len(c) // 4] = np.frombuffer(c, "<u4")
    used = np.full(lanes, 2, np.int64)
    code = (words[:, 0] << _S32) | words[:, 1]  # less low
    m = _Model(lanes, freq)
    of = np.repeat(np.arange(len(freq), dtype=np.int32), freq)  # order-0 place to id
    span = np.full(lanes, ~np.uint64(0))
    ids = np.zeros((steps + 2, lanes), np.uint32)
    active = np.searchsorted(-np.asarray(lengths), -np.arange(steps), side="left")
    for t in range(steps):
        n = int(active[t])
        m.predict(*m.places(ids[t + 1, :n], ids[t, :n]))
        own, left = code[:n], span[:n]
        left >>= _UNIT
        v = (own // left).astype(np.int32)
        np.minimum(v, _TOP - np.int32(1), out=v)
        # the predictions' own places, each beside the other's share
        end1, end2 = m.a0 * m.cum.take(m.p1, mode="clip"), m.a0 * m.cum.take(m.p2, mode="clip")
        end1 += m.a2 * (m.p2 < m.p1)
        end2 += m.a1 * (m.p1 < m.p2)
        same = m.p1 == m.p2
        in1, in2 = v >= end1, v >= end2
        end1 += m.a0 * m.freq.take(m.p1, mode="clip")
        end1 += m.a1
        end1 += m.a2 * same
        end2 += m.a0 * m.freq.take(m.p2, mode="clip")
        end2 += m.a2
        end2 += m.a1 * same
        after1, after2 = v >= end1, v >= end2
        v -= m.a1 * after1
        v -= m.a2 * after2
        x = of.take((v / m.a0).astype(np.int32), mode="clip")
        in1 &= ~after1
        in2 &= ~after2
        np.copyto(x, m.p2, where=in2)
        np.copyto(x, m.p1, where=in1)
        ids[t + 2, :n] = x
        start, size = m.interval(x, m.cum.take(x, mode="clip"), m.freq.take(x, mode="clip"))
        own -= left * start.view(np.uint32)
        left *= size.view(np.uint32)
        m.learn(x)
        at = np.flatnonzero(left < _U32)
        if len(at):
            own[at] = (own[at] << _S32) | words[at, used[at]]
            used[at] += 1
            left[at] <<= _S32
    return [ids[2 : int(n) + 2, k].copy() for k, n in enumerate(lengths)]
