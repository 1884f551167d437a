"""Counting quotient filters over packed n-grams of 64-bit word ids.

An n-gram is n unsigned 64-bit lanes. ``permute`` is a bijection of all of its
bits that turns lane 0 into a hash of the whole n-gram and leaves the others.
The leading bits of lane 0 name the shard, the next ones are the quotient, and
the remainder (all other bits of all lanes) is kept in full, so a filter counts
without loss and every n-gram can be read back from it. A filter is sorted by
its permuted n-grams: filters of one shard merge as sorted runs do.

Stored form of a filter of m n-grams, with floor(log2 m) quotient bits: the run
length of each quotient, the remainder's whole bytes of lane 0, the other lanes
and the counters; small numbers take one byte, larger ones are listed after.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# The multipliers of MurmurHash3's 64-bit finaliser.
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
_BACK = tuple(pow(m, -1, 1 << 64) for m in MIX)

Run = tuple[list[np.ndarray], np.ndarray]


def _scatter(x: np.ndarray) -> np.ndarray:
    for m in MIX:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    return x ^ (x >> np.uint64(33))


def scatter_one(x: int) -> int:
    """``_scatter`` of one number."""
    for m in MIX:
        x = ((x ^ (x >> 33)) * m) & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 33)


def _gather(x: np.ndarray) -> np.ndarray:
    """The inverse of ``_scatter``; x ^ (x >> 33) undoes itself on 64 bits."""
    for m in reversed(_BACK):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    return x ^ (x >> np.uint64(33))


def _others(lanes: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(lanes[0]), dtype=np.uint64)
    for i, lane in enumerate(lanes[1:], 1):
        h = _scatter(h ^ lane) + np.uint64(i)
    return h


def permute(lanes: list[np.ndarray]) -> list[np.ndarray]:
    return [_scatter(lanes[0] ^ _others(lanes)), *lanes[1:]]


def restore(lanes: list[np.ndarray]) -> list[np.ndarray]:
    """The n-grams that ``permute`` turned into ``lanes``."""
    return [_gather(lanes[0]) ^ _others(lanes), *lanes[1:]]


def merge(runs: list[Run]) -> Run:
    """One sorted run of distinct n-grams with the sums of their counters."""
    lanes = [np.concatenate(x) for x in zip(*(r[0] for r in runs))]
    counts = np.concatenate([r[1] for r in runs])
    if not len(counts):
        return lanes, counts
    order = np.argsort(lanes[0], kind="stable")
    sorted_lanes = [x[order] for x in lanes]
    tie = sorted_lanes[0][1:] == sorted_lanes[0][:-1]
    same = tie.copy()
    for x in sorted_lanes[1:]:
        same &= x[1:] == x[:-1]
    if (tie != same).any():  # two n-grams share all 64 bits of lane 0
        order = np.lexsort(lanes[::-1])
        sorted_lanes = [x[order] for x in lanes]
        same = np.logical_and.reduce([x[1:] == x[:-1] for x in sorted_lanes])
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    return [x[starts] for x in sorted_lanes], np.add.reduceat(counts[order], starts)


def _small(values: np.ndarray) -> bytes:
    low = np.minimum(values, 255).astype(np.uint8)
    return low.tobytes() + values[values >= 255].astype(np.int64).tobytes()


def _read_small(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, np.int64, offset=n)
    return out


def _whole_bytes(bits: int) -> int:
    return (bits + 7) // 8


def pack(lanes: list[np.ndarray], counts: np.ndarray, lead: int) -> tuple[bytes, bytes, bytes, bytes]:
    """``(runs, remainders, lanes, counters)`` of a sorted run whose n-grams
    share the ``lead`` first bits."""
    q = max(0, len(counts).bit_length() - 1)
    rest = 64 - lead - q
    own = (lanes[0] << np.uint64(lead)) if lead else lanes[0]
    quotient = (own >> np.uint64(64 - q)).astype(np.int64) if q else np.zeros(len(counts), dtype=np.int64)
    runs = np.bincount(quotient, minlength=1 << q)
    width = _whole_bytes(rest)
    low = lanes[0] & np.uint64((1 << rest) - 1)
    remainder = low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return _small(runs), remainder, b"".join(x.astype("<u8").tobytes() for x in lanes[1:]), _small(counts)


def unpack(size: int, m: int, shard: int, lead: int, runs: bytes, remainder: bytes, lanes: bytes,
           counters: bytes) -> Run:
    q = max(0, m.bit_length() - 1)
    rest = 64 - lead - q
    width = _whole_bytes(rest)
    quotient = np.repeat(np.arange(1 << q, dtype=np.uint64), _read_small(runs, 1 << q))
    low = np.zeros((m, 8), dtype=np.uint8)
    low[:, :width] = np.frombuffer(remainder, np.uint8).reshape(m, width)
    first = low.reshape(-1).view("<u8").astype(np.uint64)
    if q:
        first |= quotient << np.uint64(rest)
    if lead:
        first |= np.uint64(shard << (64 - lead))
    others = np.frombuffer(lanes, "<u8").reshape(size - 1, m)
    return [first, *others], _read_small(counters, m)


class Counter:
    """Counts n-grams of one size in a filter, and lets it go when it is full."""

    def __init__(self, size: int, pending: int = 1 << 19, most: int = 1 << 20) -> None:
        self.size, self.most_pending, self.most = size, pending, most
        self.kept: Run | None = None
        self.pending: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, lanes: list[np.ndarray]) -> bool:
        """True if the filter is full and should be taken."""
        if len(lanes[0]):
            self.pending.append(lanes)
            self.waiting += len(lanes[0])
        if self.waiting >= self.most_pending:
            self._compact()
        return self.kept is not None and len(self.kept[1]) >= self.most

    def _compact(self) -> None:
        if not self.pending:
            return
        lanes = permute([np.concatenate(x) for x in zip(*self.pending)])
        fresh = merge([(lanes, np.ones(self.waiting, dtype=np.int64))])
        self.kept = merge([self.kept, fresh]) if self.kept is not None else fresh
        self.pending, self.waiting = [], 0

    def take(self, lead: int) -> Iterator[tuple[int, int, bytes, bytes, bytes, bytes]]:
        """``(shard, m, runs, remainders, lanes, counters)`` of each shard's
        part, and the counter starts anew."""
        self._compact()
        if self.kept is None:
            return
        lanes, counts = self.kept
        self.kept = None
        shards = (lanes[0] >> np.uint64(64 - lead)).astype(np.int64) if lead else np.zeros(len(counts), dtype=np.int64)
        ends = np.flatnonzero(np.concatenate([shards[1:] != shards[:-1], [True]])) + 1
        at = 0
        for end in ends.tolist():
            yield (int(shards[at]), end - at, *pack([x[at:end] for x in lanes], counts[at:end], lead))
            at = end
