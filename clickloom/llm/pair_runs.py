"""Sorted runs of (pair, total) in zstd frames, merged many at a time by a heap over their next frames.

A pair is (B id << 16 | A id), so the order is by the B side first. A run is a sequence of frames, each with its length in
four bytes and at most ``FRAME`` entries; a merge holds one frame of each run.
"""

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import zstandard

FRAME = 8192


def packed(*parts: np.ndarray) -> bytes:
    """Arrays as one zstd frame, each with its type and length."""
    head = b"".join(struct.pack("<2sI", p.dtype.str[1:].encode(), len(p)) for p in parts)
    body = b"".join(np.ascontiguousarray(p).tobytes() for p in parts)
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<B", len(parts)) + head + body)


def unpacked(frame: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(frame)
    at, out = 1 + 6 * data[0], []
    for k in range(data[0]):
        kind, size = struct.unpack_from("<2sI", data, 1 + 6 * k)
        out.append(np.frombuffer(data, "<" + kind.decode(), size, at))
        at += out[-1].nbytes
    return out


def run_of(pairs: np.ndarray, totals: np.ndarray) -> bytes:
    """A run from sorted, distinct pairs."""
    out = []
    for at in range(0, len(pairs), FRAME):
        frame = packed(np.diff(pairs[at:at + FRAME], prepend=np.uint32(0)).astype("<u4"), totals[at:at + FRAME].astype("<u8"))
        out += [struct.pack("<I", len(frame)), frame]
    return b"".join(out)


def frames(run: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at = 0
    while at < len(run):
        size, = struct.unpack_from("<I", run, at)
        steps, totals = unpacked(run[at + 4:at + 4 + size])
        yield np.cumsum(steps, dtype=np.uint32), totals
        at += 4 + size


def merged(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of the runs in order, each once, with its summed total."""
    readers = [frames(run) for run in runs]
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def load(k: int) -> None:
        found = next(readers[k], None)
        held.pop(k, None)
        if found is not None:
            held[k] = found
            heapq.heappush(heap, (int(found[0][-1]), k))

    for k in range(len(runs)):
        load(k)
    while heap:
        # Below the least last pair of all frames nothing more can come.
        bound, _ = heap[0]
        parts = []
        for k, (pairs, totals) in list(held.items()):
            n = int(np.searchsorted(pairs, bound, side="right"))
            if n:
                parts.append((pairs[:n], totals[:n]))
                held[k] = pairs[n:], totals[n:]
        while heap and heap[0][0] == bound:
            load(heapq.heappop(heap)[1])
        pairs, totals = (np.concatenate(p) for p in zip(*parts))
        order = np.argsort(pairs, kind="stable")
        pairs, totals = pairs[order], totals[order]
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        yield pairs[first], np.add.reduceat(totals, first)


def merged_run(runs: list[bytes]) -> bytes:
    return b"".join(run_of(pairs, totals) for pairs, totals in merged(runs))


def best_of_each(pairs: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Whether a pair's total is the highest of its B id."""
    if not len(pairs):
        return np.zeros(0, bool)
    side = pairs >> np.uint32(16)
    first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
    return totals == np.repeat(np.maximum.reduceat(totals, first), np.diff(np.append(first, len(side))))
