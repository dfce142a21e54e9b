"""Numpy helpers on texts as bytes: words of a batch as 64-bit hashes, without a Python loop over words."""

import numpy as np

# Odd, so that it has an inverse modulo 2 ** 64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
STEP = 1 << 16


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** i for i below n, modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_FORWARD, _BACK = powers(BASE, STEP), powers(INVERSE, STEP)
_FORWARD_HIGH, _BACK_HIGH = powers(np.uint64(pow(int(BASE), STEP, 1 << 64)), STEP), powers(
    np.uint64(pow(int(INVERSE), STEP, 1 << 64)), STEP)


def power_at(places: np.ndarray, back: bool = False) -> np.ndarray:
    """BASE ** place (or its inverse) for places below 2 ** 32, from two small tables."""
    low, high = (_BACK, _BACK_HIGH) if back else (_FORWARD, _FORWARD_HIGH)
    return low[places & (STEP - 1)] * high[places >> 16]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that low bits depend on all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def joined(texts: list[bytes], separator: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, each followed by ``separator``, and where each text starts (one entry more)."""
    data = np.frombuffer(separator.join(texts) + separator, np.uint8)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + len(separator) for t in texts], out=starts[1:])
    return data, starts


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; the array must end with False."""
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside.size and inside[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]


def weighted_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums (one entry more) of the bytes times powers of the base; ``range_hashes`` reads any range from them."""
    weighted = np.empty(len(data), np.uint64)
    for at in range(0, len(data), STEP):
        part = data[at:at + STEP]
        np.multiply(part.astype(np.uint64) + np.uint64(1), _FORWARD[:len(part)], out=weighted[at:at + len(part)])
        weighted[at:at + len(part)] *= _FORWARD_HIGH[at >> 16]
    return np.concatenate([[np.uint64(0)], np.cumsum(weighted, dtype=np.uint64)])


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each range, wherever the range lies."""
    return mixed((sums[ends] - sums[starts]) * power_at(starts, back=True))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span's bytes; spans are disjoint, in order and not empty."""
    if not len(starts):
        return np.empty(0, np.uint64)
    return range_hashes(weighted_sums(data), starts, ends)
