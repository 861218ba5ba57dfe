"""Sets of word shingles as 64-bit values, computed over the bytes of many texts at once."""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_draw = np.random.default_rng(0x5EED)
PLACES = _draw.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SEEDS = _draw.integers(1, 1 << 63, 2, dtype=np.uint64)
LANE_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def lanes_at(data: np.ndarray, at: np.ndarray, lengths: np.ndarray, k: int) -> np.ndarray:
    """Bytes 8k to 8k + 7 of the runs of bytes that begin at `at`, as one number each; beyond a run's end they are zero.

    `data` ends with eight bytes more than the runs need.
    """
    windows = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
    return windows[at + 8 * k] & LANE_MASKS[np.minimum(lengths - 8 * k, 8)]


def run_hashes(data: np.ndarray, at: np.ndarray, lengths: np.ndarray, seed: np.uint64) -> np.ndarray:
    """A 64-bit value for each run of bytes: eight bytes at a time go through a bijection that starts from the length.

    Runs of up to eight bytes of one length never share a value. Longer ones are no polynomial in their bytes, so no fixed
    pair of them collides by its form.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = mix(lanes_at(padded, at, lengths, 0) ^ mix(lengths.astype(np.uint64) + seed))
    rest, k = np.flatnonzero(lengths > 8), 1
    while len(rest):
        out[rest] = mix(out[rest] + lanes_at(padded, at[rest], lengths[rest], k))
        k += 1
        rest = rest[lengths[rest] > 8 * k]
    return out


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins, its bytes, and where each text's words start (n + 1 values)."""
    inside = np.zeros(len(data) + 1, bool)
    np.logical_not(SPACE[data], out=inside[:-1])
    first, last = inside[:-1].copy(), inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    last &= ~inside[1:]
    heads = starts[:-1][starts[:-1] < len(data)]
    first[heads] = inside[heads]
    tails = starts[1:][starts[1:] > 0] - 1
    last[tails] = inside[tails]
    at = np.flatnonzero(first)
    return at, np.flatnonzero(last) + 1 - at, np.searchsorted(at, starts)


def words(data: np.ndarray, starts: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value for each word (A-Z lower-cased, unless `lower` is false), and where each text's words start."""
    at, lengths, firsts = word_spans(data, starts)
    return run_hashes(LOWER[data] if lower else data, at, lengths, SEEDS[0]), firsts


def runs(values: np.ndarray, starts: np.ndarray, k: int) -> list[np.ndarray]:
    """For each text the sorted distinct k-word runs; the whole sequence is one run when it has fewer words."""
    n = len(values)
    joined = np.zeros(0, np.uint64)
    if n >= k:
        joined = values[: n - k + 1] * PLACES[0]
        for i in range(1, k):
            joined = joined + values[i : n - k + 1 + i] * PLACES[i]
        joined = mix(joined)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(joined[a : b - k + 1]))
        elif b > a:
            short = (values[a:b] * PLACES[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
