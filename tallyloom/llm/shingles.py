"""Word shingles as 64-bit hashes, and their circulant MinHash signatures."""

from __future__ import annotations

from functools import cache

import numpy as np
import xxhash

# Distinct words whose hashes one Python worker remembers.
WORDS_KEPT = 300_000

_U = np.uint64


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_HASHES = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and shift rounds)."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def words_of(text: bytes | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text with A-Z in lower case."""
    return text.lower().split() if text else []


@cache
def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.RandomState(seed).randint(1, 2**62, n).astype(_U) * _U(2) + _U(1)


def word_shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; a shorter text is one run, an empty one has none."""
    words = words_of(text)
    if not words:
        return np.zeros(0, _U)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), _U, len(words))
    run = min(size, len(words))
    factors = _odd(11, size + 1)
    total = np.full(len(words) - run + 1, run, _U) * factors[size]
    for j in range(run):
        total += mixed(hashes[j : j + total.size]) * factors[j]
    return np.unique(mixed(total))


# Places of the circle that the first permutation sends elements to.
PLACES = 1 << 20


@cache
def _windows(length: int) -> np.ndarray:
    """Row p holds the second permutation at places p, p+1, ... around the circle, seen without copying."""
    order = np.random.RandomState(23).permutation(PLACES).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:length]]), length)[:PLACES]


def circulant_minhash(elements: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` coordinates of a circulant MinHash signature.

    The first permutation gives each element a place on a circle; coordinate k is the smallest value of the
    second permutation, shifted by k, over these places. The values an element gives to all coordinates are
    one contiguous stretch of the second permutation, so no further hash is computed.
    """
    places = (mixed(elements + _U(0x9E3779B97F4A7C15)) >> _U(44)).astype(np.int64)
    windows = _windows(length)
    least = np.full(length, PLACES, np.uint32)
    for at in range(0, places.size, 2048):
        np.minimum(least, windows[places[at : at + 2048]].min(axis=0), out=least)
    return least


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit key per band of ``rows`` coordinates; equal bands at the same place have equal keys.

    ``signature`` is one signature or a matrix with one per row.
    """
    bands = signature.reshape(*signature.shape[:-1], -1, rows).astype(_U)
    keys = (bands * _odd(37, rows)).sum(axis=-1, dtype=_U) + np.arange(bands.shape[-2], dtype=_U) * _U(0x9E3779B97F4A7C15)
    return mixed(keys).view(np.int64)
