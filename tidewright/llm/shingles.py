"""Sets of hashed word shingles, from the bytes of Arrow string columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tidewright.llm.common import slices

WORDS = 5
_SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(_SEPARATORS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 64, 256, np.uint64)[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RNG.integers(1, 1 << 64, WORDS, np.uint64) | np.uint64(1)
_BYTES_AT_ONCE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64 over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each row's offsets in them; a null has no bytes."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    return data, offsets


def parts_of(column: pa.Array):
    """(first row, last row + 1, bytes, offsets) of runs of rows of a bounded size."""
    data, offsets = text_bytes(column)
    for a, b in slices(np.diff(offsets).tolist(), _BYTES_AT_ONCE):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def word_hashes(data: np.ndarray, offsets: np.ndarray, in_words: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of every row, lower-cased in A-Z, and the rows' offsets in them. in_words: for each byte
    whether words are made of it."""
    is_word = in_words[data]
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = is_word[heads]
    at, first = np.flatnonzero(is_word), np.flatnonzero(begins)
    if not len(first):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    start = np.searchsorted(at, first)
    size = np.diff(np.append(start, len(at)))
    place = at - np.repeat(first, size)
    powers = np.multiply.accumulate(np.full(int(place.max()) + 1, _BASE))
    hashes = np.add.reduceat(_BYTE[data[at]] * powers[place], start) + size.astype(np.uint64) * _PLACE[0]
    return mix(hashes), np.searchsorted(first, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingle hashes in ascending order, and the rows' offsets in them. A row with fewer words
    than a shingle has one: its whole sequence; a row without words has none."""
    words, bounds = word_hashes(data, offsets)
    n_words = np.diff(bounds)
    n = np.where(n_words >= WORDS, n_words - WORDS + 1, n_words > 0)
    at = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(at[-1], np.uint64)
    long = n_words >= WORDS
    if long.any():
        m = len(words) - WORDS + 1
        total = words[:m] * _PLACE[0]
        for k in range(1, WORDS):
            total += words[k : k + m] * _PLACE[k]
        whole = np.arange(m) + WORDS <= np.repeat(bounds[1:], n_words)[:m]
        out[np.repeat(long, n)] = mix(total[whole])
    for i in np.flatnonzero(~long & (n_words > 0)):
        w = words[bounds[i] : bounds[i + 1]]
        out[at[i]] = mix((w * _PLACE[: len(w)]).sum(keepdims=True) + np.uint64(len(w)))[0]
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[at[:-1][n > 0]] = True
    return out[new], np.concatenate([[0], np.cumsum(new)])[at]


def set_digests(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each row's set."""
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets ^ np.uint64(salt)), dtype=np.uint64)])
        out.append(mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def fold_of(grams: np.ndarray) -> bytes:
    """The set's row of the incidence matrix, folded: column h falls on bit h mod B, which holds whether an odd number of columns
    does. B is a power of two, the set's size or more. Two folds of one B differ in no more bits than their sets in columns."""
    bits = max(64, 1 << (len(grams) - 1).bit_length())
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def halved(fold: np.ndarray) -> np.ndarray:
    """Folds (along the last axis) as they are with half as many bits."""
    half = fold.shape[-1] // 2
    return fold[..., :half] ^ fold[..., half:]
