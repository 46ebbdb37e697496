"""Word shingles of whole texts as sets of 64-bit hashes, computed on Arrow buffers.

A word's hash is a polynomial over its bytes, taken from running sums over the whole
batch, so no word becomes a Python object. A-Z count as a-z.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_RATIO = 0x9E3779B97F4A7C15
_SLICE_BYTES = 1 << 20


def _table() -> np.ndarray:
    """A random-looking 64-bit value for every byte, the same for both cases of A-Z."""
    values = [int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8, key=b"byte").digest(), "little") | 1 for b in range(256)]
    for b in range(ord("A"), ord("Z") + 1):
        values[b] = values[b + 32]
    return np.array(values, np.uint64)


_BYTES = _table()
_PLACE = np.array([pow(_RATIO, 2 * k + 3, 1 << 64) | 1 for k in range(WORDS)], np.uint64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the ratio and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, _SLICE_BYTES + 1)
        _POWERS.clear()
        for base in (_RATIO, pow(_RATIO, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _word_hashes(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of each text) of texts that lie end to end."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(borders) - 1, np.int64)
    word = ~_SPACES[data]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    inner = borders[(borders > 0) & (borders < len(data))]
    opens[inner] = word[inner]
    closes[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = _powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)])])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    counts = np.diff(np.searchsorted(starts, borders))
    return hashes, counts


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text of a string array; texts with
    fewer words are one shingle, texts without words (or null) an empty set."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _SLICE_BYTES, side="right")) - 1)
        borders = offsets[first : last + 1] - offsets[first]
        words, counts = _word_hashes(data[offsets[first] : offsets[last]], borders)
        n = max(0, len(words) - WORDS + 1)
        runs = mix(sum((words[k : k + n] * _PLACE[k] for k in range(WORDS)), np.zeros(n, np.uint64)))
        at = 0
        for count in counts.tolist():
            if count >= WORDS:
                own = np.sort(runs[at : at + count - WORDS + 1])
                yield own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif count:
                yield mix((words[at : at + count] * _PLACE[:count]).sum(keepdims=True) + np.uint64(count))
            else:
                yield np.zeros(0, np.uint64)
            at += count
        first = last


def set_id(shingles: np.ndarray) -> int:
    """64-bit id of a set: equal sets, and practically only those, share it."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)
