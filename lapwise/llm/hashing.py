"""Vectorised 64-bit hashes of words and word n-grams over Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Bytes hashed at a time; cuts fall on white space.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_CODE[65:91] = _CODE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _hash_words(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of `data`; no word crosses an offset of `cuts`."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cuts = cuts[cuts < len(data)]
    first[cuts] = solid[cuts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    at = np.flatnonzero(solid)
    word = np.cumsum(first)[at] - 1
    place = at - starts[word]
    heads = np.flatnonzero(first[at])
    hashes = np.add.reduceat(_CODE[data[at]] * _powers(int(place.max()) + 1)[place], heads)
    return mix(hashes), starts


def batch_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of its text) in order, A-Z lower-cased; a null has no words."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    hashes, owners = [], []
    start = 0
    while start < len(data):
        end = min(start + CHUNK, len(data))
        if end < len(data):
            back = np.flatnonzero(_SPACE[data[start:end]])
            inside = offsets[(offsets > start) & (offsets <= end)]
            near = max(start + back[-1] + 1 if len(back) else 0, inside[-1] if len(inside) else 0)
            if near > start:
                end = int(near)
            else:
                ahead = np.flatnonzero(_SPACE[data[end:]])
                end = int(end + ahead[0]) if len(ahead) else len(data)
        cuts = offsets[(offsets >= start) & (offsets < end)] - start
        words, starts = _hash_words(data[start:end], cuts)
        hashes.append(words)
        owners.append(np.searchsorted(offsets, starts + start, side="right") - 1)
        start = end
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def ngrams(words: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every run of n words inside one text."""
    if len(words) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = mix(out * _BASE + words[k : len(words) - n + 1 + k])
    whole = owners[: len(out)] == owners[n - 1 :]
    return out[whole], owners[: len(out)][whole]


def sequence_hash(words: np.ndarray) -> np.uint64:
    """One hash of a short run of words."""
    out = words[:1].copy()
    for k in range(1, len(words)):
        out = mix(out * _BASE + words[k : k + 1])
    return mix(out + np.uint64(len(words)))[0]
