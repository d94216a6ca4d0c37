"""Word shingles of many texts at once, on flat byte buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from keelson.llm.common import mix, random_words, utf8

WIDTH = 5
_BYTE = random_words(11, 256)
_POWER = np.cumprod(np.full(4096, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)
_PLACE = random_words(13, WIDTH) | np.uint64(1)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every lower-cased word, in order, and the index of its text.

    Words are runs of bytes above 0x20, so spaces, tabs, line ends and controls part them.
    """
    data, offsets = utf8(pc.utf8_lower(texts.cast(pa.large_string())))
    inside = data > 0x20
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins] = inside[begins]
    at = np.flatnonzero(inside)
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    heads = np.searchsorted(at, starts)
    place = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
    sums = np.add.reduceat(_BYTE[data[at]] * _POWER[place & 4095], heads)
    return mix(sums), np.searchsorted(offsets, starts, side="right") - 1


def shingles(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, text index)`` of all shingles of ``width`` words, in text order.

    A text of fewer words has one shingle of all its words; one without words has none.
    """
    words, owner = hashed_words(texts)
    n = len(texts)
    counts = np.bincount(owner, minlength=n)
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
    place = np.arange(len(words)) - np.repeat(begins, counts)
    left = np.repeat(counts, counts) - place
    full = np.flatnonzero(left >= width)
    whole = np.zeros(len(full), np.uint64)
    for k in range(width):
        whole += words[full + k] * _PLACE[k]
    short = np.flatnonzero((place == 0) & (left < width))
    rest = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        has = left[short] > k
        rest[has] += words[short[has] + k] * _PLACE[k]
    rest += left[short].astype(np.uint64)
    at = np.concatenate([full, short])
    order = np.argsort(at, kind="stable")
    return mix(np.concatenate([whole, rest]))[order], owner[at[order]]


def bags(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(owner, hash, count)`` of the distinct shingles of each text, ordered by both."""
    if not len(hashes):
        return owner, hashes, np.zeros(0, np.int64)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    return owner[heads], hashes[heads], np.diff(np.append(heads, len(hashes)))
