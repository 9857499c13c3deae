"""Sets of word shingles of texts, as sorted 64-bit hashes and as they are."""

from __future__ import annotations

import re

import numpy as np

CHUNK = 1 << 18
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
GAP = re.compile(rb"[\x20\x09-\x0D]")
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32
AS_IS = np.arange(256, dtype=np.uint64)
STEP = np.uint64(0xD6E8FEB86659FD93)
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit values of others, in place."""
    for factor in MIX:
        h *= factor
        h ^= h >> np.uint64(31)
    return h


def _words(raw: np.ndarray, letters: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of the bytes begins, and its hash.

    A byte and its place in the word are mixed to one value, and a word has the sum of these: unlike a polynomial's, its
    terms have no structure by which words of some pattern would meet.
    """
    gap = SPACE[raw]
    edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    begins = np.cumsum(sizes) - sizes
    value = np.arange(begins[-1] + sizes[-1], dtype=np.uint64)
    value -= np.repeat(begins.astype(np.uint64), sizes)
    value *= np.uint64(256)
    value += letters[raw[~gap]]
    value += np.uint64(1)
    return starts, _mixed(np.add.reduceat(_mixed(value), begins))


def all_words(data: bytes, letters: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of data of any length begins, and its hash, a slice that ends between words at a time."""
    parts, at = [], 0
    while at < len(data):
        end = at + CHUNK
        if end < len(data):
            gap = GAP.search(data, end)
            end = gap.start() if gap else len(data)
        starts, words = _words(np.frombuffer(data, np.uint8, min(end, len(data)) - at, at), letters)
        parts.append((starts + at, words))
        at = end
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) if parts else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))


def _of_chunk(texts: list[bytes], words: int) -> list[np.ndarray]:
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(sizes + 1) - sizes - 1
    starts, word = all_words(b" ".join(texts))
    first, last = np.searchsorted(starts, begins), np.searchsorted(starts, begins + sizes)
    rows = np.zeros(max(len(word) - words + 1, 0), dtype=np.uint64)
    for k in range(words):
        rows *= STEP
        rows += word[k : k + len(rows)]
    rows = _mixed(rows)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= words:
            out.append(np.unique(rows[a : b - words + 1]))
        elif b > a:
            one = np.full(1, b - a, dtype=np.uint64)
            for h in word[a:b]:
                one *= STEP
                one += h
            out.append(_mixed(one))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of so many words, of the whole sequence where it is shorter.

    Words are runs without the six ASCII white-space characters, A-Z lower-cased.
    """
    out: list[np.ndarray] = []
    chunk: list[bytes] = []
    held = 0
    for text in texts:
        chunk.append(data := text.encode("utf-8", "surrogatepass"))
        held += len(data) + 1
        if held >= CHUNK:
            out += _of_chunk(chunk, words)
            chunk, held = [], 0
    if chunk:
        out += _of_chunk(chunk, words)
    return out


def true_shingles(text: str, words: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves; bytes are lower-cased and split at ASCII characters only."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if len(found) < words:
        return {tuple(found)} if found else set()
    return set(zip(*(found[k:] for k in range(words))))
