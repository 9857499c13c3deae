"""Periodic runs of words by Gusfield and Stoye's tandem-repeat method.

A run is a stretch of words with smallest period q (words q apart are identical) that no neighbouring word extends, and of
length max(``LEAST``, ``TIMES`` * q) or more. Its squares, two roots of q words one after the other, are found type by type:

1. A suffix array with common-prefix lengths stands for the suffix tree, and longest common extensions, ahead and behind, give
   the Lempel-Ziv blocks. The leftmost square of each type crosses the border of a block, with a root no longer than that
   block, or than it and the next; comparing a border with the words as far away finds squares that cover all leftmost ones.
2. From each square a suffix link and its first word lead to the next rotation, if the text has that anywhere. Following
   these links from the covering squares completes the vocabulary: every type of square that the text has.
3. All suffixes below a type's place in the tree are occurrences. Neighbouring occurrences of one period make up a run.

Squares whose root itself is a repetition are left out, so that a period is the smallest and occurrences are few (n log n).

Before that, what can't be in a run is left out: every three words in a row of a run occur three times in it or more (for q = 1,
as a run has six words, and for larger q, as it has 4 q). So only stretches of such triples of a text are searched, told
first by hashes and then by the words themselves; the stretches of several texts are searched as one sequence, with a word
of its own between them.

Every text is handled whole by one task; memory follows the text, and for its candidate stretches log2(n) numbers a word.

Defined cases: a null text counts as empty, and has no runs; runs may overlap; a word is dropped from the collapsed text if
any run holds it after its first q words; texts of any length are searched whole; repeated rows each get the same result;
columns named like the result's are replaced, others pass through whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_parts, text_of
from .shingles import AS_IS, STEP, all_words

LEAST, TIMES = 6, 4
GRAM = 3  # words in a row; each occurs so many times in a run
CHUNK = 1 << 20  # bytes of texts that are filtered at once
GROUP = 1 << 15  # words of candidates that are searched at once, but for a longer stretch
MADE = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


class Suffixes:
    """Ranks of substrings of 1, 2, 4, ... words, which give the suffix array and common extensions."""

    def __init__(self, text: np.ndarray):
        self.text, n = text, len(text)
        self.levels = [np.unique(text, return_inverse=True)[1].astype(np.int32)]
        while self.levels[-1].max(initial=0) < n - 1:
            rank, far = self.levels[-1].astype(np.int64), 1 << (len(self.levels) - 1)
            after = np.zeros(n, dtype=np.int64)
            after[: n - far] = rank[far:] + 1
            self.levels.append(np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int32))
        self.rank = self.levels[-1]
        self.order = np.argsort(self.rank)
        self.common = np.zeros(n, dtype=np.int64)  # of a suffix, by order, and the one before it
        self.common[1:] = self.ahead(self.order[:-1], self.order[1:])

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from places i and j on are the same; i and j differ."""
        n, i, j, total = len(self.text), i.copy(), j.copy(), np.zeros(len(i), dtype=np.int64)
        for k in reversed(range(len(self.levels))):
            level = self.levels[k]
            same = (i < n) & (j < n)
            same &= level[np.minimum(i, n - 1)] == level[np.minimum(j, n - 1)]
            step = same.astype(np.int64) << k
            i, j, total = i + step, j + step, total + step
        return total

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words up to and with places i and j are the same; they may be -1."""
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), dtype=np.int64)
        for k in reversed(range(len(self.levels))):
            level, back = self.levels[k], (1 << k) - 1
            same = (i >= back) & (j >= back)
            same &= level[np.maximum(i - back, 0)] == level[np.maximum(j - back, 0)]
            step = same.astype(np.int64) << k
            i, j, total = i - step, j - step, total + step
        return total

    def blocks(self) -> np.ndarray:
        """Where Lempel-Ziv blocks begin, with the end: each is the longest prefix of the rest that also begins earlier, or a new word."""
        n = len(self.text)
        before, after, stack = np.full(n, -1), np.full(n, -1), []
        for place in self.order.tolist():  # the nearest suffixes of both sides that begin earlier
            while stack and stack[-1] > place:
                after[stack.pop()] = place
            if stack:
                before[place] = stack[-1]
            stack.append(place)
        at, longest = np.arange(n), np.zeros(n, dtype=np.int64)
        for other in (before, after):
            some = np.flatnonzero(other >= 0)
            longest[some] = np.maximum(longest[some], self.ahead(at[some], other[some]))
        starts, longest = [0], np.maximum(longest, 1).tolist()
        while starts[-1] < n:
            starts.append(starts[-1] + longest[starts[-1]])
        return np.array(starts)

    def covering(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stretches (start, end, period) that hold the leftmost square of every type with a primitive root."""
        starts, n = self.blocks(), len(self.text)
        size = np.diff(starts)
        follow = np.append(size[1:], 0)
        # A root that ends a block, against the border after it; one that begins at a border, against what lies so far ahead.
        number = np.concatenate([size, size + follow])
        root = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + 1
        border = np.concatenate([np.repeat(starts[1:], size), np.repeat(starts[:-1], size + follow)])
        ends = np.arange(len(root)) < size.sum()
        one = np.where(ends, border - root, border)
        some = (one >= 0) & (one + root < n)
        one, root = one[some], root[some]
        back, on = self.behind(one - 1, one + root - 1), self.ahead(one, one + root)
        start, end = one - back, one + root + on
        found = np.unique(np.stack([root, start, end])[:, back + on >= root], axis=1)
        root, start, end = found
        # With a shorter period the root is a repetition, and that period divides it (Fine and Wilf).
        single, rest = np.ones(len(root), dtype=bool), root.copy()
        least = _least_factors(int(root.max(initial=1)))
        while (rest > 1).any():
            part = root // np.where(rest > 1, least[rest], root)
            some = np.flatnonzero((rest > 1) & (part < root))
            single[some] &= self.ahead(start[some], start[some] + part[some]) < end[some] - start[some] - part[some]
            rest = np.where(rest > 1, rest // least[rest], rest)
        return start[single], end[single], root[single]

    def squares(self, start: np.ndarray, end: np.ndarray, q: int) -> np.ndarray:
        """Where squares of root length q begin, from the covering stretches of that period: the vocabulary, completed and located."""
        n = len(self.text)
        group = np.cumsum(self.common < 2 * q) - 1  # of suffixes, by order, that share 2 q words
        of = np.empty(n, dtype=np.int64)
        of[self.order] = group
        marked = np.zeros(group[-1] + 1, dtype=bool)
        sizes = end - start - 2 * q + 1
        at = np.repeat(start, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        fresh = np.unique(of[at])
        heads = np.flatnonzero(np.diff(group, prepend=-1))
        shorter = np.cumsum(self.common < 2 * q - 1) - 1  # and those that share a word less: where suffix links lead
        of_shorter = np.empty(n, dtype=np.int64)
        of_shorter[self.order] = shorter
        last = self.order[heads] + 2 * q - 1
        word = np.where(last < n, self.levels[0][np.minimum(last, n - 1)], -1).astype(np.int64)
        keys = shorter[heads] * (n + 1) + word  # in order already
        while len(fresh):
            marked[fresh] = True
            place = self.order[heads[fresh]]
            wanted = of_shorter[place + 1] * (n + 1) + self.levels[0][place]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            fresh = np.unique(at[keys[at] == wanted])
            fresh = fresh[~marked[fresh]]
        return np.flatnonzero(marked[of])

    def runs(self, most: int) -> list[tuple[int, int, int]]:
        """Runs (start, length, period) in no order; none is longer than most words."""
        start, end, root = self.covering()
        out = []
        for q in np.unique(root[root * TIMES <= most]).tolist():
            some = root == q
            at = self.squares(start[some], end[some], q)
            cut = np.flatnonzero(np.diff(at, prepend=-2) > 1)
            first, last = at[cut], at[np.append(cut[1:], len(at)) - 1]
            length = last - first + 2 * q
            for k in np.flatnonzero(length >= max(LEAST, TIMES * q)).tolist():
                out.append((int(first[k]), int(length[k]), q))
        return out


@lru_cache(1)
def _sieve(size: int) -> np.ndarray:
    least = np.arange(size + 1)
    for p in range(2, int(size**0.5) + 1):
        if least[p] == p:
            multiples = least[p * p :: p]
            multiples[multiples == np.arange(p * p, size + 1, p)] = p
    return least


def _least_factors(most: int) -> np.ndarray:
    """The least prime factor of numbers up to most or further."""
    return _sieve(1 << max(10, most.bit_length()))


def _stretches(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of consecutive numbers."""
    cut = np.flatnonzero(np.diff(place, prepend=-2) != 1)
    return place[cut], place[np.append(cut[1:], len(place))[: len(cut)] - 1]


def candidates(word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches (begin, end) of words that may hold runs, from words' hashes and where texts begin."""
    n = len(word) - GRAM + 1
    if n < LEAST - GRAM + 1:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    gram = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        gram *= STEP
        gram += word[k : k + n]
    gram ^= gram >> np.uint64(32)
    text = np.searchsorted(first, np.arange(len(word)), side="right")
    place = np.flatnonzero(text[:n] == text[GRAM - 1 :])
    where, before = text[place], -1
    while len(place) != before:
        before = len(place)
        with np.errstate(over="ignore"):
            key = gram[place] + where.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        _, same, times = np.unique(key, return_inverse=True, return_counts=True)
        place = place[times[same] >= GRAM]
        begin, last = _stretches(place)
        some = last - begin >= LEAST - GRAM
        begin, last = begin[some], last[some]
        # Next time triples are counted within their stretch.
        sizes = last - begin + 1
        where = np.repeat(np.arange(len(begin)), sizes)
        place = np.repeat(begin, sizes) + np.arange(len(where)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        if not len(place):
            break
    return begin, last + GRAM


def _searched(words: list[list[bytes]], sizes: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Runs (stretch, start, length, period) of stretches of words."""
    known: dict[bytes, int] = {}
    number = known.setdefault
    ids = np.array([number(w, len(known)) for stretch in words for w in stretch], dtype=np.int64)
    ends = np.cumsum(sizes)
    # A word of its own between stretches.
    text = np.insert(ids, ends[:-1], len(known) + np.arange(len(ends) - 1))
    begins = ends - sizes + np.arange(len(ends))
    for start, length, q in Suffixes(text).runs(max(sizes)):
        k = int(np.searchsorted(begins, start, side="right")) - 1
        yield k, start - int(begins[k]), length, q


def runs_of(texts: list[bytes]) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """For each text its words, its runs (start, length, period) by start and period, and its words without repeats."""
    data = b" ".join(texts)
    starts, word = all_words(data, AS_IS)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    first = np.searchsorted(starts, np.cumsum(sizes + 1) - sizes - 1)
    begin, end = candidates(word, first)
    del starts, word
    owner = np.searchsorted(first, begin, side="right") - 1
    split: dict[int, list[bytes]] = {}
    found: dict[int, list[tuple[int, int, int]]] = {}
    held: list[tuple[int, int]] = []  # text and start of a stretch
    words: list[list[bytes]] = []
    total = 0

    def search() -> None:
        if words:
            for k, start, length, q in _searched(words, [len(x) for x in words]):
                found.setdefault(held[k][0], []).append((held[k][1] + start, length, q))
        held.clear()
        words.clear()

    for t, a, b in zip(owner.tolist(), (begin - first[owner]).tolist(), (end - first[owner]).tolist()):
        if t not in split:
            split[t] = texts[t].split()
        held.append((t, a))
        words.append(split[t][a:b])
        total += b - a
        if total >= GROUP:
            search()
            total = 0
    search()
    out = []
    for t, text in enumerate(texts):
        kept = split.get(t) or text.split()
        n, runs = len(kept), sorted(found.get(t, ()), key=lambda r: (r[0], r[2]))
        if runs:
            dropped = np.zeros(n + 1, dtype=np.int64)
            for start, length, q in runs:
                dropped[start + q] += 1
                dropped[start + length] -= 1
            kept = [w for w, d in zip(kept, np.cumsum(dropped).tolist()) if not d]
        out.append((n, runs, b" ".join(kept)))
    return out


def _made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    def rows(chunk: list[bytes]) -> pa.Array:
        found = runs_of(chunk)
        runs = [[dict(zip(("start", "length", "period"), r)) for r in x[1]] for x in found]
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array(runs, kind), pa.array([x[2] for x in found], pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])

    for texts in batches:
        made, chunk, held = [], [], 0
        for part in in_parts(texts):
            for text in part:
                chunk.append(text)
                held += len(text)
                if held >= CHUNK:
                    made.append(rows(chunk))
                    chunk, held = [], 0
        made.append(rows(chunk))
        yield pa.concat_arrays(made)


def with_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, runs (start and length in words, period; by start, then period) and collapsed, the kept words joined by spaces."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_words", "runs", "collapsed")]
    return docs.withColumn("made_", F.arrow_udf(_made, MADE)(text_of(text_col).cast("binary"))).select(*kept, "made_.*")
