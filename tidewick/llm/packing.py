"""Pattern packing of token pieces by non-negative least squares.

Documents longer than a sequence are cut so that all but the first piece fill one. The histogram of the other pieces'
lengths, which has as many entries as a sequence has tokens however many documents there are, goes to the driver. There,
all patterns of two or three lengths that fill a sequence exactly are enumerated (about length**2 / 12, at 12 bytes each),
and their repeat counts are fitted to the histogram by non-negative least squares: coordinate descent, until a round lowers
the squared residual by less than ``STILL`` of the histogram's squares. Counts are rounded to the nearest number that what
is left allows, and the pieces that they leave are packed best-fit, longest first, on the histogram. The plan is a list of
runs: so many pieces of one length, from one rank among the pieces of that length on, go to consecutive sequences at one
offset. Its size depends on the number of lengths, not of documents, so that it can be sent to every task.

A piece's rank among those of its length is its place in its task plus the counts of earlier tasks, so that neither a
length that a third of all pieces share nor the whole table ever meets in one task.

Defined cases: a null text counts as empty and gives one piece of the end token; very long texts are tokenized whole and cut
into as many pieces as they need; pieces of one length are interchangeable, and tied patterns go in order of enumeration;
repeated rows are packed each; only id and text are read, so that other columns may have any names; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, in_parts, text_of

LENGTH = 2048
END = 0
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: the byte-level pre-tokenizer
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint"
STILL = 1e-6
RANKS = 2**40


@lru_cache(maxsize=2)
def byte_level(path: str) -> tiktoken.Encoding:
    """The byte-level tokenizer of a JSON file of the tokenizers library, run by tiktoken, which is a few times faster."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    # In the file each byte stands as a printable character: itself, or for the rest the next one from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte_level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def tokenized(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """A row for each piece: where it starts, its length, a checksum of its ids, its task and its place there by length."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = byte_level(path).encode, TaskContext.get().partitionId()
        seen = np.zeros(length + 1, dtype=np.int64)
        for batch in batches:
            rows = []
            for doc_ids, texts in zip(in_parts(batch["id"]), in_parts(batch["text"])):
                for doc_id, text in zip(doc_ids, texts):
                    ids = np.array([*encode(text, allowed_special="all"), END], dtype="<u4")
                    first = (len(ids) - 1) % length + 1
                    for piece, start in enumerate([0, *range(first, len(ids), length)]):
                        part = ids[start : first if piece == 0 else start + length]
                        rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes()), task, int(seen[len(part)])))
                        seen[len(part)] += 1
            columns = zip(*rows) if rows else [[]] * len(PIECES.split(", "))
            kinds = [pa.int32() if c.endswith(" int") else pa.int64() for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=[c.split()[0] for c in PIECES.split(", ")])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text")).mapInArrow(pieces, PIECES)


def patterns(present: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c, of present lengths that fill a sequence exactly; c is 0 in patterns of two."""
    has = np.zeros(length + 1, dtype=bool)
    has[present] = True
    found = [np.zeros((0, 3), dtype=np.int32)]
    for a in present[::-1].tolist():
        rest = length - a
        b = np.arange(-(-rest // 2), min(a, rest) + 1, dtype=np.int32)
        b = b[has[b] & (has[rest - b] | (rest == b))]
        found.append(np.stack([np.full(len(b), a, dtype=np.int32), b, rest - b], axis=1))
    return np.concatenate(found)


def fit(histogram: np.ndarray, rows: np.ndarray, still: float = STILL) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that bring A x near the histogram, A counting each length in each pattern.

    Coordinate descent: each round takes patterns by what their step gains, each length in one of them at most, so that
    steps do not interfere, and moves each to its own minimum. The squared residual falls with each round.
    """
    x, rest = np.zeros(len(rows)), histogram.astype(float)
    rest[0] = 0
    before, enough = np.inf, still * (rest**2).sum()
    same = (rows[:, 0] == rows[:, 1]).astype(int) + ((rows[:, 1] == rows[:, 2]) & (rows[:, 2] > 0))
    norm = (rows > 0).sum(axis=1) + 2 * same + 2 * (same == 2)  # a length that a pattern holds k times counts k**2
    while before - (now := (rest**2).sum()) > enough:
        before = now
        step = np.maximum(rest[rows].sum(axis=1) / norm, -x)
        gain = step * step * norm
        # No more patterns than lengths can be taken; the best by gain are looked at first.
        many = min(len(gain), 8 * len(histogram))
        top = np.argpartition(-gain, many - 1)[:many] if many else np.zeros(0, dtype=int)
        top = top[np.argsort(-gain[top], kind="stable")]
        used, chosen = np.zeros(len(histogram), dtype=bool), []
        for i, (a, b, c) in zip(top.tolist(), rows[top].tolist()):
            if gain[i] > 0 and not (used[a] or used[b] or (c and used[c])):
                used[a] = used[b] = True
                used[c] = c > 0
                chosen.append(i)
        x[chosen] += step[chosen]
        np.subtract.at(rest, rows[chosen].ravel(), np.repeat(step[chosen], 3))
        rest[0] = 0
    return x


def plan(histogram: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Runs (length, first rank, count, first sequence, offset, 1 if by a pattern) that place every piece of the histogram."""
    left, rank, runs, sequence = histogram.astype(np.int64).copy(), np.zeros(len(histogram), dtype=np.int64), [], 0

    def place(size: int, count: int, first: int, offset: int, fitted: int = 0) -> None:
        runs.append((size, rank[size], count, first, offset, fitted))
        rank[size] += count
        left[size] -= count

    if left[length]:
        place(length, int(left[length]), 0, 0)
        sequence = int(rank[length])
    rows = patterns(np.flatnonzero(left), length)
    x = fit(left, rows)
    # Whole repeats first, the greatest fractions after them, so that rounding up takes what rounding down has left.
    whole = np.floor(x + 1e-9)
    for wanted, order in ((whole, np.argsort(-whole, kind="stable")), ((x - whole >= 0.5).astype(int), np.argsort(whole - x, kind="stable"))):
        for i in order[: np.count_nonzero(wanted)].tolist():
            sizes = [int(s) for s in rows[i] if s]
            count = min([int(wanted[i]), *(int(left[s]) // sizes.count(s) for s in sizes)])
            if count > 0:
                for k, size in enumerate(sizes):
                    place(size, count, sequence, sum(sizes[:k]), 1)
                sequence += count
    # Best fit on the rest, longest first: room[r] has runs of sequences with r tokens free.
    room: dict[int, list[tuple[int, int]]] = {}
    for size in range(length - 1, 0, -1):
        while left[size]:
            free = min((r for r in room if r >= size), default=None)
            if free is None:
                # As many as fit side by side open a run of new sequences; a remainder opens one more.
                many = min(length // size, int(left[size]))
                count = int(left[size]) // many
                first, offset = sequence, many * size
                for k in range(many):
                    place(size, count, first, k * size)
                sequence += count
                if offset < length:
                    room.setdefault(length - offset, []).append((first, count))
                continue
            first, have = room[free].pop()
            count = min(have, int(left[size]))
            if count < have:
                room[free].append((first + count, have - count))
            if not room[free]:
                del room[free]
            place(size, count, first, length - free)
            if free > size:
                room.setdefault(free - size, []).append((first, count))
    return np.array(runs, dtype=np.int64).reshape(-1, 6)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    pieces = checkpointed(tokenized(docs, path, id_col, text_col, length))
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(length + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row for each length
        histogram[row["length"]] = row["n"]
    runs = plan(histogram, length)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    sent = docs.sparkSession.sparkContext.broadcast(runs)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    earlier = counts.select("length", "task", F.coalesce(before, F.lit(0)).alias("earlier"))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def placed(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        runs = sent.value
        i = np.searchsorted(runs[:, 0] * RANKS + runs[:, 1], size.to_numpy() * RANKS + rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": runs[i, 3] + rank.to_numpy() - runs[i, 1], "offset": runs[i, 4]})

    found = pieces.join(earlier, ["length", "task"]).withColumn("placed", placed("length", F.col("earlier") + F.col("place")))
    return found.select(F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32", "placed.sequence_id", "placed.offset")
