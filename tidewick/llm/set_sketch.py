"""Near-duplicate detection by SetSketch registers.

Every shingle draws an exponential variable for each of ``REGISTERS`` registers, the same one in every text; a register holds
the least one of a text's shingles, truncated to its place among values spaced exponentially by ``BASE``. So the register of
a union is the greater one of its parts' registers, and registers of similar sets often agree. A shingle's variables are
drawn in rising order, as the points of a Poisson process that fall to registers at random, until they exceed the greatest of
the text's least ones: most shingles need a few points only.

Documents meet where the registers of one of ``BANDS`` bands agree. Of sets with a Jaccard similarity of 0.85 a band agrees
with a probability of 0.377 at least, so that a linked pair is missed once in 3.7 million. Pairs that met are tested by the
joint likelihood of how many registers are greater in one set, in the other, and equal, given the sets' sizes: it is concave in the
similarity, and its slope at ``SIGMAS`` deviations under the similarity asked for tells whether the estimate lies above. Those
that pass are verified on whole texts; see set_links.py, which also says what large buckets go through.

Defined cases: a null or empty text, or one of white space, has the empty set and is linked with nothing; a text with fewer
words than a shingle is one shingle; very long texts are sketched and compared whole; repeated rows are linked unless empty;
a null id counts as greater than any other, and is the component's where all ids are null; columns of any name may be there,
as only id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, in_parts
from .set_links import Search, component_ids, least_shared, one_of_each, signatures, signed
from .shingles import MIX, STEP, shingle_sets

REGISTERS, BANDS = 192, 32
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 1  # of registers: spacing, the scale that 0 stands for, greatest value
SIGMAS = 5
SINGLE, ROUNDS = 3, 16  # points of every shingle that are drawn one by one, then so many at once
PART = 1 << 17  # shingles that are sketched at once
MADE = "n bigint, sig_a bigint, sig_b bigint, summary binary, bands array<bigint>"


def _mixed(h: np.ndarray) -> np.ndarray:
    for factor in MIX:
        h = h * factor
        h ^= h >> np.uint64(31)
    return h


def _least(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the least variable of each register."""
    least = np.full(len(sets) * REGISTERS, np.inf)
    shingle, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at, drawn = np.zeros(len(shingle)), 0
    while len(shingle):
        number = 1 if drawn < SINGLE else ROUNDS
        h = _mixed(shingle[:, None] + np.arange(drawn + 1, drawn + number + 1, dtype=np.uint64) * STEP)
        drawn += number
        # 40 bits give the distance to the next point, the others its register.
        points = at[:, None] - np.cumsum(np.log1p(-(h >> np.uint64(24)).astype(np.float64) / (1 << 40)), axis=1) / REGISTERS
        register = ((h & np.uint64(0xFFFFFF)) * np.uint64(REGISTERS) >> np.uint64(24)).astype(np.intp)
        np.minimum.at(least, (owner[:, None] * REGISTERS + register).ravel(), points.ravel())
        most = least.reshape(-1, REGISTERS).max(axis=1)
        going = points[:, -1] < most[owner]
        shingle, owner, at = shingle[going], owner[going], points[going, -1]
    return least.reshape(-1, REGISTERS)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The registers of sets of 64-bit hashes, a row for each; all 0 for the empty set. The greater ones of two are their union's."""
    out = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
    start = 0
    while start < len(sets):
        end, held = start + 1, len(sets[start])
        while end < len(sets) and held + len(sets[end]) <= PART:
            held += len(sets[end])
            end += 1
        with np.errstate(over="ignore"):
            level = np.floor(1 - np.log(_least(sets[start:end]) * (1 / RATE)) / np.log(BASE))
        out[start:end] = np.clip(np.where(np.isfinite(level), level, 0), 0, LIMIT)
        start = end
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A hash of each band of registers, different for each band."""
    rows = registers.reshape(len(registers), BANDS, -1).astype(np.uint64)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(registers), 1))
    with np.errstate(over="ignore"):
        for k in range(rows.shape[2]):
            key = key * STEP + rows[:, :, k] + np.uint64(1)
        return _mixed(key)


def _above(x: np.ndarray) -> np.ndarray:
    """The probability that a register is greater in one set, where x is the share of the union that only this set has."""
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def slope(similarity: np.ndarray | float, u: np.ndarray, more: np.ndarray, less: np.ndarray) -> np.ndarray:
    """The derivative of the joint log-likelihood by the similarity, up to a factor, where u is the first set's share of both sizes.

    more and less are the numbers of registers in which the first set's is greater, or less; it falls with the similarity.
    """
    v = 1 - u
    only_u, only_v = np.maximum(u - v * similarity, 1e-12), np.maximum(v - u * similarity, 1e-12)
    p, q = _above(only_u), _above(only_v)
    scale = (BASE - 1) / BASE
    dp, dq = -v / (1 - only_u * scale), -u / (1 - only_v * scale)  # of p and q, up to the same factor
    return more * dp / p + less * dq / q - (REGISTERS - more - less) * (dp + dq) / np.maximum(1 - p - q, 1e-12)


def estimate(u: np.ndarray, more: np.ndarray, less: np.ndarray, steps: int = 40) -> np.ndarray:
    """The similarity of greatest joint likelihood, by halving."""
    lo, hi = np.zeros(np.shape(u)), np.minimum(u / (1 - u), (1 - u) / u)
    for _ in range(steps):
        middle = (lo + hi) / 2
        rises = slope(middle, u, more, less) > 0
        lo, hi = np.where(rises, middle, lo), np.where(rises, hi, middle)
    return (lo + hi) / 2


def possible(n: np.ndarray, registers: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets of these sizes may be linked by the likelihood of their registers."""
    rows = np.stack(registers)
    more = np.array([(row > rows).sum(axis=1) for row in rows])
    t = percent / 100
    cut = t - SIGMAS * np.sqrt(t * (1 - t) / REGISTERS)
    u = n[:, None] / (n[:, None] + n[None, :])
    return (least_shared(n, percent) <= np.minimum(n[:, None], n[None, :])) & (slope(cut, u, more, more.T) >= 0)


def with_sketches(docs: DataFrame, words: int) -> DataFrame:
    """docs with the size of each shingle set, signatures of it, its registers as its summary and its bands, in place of the text."""

    @F.arrow_udf(MADE)
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = []
            for part in in_parts(texts):
                sets = shingle_sets(part, words)
                registers = sketches(sets)
                marks = [signatures(found) for found in sets]
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(sets) + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(band_keys(registers).ravel().view(np.int64)))
                columns = [pa.array([len(s) for s in sets], pa.int64()), *[signed([x[k] for x in marks]) for k in (0, 1)], pa.array([r.tobytes() for r in registers], pa.binary()), bands]
                parts.append(pa.StructArray.from_arrays(columns, ["n", "sig_a", "sig_b", "summary", "bands"]))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("n", pa.int64()), ("sig_a", pa.int64()), ("sig_b", pa.int64()), ("summary", pa.binary()), ("bands", pa.list_(pa.int64()))]))

    return docs.withColumn("made", made("text")).select(*[c for c in docs.columns if c != "text"], "made.*")


def _buckets(classes: DataFrame) -> DataFrame:
    """From rows (row, n, bands): rows (bucket, row, n) such that classes that agree in a band meet in a bucket.

    A band's classes meet in the bucket of the least of them, so that the many bands of near copies share a few buckets.
    """
    posted = classes.select("row", "n", F.explode("bands").alias("band"))
    # Kept, so that the join deals both sides anew and adaptive execution can split a band of very many sets.
    heads = checkpointed(posted.groupBy("band").agg(F.count(F.lit(1)).alias("c"), F.min("row").alias("bucket")).where("c > 1").select("band", "bucket"))
    return posted.join(heads, "band").select("bucket", "row", "n").distinct()


def search(words: int, percent: int) -> Search:
    return Search(words, percent, lambda docs: with_sketches(docs, words), _buckets, F.col("summary"), lambda n, registers: possible(n, registers, percent))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: id_col, n_shingles and component_id, the least id reachable by links, its own included.

    Sets link when percent * union <= 100 * intersection.
    """
    return component_ids(docs, search(words, percent), id_col, text_col)


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without near copies: of each component the row with the least id stays (a null id is the greatest).

    Rows are told apart by their id and text, so that of rows with equal id and text one stays.
    """
    return one_of_each(docs, search(words, percent), id_col, text_col)
