"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Statistics of each whole text (lengths, character classes, repetition, compressibility) are transformed to be near normal.
Means and second moments of each class are summed in Spark over all labelled training rows. Each class covariance is shrunk
towards the pooled one and that towards a scaled identity, so that few labels or collinear statistics don't make it
singular. A text's score is the difference of the classes' log-densities, by Mahalanobis distances with Cholesky factors
that are computed once and sent to all tasks, made a probability by a logistic curve fitted to a histogram of differences.

Only the text is an input of a score. For all scores of a table, statistics are computed once and kept in the shared folder;
to keep rows, they are computed anew beside the text, so that no text is shuffled or stored.

Defined cases: a null text counts as empty, which has the statistics of no words; very long texts are measured whole; null
labels don't count, and a row that several labels name counts for each; where a class has fewer than two labelled rows, all
score the share of label 1 in what there is (1 without any labels); equal texts score equally, and repeated rows each get
their score; an empty table gives an empty result. Columns of docs named like the two results are replaced; all others but
the text pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, in_parts, scratch, text_of

CUT = 0.3
FOLDS, HELD = 5, 0
TO_POOLED, TO_IDENTITY = 0.1, 0.02
BINS = 2000
# Frequent short words of the four languages.
COMMON = frozenset("the of and to in is that for it was on with as be by at le la les de des un une et en du que qui dans pour der die das und ist nicht ein eine mit von zu den el los las una por con no se es del al".split())
NAMES = (
    "chars", "words", "word_length", "symbols", "bars", "marks", "stops", "upper", "shouted", "digits", "distinct", "repeats", "pairs", "lines", "same_lines", "common", "packed", "foreign",
)
GROUPS = {"symbols": b"#$%&*+/<=>@[\\]^_`{}~\"", "bars": b"|", "marks": b"!?", "stops": b".,;:", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digits": b"0123456789", "foreign": bytes(range(128, 192))}


def _groups() -> np.ndarray:
    table = np.zeros((256, len(GROUPS)))
    for i, members in enumerate(GROUPS.values()):
        table[list(members), i] = 1
    return table


MEMBERS = _groups()


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text, in the order of NAMES."""
    data = text.encode("utf-8", "surrogatepass")
    count = dict(zip(GROUPS, np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ MEMBERS))
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    n = max(len(words), 1)
    letters = max(count["upper"] + count["lower"] + count["foreign"], 1)
    pairs = len(set(zip(words, words[1:])))
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(len(text) / n),
        np.log1p(10 * count["symbols"] / n),
        np.log1p(10 * count["bars"] / n),
        np.log1p(10 * count["marks"] / n),
        np.log1p(10 * count["stops"] / n),
        np.sqrt(count["upper"] / letters),
        np.sqrt(sum(map(str.isupper, words)) / n),
        np.sqrt(count["digits"] / max(len(data), 1)),
        np.log1p(len(set(words))) / np.log1p(n),
        np.sqrt(sum(map(eq, words, words[1:])) / n),
        np.log1p(pairs) / np.log1p(max(n - 1, 1)),
        np.log1p(100 * len(lines) / n),
        np.sqrt(1 - len(set(lines)) / max(len(lines), 1)),
        np.sqrt(sum(map(COMMON.__contains__, words)) / n),
        np.log(len(zlib.compress(data, 1)) / (len(data) + 20)),
        np.sqrt(count["foreign"] / letters),
    ]


class Discriminant:
    """Two normal densities with shrunk covariances."""

    def __init__(self, n: np.ndarray, sums: np.ndarray, squares: np.ndarray):
        """n, sums and squares: rows, summed statistics and summed outer products of class 0 and class 1."""
        size = sums.shape[1]
        self.mean = sums / n[:, None]
        spread = squares - n[:, None, None] * self.mean[:, :, None] * self.mean[:, None, :]
        pooled = spread.sum(axis=0) / n.sum()
        pooled = (1 - TO_IDENTITY) * pooled + TO_IDENTITY * (np.trace(pooled) / size + 1e-9) * np.eye(size)
        factors = [np.linalg.cholesky((1 - TO_POOLED) * s / m + TO_POOLED * pooled) for s, m in zip(spread, n)]
        self.inverse = [np.linalg.inv(f) for f in factors]
        self.constant = [np.log(m / n.sum()) - np.log(np.diag(f)).sum() for f, m in zip(factors, n)]
        self.slope, self.shift = 1.0, 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, priors included; its root, signed, as densities are apart by squares."""
        parts = [c - 0.5 * (((x - m) @ i.T) ** 2).sum(axis=1) for c, m, i in zip(self.constant, self.mean, self.inverse)]
        apart = parts[1] - parts[0]
        return np.sign(apart) * np.sqrt(np.abs(apart))

    def calibrate(self, at: np.ndarray, good: np.ndarray, bad: np.ndarray) -> None:
        """Fit the logistic curve to numbers of good and bad rows at differences, by Newton's steps with a small ridge."""
        design, weight = np.stack([at, np.ones_like(at)], axis=1), good + bad
        theta = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
            slope = design.T @ (good - weight * p) - 1e-2 * (theta - [1.0, 0.0])
            bend = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
            theta = theta + np.clip(np.linalg.solve(bend, slope), -2, 2)
        self.slope, self.shift = theta

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.shift, -30, 30)))


def held_out(key: Column, folds: int = FOLDS, held: int = HELD) -> Column:
    """Whether a row is kept from training, by the hash of its id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == held, F.lit(False))


def _measured(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(x) for part in in_parts(texts) for x in part], dtype=float).reshape(-1, len(NAMES))


def with_statistics(docs: DataFrame, out: str, text_col: str = "text") -> DataFrame:
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = _measured(texts)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(NAMES)), pa.array(rows.ravel()))

    return docs.withColumn(out, measured(text_of(text_col)))


def fit(rows: DataFrame) -> Discriminant | float:
    """The discriminant of rows (x, label), or where a class is missing the share of label 1."""
    size = len(NAMES)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 + size + size * size))
        for batch in batches:
            x, label = np.array(batch["x"].tolist(), dtype=float).reshape(-1, size), batch["label"].to_numpy()
            for k in (0, 1):
                own = x[label == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pd.DataFrame({"label": np.repeat([0, 1], total.shape[1]), "i": np.tile(np.arange(total.shape[1]), 2), "value": total.ravel()})

    sums = rows.mapInPandas(moments, "label int, i int, value double").groupBy("label", "i").agg(F.sum("value").alias("value"))
    total = np.zeros((2, 1 + size + size * size))
    for row in sums.collect():  # as many rows as moments, however many documents
        total[row["label"], row["i"]] = row["value"]
    n = total[:, 0]
    if n.min() < 2:
        return float(n[1] / n.sum()) if n.sum() else 1.0
    model = Discriminant(n, total[:, 1 : 1 + size], total[:, 1 + size :].reshape(2, size, size))

    @F.pandas_udf(T.DoubleType())
    def differences(x: pd.Series) -> pd.Series:
        return pd.Series(model.difference(np.array(x.tolist(), dtype=float).reshape(-1, size)))

    bins = rows.select("label", F.round(F.greatest(F.lit(-50.0), F.least(F.lit(50.0), differences("x"))) * (BINS / 100)).cast("int").alias("bin"))
    held = bins.groupBy("bin").agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")).toPandas()  # BINS rows at most
    model.calibrate(held["bin"].to_numpy() * (100 / BINS), held["good"].to_numpy(float), held["bad"].to_numpy(float))
    return model


def with_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "score", held: str = "held_out") -> DataFrame:
    """docs without the text, with ``held`` and a score from 0 to 1. labels: rows (id_col, quality), of which held-out ones are not used."""
    (x,) = scratch(docs.select(*docs.columns, F.lit(0).alias(held), F.lit(0).alias(out)), "statistics")
    measured = checkpointed(with_statistics(docs.withColumn(held, held_out(F.col(id_col))), x, text_col).drop(text_col))
    train = _labelled(measured.where(~F.col(held)), labels, id_col, x)
    return measured.withColumn(out, _scored(fit(train), F.col(x))).drop(x)


def _labelled(measured: DataFrame, labels: DataFrame, id_col: str, x: str) -> DataFrame:
    """Rows (x, label) of all measured rows that have a usable label."""
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col(id_col).alias("labelled"), F.col("quality").cast("int").alias("label"))
    rows = measured.select(F.col(id_col).alias("id"), F.col(x).alias("x"))
    return rows.join(known, F.col("id") == F.col("labelled")).select("x", "label")


def _scored(model: Discriminant | float, x: Column) -> Column:
    if isinstance(model, float):
        return F.lit(model)

    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.tolist(), dtype=float).reshape(-1, len(NAMES))))

    return score(x)


def _scored_text(model: Discriminant | float, text: Column) -> Column:
    """The score from the text by one function, so that a task needs one Python worker."""
    if isinstance(model, float):
        return F.lit(model)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.score(_measured(texts)))

    return score(text)


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose text scores cut or more.

    The model learns from all labelled rows that are not held out, as in ``with_quality``.
    """
    learning = docs.where(~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = fit(_labelled(checkpointed(with_statistics(learning, "x").drop("text")), labels.select(F.col(id_col).alias("id"), "quality"), "id", "x"))
    return docs.where(_scored_text(model, text_of(text_col)) >= cut)
