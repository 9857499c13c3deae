"""Training windows as arrays: each usable end point's normalised rows and label, batch by batch.

Windows are never spelled out as rows. Tasks get the feature rows once, in chunks by row number with the rows before them that their
windows need, and cut windows from a chunk's matrix as batches are asked for: a task holds one chunk and one batch,
whatever the lookback, the number of symbols and their length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import MODEL
from .sequence import chunked
from .windows import HORIZON, LOOKBACK, PRICES, SPLITS, window_dataset

BATCH, CHUNK = 64, 4096
ROWS = "symbol string, i bigint, split string, chunk bigint, batch bigint, x array<float>, y double"
SCALED = [MODEL.index(c) for c in PRICES]
CLOSE = MODEL.index("close")


def normalised(windows: np.ndarray) -> np.ndarray:
    """Of windows (number, rows, columns): prices over the first close (as they are where that is 0), others as z-scores.

    A column that is flat, or lacks a value, is 0. Runs in double precision; the result is single.
    """
    first = windows[:, :1, CLOSE]
    mean, std = windows.mean(axis=1, keepdims=True), windows.std(axis=1, keepdims=True)
    # Equal values have a deviation of 0, not one of rounding.
    known = (std > 0) & (windows.max(axis=1, keepdims=True) > windows.min(axis=1, keepdims=True))
    out = np.where(known, (windows - mean) / np.where(known, std, 1), 0.0)
    prices = windows[:, :, SCALED]
    out[:, :, SCALED] = np.where((first != 0)[:, :, None], prices / np.where(first != 0, first, 1)[:, :, None], prices)
    return out.astype(np.float32)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, dict[str, np.ndarray]]]:
    """The rows of each symbol and chunk, which come sorted; a chunk may go on in the next batch."""
    key, parts = None, []
    names = ("i", "own_", "split", "y", "key_")

    def joined() -> dict[str, np.ndarray]:
        return {c: np.concatenate([p[c] for p in parts]) for c in (*names, "values")}

    for batch in batches:
        symbol, chunk = batch["symbol"].to_numpy(zero_copy_only=False), batch["chunk_"].to_numpy(zero_copy_only=False)
        columns = {c: batch[c].to_numpy(zero_copy_only=False) for c in names}
        columns["values"] = np.stack([batch[c].cast(pa.float64()).to_numpy(zero_copy_only=False) for c in MODEL], axis=1)
        cuts = np.flatnonzero((symbol[1:] != symbol[:-1]) | (chunk[1:] != chunk[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(symbol)]):
            if a < b:
                if (now := (symbol[a], int(chunk[a]))) != key:
                    if parts:
                        yield *key, joined()
                    key, parts = now, []
                parts.append({c: x[a:b] for c, x in columns.items()})
    if parts:
        yield *key, joined()


def _cut(lookback: int, size: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbol, chunk, rows in _chunks(batches):
            for split in SPLITS:
                ends = np.flatnonzero(rows["own_"].astype(bool) & (rows["split"] == split))
                ends = ends[np.lexsort((rows["i"][ends], rows["key_"][ends]))]
                for number, start in enumerate(range(0, len(ends), size)):
                    some = ends[start : start + size]
                    x = normalised(rows["values"][some[:, None] + np.arange(-lookback, 0)])
                    width = lookback * len(MODEL)
                    same = lambda value, kind: pa.array([value] * len(some), kind)  # noqa: B023, E731
                    columns = [
                        same(symbol, pa.string()), pa.array(rows["i"][some], pa.int64()), same(split, pa.string()), same(chunk, pa.int64()), same(number, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, (len(some) + 1) * width, width, dtype=np.int32)), pa.array(x.ravel())), pa.array(rows["y"][some], pa.float64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["symbol", "i", "split", "chunk", "batch", "x", "y"])

    return cut


def training_tensors(features: DataFrame, lookback: int = LOOKBACK, horizon: int = HORIZON, size: int = BATCH, seed: int = 0, chunk: int = CHUNK) -> DataFrame:
    """A row for each usable end point: symbol, i, split, chunk, batch, x (lookback x 8 values, row by row) and label y.

    Rows of a batch come one after another. Batches are cut within a symbol's chunks: train in the order of a digest of seed,
    symbol and i, the others by time. Only a chunk's last batch of a split may be short.
    """
    ends = window_dataset(features, lookback, horizon).select("symbol", "i", "split", "y")
    digest = F.md5(F.concat_ws("|", F.lit(seed).cast("string"), "symbol", F.col("i").cast("string")))
    order = F.when(F.col("split") == "train", F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")).otherwise(F.col("i"))
    rows = features.select("symbol", "i", *MODEL).join(ends, ["symbol", "i"], "left").withColumn("key_", order)
    cut = chunked(rows, lookback, 0, chunk).repartition("symbol", "chunk_").sortWithinPartitions("symbol", "chunk_", "i")
    return cut.mapInArrow(_cut(lookback, size), ROWS)


def window_arrays(features: DataFrame, lookback: int = LOOKBACK, horizon: int = HORIZON) -> DataFrame:
    """One row for each usable end point with its normalised window as an array of rows in the model's order."""
    width = len(MODEL)
    rows = F.transform(F.sequence(F.lit(0), F.lit(lookback - 1)), lambda k: F.slice("x", k * width + 1, F.lit(width)))
    return training_tensors(features, lookback, horizon).select("symbol", "i", rows.alias("x"))


def make_loaders(features: DataFrame, lookback: int = LOOKBACK, horizon: int = HORIZON, size: int = BATCH, seed: int = 0, chunk: int = CHUNK) -> dict[str, DataFrame]:
    """The tensors of each split. Write them for a training job to read, or go through them by batches()."""
    tensors = training_tensors(features, lookback, horizon, size, seed, chunk)
    return {split: tensors.where(F.col("split") == split) for split in SPLITS}


def batches(loader: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The batches (x, y) of a loader as arrays of single precision, one task's result after another."""
    key, x, y = None, [], []
    for row in loader.select("symbol", "chunk", "split", "batch", "x", "y").toLocalIterator():
        if row[:4] != key and x:
            yield np.array(x, dtype=np.float32).reshape(len(x), -1, len(MODEL)), np.array(y, dtype=np.float32)
            x, y = [], []
        key = row[:4]
        x.append(row["x"])
        y.append(row["y"])
    if x:
        yield np.array(x, dtype=np.float32).reshape(len(x), -1, len(MODEL)), np.array(y, dtype=np.float32)
