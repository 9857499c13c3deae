"""An exchange that replays stored candles, to try jobs without a network: ``client`` tidewick.sources.replay:exchange.

The option ``target`` names a folder that ``store_history`` wrote and all machines share. It has a folder for each symbol and ``SLICE`` minutes, so
that a request opens one or two small files, however long the history is.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import MINUTE

VALUES = ["ts_ms", "open", "high", "low", "close", "volume"]
SLICE = 65_536


def store_history(candles: DataFrame, path: str) -> None:
    """Write candles, one of each symbol and time, as a folder to replay."""
    # The hexadecimal name needs no escapes, whatever the symbol.
    rows = candles.select(F.concat(F.lit("s"), F.hex("symbol")).alias("named"), F.unix_millis(F.col("timestamp").cast("timestamp")).alias("ts_ms"), *VALUES[1:])
    rows = rows.withColumn("slice", F.floor(F.col("ts_ms") / (SLICE * MINUTE)))
    rows.repartition("named", "slice").sortWithinPartitions("named", "slice", "ts_ms").write.partitionBy("named", "slice").mode("overwrite").parquet(path)


def _folder(target: str, symbol: str) -> tuple[fs.FileSystem, str]:
    files, path = fs.FileSystem.from_uri(target) if "://" in target else (fs.LocalFileSystem(), target)
    return files, f"{path}/named=s{symbol.encode().hex().upper()}"


@lru_cache(4096)
def _slices(target: str, symbol: str) -> list[int]:
    """The numbers of a symbol's slices, in order."""
    files, path = _folder(target, symbol)
    found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(int(f.base_name.removeprefix("slice=")) for f in found if f.base_name.startswith("slice="))


@lru_cache(8)
def _bars(target: str, symbol: str, number: int) -> tuple[np.ndarray, pa.Table]:
    """A slice's bars by time, and their times."""
    files, path = _folder(target, symbol)
    found = ds.dataset(f"{path}/slice={number}", filesystem=files, format="parquet").to_table(columns=VALUES).sort_by("ts_ms").combine_chunks()
    return found["ts_ms"].to_numpy(), found


def exchange(target: str) -> Callable[[str, int, int], list[list]]:
    def fetch(symbol: str, since: int, limit: int) -> list[list]:
        """The first bars from since on, from as many slices as it takes."""
        numbers, rows = _slices(target, symbol), []
        for number in numbers[bisect_left(numbers, since // (SLICE * MINUTE)) :]:
            if len(rows) >= limit:
                break
            times, bars = _bars(target, symbol, number)
            some = bars.slice(int(np.searchsorted(times, since)), limit - len(rows))
            rows += map(list, zip(*(some[c].to_pylist() for c in VALUES)))
        return rows

    return fetch
