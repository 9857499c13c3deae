"""Streams that keep state: rolling volatility, latest-wins bars, sessions, and counters of quality.

All of them wait for a watermark: a bar counts as settled when bars that are ``late`` newer have come, of any symbol. Until then it may be
replaced by one collected later; what comes after that is late and left out. State holds what isn't settled, and of each
symbol its last closes, however long the stream runs. Times are cast to ones with a zone, which watermarks need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQueryListener

from ..functions.columns import well_formed
from ..operators.features import SPAN
from ..sources.candles import COLUMNS

LATE = "10 minutes"
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
GAP = "90 seconds"  # between bars of different sessions; those of one are a minute apart
# Of rows with one time, the one that is greatest by these stays, as in the deduplicated view.
PREFERENCE = ("collected_at", "volume", "close", "open", "high", "low", "volatility_5m")
COUNTERS = "quality"
SLAB = 65_536  # rows of a symbol whose deviations are worked out at once
SLOW = 120  # seconds from a bar's time to its collection


def timed(candles: DataFrame, late: str = LATE) -> DataFrame:
    return candles.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late)


class RollingVolatility(StatefulProcessor):
    """Of each symbol the closes that the next return and deviation need; a batch's settled bars are worked through as arrays."""

    def __init__(self, span: int = SPAN):
        self.span = span

    def init(self, handle) -> None:
        self.closes = handle.getValueState("closes", "closes array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(p["us"].to_numpy(), p["close"].to_numpy(dtype=float, na_value=np.nan), p["known"].to_numpy()) for p in rows]
        us, close, known = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(us)
        us, close, known = us[order], close[order], known[order]
        held = [np.nan if x is None else x for x in self.closes.get()[0]] if self.closes.exists() else []
        every = np.concatenate([np.full(self.span - len(held), np.nan), held, close])
        self.closes.update(([None if np.isnan(x) else float(x) for x in every[-self.span :]],))
        for start in range(0, len(us), SLAB):
            some = every[start : start + SLAB + self.span]
            with np.errstate(all="ignore"):
                returns = np.where((some[1:] > 0) & (some[:-1] > 0), np.log(some[1:] / some[:-1]), np.nan)
                spread = np.lib.stride_tricks.sliding_window_view(returns, self.span).std(axis=1, ddof=1)
            at = slice(start, start + SLAB)
            yield pd.DataFrame({"symbol": key[0], "us": us[at], "close": close[at], "known": known[at], "volatility": spread})

    def close(self) -> None:
        pass


def rolling_volatility(candles: DataFrame, late: str = LATE, span: int = SPAN) -> DataFrame:
    """Settled bars (symbol, timestamp, close) with the volatility of their last returns, in append mode.

    It equals the batch operator's over the deduplicated bars that weren't late, however they are split into batches. Bars are settled
    by latest_bars(), whose state is dealt by symbol and time, so that only settled ones are put in order for each symbol.
    """
    candles.sparkSession.conf.set(*STORE)
    rows = latest_bars(candles, late).select("symbol", F.unix_micros("timestamp").alias("us"), "close", F.col("close").isNotNull().alias("known"))
    out = rows.groupBy("symbol").transformWithStateInPandas(RollingVolatility(span), "symbol string, us bigint, close double, known boolean, volatility double", "append", "None")
    # Arrays have one value for null and NaN.
    close = F.when(F.col("known"), F.coalesce("close", F.lit(float("nan"))))
    return out.select("symbol", F.timestamp_micros("us").alias("timestamp"), close.alias("close"), "volatility")


def latest_bars(candles: DataFrame, late: str = LATE) -> DataFrame:
    """Settled bars, of each symbol and time the one collected last, in append mode; state of settled ones is dropped."""
    names = [c for c in COLUMNS if c not in ("symbol", "timestamp")]
    best = timed(candles, late).groupBy("symbol", "timestamp").agg(F.max(F.struct(*PREFERENCE)).alias("best"))
    return best.select("symbol", "timestamp", *[F.col(f"best.{c}").alias(c) for c in names])


def sessions(bars: DataFrame, gap: str = GAP) -> DataFrame:
    """Runs of bars without a gap: symbol, first and last bar's time and number of bars, for one bar of each time.

    Bars of a stream need a watermark, as those of latest_bars() have; a run is given when the watermark is a gap past its end.
    A table's runs are found within days. A day's first and last run, which may go on in other days, are then put together, so that
    no task sees all bars of a symbol.
    """
    if not bars.isStreaming:
        return _table_sessions(bars.withColumn("timestamp", F.col("timestamp").cast("timestamp")).where("timestamp IS NOT NULL"), gap)
    run = bars.groupBy("symbol", F.session_window("timestamp", gap).alias("run")).agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), F.count(F.lit(1)).alias("bars"))
    return run.select("symbol", "first_ts", "last_ts", "bars")


def _table_sessions(bars: DataFrame, gap: str) -> DataFrame:
    limit = F.expr(f"INTERVAL {gap}")
    begins = lambda first, last, over: F.when(F.col(first) <= F.lag(last).over(over) + limit, 0).otherwise(1)
    merged = [F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("bars").alias("bars")]
    day = Window.partitionBy("symbol", "day_").orderBy("timestamp")
    rows = bars.select("symbol", "timestamp", F.to_date("timestamp").alias("day_"))
    rows = rows.withColumn("new_", begins("timestamp", "timestamp", day)).withColumn("run_", F.sum("new_").over(day.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy("symbol", "day_", "run_").agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), F.count(F.lit(1)).alias("bars"))
    runs = runs.withColumn("edge_", (F.col("run_") == 1) | (F.col("run_") == F.max("run_").over(Window.partitionBy("symbol", "day_"))))
    along = Window.partitionBy("symbol").orderBy("first_ts")
    edges = runs.where("edge_").withColumn("new_", begins("first_ts", "last_ts", along)).withColumn("whole_", F.sum("new_").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    joined = edges.groupBy("symbol", "whole_").agg(*merged)
    names = ["symbol", "first_ts", "last_ts", "bars"]
    return runs.where("NOT edge_").select(names).unionByName(joined.select(names))


def observed(candles: DataFrame, name: str = COUNTERS) -> DataFrame:
    """candles as they are, with counters that each batch reports: rows, malformed and slow ones, and missing volatilities."""
    count = lambda p: F.count_if(F.coalesce(p, F.lit(False)))
    seconds = F.timestamp_diff("SECOND", F.col("timestamp"), F.col("collected_at"))
    return candles.observe(name, F.count(F.lit(1)).alias("rows"), count(~well_formed()).alias("malformed"), count(seconds > SLOW).alias("slow"), count(F.col("volatility_5m").isNull()).alias("no_volatility"))


COUNTED = "batch bigint, rows bigint, malformed bigint, slow bigint, no_volatility bigint, late bigint, state bigint"


def counters_of(progress, name: str = COUNTERS) -> tuple | None:
    """From a batch's progress: its number, what observed() counted, rows dropped as late and rows held as state; of an empty batch nothing."""
    states = progress.stateOperators or ()
    late = sum(s.numRowsDroppedByWatermark for s in states)
    if not progress.numInputRows and not late:
        return None
    found = (progress.observedMetrics or {}).get(name)
    return progress.batchId, *[found[c] if found else None for c in ("rows", "malformed", "slow", "no_volatility")], late, sum(s.numRowsTotal for s in states)


class QualityCounters(StreamingQueryListener):
    """Collects the counters of all batches of a session's streams, by stream. A batch that is run again replaces its own."""

    def __init__(self, name: str = COUNTERS):
        self.name = name
        self.batches: dict[tuple[str, int], tuple] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if found := counters_of(event.progress, self.name):
            self.batches[str(event.progress.id), found[0]] = found

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(stream, *row) for (stream, _), row in sorted(self.batches.items())], f"stream string, {COUNTED}")
