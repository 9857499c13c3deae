"""Gap-free sliding windows, their normalisation, labels and splits. Windows are kept as end points, not as copies of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import kept
from .sequence import CHUNK, chunked, dealt, own_rows, tasks_for, within

LOOKBACK, HORIZON = 360, 30
EPSILON = 1e-8
PRICES = ("open", "high", "low", "close")
SCORED = ("log_return", "price_range", "log_volume", "volatility_5m")
SPLITS = ("train", "val", "test")
SHARD_ROWS = 65_536


def _usable(lookback: int, horizon: int) -> Column:
    """Whether row i ends a window: its rows i - lookback to i + horizon - 1 lie a minute apart.

    Rows without a gap between them are an island, told by a running count of gaps.
    """
    island = F.sum(F.when(F.col("timestamp") == F.lag("timestamp").over(within()) + F.expr("INTERVAL 1 MINUTE"), 0).otherwise(1)).over(within())
    # The last end point that would fit, n - horizon, is left out.
    return (F.col("i") >= lookback) & (F.col("i") < F.col("n") - horizon) & (F.lag("isle_", lookback).over(within()) == F.lead("isle_", horizon - 1).over(within())), island


def _framed(features: DataFrame, lookback: int, horizon: int, prepared: dict[str, Column] | None = None, **columns: Column) -> DataFrame:
    """Rows of usable end points with the columns, which may look back and ahead as far as the window and the horizon.

    What they look at may be prepared for all rows of a chunk first. Tasks are counted by rows, so that features should be kept.
    """
    usable, island = _usable(lookback, horizon)
    # One row more before, as the first in a chunk can't tell whether it follows a gap.
    rows = dealt(chunked(features, lookback + 1, horizon), tasks_for(features)).withColumn("isle_", island).withColumns(prepared or {})
    return own_rows(rows.withColumns({"usable_": usable, **columns})).where("usable_").drop("usable_", "isle_", *(prepared or ()))


def valid_indices(features: DataFrame, lookback: int = LOOKBACK, horizon: int = HORIZON) -> DataFrame:
    """Usable end points: symbol, i and the time of the window's last row."""
    return _framed(features.select("symbol", "timestamp", "i", "n"), lookback, horizon, ts=F.lag("timestamp").over(within())).select("symbol", "i", "ts")


def _label(horizon: int, back: bool = False) -> Column:
    frame = within().rowsBetween(-horizon, -1) if back else within().rowsBetween(0, horizon - 1)
    return F.ln(F.stddev_pop("log_return").over(frame) + EPSILON)


def realized_vol_label(features: DataFrame, lookback: int = LOOKBACK, horizon: int = HORIZON) -> DataFrame:
    """Logarithm of the population deviation of the next returns, for each usable end point."""
    rows = features.select("symbol", "timestamp", "i", "n", "log_return")
    return _framed(rows, lookback, horizon, y=_label(horizon)).select("symbol", "i", "y")


def persistence(features: DataFrame, lookback: int = LOOKBACK, horizon: int = HORIZON) -> DataFrame:
    """Labels with the same measure of the last returns as a prediction. lookback must be horizon or more."""
    rows = features.select("symbol", "timestamp", "i", "n", "log_return")
    return _framed(rows, lookback, horizon, y=_label(horizon), prediction=_label(horizon, back=True)).select("symbol", "i", "y", "prediction")


def _moments(lookback: int) -> tuple[dict[str, Column], dict[str, Column]]:
    """What to prepare for each row, and from that the mean and the population deviation of each column over the window before it.

    Rows are cut into blocks of the window's length, so that a window is the end of one block and the beginning of the next.
    For each row the number, mean and sum of squared differences of its block up to it, and from it on, come from frames that only grow,
    which are read once; two of them make up a window's. So time doesn't depend on the window's length, and no large sums cancel.
    """
    block = Window.partitionBy("symbol", "chunk_", F.floor(F.col("i") / lookback))
    prepared, stats = {}, {}
    for c in SCORED:
        for name, order in (("head", block.orderBy("i")), ("tail", block.orderBy(F.desc("i")))):
            frame = order.rowsBetween(Window.unboundedPreceding, 0)
            number = F.count(c).over(frame)
            prepared[f"{name}_{c}_"] = F.struct(number.alias("n"), F.avg(c).over(frame).alias("mean"), (number * F.var_pop(c).over(frame)).alias("squares"), F.min(c).over(frame).alias("lo"), F.max(c).over(frame).alias("hi"))
        # The end of the earlier block is missing where the window is a whole block.
        one, other = F.lag(f"head_{c}_").over(within()), F.when(F.col("i") % lookback != 0, F.lag(f"tail_{c}_", lookback).over(within()))
        part = lambda x, field: F.coalesce(x[field], F.lit(0.0))
        n, m = part(one, "n"), part(other, "n")
        apart = part(one, "mean") - part(other, "mean")
        every = F.nullif(n + m, F.lit(0.0))
        stats[f"mean_{c}"] = (n * part(one, "mean") + m * part(other, "mean")) / every
        std = F.sqrt((part(one, "squares") + part(other, "squares") + apart * apart * n * m / every) / every)
        # Exactly 0 where flat: means of equal values may differ in the last bit.
        stats[f"std_{c}"] = F.when(F.least(one["lo"], other["lo"]) == F.greatest(one["hi"], other["hi"]), 0.0).otherwise(std)
    return prepared, stats


def _statistics(lookback: int) -> tuple[dict[str, Column], dict[str, Column]]:
    """What normalisation needs, and what to prepare for it."""
    prepared, stats = _moments(lookback)
    return prepared, {"first_close": F.lag("close", lookback).over(within()), **stats}


def window_norm_stats(features: DataFrame, lookback: int = LOOKBACK, horizon: int = HORIZON) -> DataFrame:
    """What normalisation needs for each usable end point: the first close, means and population deviations over the window."""
    prepared, stats = _statistics(lookback)
    rows = features.select("symbol", "timestamp", "i", "n", "close", *SCORED)
    return _framed(rows, lookback, horizon, prepared, **stats).select("symbol", "i", *stats)


def _window(lookback: int, columns: tuple[str, ...]) -> Column:
    """The rows of the window before a row, in order."""
    return F.collect_list(F.struct(*columns)).over(within().rowsBetween(-lookback, -1))


def _spelled(ends: DataFrame, *others: str) -> DataFrame:
    """A row for each end point and row of its window_, k from 0."""
    rows = ends.select("symbol", "i", *others, F.posexplode("window_").alias("k", "row_"))
    return rows.select("symbol", "i", F.col("k").cast("bigint").alias("k"), "row_.*", *others)


def windows_long(features: DataFrame, columns: tuple[str, ...], lookback: int, horizon: int) -> DataFrame:
    """A row for each usable end point and row of its window, k from 0. For short windows: it has lookback times the rows.

    An end point's rows are there when its chunk is gone through, so that they needn't be joined to it.
    """
    rows = features.select("symbol", "timestamp", "i", "n", *columns)
    return _spelled(_framed(rows, lookback, horizon, window_=_window(lookback, ("timestamp", *columns))))


def normalized_windows(features: DataFrame, lookback: int, horizon: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Windows in long form: prices over the first close (as they are where that is 0), others as z-scores (0 where flat).

    Some of the statistics may be kept beside them.
    """
    prepared, stats = _statistics(lookback)
    rows = features.select("symbol", "timestamp", "i", "n", *PRICES, *SCORED)
    rows = _spelled(_framed(rows, lookback, horizon, prepared, window_=_window(lookback, (*PRICES, *SCORED)), **stats), *stats)
    price = lambda c: F.when(F.col("first_close") != 0, F.try_divide(F.col(c), F.col("first_close"))).otherwise(F.col(c))
    score = lambda c: F.when(F.col(f"std_{c}") > 0, (F.col(c) - F.col(f"mean_{c}")) / F.col(f"std_{c}")).otherwise(0.0)
    return rows.select("symbol", "i", "k", *[price(c).alias(c) for c in PRICES], *[score(c).alias(c) for c in SCORED], *keep)


def time_split(indices: DataFrame, val: float = 0.15, test: float = 0.15) -> DataFrame:
    """Index rows (symbol, i, ...) with their split, by order of i: the last part is test, the one before val, the rest train.

    Ranks are taken within runs of a fixed number of i and shifted by the counts of earlier runs. Index rows are kept in the shared
    folder, as they are counted, for runs and for tasks, before they are placed.
    """
    indices = kept(indices)
    tasks, runs = tasks_for(indices), indices.withColumn("run_", F.floor(F.col("i") / CHUNK))
    whole = Window.partitionBy("symbol")
    before = F.coalesce(F.sum("c_").over(whole.orderBy("run_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = runs.groupBy("symbol", "run_").agg(F.count(F.lit(1)).alias("c_")).select("symbol", "run_", before.alias("before_"), F.sum("c_").over(whole).alias("all_"))
    runs, sizes = (dealt(x, tasks, "symbol", "run_") for x in (runs, sizes))
    placed = runs.withColumn("at_", F.row_number().over(Window.partitionBy("symbol", "run_").orderBy("i"))).join(sizes, ["symbol", "run_"])
    rank, n_test, n_val = F.col("before_") + F.col("at_"), F.floor(F.col("all_") * test), F.floor(F.col("all_") * val)
    split = F.when(rank > F.col("all_") - n_test, "test").when(rank > F.col("all_") - n_test - n_val, "val").otherwise("train")
    return placed.withColumn("split", split).drop("run_", "at_", "before_", "all_")


def window_dataset(features: DataFrame, lookback: int = LOOKBACK, horizon: int = HORIZON) -> DataFrame:
    """End points with label and split; the windows themselves stay in the feature table."""
    return time_split(realized_vol_label(features, lookback, horizon))


def training_batches(dataset: DataFrame, size: int = 64, seed: int = 0, shards: int | None = None) -> DataFrame:
    """Dataset rows with shard and batch: train in random order, the others by time. Batches are cut within shards of rows.

    Unless said otherwise there is a shard for every ``SHARD_ROWS`` rows, so that none grows with the table, and as many tasks as shards. The order of train is that of a digest of
    seed, symbol and i, so that a seed gives the same batches anywhere; shards of the others hold runs of 4,096 i.
    """
    if shards is None:
        dataset = kept(dataset)
        shards = max(1, -(-dataset.count() // SHARD_ROWS))
    key = F.when(F.col("split") == "train", F.md5(F.concat_ws("|", F.lit(seed).cast("string"), "symbol", F.col("i").cast("string"))))
    number = F.coalesce(F.conv(F.substring("key_", 1, 15), 16, 10).cast("bigint"), F.floor(F.col("i") / 4096))
    rows = dataset.withColumn("key_", key).withColumn("shard", F.pmod(number, F.lit(shards)))
    rows = dealt(rows, max(rows.sparkSession.sparkContext.defaultParallelism, shards), "split", "shard")
    order = Window.partitionBy("split", "shard").orderBy("key_", "symbol", "i")
    return rows.withColumn("batch", F.floor((F.row_number().over(order) - 1) / size)).drop("key_")
