"""Returns, volatility and model features, by row order within each symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import log_ratio, log_volume
from ..sources.shared import kept
from .sequence import chunked, dealt, numbered, own_rows, tasks_for, within

SPAN = 5
PAGE = 1000
# The order is part of the model's contract.
MODEL = ("open", "high", "low", "close", "log_return", "price_range", "log_volume", "volatility_5m")


def _return(window) -> Column:
    return log_ratio(F.col("close"), F.lag("close").over(window))


def log_returns(view: DataFrame, tasks: int | None = None) -> DataFrame:
    """Numbered rows with the logarithm of the close over that of the row before, whether or not a minute apart."""
    return own_rows(dealt(chunked(numbered(view, tasks), 1, 0), tasks).withColumn("log_return", _return(within())))


def _spread(window, span: int) -> Column:
    """Sample deviation of the last returns; null unless all are there."""
    last = window.rowsBetween(1 - span, 0)
    return F.when(F.count("log_return").over(last) == span, F.stddev_samp("log_return").over(last))


def rolling_volatility(view: DataFrame, span: int = SPAN, page: int | None = None) -> DataFrame:
    """Numbered rows with the volatility of the last returns. With a page it starts anew every so many rows, as backfill does."""
    if page:
        rows, window = numbered(view).withColumn("page", F.floor(F.col("i") / page)), Window.partitionBy("symbol", "page").orderBy("i")
        return rows.withColumn("log_return", _return(window)).withColumn("volatility", _spread(window, span)).drop("log_return")
    rows = chunked(numbered(view), span, 0).withColumn("log_return", _return(within()))
    return own_rows(rows.withColumn("volatility", _spread(within(), span))).drop("log_return")


def backfilled(rows: DataFrame, column: str, tasks: int | None = None) -> DataFrame:
    """Numbered rows with nulls of the column replaced by the symbol's next value; nulls at the end stay.

    The next value is looked for within a chunk, then taken from the first later chunk that has any. Both go through rows
    backwards, as a frame that only grows is read once, while one that begins at the row is read anew for each row.
    Chunks may be dealt to so many tasks; else adaptive execution counts them.
    """
    cut = dealt(chunked(rows, 0, 0), tasks)
    next_value = lambda value, by: F.last(value, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    every = cut.groupBy("symbol", "chunk_").agg(F.min_by(column, F.when(F.col(column).isNotNull(), F.col("i"))).alias("first_"))
    down = Window.partitionBy("symbol").orderBy(F.desc("chunk_"))
    every = every.withColumn("later_", next_value("first_", down)).select("symbol", "chunk_", F.lag("later_").over(down).alias("later_"))
    # Dealt as the chunks are; else the join may deal those anew.
    every = dealt(every, tasks)
    found = cut.withColumn("next_", next_value(column, Window.partitionBy("symbol", "chunk_").orderBy(F.desc("i")))).join(every, ["symbol", "chunk_"])
    return own_rows(found.withColumn(column, F.coalesce("next_", "later_"))).drop("next_", "later_")


def build_features(view: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows that have a return, numbered anew from 0, with returns, range and volume, and volatility filled from ahead.

    A symbol's first row has no return, nor has one whose close, or that of the row before, is not positive. Numbered rows
    are kept in the shared folder, as several steps read them. Tasks of all steps are counted by rows, those of the last also as what
    follows, such as sorting by folders as they are written, runs in them. Their number may be given, so that the view needn't be counted.
    """
    tasks = tasks or tasks_for(view)
    rows = log_returns(view.select("symbol", "timestamp", "open", "high", "low", "close", "volume", "volatility_5m"), tasks)
    derived = {"price_range": F.try_divide(F.col("high") - F.col("low"), F.nullif("close", F.lit(0.0))), "log_volume": log_volume(F.col("volume"))}
    rows = kept(rows.where("log_return IS NOT NULL").drop("i", "n").withColumns(derived))
    return backfilled(kept(numbered(rows, tasks)), "volatility_5m", tasks)
