"""What the collector and the backfill do with fetched candles, for all symbols at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import log_ratio, well_formed
from .features import SPAN, rolling_volatility
from .sequence import numbered

FETCHED = 7
PAGE = 1000


def validate_batches(candles: DataFrame, batch: Column) -> DataFrame:
    """A row for each symbol and batch: its rows and whether all are well formed. One bad candle rejects its batch."""
    return candles.groupBy("symbol", batch.alias("batch")).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bool_and(well_formed()), F.lit(False)).alias("valid"))


def batch_verdicts(symbols: DataFrame, candles: DataFrame) -> DataFrame:
    """Symbols with whether their one batch is valid; no candles at all is not."""
    found = candles.groupBy("symbol").agg(F.bool_and(well_formed()).alias("valid"))
    return symbols.join(found, "symbol", "left").withColumn("valid", F.coalesce("valid", F.lit(False)))


def latest_closed_bar(candles: DataFrame, fetched: int = FETCHED, span: int = SPAN, by: tuple[str, ...] = ()) -> DataFrame:
    """The second newest of each symbol's last candles (the newest where there is one), with the volatility over these candles.

    With columns by, of each symbol and group of these.
    """
    newest = Window.partitionBy("symbol", *by).orderBy(F.desc("timestamp"))
    last = candles.withColumn("back_", F.row_number().over(newest)).where(F.col("back_") <= fetched)
    order = Window.partitionBy("symbol", *by).orderBy("timestamp")
    recent = order.rowsBetween(1 - span, 0)
    rows = last.withColumn("r_", log_ratio(F.col("close"), F.lag("close").over(order)))
    rows = rows.withColumn("volatility_5m", F.when(F.count("r_").over(recent) == span, F.stddev_samp("r_").over(recent)))
    rows = rows.withColumn("count_", F.count(F.lit(1)).over(Window.partitionBy("symbol", *by)))
    return rows.where("back_ = least(2, count_)").drop("back_", "r_", "count_")


def to_records(candles: DataFrame, collected_at: Column, page: int | None = PAGE) -> DataFrame:
    """Raw candles (symbol, ts_ms, prices, volume) as table rows. Volatility starts anew on each page; with page None it runs on."""
    typed = candles.select("symbol", F.timestamp_millis("ts_ms").cast("timestamp_ntz").alias("timestamp"), *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")])
    rows = rolling_volatility(typed, page=page)
    return rows.select("symbol", "timestamp", "open", "high", "low", "close", "volume", F.nanvl("volatility", F.lit(None).cast("double")).alias("volatility_5m"), collected_at.alias("collected_at"))


def load_symbol(view: DataFrame, symbol: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """A symbol's candles by time, from start on and before end, each of which may be left out."""
    rows = view.where(F.col("symbol") == symbol)
    if start:
        rows = rows.where(F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        rows = rows.where(F.col("timestamp") < F.lit(end).cast("timestamp_ntz"))
    return rows.select("timestamp", "open", "high", "low", "close", "volume", "volatility_5m").orderBy("timestamp")


def as_json(records: DataFrame) -> DataFrame:
    return records.select("symbol", "timestamp", F.to_json(F.struct("*")).alias("record"))


def existing_range(raw: DataFrame) -> DataFrame:
    return raw.groupBy("symbol").agg(F.min("timestamp").alias("existing_min"), F.max("timestamp").alias("existing_max"))


def backfill_plan(requests: DataFrame, existing: DataFrame, page: int = PAGE) -> DataFrame:
    """From requests (symbol, start, end): what is left to fetch, by pages of so many minutes.

    Where bars exist and the request begins at or after the first of them, its end is cut to the minute before that bar, so
    that nothing is left; a request that begins before keeps its end, and what overlaps is collected again.
    """
    cut = F.when(F.col("existing_min").isNotNull() & (F.col("start") >= F.col("existing_min")), F.least("end", F.expr("existing_min - INTERVAL 1 MINUTE"))).otherwise(F.col("end"))
    rows = requests.join(existing, "symbol", "left").withColumn("plan_end", cut)
    minutes = F.greatest(F.timestamp_diff("MINUTE", F.col("start"), F.col("plan_end")), F.lit(0)).cast("bigint")
    return rows.select("symbol", "existing_min", "existing_max", F.col("start").alias("plan_start"), "plan_end", minutes.alias("minutes"), F.ceil(minutes / page).alias("pages"))


def page_slices(plan: DataFrame, page: int = PAGE) -> DataFrame:
    """A row for each page of a plan: since (inclusive) and until (exclusive), which readers can fetch side by side."""
    rows = plan.where("pages > 0").select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pages") - 1)).alias("page"))
    since = F.expr(f"plan_start + make_interval(0, 0, 0, 0, 0, CAST(page * {page} AS INT), 0)")
    return rows.select("symbol", "page", since.alias("since"), F.least(F.expr(f"plan_start + make_interval(0, 0, 0, 0, 0, CAST((page + 1) * {page} AS INT), 0)"), F.col("plan_end")).alias("until"))


def cursor_pages(candles: DataFrame, page: int = PAGE) -> DataFrame:
    """The pages that a cursor walks through: each begins a minute after the last bar of the one before."""
    rows = numbered(candles.select("symbol", "timestamp")).groupBy("symbol", F.floor(F.col("i") / page).alias("page")).agg(F.count(F.lit(1)).alias("candles"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))
    before = F.lag("last_ts").over(Window.partitionBy("symbol").orderBy("page"))
    return rows.withColumn("since", F.coalesce(before + F.expr("INTERVAL 1 MINUTE"), F.col("first_ts")))
