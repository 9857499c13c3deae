"""The live path as a stream: batches are validated and each symbol's latest closed bar is added to the store.

Row windows don't run on streams, and the collector keeps no state but reads the trailing bars each time; so each micro-batch
is handled as a table. A replayed batch replaces its own folders of the store, so that a failure in between leaves no
duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.columns import well_formed
from ..operators.collect import FETCHED, as_json, latest_closed_bar
from ..sources.candles import COLUMNS, SCHEMA, write_store
from ..sources.exchange import CandlePages
from ..sources.shared import kept

TRAIL = 60  # minutes before a symbol's new bars that are read again for its volatility


def candle_stream(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(SCHEMA)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def exchange_stream(spark: SparkSession, options: dict, trail: int = TRAIL) -> DataFrame:
    """New bars of each symbol with the trailing ones before them, from the exchange source; options as there."""
    spark.dataSource.register(CandlePages)
    rows = spark.readStream.format("candle_pages").options(**options, trail=str(trail)).load()
    return rows.select("symbol", F.timestamp_millis("ts_ms").cast("timestamp_ntz").alias("timestamp"), "open", "high", "low", "close", "volume")


def closed_bars(batch: DataFrame, collected_at: Column | None = None, arrival: Column | None = None) -> DataFrame:
    """Latest closed bars of the symbols whose last bars are all well formed, collected now unless said otherwise.

    A batch may hold several arrivals, told apart by a column: each of them has its own closed bars, as if it had come alone.
    """
    by = () if arrival is None else ("arrival_",)
    batch = batch if arrival is None else batch.withColumn("arrival_", arrival)
    last = batch.drop("volatility_5m").withColumn("collected_at", F.current_timestamp().cast("timestamp_ntz") if collected_at is None else collected_at)
    good = batch.groupBy("symbol", *by).agg(F.bool_and(well_formed()).alias("good_")).where("good_").select("symbol", *by)
    return latest_closed_bar(last.join(good, ["symbol", *by]), FETCHED, by=by).select(COLUMNS)


def start_collector(candles: DataFrame, store: str, checkpoint: str, trigger: dict | None = None, collected_at: Column | None = None, log: str | None = None, arrival: Column | None = None) -> StreamingQuery:
    """Add each batch's closed bars to the store's days. By default a batch begins every minute.

    With an arrival, as closed_bars() takes, a batch may catch up on many of them; none may be cut by batches.
    With a log folder each record is also written there as a line of JSON, in a folder for each batch.
    """

    def put(batch: DataFrame, number: int) -> None:
        bars = closed_bars(batch, collected_at, arrival)
        if log:
            bars = kept(bars)
            as_json(bars).select("record").write.mode("overwrite").text(f"{log}/batch={number}")
        write_store(bars, store, batch=f"live-{number}")

    return candles.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 minute"})).start()


def daily_counts(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Tumbling counts by day and type. A watermark needs times with a zone."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    counted = timed.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("day"), "event_type", "n")
