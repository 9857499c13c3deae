"""The data-quality suite kept up by days: partial results for each symbol and day, made anew only for days that changed.

A part holds what its day says: counts, sums, extremes, mergeable sketches of quantiles, and the day's own findings (gaps,
violations, outliers), as many as a day has minutes at most. Reports merge parts without reading candles; a symbol's day is
complete in itself, and gaps between days follow from the days' first and last bars.

Quantiles over several days come from KLL sketches, which are merged: with ``K`` = 200 the rank of what is given for p lies within
``RANK_ERROR`` of p with a probability of 99 %. A sketch of up to K values is exact.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import violation, whole_minutes
from ..sources.candles import read_store, write_store
from .quality import PER_DAY, latest

K, RANK_ERROR = 200, 0.0133
LATE = 120


def _listed(wanted: Column, *fields: Column) -> Column:
    return F.array_sort(F.collect_list(F.when(wanted, F.struct(*fields))))


def day_parts(raw: DataFrame, limit: float = 5.0, times: float = 10.0, k: int = K) -> DataFrame:
    """A row for each symbol and trade_day of raw candles."""
    day = Window.partitionBy("symbol", "trade_day")
    rows = latest(raw).withColumn("trade_day", F.to_date("timestamp"))
    rows = rows.withColumns({
        "next_": F.lead("timestamp").over(day.orderBy("timestamp")), "mean_": F.avg("close").over(day), "std_": F.stddev_samp("close").over(day),
        "median_": F.percentile_approx("volume", 0.5, 10000).over(day), "s_": F.timestamp_diff("SECOND", F.col("timestamp"), F.col("collected_at")),
    })
    z = F.abs(F.try_divide(F.col("close") - F.col("mean_"), F.nullif("std_", F.lit(0.0))))
    v = F.col("volatility_5m")
    return rows.groupBy("symbol", "trade_day").agg(
        F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
        F.count(v).alias("n_volatility"), F.sum(v).alias("sum_volatility"), F.max(v).alias("max_volatility"), F.min(v).alias("min_volatility"),
        F.sum("s_").alias("sum_s"), F.max("s_").alias("max_s"), F.count_if(F.col("s_") > LATE).alias("late"),
        F.kll_sketch_agg_bigint("s_", k).alias("latencies"), F.kll_sketch_agg_double("volume", k).alias("volumes"),
        _listed(whole_minutes(F.col("timestamp"), F.col("next_")) > 1, F.col("timestamp").alias("gap_start"), F.col("next_").alias("gap_end")).alias("gaps"),
        _listed(violation().isNotNull(), *[F.col(c) for c in ("timestamp", "open", "high", "low", "close")], violation().alias("violation")).alias("violations"),
        _listed(z > limit, F.col("timestamp"), F.col("close"), F.col("mean_").alias("mean_close"), F.col("std_").alias("std_close"), z.alias("z")).alias("prices"),
        _listed(F.col("volume") > times * F.col("median_"), F.col("timestamp"), F.col("volume"), F.col("median_").alias("daily_median_vol")).alias("volumes_out"),
    )


def refresh(spark: SparkSession, store: str, parts: str, days: list[dt.date] | None = None) -> None:
    """Make the parts of these days of a store anew, or of all; other days are neither read nor written."""
    made = day_parts(read_store(spark, store, days=days))
    made.write.partitionBy("trade_day").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(parts)


def append(candles: DataFrame, store: str, parts: str, batch: str | None = None) -> list[dt.date]:
    """Add candles to a store and bring its parts up to date; returns the days that changed."""
    days = sorted(r[0] for r in candles.select(F.to_date("timestamp")).distinct().collect())
    write_store(candles, store, batch=batch)
    if days:
        refresh(candles.sparkSession, store, parts, days)
    return days


def read_parts(spark: SparkSession, parts: str) -> DataFrame:
    return spark.read.parquet(parts)


def overview(parts: DataFrame) -> DataFrame:
    found = parts.groupBy("symbol").agg(F.sum("rows").alias("total_rows"), F.min("first_ts").alias("earliest"), F.max("last_ts").alias("latest"))
    found = found.withColumn("span_days", (F.datediff("latest", "earliest") + 1).cast("bigint"))
    per_day = F.round(F.try_divide(F.col("total_rows").cast("double"), F.col("span_days")), 1)
    share = F.round(F.try_divide(F.col("total_rows") * 100.0, F.col("span_days") * float(PER_DAY)), 2)
    return found.select("*", per_day.alias("avg_rows_per_day"), share.alias("completeness_pct")).orderBy("symbol")


def daily_completeness(parts: DataFrame) -> DataFrame:
    status = F.when(F.col("rows") < 1400, "WARN").otherwise("OK")
    return parts.select("symbol", "trade_day", F.col("rows").alias("row_count"), (PER_DAY - F.col("rows")).alias("missing_minutes"), status.alias("status")).orderBy("symbol", "trade_day")


def gaps(parts: DataFrame, most: int = 50) -> DataFrame:
    """The longest holes, within days and between one day that has bars and the next."""
    within = parts.select("symbol", F.explode("gaps").alias("g")).select("symbol", "g.*")
    between = parts.select("symbol", F.col("last_ts").alias("gap_start"), F.lead("first_ts").over(Window.partitionBy("symbol").orderBy("trade_day")).alias("gap_end"))
    missing = whole_minutes(F.col("gap_start"), F.col("gap_end"))
    found = within.unionByName(between).where(missing > 1).withColumn("missing_minutes", (missing - 1).cast("bigint"))
    return found.orderBy(F.desc("missing_minutes"), "symbol", "gap_start").limit(most)


def ohlc_sanity(parts: DataFrame) -> DataFrame:
    return parts.select("symbol", F.explode("violations").alias("x")).select("symbol", "x.*").orderBy("symbol", "timestamp")


def price_outliers(parts: DataFrame) -> DataFrame:
    found = parts.select("symbol", F.explode("prices").alias("x")).select("symbol", "x.*")
    rounded = [F.round("mean_close", 6).alias("mean_close"), F.round("std_close", 6).alias("std_close"), F.round("z", 2).alias("z_score")]
    return found.select("symbol", "timestamp", "close", *rounded).orderBy(F.desc("z_score"), "symbol", "timestamp")


def volume_outliers(parts: DataFrame, most: int = 30) -> DataFrame:
    found = parts.select("symbol", F.explode("volumes_out").alias("x")).select("symbol", "x.*")
    ratio = F.round(F.try_divide(F.col("volume"), F.nullif("daily_median_vol", F.lit(0.0))), 1)
    return found.withColumn("x_median", ratio).orderBy(F.desc_nulls_last("x_median"), "symbol", "timestamp").limit(most)


def volatility_nulls(parts: DataFrame) -> DataFrame:
    rows, known = F.sum("rows"), F.sum("n_volatility")
    return parts.groupBy("symbol").agg(
        rows.alias("total_rows"), (rows - known).alias("null_volatility"), F.round((rows - known) * 100.0 / rows, 2).alias("null_pct"),
        F.round(F.try_divide(F.sum("sum_volatility"), known), 8).alias("mean_volatility"), F.round(F.max("max_volatility"), 8).alias("max_volatility"), F.round(F.min("min_volatility"), 8).alias("min_volatility"),
    ).orderBy("symbol")


def latency(parts: DataFrame) -> DataFrame:
    """As the suite's, but that the percentile comes from merged sketches."""
    p95 = F.kll_sketch_get_quantile_bigint(F.kll_merge_agg_bigint("latencies"), F.lit(0.95))
    return parts.groupBy("symbol").agg(
        F.round(F.sum("sum_s") / F.sum("rows"), 1).alias("avg_latency_s"), F.max("max_s").cast("double").alias("max_latency_s"), p95.cast("double").alias("p95_latency_s"), F.sum("late").alias("late_rows_gt2min")
    ).orderBy("symbol")


def volume_quantiles(parts: DataFrame, *ranks: float) -> DataFrame:
    """Quantiles of each symbol's volumes over all days, from merged sketches: symbol, rank, volume."""
    merged = parts.groupBy("symbol").agg(F.kll_merge_agg_double("volumes").alias("sketch"))
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("rank"), F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("volume")) for p in ranks]))
    return merged.select("symbol", each.alias("q")).select("symbol", "q.*")


def scorecard(parts: DataFrame) -> DataFrame:
    """Of the deduplicated view, which has no duplicates."""
    rows, missing = F.sum("rows"), F.sum(F.col("rows") - F.col("n_volatility"))
    found = parts.groupBy("symbol").agg(rows.alias("total_rows"), F.lit(0).cast("bigint").alias("duplicate_pairs"), F.sum(F.size("violations")).alias("ohlc_violations"), (missing * 100.0 / rows).alias("share_"))
    good = (F.col("ohlc_violations") == 0) & (F.col("share_") < 1.0)
    return found.withColumn("volatility_null_pct", F.round("share_", 2)).withColumn("overall", F.when(good, "PASS").otherwise("FAIL")).drop("share_").orderBy("symbol")
