"""The data-quality suite over the deduplicated view, for all symbols at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import VIOLATIONS, violation, whole_minutes
from .sequence import chunked, dealt, numbered, own_rows, within

PER_DAY = 1440


def latest(raw: DataFrame, tasks: int | None = None) -> DataFrame:
    """Of the candles of a symbol and minute, the one collected last; ties go to the greatest values. Minutes may be dealt to so many tasks."""
    order = [F.desc(c) for c in ("collected_at", "volume", "close", "open", "high", "low")] + [F.desc_nulls_last("volatility_5m")]
    raw = dealt(raw, tasks, "symbol", "timestamp")
    return raw.withColumn("rank_", F.row_number().over(Window.partitionBy("symbol", "timestamp").orderBy(*order))).where("rank_ = 1").drop("rank_")


def overview(view: DataFrame) -> DataFrame:
    found = view.groupBy("symbol").agg(F.count(F.lit(1)).alias("total_rows"), F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest"))
    days = (F.datediff("latest", "earliest") + 1).cast("bigint")
    found = found.withColumn("span_days", days)
    return found.select(
        "*",
        F.round(F.try_divide(F.col("total_rows").cast("double"), F.col("span_days")), 1).alias("avg_rows_per_day"),
        F.round(F.try_divide(F.col("total_rows") * 100.0, F.col("span_days") * float(PER_DAY)), 2).alias("completeness_pct"),
    ).orderBy("symbol")


def daily_completeness(view: DataFrame) -> DataFrame:
    return (
        view.groupBy("symbol", F.to_date("timestamp").alias("trade_day"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("*", (PER_DAY - F.col("row_count")).alias("missing_minutes"), F.when(F.col("row_count") < 1400, "WARN").otherwise("OK").alias("status"))
        .orderBy("symbol", "trade_day")
    )


def gaps(view: DataFrame, most: int = 50) -> DataFrame:
    """The longest holes between neighbouring bars."""
    rows = chunked(numbered(view.select("symbol", "timestamp")), 0, 1)
    following = own_rows(rows.withColumn("gap_end", F.lead("timestamp").over(within())))
    missing = whole_minutes(F.col("timestamp"), F.col("gap_end"))
    return (
        following.where(missing > 1)
        .select("symbol", F.col("timestamp").alias("gap_start"), "gap_end", (missing - 1).cast("bigint").alias("missing_minutes"))
        .orderBy(F.desc("missing_minutes"), "symbol", "gap_start")
        .limit(most)
    )


def duplicates(table: DataFrame, most: int = 20) -> DataFrame:
    return table.groupBy("symbol", "timestamp").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1").orderBy(F.desc("cnt"), "symbol", "timestamp").limit(most)


def ohlc_sanity(view: DataFrame) -> DataFrame:
    broken = " OR ".join(f"({rule})" for rule, _ in VIOLATIONS)
    return view.where(broken).select("symbol", "timestamp", "open", "high", "low", "close", violation().alias("violation")).orderBy("symbol", "timestamp")


def price_outliers(view: DataFrame, limit: float = 5.0) -> DataFrame:
    """Closes over so many daily standard deviations from the daily mean."""
    day = Window.partitionBy("symbol", F.to_date("timestamp"))
    rows = view.select("symbol", "timestamp", "close", F.avg("close").over(day).alias("mean_close"), F.stddev_samp("close").over(day).alias("std_close"))
    z = F.abs(F.try_divide(F.col("close") - F.col("mean_close"), F.nullif("std_close", F.lit(0.0))))
    return (
        rows.withColumn("z", z).where(F.col("z") > limit)
        .select("symbol", "timestamp", "close", F.round("mean_close", 6).alias("mean_close"), F.round("std_close", 6).alias("std_close"), F.round("z", 2).alias("z_score"))
        .orderBy(F.desc("z_score"), "symbol", "timestamp")
    )


def volume_outliers(view: DataFrame, times: float = 10.0, most: int = 30) -> DataFrame:
    """Volumes over so many times the daily median; with a median of 0 any volume is, without a ratio."""
    day = Window.partitionBy("symbol", F.to_date("timestamp"))
    rows = view.select("symbol", "timestamp", "volume", F.percentile_approx("volume", 0.5, 10000).over(day).alias("daily_median_vol"))
    ratio = F.round(F.try_divide(F.col("volume"), F.nullif("daily_median_vol", F.lit(0.0))), 1)
    return rows.where(F.col("volume") > times * F.col("daily_median_vol")).withColumn("x_median", ratio).orderBy(F.desc_nulls_last("x_median"), "symbol", "timestamp").limit(most)


def volatility_nulls(view: DataFrame) -> DataFrame:
    missing = F.count_if(F.col("volatility_5m").isNull())
    v = F.col("volatility_5m")
    return view.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_rows"),
        missing.alias("null_volatility"),
        F.round(missing * 100.0 / F.count(F.lit(1)), 2).alias("null_pct"),
        F.round(F.avg(v), 8).alias("mean_volatility"),
        F.round(F.max(v), 8).alias("max_volatility"),
        F.round(F.min(v), 8).alias("min_volatility"),
    ).orderBy("symbol")


def latency(view: DataFrame, late: int = 120) -> DataFrame:
    rows = view.select("symbol", F.timestamp_diff("SECOND", F.col("timestamp"), F.col("collected_at")).alias("s"))
    return rows.groupBy("symbol").agg(
        F.round(F.avg("s"), 1).alias("avg_latency_s"),
        F.max("s").cast("double").alias("max_latency_s"),
        F.percentile_approx("s", 0.95, 10000).cast("double").alias("p95_latency_s"),
        F.count_if(F.col("s") > late).alias("late_rows_gt2min"),
    ).orderBy("symbol")


def scorecard(table: DataFrame) -> DataFrame:
    """PASS or FAIL for each symbol, in one pass: candles are first counted by minute, so that any table can be scored."""
    per_minute = table.groupBy("symbol", "timestamp").agg(
        F.count(F.lit(1)).alias("c"), F.count_if(violation().isNotNull()).alias("v"), F.count_if(F.col("volatility_5m").isNull()).alias("m")
    )
    found = per_minute.groupBy("symbol").agg(
        F.sum("c").alias("total_rows"),
        F.count_if(F.col("c") > 1).alias("duplicate_pairs"),
        F.sum("v").alias("ohlc_violations"),
        F.round(F.sum("m") * 100.0 / F.sum("c"), 2).alias("volatility_null_pct"),
        (F.sum("m") * 100.0 / F.sum("c")).alias("share_"),
    )
    good = (F.col("duplicate_pairs") == 0) & (F.col("ohlc_violations") == 0) & (F.col("share_") < 1.0)
    return found.withColumn("overall", F.when(good, "PASS").otherwise("FAIL")).drop("share_").orderBy("symbol")
