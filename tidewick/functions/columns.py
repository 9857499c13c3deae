"""Column functions on candles, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First match wins.
VIOLATIONS = (
    ("high < open", "high < open"),
    ("high < close", "high < close"),
    ("low > open", "low > open"),
    ("low > close", "low > close"),
    ("high < low", "high < low"),
    ("open <= 0", "non-positive open"),
    ("close <= 0", "non-positive close"),
    ("volume < 0", "negative volume"),
)


def violation() -> Column:
    """The first rule that a candle breaks, or null."""
    chain = F.when(F.expr(VIOLATIONS[0][0]), VIOLATIONS[0][1])
    for rule, name in VIOLATIONS[1:]:
        chain = chain.when(F.expr(rule), name)
    return chain


def log_ratio(value: Column, before: Column) -> Column:
    """Logarithm of value over before; null where either is not positive."""
    return F.when((value > 0) & (before > 0), F.ln(value / before))


def log_volume(volume: Column) -> Column:
    return F.when(volume > -1, F.log1p(volume))


def whole_minutes(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, cut off."""
    return F.timestamp_diff("MINUTE", start, end)


def well_formed() -> Column:
    """The collector's gate for one candle: nothing missing, high and low in order, no negative volume. A NaN volume passes."""
    whole = F.lit(True)
    for c in ("open", "high", "low", "close"):
        whole = whole & F.col(c).isNotNull() & ~F.isnan(c)
    return F.coalesce(whole & F.col("timestamp").isNotNull() & F.col("volume").isNotNull() & F.expr("high >= open AND high >= close AND low <= open AND low <= close AND high >= low AND NOT (volume < 0)"), F.lit(False))


def path_name(symbol: Column) -> Column:
    return F.replace(symbol, F.lit("/"), F.lit("_"))


def day_tag(day: Column, default: str) -> Column:
    """The first eight digits of a date's text, or the default."""
    return F.coalesce(F.substring(F.replace(day, F.lit("-"), F.lit("")), 1, 8), F.lit(default))
