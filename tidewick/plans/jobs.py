"""Jobs that the operators and sources make up: backfill of a store from an exchange, and export of a symbol's features."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.collect import PAGE, backfill_plan, existing_range, load_symbol, to_records
from ..operators.features import build_features
from ..sources.candles import SCHEMA, read_store, write_store
from ..sources.exchange import CandlePages
from ..sources.shared import kept

DAYS = 365


def default_range(start: str | None = None, end: str | None = None, days: int = DAYS, now: dt.datetime | None = None) -> tuple[dt.datetime, dt.datetime]:
    """The range of a backfill: to the end, or to the current minute's beginning, from the start, or so many days before the end."""
    last = dt.datetime.fromisoformat(end) if end else (now or dt.datetime.now(dt.timezone.utc)).replace(second=0, microsecond=0, tzinfo=None)
    return dt.datetime.fromisoformat(start) if start else last - dt.timedelta(days=days), last


def _store(spark: SparkSession, path: str) -> DataFrame:
    """The store's rows, or none where there is no store yet."""
    try:
        return read_store(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def backfill(
    spark: SparkSession, symbols: list[str], store: str, options: dict, start: str | None = None, end: str | None = None, days: int = DAYS,
    dry_run: bool = False, page: int = PAGE, now: dt.datetime | None = None,
) -> DataFrame:
    """Fetch what a store lacks before its first bar of each symbol, and add it; returns the records (of a dry run, too).

    Only the plan, one row for each symbol, reaches the driver; pages are fetched by tasks, and kept, as records are made of them by
    two passes, neither of which should ask the exchange again.
    """
    begin, last = default_range(start, end, days, now)
    requests = spark.createDataFrame([(s, begin, last) for s in symbols], "symbol string, start timestamp_ntz, end timestamp_ntz")
    plan = backfill_plan(requests, existing_range(_store(spark, store)), page)
    ms = lambda t: int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    ranges = {r["symbol"]: [ms(r["plan_start"]), ms(r["plan_end"])] for r in plan.where("plan_start < plan_end").collect()}
    spark.dataSource.register(CandlePages)
    fetched = spark.read.format("candle_pages").options(**options, ranges=json.dumps(ranges), page=str(page)).load()
    records = to_records(kept(fetched), F.current_timestamp().cast("timestamp_ntz"), page)
    return write_store(records, store, dry_run=dry_run).drop("trade_day")


def export_name(symbol: str, start: str | None = None, end: str | None = None) -> str:
    """A symbol's and range's place under a prefix: its name, and the first eight digits of both days."""
    tag = lambda day, default: (day or default).replace("-", "")[:8]
    return f"{symbol.replace('/', '_')}/{tag(start, 'all')}_{tag(end, 'now')}.parquet"


def export_symbol(view: DataFrame, symbol: str, prefix: str, start: str | None = None, end: str | None = None) -> str:
    """Write the features of a symbol's candles of a range; returns where. What was there is replaced."""
    rows = load_symbol(view, symbol, start, end).withColumn("symbol", F.lit(symbol))
    path = f"{prefix.rstrip('/')}/{export_name(symbol, start, end)}"
    build_features(rows).drop("symbol", "i", "n").write.mode("overwrite").parquet(path)
    return path
