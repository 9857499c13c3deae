"""Names of the candle queries, each with its Spark plan and, where SQL can express it, its DuckDB counterpart.

Counterparts see only the raw tables, so that each begins with the derived candles as common table expressions: raw, the
deduplicated view ohlcv, and for some the feature rows feats. What passes through a logarithm or a deviation is rounded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import day_tag, path_name
from ..operators import collect, features, incremental, metrics, quality, sequence, tensors, windows
from ..sources import candles as source
from ..sources import exchange, replay
from ..sources.shared import kept, shared_folder
from ..streaming import live, state
from . import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Short windows, so that the small tables have some in every symbol; the operators' defaults are 360 and 30.
L, H = 36, 6
LONG = 4
SYMBOL, START, END = "5-LOW", "2024-01-01 06:00:00", "2024-01-02 06:00:00"
RAW = f"WITH {source.STEPS.format(NTZ='TIMESTAMP')}, raw AS ({source.DERIVED})"
VIEW = f"""{RAW}, ohlcv AS (
  SELECT * FROM raw QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol, timestamp
    ORDER BY collected_at DESC, volume DESC, close DESC, open DESC, high DESC, low DESC, volatility_5m DESC NULLS LAST) = 1
)"""
RETURNS = f"""{VIEW}, rets AS (
  SELECT *, ROW_NUMBER() OVER w - 1 AS i, LAG(close) OVER w AS prev,
         CASE WHEN close > 0 AND LAG(close) OVER w > 0 THEN LN(close / LAG(close) OVER w) END AS log_return
  FROM ohlcv WINDOW w AS (PARTITION BY symbol ORDER BY timestamp)
)"""
FEATS = f"""{RETURNS}, feats AS (
  SELECT symbol, timestamp, open, high, low, close, volume,
         FIRST_VALUE(volatility_5m IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS volatility_5m,
         ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS i, COUNT(*) OVER (PARTITION BY symbol) AS n, log_return, (high - low) / NULLIF(close, 0) AS price_range,
         CASE WHEN volume > -1 THEN LN(1 + volume) END AS log_volume
  FROM rets WHERE log_return IS NOT NULL
)"""
ISLES = f"""{FEATS}, steps AS (
  SELECT *, CASE WHEN timestamp = LAG(timestamp) OVER (PARTITION BY symbol ORDER BY i) + INTERVAL 1 MINUTE THEN 0 ELSE 1 END AS hole FROM feats
), isles AS (
  SELECT *, SUM(hole) OVER (PARTITION BY symbol ORDER BY i) AS isle FROM steps
)"""


def _valid(lookback: int, horizon: int) -> str:
    return f"""i >= {lookback} AND i < n - {horizon} AND LAG(isle, {lookback}) OVER w = LEAD(isle, {horizon - 1}) OVER w"""


def _ends(lookback: int, horizon: int, columns: str = "LAG(timestamp) OVER w AS ts") -> str:
    return f"""{ISLES}, ends AS (
  SELECT symbol, i, timestamp, {columns}, {_valid(lookback, horizon)} AS ok FROM isles WINDOW w AS (PARTITION BY symbol ORDER BY i)
)"""


def _label(horizon: int) -> str:
    return f"LN(STDDEV_POP(log_return) OVER (PARTITION BY symbol ORDER BY i ROWS BETWEEN CURRENT ROW AND {horizon - 1} FOLLOWING) + 1e-8) AS y"


def _persistence(horizon: int) -> str:
    return f"LN(STDDEV_POP(log_return) OVER (PARTITION BY symbol ORDER BY i ROWS BETWEEN {horizon} PRECEDING AND 1 PRECEDING) + 1e-8) AS prediction"


def _split(lookback: int, horizon: int) -> str:
    return f"""{_ends(lookback, horizon, _label(horizon) + ', ' + _persistence(horizon))}, ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY i) AS r, COUNT(*) OVER (PARTITION BY symbol) AS c FROM ends WHERE ok
), dataset AS (
  SELECT symbol, i, y, prediction, CASE WHEN r > c - FLOOR(c * 0.15e0) THEN 'test' WHEN r > c - FLOOR(c * 0.15e0) - FLOOR(c * 0.15e0) THEN 'val' ELSE 'train' END AS split FROM ranked
)"""


LABEL, SPLIT = _label(H), _split(L, H)


def query(sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.derived(spark, sf_dir)


def tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for the candles, by the number of orders, of which a 211th comes twice."""
    return sequence.tasks_for(spark.read.parquet(f"{sf_dir}/orders.parquet"))


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.latest(raw(spark, sf_dir), tasks(spark, sf_dir))


def feats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, kept, as most queries on windows read them several times."""
    return kept(features.build_features(view(spark, sf_dir), tasks(spark, sf_dir)))


def rounded(df: DataFrame, *columns: str, places: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


@query(f"{RAW} SELECT * FROM raw")
def fixture(spark, sf_dir):
    return raw(spark, sf_dir)


@query(f"{VIEW} SELECT * FROM ohlcv")
def dedup_latest(spark, sf_dir):
    return view(spark, sf_dir)


@query(f"""{VIEW} SELECT *, ROUND(total_rows::DOUBLE / NULLIF(span_days, 0), 1) AS avg_rows_per_day, ROUND(total_rows * 100.0e0 / NULLIF(span_days * 1440.0e0, 0), 2) AS completeness_pct
FROM (SELECT symbol, COUNT(*) AS total_rows, MIN(timestamp) AS earliest, MAX(timestamp) AS latest, MAX(timestamp)::DATE - MIN(timestamp)::DATE + 1 AS span_days FROM ohlcv GROUP BY symbol)""")
def dq_overview(spark, sf_dir):
    return quality.overview(view(spark, sf_dir))


@query(f"""{VIEW} SELECT symbol, timestamp::DATE AS trade_day, COUNT(*) AS row_count, 1440 - COUNT(*) AS missing_minutes, CASE WHEN COUNT(*) < 1400 THEN 'WARN' ELSE 'OK' END AS status FROM ohlcv GROUP BY ALL""")
def dq_daily_completeness(spark, sf_dir):
    return quality.daily_completeness(view(spark, sf_dir))


@query(f"""{VIEW} SELECT symbol, timestamp AS gap_start, gap_end, DATE_SUB('minute', timestamp, gap_end) - 1 AS missing_minutes
FROM (SELECT symbol, timestamp, LEAD(timestamp) OVER (PARTITION BY symbol ORDER BY timestamp) AS gap_end FROM ohlcv)
WHERE DATE_SUB('minute', timestamp, gap_end) > 1 ORDER BY missing_minutes DESC, symbol, gap_start LIMIT 50""")
def dq_gaps(spark, sf_dir):
    return quality.gaps(view(spark, sf_dir))


_TWICE = "SELECT symbol, timestamp, COUNT(*) AS cnt FROM {} GROUP BY ALL HAVING COUNT(*) > 1 ORDER BY cnt DESC, symbol, timestamp LIMIT 20"


@query(f"{VIEW} {_TWICE.format('ohlcv')}")
def dq_duplicates(spark, sf_dir):
    return quality.duplicates(view(spark, sf_dir))


@query(f"{RAW} {_TWICE.format('raw')}")
def dq_duplicates_raw(spark, sf_dir):
    return quality.duplicates(raw(spark, sf_dir))


_BROKEN = "CASE " + " ".join(f"WHEN {rule} THEN '{name}'" for rule, name in quality.VIOLATIONS) + " END"


@query(f"{VIEW} SELECT symbol, timestamp, open, high, low, close, {_BROKEN} AS violation FROM ohlcv WHERE {_BROKEN} IS NOT NULL")
def dq_ohlc_sanity(spark, sf_dir):
    return quality.ohlc_sanity(view(spark, sf_dir))


@query(f"""{VIEW} SELECT symbol, timestamp, o.close, ROUND(m, 6) AS mean_close, ROUND(s, 6) AS std_close, ROUND(ABS((o.close - m) / NULLIF(s, 0)), 2) AS z_score
FROM ohlcv o JOIN (SELECT symbol, timestamp::DATE AS day, AVG(close) AS m, STDDEV_SAMP(close) AS s FROM ohlcv GROUP BY ALL) d USING (symbol)
WHERE o.timestamp::DATE = d.day AND ABS((o.close - m) / NULLIF(s, 0)) > 5""")
def dq_price_outliers(spark, sf_dir):
    return quality.price_outliers(view(spark, sf_dir))


@query(f"""{VIEW} SELECT symbol, timestamp, volume, med AS daily_median_vol, ROUND(volume / NULLIF(med, 0), 1) AS x_median
FROM ohlcv o JOIN (SELECT symbol, timestamp::DATE AS day, QUANTILE_DISC(volume, 0.5) AS med FROM ohlcv GROUP BY ALL) d USING (symbol)
WHERE o.timestamp::DATE = d.day AND volume > 10 * med ORDER BY x_median DESC NULLS LAST, symbol, timestamp LIMIT 30""")
def dq_volume_outliers(spark, sf_dir):
    return quality.volume_outliers(view(spark, sf_dir))


@query(f"""{VIEW} SELECT symbol, COUNT(*) AS total_rows, COUNT(*) - COUNT(volatility_5m) AS null_volatility, ROUND((COUNT(*) - COUNT(volatility_5m)) * 100.0e0 / COUNT(*), 2) AS null_pct,
ROUND(AVG(volatility_5m), 8) AS mean_volatility, ROUND(MAX(volatility_5m), 8) AS max_volatility, ROUND(MIN(volatility_5m), 8) AS min_volatility FROM ohlcv GROUP BY symbol""")
def dq_volatility_nulls(spark, sf_dir):
    return quality.volatility_nulls(view(spark, sf_dir))


@query(f"""{VIEW} SELECT symbol, ROUND(AVG(s), 1) AS avg_latency_s, MAX(s)::DOUBLE AS max_latency_s, QUANTILE_DISC(s, 0.95)::DOUBLE AS p95_latency_s, COUNT(*) FILTER (s > 120) AS late_rows_gt2min
FROM (SELECT symbol, DATE_SUB('second', timestamp, collected_at) AS s FROM ohlcv) GROUP BY symbol""")
def dq_latency(spark, sf_dir):
    return quality.latency(view(spark, sf_dir))


def _card(table: str) -> str:
    return f"""SELECT symbol, t.c AS total_rows, COALESCE(d.c, 0) AS duplicate_pairs, COALESCE(v.c, 0) AS ohlc_violations, ROUND(p, 2) AS volatility_null_pct,
CASE WHEN COALESCE(d.c, 0) = 0 AND COALESCE(v.c, 0) = 0 AND p < 1.0 THEN 'PASS' ELSE 'FAIL' END AS overall
FROM (SELECT symbol, COUNT(*) AS c, (COUNT(*) - COUNT(volatility_5m)) * 100.0e0 / COUNT(*) AS p FROM {table} GROUP BY symbol) t
LEFT JOIN (SELECT symbol, COUNT(*) AS c FROM (SELECT symbol, timestamp FROM {table} GROUP BY ALL HAVING COUNT(*) > 1) GROUP BY symbol) d USING (symbol)
LEFT JOIN (SELECT symbol, COUNT(*) AS c FROM {table} WHERE {_BROKEN} IS NOT NULL GROUP BY symbol) v USING (symbol)"""


@query(f"{VIEW} {_card('ohlcv')}")
def dq_scorecard(spark, sf_dir):
    return quality.scorecard(view(spark, sf_dir))


@query(f"{RAW} {_card('raw')}")
def dq_scorecard_raw(spark, sf_dir):
    return quality.scorecard(raw(spark, sf_dir))


def _between(df: DataFrame) -> DataFrame:
    return df.where((F.col("timestamp") >= F.lit(START).cast("timestamp_ntz")) & (F.col("timestamp") < F.lit(END).cast("timestamp_ntz")))


_SLICE = f"timestamp >= TIMESTAMP '{START}' AND timestamp < TIMESTAMP '{END}'"


@query(f"{VIEW} SELECT timestamp, open, high, low, close, volume, volatility_5m FROM ohlcv WHERE symbol = '{SYMBOL}' AND {_SLICE}")
def load_symbol(spark, sf_dir):
    return collect.load_symbol(view(spark, sf_dir), SYMBOL, START, END)


@query(f"{VIEW} SELECT timestamp, open, high, low, close, volume, volatility_5m FROM ohlcv WHERE symbol = '{SYMBOL}'")
def load_symbol_all(spark, sf_dir):
    """Without bounds."""
    return collect.load_symbol(view(spark, sf_dir), SYMBOL)


@query(f"{VIEW} SELECT timestamp, open, high, low, close, volume, volatility_5m FROM ohlcv WHERE symbol = '{SYMBOL}' AND {_SLICE}")
def load_symbol_sql(spark, sf_dir):
    """The same by a parameterised statement."""
    columns = ", ".join(("timestamp", *source.PRICES, "volume", "volatility_5m"))
    text = f"SELECT {columns} FROM {{view}} WHERE symbol = :symbol AND timestamp >= CAST(:start AS TIMESTAMP_NTZ) AND timestamp < CAST(:end AS TIMESTAMP_NTZ) ORDER BY timestamp"
    return spark.sql(text, args={"symbol": SYMBOL, "start": START, "end": END}, view=view(spark, sf_dir))


@query(f"{VIEW} SELECT * FROM ohlcv WHERE {_SLICE}")
def time_slice(spark, sf_dir):
    return _between(view(spark, sf_dir))


@query(f"{RAW} SELECT symbol, MIN(timestamp) AS existing_min, MAX(timestamp) AS existing_max FROM raw GROUP BY symbol")
def existing_range(spark, sf_dir):
    return collect.existing_range(raw(spark, sf_dir))


# One request that begins before what exists, one inside it, one for a symbol without bars.
REQUESTS = (("1-URGENT", "2023-12-29 00:00:00", "2024-01-03 00:00:00"), ("2-HIGH", "2024-01-01 12:00:00", "2024-01-05 00:00:00"), ("NEW", "2024-01-01 00:00:00", "2024-01-02 10:30:00"))
_PLAN = f"""{RAW}, requests(symbol, s, e) AS (VALUES {', '.join(f"('{a}', TIMESTAMP '{b}', TIMESTAMP '{c}')" for a, b, c in REQUESTS)}),
planned AS (SELECT symbol, existing_min, existing_max, s AS plan_start,
  CASE WHEN s >= existing_min THEN LEAST(e, existing_min - INTERVAL 1 MINUTE) ELSE e END AS plan_end
  FROM requests LEFT JOIN (SELECT symbol, MIN(timestamp) AS existing_min, MAX(timestamp) AS existing_max FROM raw GROUP BY symbol) USING (symbol)),
plans AS (SELECT *, GREATEST(DATE_SUB('minute', plan_start, plan_end), 0) AS minutes, CAST(CEIL(GREATEST(DATE_SUB('minute', plan_start, plan_end), 0) / 1000.0e0) AS BIGINT) AS pages FROM planned)"""


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = spark.createDataFrame(REQUESTS, "symbol string, start string, end string").select("symbol", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "end")])
    return collect.backfill_plan(requests, collect.existing_range(raw(spark, sf_dir)))


@query(f"{_PLAN} SELECT * FROM plans")
def backfill_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


@query(f"""{_PLAN} SELECT symbol, page, plan_start + page * 1000 * INTERVAL 1 MINUTE AS since, LEAST(plan_start + (page + 1) * 1000 * INTERVAL 1 MINUTE, plan_end) AS until
FROM plans, LATERAL (SELECT UNNEST(RANGE(pages)) AS page) WHERE pages > 0""")
def backfill_slices(spark, sf_dir):
    return collect.page_slices(_plan(spark, sf_dir))


@query(f"""{RETURNS}, pages AS (SELECT symbol, i // 1000 AS page, COUNT(*) AS candles, MIN(timestamp) AS first_ts, MAX(timestamp) AS last_ts FROM rets GROUP BY ALL)
SELECT *, COALESCE(LAG(last_ts) OVER (PARTITION BY symbol ORDER BY page) + INTERVAL 1 MINUTE, first_ts) AS since FROM pages""")
def backfill_pages(spark, sf_dir):
    return collect.cursor_pages(view(spark, sf_dir))


@query(f"""{RAW} SELECT symbol, DATE_TRUNC('hour', timestamp) AS batch, COUNT(*) AS rows,
BOOL_AND(high >= open AND high >= close AND low <= open AND low <= close AND high >= low AND NOT volume < 0) AS valid FROM raw GROUP BY ALL""")
def validate_batch(spark, sf_dir):
    return collect.validate_batches(raw(spark, sf_dir), F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))


@query(f"""{VIEW}, last AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY timestamp DESC) AS back, COUNT(*) OVER (PARTITION BY symbol) AS c FROM ohlcv),
steps AS (SELECT *, LN(close / LAG(close) OVER (PARTITION BY symbol ORDER BY timestamp)) AS r FROM last WHERE back <= 7)
SELECT symbol, timestamp, open, high, low, close, volume, ROUND(v, 9) AS volatility_5m, collected_at FROM (
  SELECT *, CASE WHEN COUNT(r) OVER w = 5 THEN STDDEV_SAMP(r) OVER w END AS v FROM steps WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE back = LEAST(2, c)""")
def latest_closed_bar(spark, sf_dir):
    return rounded(collect.latest_closed_bar(view(spark, sf_dir)), "volatility_5m")


def _rolled(partition: str) -> str:
    return f"""{RETURNS}, paged AS (SELECT *, i // 1000 AS page FROM rets), r AS (
  SELECT *, CASE WHEN close > 0 AND LAG(close) OVER w > 0 THEN LN(close / LAG(close) OVER w) END AS r FROM paged WINDOW w AS (PARTITION BY {partition} ORDER BY i)
), rolled AS (SELECT *, ROUND(CASE WHEN COUNT(r) OVER w = 5 THEN STDDEV_SAMP(r) OVER w END, 9) AS volatility FROM r WINDOW w AS (PARTITION BY {partition} ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"""


@query(f"{_rolled('symbol, page')} SELECT symbol, timestamp, open, high, low, close, volume, volatility AS volatility_5m, TIMESTAMP '2024-02-01 00:00:00' AS collected_at FROM rolled")
def candles_to_records(spark, sf_dir):
    fetched = view(spark, sf_dir).withColumn("ts_ms", F.unix_millis(F.col("timestamp").cast("timestamp")))
    return rounded(collect.to_records(fetched, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")), "volatility_5m")


_NUMBERS = (*source.PRICES, "volume", "volatility_5m")


@query(f"""{VIEW} SELECT symbol, timestamp, 'symbol,timestamp,open,high,low,close,volume,' || CASE WHEN volatility_5m IS NULL THEN '' ELSE 'volatility_5m,' END || 'collected_at' AS keys,
symbol AS told_symbol, timestamp AS told_timestamp, {', '.join(f'{c} AS told_{c}' for c in _NUMBERS)} FROM ohlcv""")
def record_json(spark, sf_dir):
    """Each record's JSON, read again: its keys and values."""
    told = lambda c: F.get_json_object("record", f"$.{c}")
    return collect.as_json(view(spark, sf_dir)).select(
        "symbol", "timestamp", F.array_join(F.json_object_keys("record"), ",").alias("keys"), told("symbol").alias("told_symbol"), told("timestamp").cast("timestamp_ntz").alias("told_timestamp"),
        *[told(c).cast("double").alias(f"told_{c}") for c in _NUMBERS],
    )


@query(f"{_rolled('symbol')} SELECT symbol, timestamp, volatility FROM rolled")
def rolling_volatility(spark, sf_dir):
    return rounded(features.rolling_volatility(view(spark, sf_dir)).select("symbol", "timestamp", "volatility"), "volatility")


@query(f"{_rolled('symbol, page')} SELECT symbol, timestamp, page, volatility FROM rolled")
def rolling_volatility_pages(spark, sf_dir):
    return rounded(features.rolling_volatility(view(spark, sf_dir), page=features.PAGE).select("symbol", "timestamp", "page", "volatility"), "volatility")


@query(f"{RETURNS} SELECT symbol, timestamp, close, ROUND(log_return, 9) AS log_return FROM rets")
def log_return(spark, sf_dir):
    return rounded(features.log_returns(view(spark, sf_dir)).select("symbol", "timestamp", "close", "log_return"), "log_return")


@query(f"{VIEW} SELECT symbol, timestamp, FIRST_VALUE(volatility_5m IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS volatility_5m FROM ohlcv")
def bfill_volatility(spark, sf_dir):
    from ..operators.sequence import numbered

    return features.backfilled(numbered(view(spark, sf_dir)), "volatility_5m").select("symbol", "timestamp", "volatility_5m")


@query(f"""{FEATS} SELECT symbol, timestamp, i, open, high, low, close, volume, volatility_5m, ROUND(log_return, 9) AS log_return, ROUND(price_range, 9) AS price_range, ROUND(log_volume, 9) AS log_volume FROM feats""")
def build_features(spark, sf_dir):
    return rounded(features.build_features(view(spark, sf_dir), tasks(spark, sf_dir)).drop("n"), "log_return", "price_range", "log_volume")


@query(f"{_ends(L, H)} SELECT symbol, i, ts FROM ends WHERE ok")
def valid_indices(spark, sf_dir):
    return windows.valid_indices(feats(spark, sf_dir), L, H)


@query(f"{_ends(windows.LOOKBACK, windows.HORIZON)} SELECT symbol, i, ts FROM ends WHERE ok")
def valid_indices_full(spark, sf_dir):
    return windows.valid_indices(feats(spark, sf_dir))


@query(f"{_ends(L, H, LABEL)} SELECT symbol, i, ROUND(y, 6) AS y FROM ends WHERE ok")
def realized_vol_label(spark, sf_dir):
    return rounded(windows.realized_vol_label(feats(spark, sf_dir), L, H), "y", places=6)


# Means of values of few decimals often lie halfway between two rounded ones, where the last bit would decide.
_NUDGE = 1e-12


def _nudged(stats: DataFrame) -> DataFrame:
    return stats.withColumns({c: F.round(F.col(c) + _NUDGE, 7) for c in stats.columns if c not in ("symbol", "i", "first_close")})


def _stats(lookback: int, places: int | None) -> str:
    frame = f"(PARTITION BY symbol ORDER BY i ROWS BETWEEN {lookback} PRECEDING AND 1 PRECEDING)"
    cut = (lambda x: f"ROUND({x} + {_NUDGE}, {places})") if places else (lambda x: x)
    return ", ".join([f"FIRST_VALUE(close) OVER {frame} AS first_close", *[f"{cut(f'{f}({c}) OVER {frame}')} AS {n}_{c}" for c in windows.SCORED for f, n in (("AVG", "mean"), ("STDDEV_POP", "std"))]])


_NAMES = ", ".join(["first_close", *[f"{n}_{c}" for c in windows.SCORED for n in ("mean", "std")]])


@query(f"{_ends(L, H, _stats(L, 7))} SELECT symbol, i, {_NAMES} FROM ends WHERE ok")
def window_norm_stats(spark, sf_dir):
    return _nudged(windows.window_norm_stats(feats(spark, sf_dir), L, H))


_LONG = f"""{_ends(LONG, 2, _stats(LONG, None))}, long AS (
  SELECT e.symbol, e.i, f.i - e.i + {LONG} AS k, f.timestamp AS row_ts, f.open, f.high, f.low, f.close, f.log_return, f.price_range, f.log_volume, f.volatility_5m, {_NAMES}
  FROM ends e JOIN feats f ON e.symbol = f.symbol AND f.i BETWEEN e.i - {LONG} AND e.i - 1 WHERE ok
)"""


@query(f"{_LONG} SELECT symbol, i, k, row_ts AS timestamp, close, volume_ AS log_volume FROM (SELECT *, ROUND(log_volume, 9) AS volume_ FROM long)")
def windows_long(spark, sf_dir):
    return rounded(windows.windows_long(feats(spark, sf_dir), ("close", "log_volume"), LONG, 2), "log_volume")


# A flat window's deviation is 0 but for the last bits, in which the engines differ; z-scores are compared where it is not flat.
@query(f"""{_LONG} SELECT symbol, i, k, {', '.join(f'ROUND({c} / first_close, 6) AS {c}' for c in windows.PRICES)},
{', '.join(f'CASE WHEN std_{c} > 1e-7 THEN ROUND(({c} - mean_{c}) / std_{c}, 3) END AS {c}' for c in ('log_return', 'price_range'))} FROM long""")
def normalize_window(spark, sf_dir):
    found = windows.normalized_windows(feats(spark, sf_dir), LONG, 2, keep=("std_log_return", "std_price_range"))
    found = rounded(found, *windows.PRICES, places=6)
    z = {c: F.when(F.col(f"std_{c}") > 1e-7, F.round(c, 3)) for c in ("log_return", "price_range")}
    return found.withColumns(z).select("symbol", "i", "k", *windows.PRICES, *z)


_OWN = [f"CAST(MAX(CASE WHEN k = {k} THEN {c} / first_close END) AS FLOAT)" for k in range(LONG) for c in windows.PRICES]


@query(f"""{_LONG} SELECT symbol, i, COUNT(*) AS rows, 8 AS width, {', '.join(f'ROUND(CAST({x} AS DOUBLE), 6) AS price_{j}' for j, x in enumerate(_OWN))} FROM long GROUP BY symbol, i""")
def window_arrays(spark, sf_dir):
    """The arrays' sizes and their prices, row by row of the window."""
    x = lambda j: F.round(F.col("x")[j // 4][j % 4].cast("double"), 6).alias(f"price_{j}")
    found = tensors.window_arrays(feats(spark, sf_dir), LONG, 2)
    return found.select("symbol", "i", F.size("x").cast("bigint").alias("rows"), F.size(F.col("x")[0]).alias("width"), *[x(j) for j in range(4 * LONG)])


@query(f"{SPLIT} SELECT symbol, i, split FROM dataset")
def time_split(spark, sf_dir):
    return windows.time_split(windows.valid_indices(feats(spark, sf_dir), L, H)).select("symbol", "i", "split")


@query(f"{SPLIT} SELECT symbol, i, split, ROUND(y, 6) AS y FROM dataset")
def window_dataset(spark, sf_dir):
    return rounded(windows.window_dataset(feats(spark, sf_dir), L, H), "y", places=6)


@query(f"""{SPLIT}, keyed AS (SELECT *, CASE WHEN split = 'train' THEN MD5('0|' || symbol || '|' || i) END AS key FROM dataset),
sharded AS (SELECT *, COALESCE(CAST('0x' || SUBSTR(key, 1, 15) AS BIGINT), i // 4096) % (SELECT CAST(GREATEST(1, CEIL(COUNT(*) / {windows.SHARD_ROWS}.0)) AS BIGINT) FROM dataset) AS shard FROM keyed)
SELECT symbol, i, split, shard, (ROW_NUMBER() OVER (PARTITION BY split, shard ORDER BY key, symbol, i) - 1) // 64 AS batch, ROUND(y, 6) AS y FROM sharded""")
def training_batches(spark, sf_dir):
    return rounded(windows.training_batches(windows.window_dataset(feats(spark, sf_dir), L, H)), "y", places=6)


def _scored(spark: SparkSession, sf_dir: str, lookback: int = L, horizon: int = H) -> DataFrame:
    return windows.time_split(windows.persistence(feats(spark, sf_dir), lookback, horizon))


_EVALUATED = """{}, level AS (SELECT EXP(AVG(y)) AS b FROM dataset WHERE split = 'train'), t AS (SELECT *, EXP(y) AS v, EXP(prediction) AS p FROM dataset, level WHERE split = 'test')
SELECT COUNT(*) AS rows, ROUND(SQRT(AVG((p - v) ** 2)), 6) AS rmse, ROUND(SQRT(AVG((b - v) ** 2)), 6) AS rmse_baseline, ROUND(CORR(p, v), 6) AS pearson, ROUND(CORR(prediction, y), 6) AS pearson_log FROM t"""


@query(_EVALUATED.format(SPLIT))
def eval_metrics(spark, sf_dir):
    return rounded(metrics.evaluate(_scored(spark, sf_dir)), "rmse", "rmse_baseline", "pearson", "pearson_log", places=6)


@query(f"{SPLIT} SELECT ROUND(AVG(y), 6) AS mean_log, ROUND(EXP(AVG(y)), 6) AS baseline_vol FROM dataset WHERE split = 'train'")
def baseline_predictor(spark, sf_dir):
    return rounded(metrics.baseline_predictor(_scored(spark, sf_dir)), "mean_log", "baseline_vol", places=6)


_SUMMARY = f"""SELECT split, COUNT(*) AS rows, {', '.join(f'ROUND({f}(y), 6) AS {n}_log, ROUND(EXP({f}(y)), 6) AS {n}_vol' for f, n in (('MIN', 'min'), ('AVG', 'mean'), ('MAX', 'max')))} FROM dataset GROUP BY split"""


@query(f"{SPLIT} {_SUMMARY}")
def label_summary(spark, sf_dir):
    found = metrics.label_summary(_scored(spark, sf_dir))
    return rounded(found, *[c for c in found.columns if c not in ("split", "rows")], places=6)


# The same with the operators' own windows, of 360 rows and 30 ahead.
FULL = (windows.LOOKBACK, windows.HORIZON)


@query(f"{_ends(*FULL, _label(windows.HORIZON))} SELECT symbol, i, ROUND(y, 6) AS y FROM ends WHERE ok")
def realized_vol_label_full(spark, sf_dir):
    return rounded(windows.realized_vol_label(feats(spark, sf_dir)), "y", places=6)


@query(f"{_ends(*FULL, _stats(windows.LOOKBACK, 7))} SELECT symbol, i, {_NAMES} FROM ends WHERE ok")
def window_norm_stats_full(spark, sf_dir):
    return _nudged(windows.window_norm_stats(feats(spark, sf_dir)))


@query(f"{_split(*FULL)} SELECT symbol, i, split, ROUND(y, 6) AS y FROM dataset")
def window_dataset_full(spark, sf_dir):
    return rounded(windows.window_dataset(feats(spark, sf_dir)), "y", places=6)


def _last(column: str, lookback: int) -> str:
    frame = f"(PARTITION BY symbol ORDER BY i ROWS BETWEEN {lookback} PRECEDING AND 1 PRECEDING)"
    z = f"(LAG({column}) OVER w - AVG({column}) OVER {frame}) / STDDEV_POP({column}) OVER {frame}"
    return f"CASE WHEN STDDEV_POP({column}) OVER {frame} > 1e-7 THEN CASE WHEN COUNT({column}) OVER {frame} = {lookback} THEN ROUND(CAST(CAST({z} AS FLOAT) AS DOUBLE), 3) ELSE 0 END END AS last_{column}"


_FRAME = f"(PARTITION BY symbol ORDER BY i ROWS BETWEEN {windows.LOOKBACK} PRECEDING AND 1 PRECEDING)"
_CUT = ", ".join([
    _label(windows.HORIZON), *[f"ROUND(CAST(CAST(LAG({c}, {k}) OVER w / FIRST_VALUE(close) OVER {_FRAME} AS FLOAT) AS DOUBLE), 4) AS {n}_{c}" for n, c, k in (("first", "open", 360), ("middle", "close", 180), ("last", "high", 1))],
    *[_last(c, windows.LOOKBACK) for c in ("log_return", "price_range", "log_volume")],
])


# Some of a window's normalised prices, and its last row's z-scores, with the batch that it is in.
@query(f"""{_ends(*FULL, _CUT)}, ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY i) AS r, COUNT(*) OVER (PARTITION BY symbol) AS c, i // {tensors.CHUNK} AS chunk FROM ends WHERE ok
), dataset AS (
  SELECT *, CASE WHEN r > c - FLOOR(c * 0.15e0) THEN 'test' WHEN r > c - FLOOR(c * 0.15e0) - FLOOR(c * 0.15e0) THEN 'val' ELSE 'train' END AS split FROM ranked
)
SELECT symbol, i, split, chunk, {windows.LOOKBACK * 8} AS size, ROUND(y, 6) AS y, first_open, middle_close, last_high, last_log_return, last_price_range, last_log_volume,
  (ROW_NUMBER() OVER (PARTITION BY symbol, chunk, split ORDER BY CASE WHEN split = 'train' THEN CAST('0x' || SUBSTR(MD5('0|' || symbol || '|' || i), 1, 15) AS BIGINT) ELSE i END, i) - 1) // {tensors.BATCH} AS batch
FROM dataset""")
def training_tensors_full(spark, sf_dir):
    rows = feats(spark, sf_dir)
    at = lambda k, name: F.get("x", F.lit(8 * k + features.MODEL.index(name))).cast("double")
    last = windows.LOOKBACK - 1
    prices = {"first_open": at(0, "open"), "middle_close": at(last - 179, "close"), "last_high": at(last, "high")}
    scores = {c: at(last, c) for c in ("log_return", "price_range", "log_volume")}
    flat = windows.window_norm_stats(rows).select("symbol", "i", *[f"std_{c}" for c in scores])
    found = tensors.training_tensors(rows).select("symbol", "i", "split", "chunk", "batch", F.size("x").alias("size"), F.round("y", 6).alias("y"), *[F.round(x, 4).alias(c) for c, x in prices.items()], *[x.alias(c) for c, x in scores.items()])
    return found.join(flat, ["symbol", "i"]).select(*found.columns[:-3], *[F.when(F.col(f"std_{c}") > 1e-7, F.round(c, 3)).alias(f"last_{c}") for c in scores])


@query(_EVALUATED.format(_split(*FULL)))
def eval_metrics_full(spark, sf_dir):
    return rounded(metrics.evaluate(_scored(spark, sf_dir, *FULL)), "rmse", "rmse_baseline", "pearson", "pearson_log", places=6)


@query(f"{_split(*FULL)} {_SUMMARY}")
def label_summary_full(spark, sf_dir):
    found = metrics.label_summary(_scored(spark, sf_dir, *FULL))
    return rounded(found, *[c for c in found.columns if c not in ("split", "rows")], places=6)


@query(f"""{VIEW} SELECT symbol, 'features/' || REPLACE(symbol || '/USDT', '/', '_') || '/' || SUBSTR(REPLACE('{START[:10]}', '-', ''), 1, 8) || '_now.parquet' AS object_path FROM (SELECT DISTINCT symbol FROM ohlcv)""")
def export_path(spark, sf_dir):
    name = path_name(F.concat("symbol", F.lit("/USDT")))
    return view(spark, sf_dir).select("symbol").distinct().select("symbol", F.concat(F.lit("features/"), name, F.lit("/"), day_tag(F.lit(START[:10]), "all"), F.lit("_"), day_tag(F.lit(None).cast("string"), "now"), F.lit(".parquet")).alias("object_path"))


_ROUNDED = "ROUND(log_return, 9) AS log_return, ROUND(price_range, 9) AS price_range, ROUND(log_volume, 9) AS log_volume"


@query(f"{FEATS} SELECT symbol, timestamp, i, n, open, high, low, close, volume, volatility_5m, {_ROUNDED}, REPLACE(symbol, '/', '_') AS symbol_path FROM feats")
def export_features(spark, sf_dir):
    """Features of all symbols written as one folder for each, and read again."""
    path = f"{shared_folder(spark)}/features"
    features.build_features(view(spark, sf_dir), tasks(spark, sf_dir)).withColumn("symbol_path", path_name(F.col("symbol"))).write.partitionBy("symbol_path").parquet(path)
    return rounded(spark.read.parquet(path), "log_return", "price_range", "log_volume")


@query(f"{FEATS.replace('FROM ohlcv WINDOW', f'FROM ohlcv WHERE {_SLICE} WINDOW')} SELECT timestamp, open, high, low, close, volume, volatility_5m, {_ROUNDED}, '{jobs.export_name(SYMBOL, START, END)}' AS place FROM feats WHERE symbol = '{SYMBOL}'")
def export_symbol(spark, sf_dir):
    """A symbol's range written under its name, and read again."""
    folder = shared_folder(spark)
    path = jobs.export_symbol(view(spark, sf_dir), SYMBOL, folder, START, END)
    return rounded(spark.read.parquet(path), "log_return", "price_range", "log_volume").withColumn("place", F.lit(path.removeprefix(f"{folder}/")))


@query(f"{RAW} SELECT * FROM raw WHERE {_SLICE}")
def store_scan(spark, sf_dir):
    """The raw candles written to a store by day, and a range of them read with the bounds on days that prune folders."""
    path = f"{shared_folder(spark)}/store"
    source.write_store(raw(spark, sf_dir), path, mode="overwrite")
    return source.read_store(spark, path, START, END)


# What arrives is a day, each a file; symbols with a bad candle in a day have no bar from it.
DAYS = 365
_GOOD = "high >= open AND high >= close AND low <= open AND low <= close AND high >= low AND NOT volume < 0"


@query(f"""{VIEW}, days AS (SELECT *, timestamp::DATE AS d, BOOL_AND({_GOOD}) OVER (PARTITION BY symbol, timestamp::DATE) AS good FROM ohlcv),
last AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, d ORDER BY timestamp DESC) AS back, COUNT(*) OVER (PARTITION BY symbol, d) AS c FROM days WHERE good),
steps AS (SELECT *, LN(close / LAG(close) OVER (PARTITION BY symbol, d ORDER BY timestamp)) AS r FROM last WHERE back <= 7)
SELECT symbol, timestamp, open, high, low, close, volume, ROUND(v, 9) AS volatility_5m FROM (
  SELECT *, CASE WHEN COUNT(r) OVER w = 5 THEN STDDEV_SAMP(r) OVER w END AS v FROM steps WINDOW w AS (PARTITION BY symbol, d ORDER BY timestamp ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE back = LEAST(2, c)""")
def stream_closed_bars(spark, sf_dir):
    """The collector over candles that arrive a day at a time, into a store by days. A batch catches up on as many as a year of days."""
    folder = shared_folder(spark)
    days = kept(view(spark, sf_dir)).withColumn("day", F.to_date("timestamp"))
    days.repartition("day").sortWithinPartitions("day").write.partitionBy("day").parquet(f"{folder}/in")
    live.start_collector(live.candle_stream(spark, f"{folder}/in", files=DAYS), f"{folder}/out", f"{folder}/state", {"availableNow": True}, arrival=F.to_date("timestamp")).awaitTermination()
    return rounded(source.read_store(spark, f"{folder}/out").drop("collected_at"), "volatility_5m")


@query("SELECT DATE_TRUNC('day', ts)::TIMESTAMP AS day, event_type, COUNT(*) AS n FROM events GROUP BY ALL")
def stream_daily_counts(spark, sf_dir):
    """Tumbling counts over the events as one finished stream."""
    folder = shared_folder(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")

    def put(counts, number):
        counts.write.mode("overwrite").parquet(f"{folder}/out")

    stream = live.daily_counts(events).writeStream.outputMode("complete").foreachBatch(put)
    stream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(F.col("day").cast("timestamp_ntz").alias("day"), "event_type", "n")


# Raw candles that arrive in three parts, by the time of their collection; each part is a batch, after which the stream is stopped
# and started again. What is no newer than the newest bar of earlier parts less ten minutes is late.
STEPS, LATE_MINUTES = 3, 10
_ARRIVED = f"""{RAW}, bounds AS (SELECT MIN(EPOCH_US(collected_at)) AS lo, MAX(EPOCH_US(collected_at)) AS hi FROM raw),
stepped AS (SELECT raw.*, {STEPS} * (EPOCH_US(collected_at) - lo) // (hi - lo + 1) AS step FROM raw, bounds),
settled AS (SELECT step, MAX(MAX(timestamp)) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {LATE_MINUTES} MINUTE AS until FROM stepped GROUP BY step),
accepted AS (SELECT stepped.* FROM stepped JOIN settled USING (step) WHERE until IS NULL OR timestamp > until),
given AS (
  SELECT * FROM accepted WHERE timestamp <= (SELECT MAX(timestamp) - INTERVAL {LATE_MINUTES} MINUTE FROM stepped)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol, timestamp ORDER BY collected_at DESC, volume DESC, close DESC, open DESC, high DESC, low DESC, volatility_5m DESC NULLS LAST) = 1
)"""


def _arrive(spark: SparkSession, sf_dir: str, flow: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, list]:
    """What a flow has written after all parts, and the progress of its batches."""
    folder, rows, progress = shared_folder(spark), kept(raw(spark, sf_dir)), []
    at = "unix_micros(CAST(collected_at AS timestamp))"
    bounds = rows.agg(F.expr(f"min({at})").alias("lo"), F.expr(f"max({at})").alias("hi")).head()
    step = F.expr(f"{STEPS} * ({at} - {bounds['lo']}L) div ({bounds['hi'] - bounds['lo'] + 1}L)")
    for k in range(STEPS):
        rows.where(step == k).write.mode("append").parquet(f"{folder}/in")
        stream = flow(live.candle_stream(spark, f"{folder}/in")).writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out")
        started = stream.trigger(availableNow=True).start()
        started.awaitTermination()
        progress += started.recentProgress
    return spark.read.parquet(f"{folder}/out"), progress


def _plain_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"})


@query(f"""{_ARRIVED}, rets AS (SELECT *, CASE WHEN close > 0 AND LAG(close) OVER w > 0 THEN LN(close / LAG(close) OVER w) END AS r FROM given WINDOW w AS (PARTITION BY symbol ORDER BY timestamp))
SELECT symbol, timestamp, close, ROUND(CASE WHEN COUNT(r) OVER w = 5 THEN STDDEV_SAMP(r) OVER w END, 9) AS volatility FROM rets WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def stream_rolling_volatility(spark, sf_dir):
    """State for each symbol instead of trailing bars that are read again."""
    return rounded(_plain_times(_arrive(spark, sf_dir, state.rolling_volatility)[0]), "volatility")


@query(f"{_ARRIVED} SELECT symbol, timestamp, open, high, low, close, volume, volatility_5m, collected_at FROM given")
def stream_latest_bars(spark, sf_dir):
    return _plain_times(_arrive(spark, sf_dir, state.latest_bars)[0])


_RUNS = """, steps AS (SELECT *, CASE WHEN timestamp = LAG(timestamp) OVER w + INTERVAL 1 MINUTE THEN 0 ELSE 1 END AS hole FROM {rows} WINDOW w AS (PARTITION BY symbol ORDER BY timestamp)),
isles AS (SELECT *, SUM(hole) OVER (PARTITION BY symbol ORDER BY timestamp) AS isle FROM steps),
runs AS (SELECT symbol, MIN(timestamp) AS first_ts, MAX(timestamp) AS last_ts, COUNT(*) AS bars FROM isles GROUP BY symbol, isle)"""


@query(f"{VIEW}{_RUNS.format(rows='ohlcv')} SELECT * FROM runs")
def sessions(spark, sf_dir):
    return _plain_times(state.sessions(view(spark, sf_dir)))


# A session is given once the watermark is 90 seconds past its last bar.
@query(f"{_ARRIVED}{_RUNS.format(rows='given')} SELECT * FROM runs WHERE last_ts + INTERVAL 90 SECOND <= (SELECT MAX(timestamp) - INTERVAL {LATE_MINUTES} MINUTE FROM stepped)")
def stream_sessions(spark, sf_dir):
    """Sessions of bars that a first aggregation has settled, in one stream."""
    return _plain_times(_arrive(spark, sf_dir, lambda candles: state.sessions(state.latest_bars(candles)))[0])


@query(f"""{_ARRIVED} SELECT step AS batch, COUNT(*) AS rows, COUNT_IF(NOT ({_GOOD}))::BIGINT AS malformed, COUNT_IF(DATE_SUB('second', timestamp, collected_at) > 120)::BIGINT AS slow,
COUNT_IF(volatility_5m IS NULL)::BIGINT AS no_volatility FROM stepped GROUP BY step""")
def stream_quality_counters(spark, sf_dir):
    """What batches of a stream that only stores candles report of them."""
    progress = _arrive(spark, sf_dir, state.observed)[1]
    return spark.createDataFrame([x for p in progress if (x := state.counters_of(p))], state.COUNTED).drop("late", "state")


def _kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a store that got its candles in two appends: the first ones, and those collected in the last tenth of the time."""
    folder, rows = shared_folder(spark), kept(raw(spark, sf_dir))
    bounds = rows.agg(F.min("collected_at").alias("lo"), F.max("collected_at").alias("hi")).head()
    cut = F.col("collected_at") < F.lit(bounds["lo"] + (bounds["hi"] - bounds["lo"]) * 0.9)
    for number, part in enumerate((rows.where(cut), rows.where(~cut))):
        incremental.append(part, f"{folder}/store", f"{folder}/parts", batch=str(number))
    return incremental.read_parts(spark, f"{folder}/parts")


@query(ORACLES["dq_overview"])
def incremental_overview(spark, sf_dir):
    return incremental.overview(_kept_up(spark, sf_dir))


@query(ORACLES["dq_daily_completeness"])
def incremental_daily_completeness(spark, sf_dir):
    return incremental.daily_completeness(_kept_up(spark, sf_dir))


@query(ORACLES["dq_gaps"])
def incremental_gaps(spark, sf_dir):
    return incremental.gaps(_kept_up(spark, sf_dir))


@query(ORACLES["dq_ohlc_sanity"])
def incremental_ohlc_sanity(spark, sf_dir):
    return incremental.ohlc_sanity(_kept_up(spark, sf_dir))


@query(ORACLES["dq_price_outliers"])
def incremental_price_outliers(spark, sf_dir):
    return incremental.price_outliers(_kept_up(spark, sf_dir))


@query(ORACLES["dq_volume_outliers"])
def incremental_volume_outliers(spark, sf_dir):
    return incremental.volume_outliers(_kept_up(spark, sf_dir))


@query(ORACLES["dq_volatility_nulls"])
def incremental_volatility_nulls(spark, sf_dir):
    return incremental.volatility_nulls(_kept_up(spark, sf_dir))


@query(ORACLES["dq_scorecard"])
def incremental_scorecard(spark, sf_dir):
    return incremental.scorecard(_kept_up(spark, sf_dir))


def _ranked(found: DataFrame, values: DataFrame) -> DataFrame:
    """Whether what was found (symbol, p, value) for ranks lies within the sketch's error of them among the values (symbol, v)."""
    below, upto = F.count_if(F.col("v") < F.col("value")) / F.count("v"), F.count_if(F.col("v") <= F.col("value")) / F.count("v")
    error = incremental.RANK_ERROR
    return values.join(F.broadcast(found), "symbol").groupBy("symbol", "p").agg(below.alias("b"), upto.alias("u")).select("symbol", "p", F.expr(f"b <= p + {error} AND u >= p - {error}").alias("near"))


@query(f"""{VIEW} SELECT *, TRUE AS near FROM (SELECT symbol, ROUND(AVG(s), 1) AS avg_latency_s, MAX(s)::DOUBLE AS max_latency_s, COUNT(*) FILTER (s > 120) AS late_rows_gt2min
FROM (SELECT symbol, DATE_SUB('second', timestamp, collected_at) AS s FROM ohlcv) GROUP BY symbol)""")
def incremental_latency(spark, sf_dir):
    """The percentile comes from merged sketches; told is whether its rank is as near as they promise."""
    found = kept(incremental.latency(_kept_up(spark, sf_dir)))
    seconds = view(spark, sf_dir).select("symbol", F.timestamp_diff("SECOND", F.col("timestamp"), F.col("collected_at")).alias("v"))
    near = _ranked(found.select("symbol", F.lit(0.95).alias("p"), F.col("p95_latency_s").alias("value")), seconds)
    return found.drop("p95_latency_s").join(near.drop("p"), "symbol")


@query(f"{VIEW} SELECT symbol, p::DOUBLE AS p, TRUE AS near FROM (SELECT DISTINCT symbol FROM ohlcv), (VALUES (0.05), (0.5), (0.95), (0.99)) AS ranks(p)")
def volume_quantiles(spark, sf_dir):
    """Quantiles of volumes over all days, from sketches of each day."""
    found = kept(incremental.volume_quantiles(_kept_up(spark, sf_dir), 0.05, 0.5, 0.95, 0.99))
    return _ranked(found.select("symbol", F.col("rank").alias("p"), F.col("volume").alias("value")), view(spark, sf_dir).select("symbol", F.col("volume").alias("v")))


@query(f"{RAW} SELECT * FROM raw")
def store_compacted(spark, sf_dir):
    """A store with a folder for each day and batch, of which all days but the last are archived, read as one."""
    folder, rows = shared_folder(spark), kept(raw(spark, sf_dir))
    for k in range(3):
        source.write_store(rows.where(F.pmod(F.xxhash64("symbol", "timestamp"), F.lit(3)) == k), f"{folder}/store", batch=f"live-{k}")
    last = rows.agg(F.to_date(F.max("timestamp"))).head()[0]
    source.compact(spark, f"{folder}/store", f"{folder}/archive", last - dt.timedelta(days=1))
    return source.read_compacted(spark, f"{folder}/store", f"{folder}/archive")


def _exchange(spark: SparkSession, sf_dir: str) -> tuple[dict, dt.datetime, dt.datetime, list[str]]:
    """Options of an exchange that replays the deduplicated candles, their first and last time and the symbols."""
    path, rows = f"{shared_folder(spark)}/history", kept(view(spark, sf_dir))
    replay.store_history(rows, path)
    first, last = rows.agg(F.min("timestamp"), F.max("timestamp")).head()
    symbols = [r[0] for r in rows.select("symbol").distinct().orderBy("symbol").collect()]
    return {"client": "tidewick.sources.replay:exchange", "target": path, "rate": "1000", "tasks": "8", "together": "16"}, first, last, symbols


def _ms(at: dt.datetime) -> int:
    return int(at.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


@query(f"{VIEW} SELECT symbol, EPOCH_MS(timestamp) AS ts_ms, open, high, low, close, volume FROM ohlcv")
def exchange_history(spark, sf_dir):
    """Pages of an exchange's whole history, fetched by tasks."""
    options, first, last, symbols = _exchange(spark, sf_dir)
    return exchange.read_pages(spark, options | {"symbols": ",".join(symbols), "start": str(_ms(first)), "end": str(_ms(last) + exchange.MINUTE)})


@query(f"""{_rolled('symbol, page')} SELECT symbol, timestamp, open, high, low, close, volume, volatility AS volatility_5m FROM rolled""")
def backfill_job(spark, sf_dir):
    """A store that is filled from the middle of the time on, then from its beginning; what was collected again wins."""
    options, first, last, symbols = _exchange(spark, sf_dir)
    store, end = f"{shared_folder(spark)}/store", (last + dt.timedelta(minutes=1)).isoformat(" ")
    middle = (first + (last - first) / 2).replace(second=0, microsecond=0)
    for start in (middle, first):
        jobs.backfill(spark, symbols, store, options, start.isoformat(" "), end)
    return rounded(quality.latest(source.read_store(spark, store)).drop("collected_at"), "volatility_5m")


_TRAIL = f"(SELECT MAX(timestamp) - INTERVAL 8 HOUR - INTERVAL {live.TRAIL} MINUTE FROM ohlcv)"


@query(f"""{VIEW}, recent AS (SELECT *, BOOL_AND({_GOOD}) OVER (PARTITION BY symbol) AS good, MAX(timestamp) OVER (PARTITION BY symbol) AS newest FROM ohlcv WHERE timestamp >= {_TRAIL}),
last AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY timestamp DESC) AS back, COUNT(*) OVER (PARTITION BY symbol) AS c FROM recent WHERE good AND newest >= {_TRAIL} + INTERVAL {live.TRAIL} MINUTE),
steps AS (SELECT *, LN(close / LAG(close) OVER (PARTITION BY symbol ORDER BY timestamp)) AS r FROM last WHERE back <= 7)
SELECT symbol, timestamp, open, high, low, close, volume, ROUND(v, 9) AS volatility_5m FROM (
  SELECT *, CASE WHEN COUNT(r) OVER w = 5 THEN STDDEV_SAMP(r) OVER w END AS v FROM steps WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE back = LEAST(2, c)""")
def live_job(spark, sf_dir):
    """The collector on an exchange whose last eight hours are new, into a store by days."""
    options, _, last, symbols = _exchange(spark, sf_dir)
    folder = shared_folder(spark)
    candles = live.exchange_stream(spark, options | {"symbols": ",".join(symbols), "start": str(_ms(last) - 8 * 60 * exchange.MINUTE)})
    live.start_collector(candles, f"{folder}/store", f"{folder}/state", {"availableNow": True}).awaitTermination()
    return rounded(source.read_store(spark, f"{folder}/store").drop("collected_at"), "volatility_5m")
