"""Hand-made candles: edges of batches, gaps and windows, against plain Python."""

from __future__ import annotations

import datetime as dt
import math
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewick.operators import collect, features, quality, sequence, windows
from tidewick.plans import jobs
from tidewick.sources import exchange
from tidewick.sources.candles import COLUMNS, SCHEMA, read_store, write_store
from tidewick.streaming import live

T0 = dt.datetime(2024, 1, 1)


def bars(closes, symbol="A", minutes=None, volume=5.0, volatility=None, late=60):
    out = []
    for k, c in enumerate(closes):
        at = T0 + dt.timedelta(minutes=minutes[k] if minutes else k)
        v = volatility[k] if volatility else None
        out.append((symbol, at, c, c, c, c, volume, v, at + dt.timedelta(seconds=late)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rng_closes(n, seed=1):
    r = random.Random(seed)
    return [100 + r.random() for _ in range(n)]


@pytest.mark.parametrize("value", [None, float("nan")])
def test_gate_rejects_missing_prices(spark, value):
    rows = spark.createDataFrame([("A", T0, 1.0, 1.0, 1.0, value, 1.0), ("A", T0, 1.0, 1.0, 1.0, 1.0, 1.0), ("B", T0, 1.0, 1.0, 1.0, 1.0, float("nan"))], "symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, volume double")
    found = {r["symbol"]: r["valid"] for r in collect.batch_verdicts(spark.createDataFrame([("A",), ("B",), ("EMPTY",)], "symbol string"), rows).collect()}
    assert found == {"A": False, "B": True, "EMPTY": False}


@pytest.mark.parametrize(("n", "at", "known"), [(1, 0, False), (2, 0, False), (6, 4, False), (7, 5, True)])
def test_latest_closed_bar(spark, n, at, known):
    row = collect.latest_closed_bar(frame(spark, bars(rng_closes(n)))).head()
    assert row["timestamp"] == T0 + dt.timedelta(minutes=at)
    assert (row["volatility_5m"] is not None) == known


def test_dedup_ties_and_idempotence(spark):
    rows = bars([1.0]) + bars([2.0]) + bars([3.0], late=30)
    once = quality.latest(frame(spark, rows))
    assert [r["close"] for r in once.collect()] == [2.0]
    assert quality.latest(once).collect() == once.collect()
    assert quality.duplicates(once).count() == 0


@pytest.mark.parametrize("chunk", [3, 7, 1000])
def test_chunks_change_nothing(spark, chunk, monkeypatch):
    monkeypatch.setattr(sequence, "CHUNK", chunk)
    monkeypatch.setattr(sequence.chunked, "__defaults__", (chunk,))
    closes = rng_closes(40)
    minutes = [k + 3 * (k >= 25) for k in range(40)]
    vols = [None if k % 4 else float(k) for k in range(39)] + [None]
    rows = frame(spark, bars(closes, minutes=minutes, volatility=vols))
    got = features.build_features(rows).orderBy("i").toPandas()
    s = pd.Series(vols[1:]).bfill()
    assert np.allclose(got["volatility_5m"].fillna(-1), s.fillna(-1)) and got["volatility_5m"].isna().iloc[-1]
    assert np.allclose(got["log_return"], np.diff(np.log(closes)))
    rolled = features.rolling_volatility(rows).orderBy("i").toPandas()["volatility"]
    expected = pd.Series([np.nan, *np.diff(np.log(closes))]).rolling(5).std()
    assert np.allclose(rolled.fillna(-1), expected.fillna(-1))
    lookback, horizon = 6, 3
    n, times = 39, minutes[1:]
    steps = lambda a, b: all(times[j] - times[j - 1] == 1 for j in range(a + 1, b))
    usable = [i for i in range(lookback, n - horizon) if steps(i - lookback, i) and steps(i - 1, i + horizon)]
    feats = features.build_features(rows)
    assert [r["i"] for r in windows.valid_indices(feats, lookback, horizon).orderBy("i").collect()] == usable
    y = {r["i"]: r["y"] for r in windows.realized_vol_label(feats, lookback, horizon).collect()}
    returns = np.diff(np.log(closes))
    assert all(math.isclose(y[i], math.log(np.std(returns[i : i + horizon]) + 1e-8), rel_tol=1e-9) for i in usable)
    assert quality.gaps(rows).select("missing_minutes").collect() == [(3,)]


def test_batches_shuffle_train_only(spark):
    """A seed gives one order of train, another seed another; the rest goes by time; no row is lost between the steps."""
    rows = spark.range(3000).select(F.lit("A").alias("symbol"), F.col("id").alias("i"), F.when(F.col("id") < 2000, "train").otherwise("test").alias("split"))
    of = lambda seed: {(r["split"], r["i"]): (r["shard"], r["batch"]) for r in windows.training_batches(rows, size=32, seed=seed, shards=4).collect()}
    one, again, other = of(0), of(0), of(1)
    assert one == again and len(one) == 3000 and one.keys() == other.keys()
    assert all(one[k] == other[k] for k in one if k[0] == "test") and sum(one[k] != other[k] for k in one if k[0] == "train") > 1500
    sizes = {}
    for (split, _), place in one.items():
        sizes[split, place] = sizes.get((split, place), 0) + 1
    assert max(sizes.values()) == 32


def test_shards_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(windows, "SHARD_ROWS", 100)
    rows = spark.range(1050).select(F.lit("A").alias("symbol"), F.col("id").alias("i"), F.lit("train").alias("split"))
    found = windows.training_batches(rows, size=16).toPandas()
    assert len(found) == 1050 and found.shard.nunique() == 11 and found.groupby("shard").size().max() < 160


def test_no_window_in_short_series(spark):
    feats = features.build_features(frame(spark, bars(rng_closes(10))))
    assert windows.valid_indices(feats, 6, 3).count() == 0


def test_normalised_windows(spark):
    closes = rng_closes(12)
    feats = features.build_features(frame(spark, bars(closes, volatility=[1.0] * 12)))
    rows = windows.normalized_windows(feats, 4, 2).where("i = 5").orderBy("k").toPandas()
    c = np.array(closes[1:])
    assert np.allclose(rows["close"], c[1:5] / c[1])
    assert (rows["log_volume"] == 0).all() and (rows["volatility_5m"] == 0).all()
    r = np.diff(np.log(closes))[1:5]
    assert np.allclose(rows["log_return"], (r - r.mean()) / r.std())


def test_split_sizes(spark):
    rows = spark.range(2998).select(F.lit("A").alias("symbol"), (F.col("id") * 7).alias("i"))
    found = windows.time_split(rows).groupBy("split").agg(F.count("*").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi")).collect()
    got = {r["split"]: (r["n"], r["lo"], r["hi"]) for r in found}
    assert [got[s][0] for s in windows.SPLITS] == [2100, 449, 449]
    assert got["train"][2] < got["val"][1] and got["val"][2] < got["test"][1]


@pytest.mark.parametrize(("change", "label"), [({"high": 0.5}, "high < open"), ({"open": 0.5, "high": 0.7, "low": 0.4}, "high < close"), ({"low": 2.0, "high": 3.0}, "low > open"), ({"open": 9.0, "high": 10.0, "low": 5.0}, "low > close"), ({"open": 0.0, "low": -1.0}, "non-positive open"), ({"close": 0.0, "low": -1.0}, "non-positive close"), ({"volume": -1.0}, "negative volume")])
def test_violations(spark, change, label):
    row = dict(zip(COLUMNS, bars([1.0])[0])) | change
    assert [r["violation"] for r in quality.ohlc_sanity(frame(spark, [tuple(row.values())])).collect()] == [label]


def test_flat_prices_and_zero_median(spark):
    rows = frame(spark, bars([1.0] * 30, volume=0.0) + bars([1.0], symbol="B", volume=2.0))
    assert quality.price_outliers(rows).count() == 0
    busy = frame(spark, [*bars([1.0] * 5, volume=0.0), *bars([1.0], minutes=[9], volume=3.0)])
    assert [(r["volume"], r["x_median"]) for r in quality.volume_outliers(busy).collect()] == [(3.0, None)]


def test_store_prunes_days(spark, tmp_path):
    rows = frame(spark, bars(rng_closes(10), minutes=[k * 600 for k in range(10)]))
    write_store(rows, f"{tmp_path}/s", mode="overwrite")
    found = read_store(spark, f"{tmp_path}/s", "2024-01-02", "2024-01-03")
    assert sorted(r["timestamp"].day for r in found.collect()) == [2, 2]
    assert "PartitionFilters: [isnotnull(trade_day" in found._jdf.queryExecution().executedPlan().toString()
    assert write_store(rows, f"{tmp_path}/dry", dry_run=True).count() == 10 and not (tmp_path / "dry").exists()


def test_patience():
    slept, calls = [], []

    def failing():
        calls.append(1)
        raise OSError

    with pytest.raises(RuntimeError):
        exchange.patiently(failing, sleep=slept.append)
    assert slept == [4, 8, 16, 32, 64] and len(calls) == 5

    def refused():
        raise exchange.ExchangeError

    with pytest.raises(exchange.ExchangeError):
        exchange.patiently(refused, sleep=slept.append)
    assert len(slept) == 5


def fake_client(symbol, since, limit):
    first = -(-since // exchange.MINUTE) * exchange.MINUTE
    return [[first + k * exchange.MINUTE, 1.0, 2.0, 0.5, 1.5, 3.0] for k in range(int(limit))]


def test_pages_are_partitions(spark):
    spark.dataSource.register(exchange.CandlePages)
    options = {"client": "test_candles:fake_client", "symbols": "A,B", "start": "0", "end": str(2500 * exchange.MINUTE)}
    assert len(exchange.PageReader(options).partitions()) == 6
    rows = [r for p in exchange.PageReader(options).partitions() for r in exchange.PageReader(options).read(p)]
    assert len(rows) == 5000 == len(set(rows))
    frame = spark.createDataFrame(rows[:1200], exchange.ROW)
    records = collect.to_records(frame, F.lit("2024-01-01").cast("timestamp_ntz"), page=1000)
    assert records.where("volatility_5m is null").count() == 10


def uneven_client(symbol, since, limit):
    """A has a bar each minute to 1500, B one in three to 2100, C none."""
    minutes = {"A": range(1501), "B": range(0, 2101, 3), "C": ()}[symbol]
    return [[m * exchange.MINUTE, 1.0, 2.0, 0.5, 1.5, 3.0] for m in minutes if m * exchange.MINUTE >= since][: int(limit)]


UNEVEN = {"client": "test_candles:uneven_client", "symbols": "A,B,C", "start": "0", "page": "100"}


def test_stream_drains_each_symbol(spark, tmp_path):
    live = exchange.LiveReader(UNEVEN)
    end = live.latestOffset()
    assert end == live.latestOffset() == {"since": {"A": 1501 * exchange.MINUTE, "B": 2101 * exchange.MINUTE, "C": 0}}
    assert live.partitions(end, end) == []
    assert {p.symbol for p in live.partitions({"since": {"A": 1400 * exchange.MINUTE}}, end)} == {"A", "B"}
    spark.dataSource.register(exchange.CandlePages)
    stream = spark.readStream.format("candle_pages").options(**UNEVEN | {"client": "tests.test_candles:uneven_client"}).load().writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
    stream.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination(60)
    rows = spark.read.parquet(f"{tmp_path}/out")
    assert {r["symbol"]: r["count"] for r in rows.distinct().groupBy("symbol").count().collect()} == {"A": 1501, "B": 701} and rows.count() == 2202


def keyed_client(key, secret):
    return lambda *args: [[key, secret]] if args == ("keys",) else fake_client(*args)


def test_keys_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("TEST_KEY", "k")
    assert exchange._client({"client": "tests.test_candles:keyed_client", "keys": "TEST_KEY,TEST_SECRET"})("keys") == [["k", ""]]


def test_backfill_job(spark, tmp_path):
    store, options = f"{tmp_path}/store", {"client": "tests.test_candles:keyed_client", "keys": "TEST_KEY,TEST_SECRET", "rate": "1000"}
    day = lambda n: str((T0 + dt.timedelta(days=n)).date())
    dry = jobs.backfill(spark, ["A", "B"], store, options, day(1), day(2), dry_run=True)
    assert dry.count() == 2 * 1440 and not (tmp_path / "store").exists()
    jobs.backfill(spark, ["A"], store, options, day(1), day(2))
    first = read_store(spark, store)
    # Volatility begins anew with each page of 1,000.
    assert first.count() == 1440 and first.where("volatility_5m is null").count() == 10 and set(first.columns) == set(COLUMNS)
    # A begins within what is there and has nothing left; B has none yet.
    jobs.backfill(spark, ["A", "B"], store, options, day(1), day(2))
    assert {r["symbol"]: r["count"] for r in read_store(spark, store).groupBy("symbol").count().collect()} == {"A": 1440, "B": 1440}
    # A request that begins before keeps its end; the view removes what was collected again.
    jobs.backfill(spark, ["A"], store, options, end=day(2), days=2)
    rows = read_store(spark, store).where("symbol = 'A'")
    assert rows.count() == 3 * 1440 and quality.latest(rows).count() == 2 * 1440
    assert jobs.backfill(spark, ["A"], store, options, day(1), day(1)).count() == 0


def test_default_range():
    now = dt.datetime(2024, 5, 6, 7, 8, 9, 10)
    assert jobs.default_range(now=now) == (dt.datetime(2023, 5, 7, 7, 8), dt.datetime(2024, 5, 6, 7, 8))
    assert jobs.default_range("2024-01-01", "2024-01-03") == (T0, T0 + dt.timedelta(days=2))
    assert jobs.default_range(end="2024-01-03", days=2)[0] == T0


def test_export_job(spark, tmp_path):
    rows = frame(spark, bars(rng_closes(2000), symbol="A/B"))
    path = jobs.export_symbol(rows, "A/B", str(tmp_path), "2024-01-01", "2024-01-02")
    assert path == f"{tmp_path}/A_B/20240101_20240102.parquet" and spark.read.parquet(path).count() == 1439
    assert jobs.export_symbol(rows, "A/B", str(tmp_path)).endswith("A_B/all_now.parquet")
    assert collect.load_symbol(rows, "A/B").count() == 2000 and collect.load_symbol(rows, "A/B", end="2024-01-01 00:05").count() == 5


def test_read_through_format(spark):
    spark.dataSource.register(exchange.CandlePages)
    rows = spark.read.format("candle_pages").options(client="tests.test_candles:uneven_client", symbols="A,B,C", start="0", end=str(2500 * exchange.MINUTE), page="500").load()
    assert {r["symbol"]: r["count"] for r in rows.groupBy("symbol").count().collect()} == {"A": 1501, "B": 701}


def test_throttle():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    call = exchange.throttled(lambda x: x, 2, clock=lambda: now[0], sleep=sleep)
    assert [call(k) for k in range(3)] == [0, 1, 2] and slept == [0.5, 0.5]


def test_tasks_share_the_rate(monkeypatch):
    rates = []
    monkeypatch.setattr(exchange, "throttled", lambda fetch, rate: rates.append(rate) or fetch)
    for options in ({"rate": "10"}, {"rate": "10", "tasks": "5"}, {}):
        exchange._client({"client": "test_candles:fake_client", **options})
    assert rates == [10.0, 2.0]


def test_live_job(spark, tmp_path):
    """The newest bars go through the exchange stream into the store by days; a replayed batch adds nothing."""
    options = UNEVEN | {"client": "tests.test_candles:uneven_client"}
    stream = lambda: live.exchange_stream(spark, options)
    live.start_collector(stream(), f"{tmp_path}/store", f"{tmp_path}/state", {"availableNow": True}).awaitTermination(60)
    found = {r["symbol"]: r for r in read_store(spark, f"{tmp_path}/store").collect()}
    epoch = dt.datetime(1970, 1, 1)
    assert found["A"]["timestamp"] == epoch + dt.timedelta(minutes=1499) and found["B"]["timestamp"] == epoch + dt.timedelta(minutes=2097)
    assert found["A"]["volatility_5m"] == 0.0 and set(found) == {"A", "B"}
    batch = spark.createDataFrame([tuple(r) for r in found.values()], read_store(spark, f"{tmp_path}/store").schema)
    for _ in range(2):
        write_store(batch, f"{tmp_path}/store", batch="live-0")
    assert read_store(spark, f"{tmp_path}/store").count() == 2


def test_features_drop_rows_without_return(spark):
    """A close of 0 or less has no return, nor has the row after it; the rest is numbered on."""
    closes = [1.0, 2.0, 0.0, 3.0, 4.0, -1.0, 5.0, 6.0]
    rows = [(*x[:2], abs(x[2]) + 1, abs(x[2]) + 2, -2.0, *x[5:]) for x in bars(closes)]
    got = features.build_features(frame(spark, rows)).orderBy("i").collect()
    assert [(r["i"], r["close"], r["n"]) for r in got] == [(0, 2.0, 3), (1, 4.0, 3), (2, 6.0, 3)]
    assert np.allclose([r["log_return"] for r in got], np.log([2, 4 / 3, 6 / 5]))


def test_backward_fill_of_a_long_symbol(spark):
    rows = spark.range(60_000).select(F.lit("A").alias("symbol"), F.col("id").alias("i"), F.lit(60_000).alias("n"), F.when(F.col("id") % 20_000 == 19_999, F.col("id").cast("double")).alias("v"))
    began = time.monotonic()
    found = features.backfilled(rows, "v").agg(F.sum("v")).head()[0]
    assert found == 20_000 * (19_999 + 39_999 + 59_999) and time.monotonic() - began < 30
