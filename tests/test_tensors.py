"""Training windows as arrays, and window statistics in linear time, against numpy."""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_candles import bars, frame, rng_closes

from tidewick.operators import features, sequence, tensors, windows


def plainly(window: np.ndarray) -> np.ndarray:
    """One window, column by column."""
    out = np.zeros_like(window)
    for k, name in enumerate(features.MODEL):
        column = window[:, k]
        if name in windows.PRICES:
            out[:, k] = column / window[0, 3] if window[0, 3] != 0 else column
        elif not np.isnan(column).any() and column.max() > column.min():
            out[:, k] = (column - column.mean()) / column.std()
    return out


def made(spark, n=1500, seed=3, gap=900):
    rng = np.random.default_rng(seed)
    vols = [None if k % 5 == 1 else float(v) for k, v in enumerate(rng.random(n))]
    vols[-1] = None
    rows = bars(rng_closes(n, seed), minutes=[k + 4 * (k >= gap) for k in range(n)], volatility=vols) + bars(rng_closes(450, 9), symbol="B")
    rows = [(*r[:3], r[2] + 0.5, r[2] - 0.3 * (k % 3), r[2], float(k % 11), *r[7:]) for k, r in enumerate(rows)]
    return frame(spark, rows)


@pytest.mark.parametrize(("lookback", "horizon", "chunk"), [(360, 30, 4096), (360, 30, 400), (12, 3, 50)])
def test_tensors_equal_windows(spark, lookback, horizon, chunk):
    feats = features.build_features(made(spark))
    found = tensors.training_tensors(feats, lookback, horizon, size=16, chunk=chunk).toPandas()
    ends = windows.window_dataset(feats, lookback, horizon).toPandas()
    assert sorted(zip(found.symbol, found.i, found.split, found.y)) == sorted(zip(ends.symbol, ends.i, ends.split, ends.y)) and len(found) > 700
    assert found.groupby(["symbol", "chunk", "split", "batch"]).size().max() == 16
    for symbol, rows in feats.toPandas().sort_values("i").groupby("symbol"):
        values = rows[list(features.MODEL)].to_numpy(float)
        for r in found[found.symbol == symbol].sample(frac=0.1, random_state=1).itertuples():
            assert np.allclose(np.array(r.x).reshape(lookback, 8), plainly(values[r.i - lookback : r.i]), atol=1e-5)


def test_batches_by_seed(spark):
    feats = features.build_features(made(spark, 700, gap=10_000))
    of = lambda seed: [(r["symbol"], r["split"], r["chunk"], r["batch"], r["i"]) for r in tensors.training_tensors(feats, 24, 5, 32, seed, 256).collect()]
    one, again, other = of(0), of(0), of(1)
    assert sorted(one) == sorted(again) != sorted(other)
    assert {x for x in one if x[1] != "train"} == {x for x in other if x[1] != "train"}
    by_time = [x for x in one if x[:3] == ("A", "test", 2)]
    assert [x[4] for x in by_time] == sorted(x[4] for x in by_time)
    loaders = tensors.make_loaders(feats, 24, 5, 32, 0, 256)
    shapes = [(x.shape, x.dtype, y.shape) for x, y in tensors.batches(loaders["val"])]
    assert sum(s[0][0] for s in shapes) == sum(x[1] == "val" for x in one)
    assert all(s[0][1:] == (24, 8) and s[1] == np.float32 and s[2] == s[0][:1] for s in shapes)


def test_no_tensors_of_short_or_empty_series(spark):
    assert tensors.training_tensors(features.build_features(frame(spark, bars(rng_closes(20)))), 24, 5).count() == 0
    assert tensors.training_tensors(features.build_features(frame(spark, [])), 24, 5).count() == 0


def test_first_close_of_zero_and_flat_columns():
    window = np.ones((1, 5, 8)) * np.arange(5)[None, :, None]
    window[0, :, 5], window[0, 2, 7] = 0.1, np.nan
    found = tensors.normalised(window)[0]
    assert (found[:, 0] == np.arange(5)).all() and (found[:, 5] == 0).all() and (found[:, 7] == 0).all() and np.isclose(found[:, 4].std(), 1)


@pytest.mark.parametrize("chunk", [13, 40, 1 << 16])
@pytest.mark.parametrize("lookback", [1, 7, 12])
def test_statistics_equal_each_window(spark, monkeypatch, chunk, lookback):
    """Nulls, flat stretches and values of very different size within and between blocks."""
    monkeypatch.setattr(sequence.chunked, "__defaults__", (chunk,))
    rng = np.random.default_rng(lookback)
    n = 90
    x = np.where(np.arange(n) % 17 == 3, 1e6, rng.random(n))
    x[30:60] = 0.1
    table = pd.DataFrame({"symbol": "A", "i": np.arange(n), "n": n, "close": rng.random(n) + 1, **{c: x * (k + 1) for k, c in enumerate(windows.SCORED)}})
    table.loc[rng.choice(n, 20, replace=False), "volatility_5m"] = np.nan
    table.loc[40:55, "log_volume"] = np.nan
    rows = spark.createDataFrame(table).withColumn("timestamp", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, CAST(i AS INT), 0)"))
    rows = rows.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in windows.SCORED})
    found = windows.window_norm_stats(rows, lookback, 3).toPandas().sort_values("i")
    assert found.i.tolist() == list(range(lookback, n - 3))
    for r in found.itertuples():
        window = table.iloc[r.i - lookback : r.i]
        assert r.first_close == window.close.iloc[0]
        for c in windows.SCORED:
            known = window[c].dropna()
            mean, std = getattr(r, f"mean_{c}"), getattr(r, f"std_{c}")
            if len(known):
                assert np.isclose(mean, known.mean(), rtol=1e-12) and np.isclose(std, known.std(ddof=0), rtol=1e-9, atol=1e-12 * known.abs().max())
                assert known.nunique() > 1 or std == 0
            else:
                assert np.isnan(mean) and np.isnan(std)


def test_time_does_not_follow_the_lookback(spark):
    n = 60_000
    rows = spark.range(n).select(F.lit("A").alias("symbol"), F.col("id").alias("i"), F.lit(n).alias("n"), F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, CAST(id AS INT), 0)").alias("timestamp"), *[F.rand(k).alias(c) for k, c in enumerate(("close", *windows.SCORED))])

    def seconds(lookback: int) -> float:
        began = time.monotonic()
        windows.window_norm_stats(rows, lookback, 30).write.format("noop").mode("overwrite").save()
        return time.monotonic() - began

    seconds(36)
    short, long = seconds(36), seconds(1440)
    assert long < 3 * short + 2
