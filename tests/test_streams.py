"""Streams with state against the batch operators, in small and disordered batches with restarts; counters; parts kept up by days."""

from __future__ import annotations

import datetime as dt
import json
import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_candles import T0, bars, frame, rng_closes

from tidewick.operators import features, incremental, quality
from tidewick.sources.candles import compact, read_compacted, read_store, write_store
from tidewick.streaming import live, state


def arrive(spark, folder, batches, flow):
    """What a flow writes of batches of rows, and the progress of all of them; the stream is stopped and started for each."""
    progress = []
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = flow(live.candle_stream(spark, f"{folder}/in")).writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out")
        started = stream.trigger(availableNow=True).start()
        started.awaitTermination()
        progress += started.recentProgress
    return spark.read.parquet(f"{folder}/out"), progress


def disordered(n: int = 60):
    """Bars of two symbols in six batches: out of order by less than ten minutes, some collected twice, two of them late."""
    rng = random.Random(4)
    rows = bars(rng_closes(n, 1)) + bars([*rng_closes(20, 2), 0.0, -1.0, *rng_closes(n - 22, 3)], symbol="B", minutes=[k + 5 * (k >= 30) for k in range(n)])
    again = [(*r[:5], r[5] + 1.0, *r[6:8], r[8] + dt.timedelta(minutes=2)) for r in rows if rng.random() < 0.2]
    order = sorted(rows + again, key=lambda r: (r[1] - T0).seconds // 60 + rng.random() * 4)
    size = -(-len(order) // 6)
    batches = [order[k : k + size] for k in range(0, len(order), size)]
    late = [(*rows[k][:5], 999.0, *rows[k][6:8], rows[k][8] + dt.timedelta(hours=5)) for k in (3, 70)]
    batches[-1] += late
    return order, batches, late


def test_rolling_volatility_keeps_state(spark, tmp_path):
    order, batches, _ = disordered()
    found, progress = arrive(spark, tmp_path, batches, state.rolling_volatility)
    got = {(r["symbol"], r["timestamp"]): (r["close"], r["volatility"]) for r in found.collect()}
    newest = max(r[1] for r in order)
    plain = features.rolling_volatility(quality.latest(frame(spark, order))).collect()
    expected = {(r["symbol"], r["timestamp"]): (r["close"], r["volatility"]) for r in plain if r["timestamp"] <= newest - dt.timedelta(minutes=10)}
    assert got.keys() == expected.keys() and len(got) > 90
    for key, (close, volatility) in expected.items():
        assert got[key][0] == close and (got[key][1] is None) == (volatility is None) and (volatility is None or np.isclose(got[key][1], volatility))
    held = [s.numRowsTotal for p in progress for s in p.stateOperators]
    assert max(held) < 120 and sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators) == 2


def test_latest_bars_and_late_rows(spark, tmp_path):
    order, batches, late = disordered()
    found, progress = arrive(spark, tmp_path, batches, state.latest_bars)
    newest = max(r[1] for r in order)
    expected = [r for r in quality.latest(frame(spark, order)).collect() if r["timestamp"] <= newest - dt.timedelta(minutes=10)]
    assert sorted((r["symbol"], r["timestamp"], r["close"], r["volume"], r["collected_at"]) for r in found.collect()) == sorted((r["symbol"], r["timestamp"], r["close"], r["volume"], r["collected_at"]) for r in expected)
    counted = [x for p in progress if (x := state.counters_of(p))]
    assert sum(x[-2] for x in counted) == len(late) and max(x[-1] for x in counted) < 60


def test_sessions_equal_islands(spark, tmp_path):
    minutes = [*range(10), *range(12, 20), 40, *range(60, 90)]
    rows = bars([1.0] * len(minutes), minutes=minutes)
    whole = sorted(tuple(r) for r in state.sessions(frame(spark, rows)).collect())
    at = lambda k: T0 + dt.timedelta(minutes=k)
    assert whole == [("A", at(0), at(9), 10), ("A", at(12), at(19), 8), ("A", at(40), at(40), 1), ("A", at(60), at(89), 30)]
    found, _ = arrive(spark, tmp_path, [rows[:15], rows[15:30], rows[30:]], lambda s: state.sessions(state.latest_bars(s)))
    assert sorted(tuple(r) for r in found.collect()) == whole[:3]


def test_counters_equal_the_suite(spark, tmp_path):
    """A listener gets what each batch counted; it equals the batch suite over the same rows."""
    rows = bars(rng_closes(30), late=200) + bars(rng_closes(20), symbol="B", volatility=[None if k % 2 else 1.0 for k in range(20)])
    rows[3] = (*rows[3][:3], 0.5, *rows[3][4:])  # high under the others
    listener = state.QualityCounters()
    spark.streams.addListener(listener)
    try:
        arrive(spark, tmp_path, [rows[:25], rows[25:]], state.observed)
        for _ in range(50):
            if len(listener.batches) == 2:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    total = listener.frame(spark).agg(*[F.sum(c) for c in ("rows", "malformed", "slow", "no_volatility", "late")]).head()
    card = {r["symbol"]: r for r in quality.scorecard(frame(spark, rows)).collect()}
    slow = quality.latency(frame(spark, rows)).agg(F.sum("late_rows_gt2min")).head()[0]
    nulls = quality.volatility_nulls(frame(spark, rows)).agg(F.sum("null_volatility")).head()[0]
    assert tuple(total) == (50, sum(r["ohlc_violations"] for r in card.values()), slow, nulls, 0) and total[1] == 1 and slow == 30
    assert sorted(x[1] for x in listener.batches.values()) == [25, 25]


def test_records_are_logged(spark, tmp_path):
    frame(spark, bars(rng_closes(9))).write.parquet(f"{tmp_path}/in")
    live.start_collector(live.candle_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/store", f"{tmp_path}/state", {"availableNow": True}, log=f"{tmp_path}/log").awaitTermination(60)
    lines = [json.loads(x) for p in Path(tmp_path, "log").rglob("part-*") for x in p.read_text().splitlines()]
    stored = read_store(spark, f"{tmp_path}/store").collect()
    assert len(lines) == len(stored) == 1 and lines[0]["close"] == stored[0]["close"] and lines[0]["symbol"] == "A"


SUITE = ("overview", "daily_completeness", "gaps", "ohlc_sanity", "price_outliers", "volume_outliers", "volatility_nulls", "scorecard", "latency")


def many_days(spark, days: int = 5, seed: int = 1):
    rng = random.Random(seed)
    rows = []
    for symbol in "AB":
        minutes = sorted(rng.sample(range(days * 1440), days * 120))
        closes = [100 + rng.random() + 1000 * (rng.random() < 0.01) for _ in minutes]
        rows += [(*r[:3], r[2] - 0.1 if rng.random() < 0.02 else r[2] + 1, *r[4:6], rng.choice([1.0, 2.0, 90.0]) if rng.random() < 0.1 else 2.0, r[7], r[8] + dt.timedelta(seconds=rng.randrange(90))) for r in bars(closes, symbol, minutes, volatility=[None if rng.random() < 0.05 else rng.random() for _ in minutes])]
    return rows


def test_parts_equal_the_full_suite(spark, tmp_path):
    """After each append the reports equal those of a run over everything; only the days that changed are written anew."""
    store, parts = f"{tmp_path}/store", f"{tmp_path}/parts"
    rows = many_days(spark)
    last = T0 + dt.timedelta(days=4)
    first, later = [r for r in rows if r[1] < last], [r for r in rows if r[1] >= last]
    incremental.append(frame(spark, first), store, parts, "one")
    before = {p: p.stat().st_mtime_ns for p in Path(parts).rglob("part-*")}
    again = [(*r[:5], r[5] + 5, *r[6:8], r[8] + dt.timedelta(hours=1)) for r in first if r[1].day == 2][:10]
    assert incremental.append(frame(spark, later + again), store, parts, "two") == [dt.date(2024, 1, 2), dt.date(2024, 1, 5)]
    kept = {p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]}
    assert {p.parent.name[-2:] for p in kept} == {"01", "03", "04"}
    merged, whole = incremental.read_parts(spark, parts), quality.latest(frame(spark, rows + again))
    for name in SUITE:
        one, other = (sorted(map(repr, getattr(m, name)(table).select(*getattr(quality, name)(whole).columns).collect())) for m, table in ((incremental, merged), (quality, whole)))
        if name == "latency":
            continue
        assert one == other, name
    exact = {r["symbol"]: r for r in quality.latency(whole).collect()}
    seconds = whole.select("symbol", F.timestamp_diff("SECOND", F.col("timestamp"), F.col("collected_at")).alias("s")).toPandas()
    for r in incremental.latency(merged).collect():
        assert r["avg_latency_s"] == exact[r["symbol"]]["avg_latency_s"] and r["late_rows_gt2min"] == exact[r["symbol"]]["late_rows_gt2min"]
        s = seconds[seconds.symbol == r["symbol"]].s
        assert (s < r["p95_latency_s"]).mean() <= 0.95 + incremental.RANK_ERROR and (s <= r["p95_latency_s"]).mean() >= 0.95 - incremental.RANK_ERROR


def test_only_changed_days_are_read(spark, tmp_path):
    write_store(frame(spark, many_days(spark, 3)), f"{tmp_path}/store", batch="b")
    rows = read_store(spark, f"{tmp_path}/store", days=[dt.date(2024, 1, 2)])
    assert {Path(f).parent.parent.name for f in rows.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {"trade_day=2024-01-02"}


@pytest.mark.parametrize("until", [2, 9])
def test_compaction(spark, tmp_path, until):
    """Many small folders become one for each day; rows that the live store still holds of them aren't read twice."""
    store, archive = f"{tmp_path}/store", f"{tmp_path}/archive"
    rows = many_days(spark, 3)
    for k in range(4):
        write_store(frame(spark, rows[k::4]), store, batch=f"live-{k}")
    assert read_compacted(spark, store, archive).count() == len(rows)
    for day in (1, until):
        compact(spark, store, archive, dt.date(2024, 1, day))
    assert sorted(map(repr, read_compacted(spark, store, archive).collect())) == sorted(map(repr, read_store(spark, store).collect()))
    assert len(list(Path(archive, "days").rglob("part-*"))) == min(until, 3)
    assert read_compacted(spark, store, archive, "2024-01-02", "2024-01-03").count() == sum(r[1].day == 2 for r in rows)
