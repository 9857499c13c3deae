"""Filters that reach the exchange source, and writes by requests."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual
from clients import asked
from test_candles import bars, frame, rng_closes

from tidewick.sources import exchange, requests
from tidewick.sources.candles import SCHEMA

MINUTE = exchange.MINUTE


OPTIONS = {"client": "tests.clients:every_minute", "symbols": "A,B,C", "start": "0", "end": str(10_000 * MINUTE), "page": "1000"}
IS, IN, MORE, LEAST, LESS, MOST = EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual
SYMBOL, TIME, VOLUME = ("symbol",), ("ts_ms",), ("volume",)


@pytest.mark.parametrize(("where", "filters", "requests", "rows"), [
    ("symbol = 'B'", [IS(SYMBOL, "B")], 10, 10_000),
    ("symbol IN ('A', 'C') AND ts_ms >= 120000000 AND ts_ms < 180000000", [IN(SYMBOL, ("A", "C")), LEAST(TIME, 120000000), LESS(TIME, 180000000)], 2, 2000),
    ("ts_ms > 599940000", [MORE(TIME, 599940000)], 3, 0),
    ("ts_ms = 60000", [IS(TIME, 60000)], 3, 3),
    ("symbol = 'A' AND ts_ms <= 60000 AND volume = 1", [IS(SYMBOL, "A"), MOST(TIME, 60000), IS(VOLUME, 1.0)], 1, 1),
    ("symbol = 'A' AND symbol = 'B'", [IS(SYMBOL, "A"), IS(SYMBOL, "B")], 0, 0),
    ("symbol = 'D'", [IS(SYMBOL, "D")], 0, 0),
    ("volume < 10", [LESS(VOLUME, 10.0)], 30, 30),
])
def test_filters_choose_pages(spark, where, filters, requests, rows):
    """Only pages that may hold wanted bars are asked for; other filters are left to Spark."""
    reader = exchange.FilteringReader(OPTIONS | {"client": "clients:counted"})
    assert len(reader.partitions()) == 30
    assert all(f.attribute == VOLUME for f in reader.pushFilters(filters))
    asked.clear()
    found = [r for page in reader.partitions() for r in reader.read(page)]
    assert len(asked) == requests and len(found) >= rows
    through_spark = exchange.read_pages(spark, OPTIONS).where(where)
    assert through_spark.count() == rows and through_spark.rdd.getNumPartitions() <= max(requests, 1)


def test_ranges_are_cut(spark):
    rows = exchange.read_pages(spark, OPTIONS | {"ranges": f'{{"A": [0, {4000 * MINUTE}], "B": [0, {9000 * MINUTE}]}}'}, ["A"], 1500 * MINUTE, 2500 * MINUTE)
    assert rows.agg(F.count("*"), F.min("ts_ms"), F.max("ts_ms")).head() == (1000, 1500 * MINUTE, 2499 * MINUTE)
    assert rows.rdd.getNumPartitions() == 1


CLIENT = "tidewick.sources.requests:folder_client"


def stored(folder) -> list[list]:
    client = requests.FolderClient(str(folder))
    return [json.loads(line) for name in client.requests() for line in Path(folder, "staged", name).read_text().splitlines()]


def test_rows_go_by_requests(spark, tmp_path):
    spark.dataSource.register(requests.CandleRequests)
    rows = frame(spark, bars(rng_closes(1300))).repartition(2)
    write = lambda batch: rows.write.format("candle_requests").mode("append").options(client=CLIENT, target=str(tmp_path), batch=batch).save()
    write("one")
    found = stored(tmp_path)
    assert len(found) == 1300 == len({r[1] for r in found}) and {r[0] for r in found} == {"A"}
    sizes = [len(p.read_text().splitlines()) for p in (tmp_path / "staged").iterdir()]
    assert max(sizes) == 500 and len(sizes) == 4
    write("one")  # again: nothing is added, and what was staged is gone
    assert len(stored(tmp_path)) == 1300 and len(list((tmp_path / "staged").iterdir())) == 4
    write("two")
    assert len(stored(tmp_path)) == 2600


def test_failures_leave_no_duplicates(tmp_path):
    """A task's second attempt stages its rows anew; only these are committed. Without success nothing is."""
    rows = [[f"s{k}", None, float(k)] for k in range(100)]
    options = {"client": "tests.clients:breaking_client", "target": str(tmp_path), "rows": "10", "batch": "b"}
    writer = requests.RequestWriter(options)
    first = writer.write(iter(rows[:50]))
    with pytest.raises(OSError):
        writer.write(iter(rows[50:]))
    second = writer.write(iter(rows[50:]))
    assert stored(tmp_path) == []
    writer.commit([first, second, None])
    assert sorted(r[2] for r in stored(tmp_path)) == [float(k) for k in range(100)]
    other = requests.RequestWriter(options | {"batch": "c"})
    other.abort([other.write(iter(rows[:5])), None])
    assert len(stored(tmp_path)) == 100


def test_job_that_fails_commits_nothing(spark, tmp_path):
    spark.dataSource.register(requests.CandleRequests)
    with pytest.raises(Exception, match="division"):
        frame(spark, bars([1.0])).write.format("candle_requests").mode("append").options(client="tests.clients:failing_client", target=str(tmp_path)).save()
    assert stored(tmp_path) == []


def test_stream_by_requests(spark, tmp_path):
    """Batches of a stream are committed by their number; one that is run again adds nothing."""
    spark.dataSource.register(requests.CandleRequests)
    for k in range(2):
        frame(spark, bars(rng_closes(700), symbol=f"S{k}")).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in").writeStream.format("candle_requests").options(client=CLIENT, target=f"{tmp_path}/out", checkpointLocation=f"{tmp_path}/state")
        stream.trigger(availableNow=True).start().awaitTermination()
    found = stored(tmp_path / "out")
    assert len(found) == 1400 == len({(r[0], r[1]) for r in found})
    writer = requests.RequestStreamWriter({"client": CLIENT, "target": f"{tmp_path}/out"})
    again = writer.write(iter([["S1", dt.datetime(2024, 1, 1)]]))
    writer.commit([again], 1)
    assert len(stored(tmp_path / "out")) == 1400
