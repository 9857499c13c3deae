"""An exchange as a data source: pages of candles are input partitions, fetched by tasks side by side.

``spark.read.format("candle_pages")`` reads a history; ``readStream`` the newest bars. The client is named by the option
``client`` as module:function and gives fetch(symbol, since_ms, limit) -> rows [ts_ms, open, high, low, close, volume], the
first ones from since_ms on. Bars of a symbol are a minute or more apart and appear in order; symbols needn't keep step.
With the option ``target``, or ``keys``, the names of environment variables, the function is called with that and their values
first, on the machine that fetches, and returns fetch. ``rate`` is the most requests a second of all tasks together, of which ``tasks`` (1
where it isn't said) run at once, so that each keeps to its share.
With ``together`` an input partition is so many pages of a history, fetched one after another, so that a long one isn't a task for each page.

A history's symbols share the options ``start`` and ``end``, or each has its own in ``ranges``: JSON {symbol: [start, end]}.
With the option ``pushdown``, which ``read_pages`` sets with the session's setting that it needs, filters on ``symbol`` and ``ts_ms``
reach the source, so that pages without wanted bars aren't fetched.

A stream's offset tells for each symbol the time from which its bars are still to be read: {"since": {symbol: ms}}, or
{"since": ms} where it is the same for all. A symbol that an offset doesn't name begins at the option ``start``.
With ``trail`` a symbol's new bars come with those of so many minutes before them, which a rolling measure of them needs.
"""

from __future__ import annotations

import importlib
import json
import os
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

MINUTE = 60_000
ROW = "symbol string, ts_ms bigint, open double, high double, low double, close double, volume double"


class ExchangeError(Exception):
    """The exchange refuses a request; trying again won't help."""


def patiently(fetch: Callable[[], list], attempts: int = 5, base: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> list:
    """The result of fetch, tried again after doubling pauses. An exchange's refusal is raised at once."""
    for attempt in range(1, attempts + 1):
        try:
            return fetch()
        except ExchangeError:
            raise
        except Exception:
            sleep(base * 2**attempt)
    raise RuntimeError(f"no answer after {attempts} attempts")


@dataclass
class Page(InputPartition):
    symbol: str
    since: int
    until: int


def pages(symbols: list[str], start: int, end: int, size: int) -> list[Page]:
    """Slices of size minutes from start to end, in milliseconds, for each symbol."""
    step = size * MINUTE
    return [Page(s, since, min(since + step, end)) for s in symbols for since in range(start, end, step)]


def throttled(fetch: Callable, rate: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """fetch with pauses, so that so many calls a second are begun at most."""
    free = clock()

    def call(*args):
        nonlocal free
        now = clock()
        if free > now:
            sleep(free - now)
        free = max(free, now) + 1 / rate
        return fetch(*args)

    return call


def _client(options: dict) -> Callable:
    module, _, name = options["client"].partition(":")
    fetch = getattr(importlib.import_module(module), name)
    keys = [os.environ.get(x, "") for x in options["keys"].split(",")] if options.get("keys") else []
    first = ([options["target"]] if options.get("target") else []) + keys
    if first:
        fetch = fetch(*first)
    return throttled(fetch, float(options["rate"]) / int(options.get("tasks", 1))) if options.get("rate") else fetch


def _rows_of(options: dict, wanted: Iterable[Page]) -> Iterator[tuple]:
    fetch, pause = _client(options), float(options.get("pause", 2.0))
    for page in wanted:
        for row in patiently(lambda: fetch(page.symbol, page.since, -(-(page.until - page.since) // MINUTE)), base=pause):  # noqa: B023
            if page.since <= row[0] < page.until:
                yield (page.symbol, int(row[0]), *map(float, row[1:6]))


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.wanted: set[str] | None = None
        self.start, self.end = 0, 1 << 62
        self.size = int(options.get("page", 1000))

    def partitions(self) -> list[Page]:
        o, size = self.options, self.size * int(self.options.get("together", 1))
        ranges = json.loads(o["ranges"]) if o.get("ranges") else {s: (o["start"], o["end"]) for s in o["symbols"].split(",")}
        kept = [(s, max(int(start), self.start), min(int(end), self.end)) for s, (start, end) in ranges.items() if self.wanted is None or s in self.wanted]
        return [page for s, start, end in kept for page in pages([s], start, end, size)]

    def read(self, page: Page | None) -> Iterator[tuple]:
        return _rows_of(self.options, pages([page.symbol], page.since, page.until, self.size)) if page else iter(())


class FilteringReader(PageReader):
    """Filters on symbol and ts_ms narrow what is asked for, so that only pages that may hold wanted bars are fetched."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") else None
            if column == "symbol" and isinstance(f, (EqualTo, In)):
                found = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = found if self.wanted is None else self.wanted & found
            elif column == "ts_ms" and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)) and f.value is not None:
                self.start = max(self.start, int(f.value) + isinstance(f, GreaterThan))
                if isinstance(f, EqualTo):
                    self.end = min(self.end, int(f.value) + 1)
            elif column == "ts_ms" and isinstance(f, (LessThan, LessThanOrEqual)) and f.value is not None:
                self.end = min(self.end, int(f.value) + isinstance(f, LessThanOrEqual))
            else:
                yield f  # left to Spark


def _by_symbol(options: dict, offset: dict) -> dict[str, int]:
    since, symbols = offset["since"], options["symbols"].split(",")
    return {s: int(since.get(s, options["start"])) for s in symbols} if isinstance(since, dict) else dict.fromkeys(symbols, int(since))


def _offset(since: dict[str, int]) -> dict:
    return {"since": next(iter(since.values())) if len(set(since.values())) == 1 else since}


class LiveReader(DataSourceStreamReader):
    """Micro-batches of all bars that came since the last one, fetched by tasks in pages of each symbol.

    The driver only looks for the time of each symbol's newest bar, by single bars: doubled steps from the last known one,
    then halving. Bars later than the clock are left for a later batch.
    """

    def __init__(self, options: dict):
        self.options = options
        self.newest: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"since": int(self.options["start"])}

    def _first(self, symbol: str, since: int, until: int) -> int | None:
        """The time of the symbol's first bar from since on, before until."""
        fetch, pause = _client(self.options), float(self.options.get("pause", 2.0))
        return min((int(row[0]) for row in patiently(lambda: fetch(symbol, since, 1), base=pause) if since <= row[0] < until), default=None)

    def _end(self, symbol: str) -> int:
        """The time from which the symbol has no bar yet."""
        since = self.newest.get(symbol, int(self.options["start"]))
        until = int(time.time() * 1000) + MINUTE
        last = self._first(symbol, since, until)
        if last is None:
            return since
        step = MINUTE
        while last + step < until:
            found = self._first(symbol, last + step, until)
            if found is None:
                until = last + step
            else:
                last, step = found, 2 * step
        while until - last > MINUTE:
            middle = last + max(MINUTE, (until - last) // 2)
            found = self._first(symbol, middle, until)
            if found is None:
                until = middle
            else:
                last = found
        return last + MINUTE

    def latestOffset(self) -> dict:
        self.newest = {s: self._end(s) for s in self.options["symbols"].split(",")}
        return _offset(self.newest)

    def partitions(self, start: dict, end: dict) -> list[Page]:
        since, until = _by_symbol(self.options, start), _by_symbol(self.options, end)
        trail, size = int(self.options.get("trail", 0)) * MINUTE, int(self.options.get("page", 1000))
        return [page for s in since if since[s] < until[s] for page in pages([s], max(0, since[s] - trail), until[s], size)]

    def read(self, page: Page) -> Iterator[tuple]:
        return _rows_of(self.options, [page])


class CandlePages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "candle_pages"

    def schema(self) -> str:
        return ROW

    def reader(self, schema) -> DataSourceReader:
        # A reader that takes filters may only be used where the session lets it.
        return FilteringReader(self.options) if self.options.get("pushdown") == "true" else PageReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LiveReader(self.options)


PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def read_pages(spark: SparkSession, options: dict, symbols: list[str] | None = None, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """A history from the source, of some of its symbols and from start on and before end; only pages of these are fetched."""
    spark.dataSource.register(CandlePages)
    spark.conf.set(PUSHDOWN, "true")
    rows = spark.read.format("candle_pages").options(**options, pushdown="true").load()
    if symbols is not None:
        rows = rows.where(F.col("symbol").isin(symbols))
    if start_ms is not None:
        rows = rows.where(F.col("ts_ms") >= start_ms)
    if end_ms is not None:
        rows = rows.where(F.col("ts_ms") < end_ms)
    return rows
