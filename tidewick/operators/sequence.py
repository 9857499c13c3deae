"""Order within a symbol without one task for a symbol.

A symbol may have most rows of the table, so that a window over all its rows would run in one task. Rows are numbered in
two steps (within days, then by the counts of earlier days), cut into chunks of equal size by number, and those near a cut
are also given to the chunk beside it. Row frames that reach no further than that are then exact within a chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 8192
# Rows for a task, on average.
TASK_ROWS = 65_536


def numbered(candles: DataFrame, tasks: int | None = None) -> DataFrame:
    """candles with i, the place by time within the symbol from 0, and n, the symbol's rows. Days may be dealt to so many tasks."""
    days = candles.withColumn("day_", F.to_date("timestamp"))
    whole = Window.partitionBy("symbol")
    before = F.sum("rows_").over(whole.orderBy("day_").rowsBetween(Window.unboundedPreceding, -1))
    sizes = days.groupBy("symbol", "day_").agg(F.count(F.lit(1)).alias("rows_")).select("symbol", "day_", F.coalesce(before, F.lit(0)).alias("before_"), F.sum("rows_").over(whole).alias("n"))
    # Both sides alike; else the join may deal the days anew.
    days, sizes = (dealt(x, tasks, "symbol", "day_") for x in (days, sizes))
    placed = days.withColumn("in_day_", F.row_number().over(Window.partitionBy("symbol", "day_").orderBy("timestamp")) - 1)
    return placed.join(sizes, ["symbol", "day_"]).withColumn("i", F.col("before_") + F.col("in_day_")).drop("day_", "in_day_", "before_")


def chunked(rows: DataFrame, before: int, after: int, size: int = CHUNK) -> DataFrame:
    """Numbered rows with their chunk_, those within before rows of its start or after rows of its end included; own_ tells a chunk's own rows."""
    size = max(size, before, after, 1)
    own = F.floor(F.col("i") / size)
    at = F.col("i") % size
    chunks = F.array_compact(F.array(own, F.when(at >= size - before, own + 1), F.when((at < after) & (own > 0), own - 1)))
    return rows.withColumn("chunk_", F.explode(chunks)).withColumn("own_", F.col("chunk_") == F.floor(F.col("i") / size))


def tasks_for(rows: DataFrame) -> int:
    """Tasks by the number of rows, which are counted: as many as there are cores at least.

    Adaptive execution goes by the bytes that tasks read, whatever they make of them, and never beyond Spark's number of shuffle partitions,
    which doesn't grow with the table.
    """
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))


def dealt(rows: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """Groups of rows, chunks unless keys are named, dealt to so many tasks; without a number adaptive execution counts them."""
    return rows.repartition(tasks, *(keys or ("symbol", "chunk_"))) if tasks else rows


def within():
    """A window by number within a chunk."""
    return Window.partitionBy("symbol", "chunk_").orderBy("i")


def own_rows(rows: DataFrame) -> DataFrame:
    return rows.where("own_").drop("chunk_", "own_")
