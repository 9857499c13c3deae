"""What several operators share: reading tables, shared checkpoints, hashes."""

from __future__ import annotations

import re
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of df, computed now and kept in the folder that all executors share.

    The cluster names that folder in spark.checkpoint.dir. Where none is set, a temporary one is used in local mode, as in
    tests; on a cluster, whose machines don't share such a folder, that is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp())
    return df.checkpoint(eager=True)


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def scratch(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that clash with no column of df."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


BROADCAST, SALTS = 32 << 20, 64


def meet(rows: DataFrame, table: DataFrame, key: str, limit: int = BROADCAST) -> DataFrame:
    """rows with the columns of table, which has a short row for each key; null ones where the key has none.

    The table is counted first and broadcast if it has ``limit`` bytes at most, so that rows aren't shuffled. A larger one is
    given to all of ``SALTS`` tasks that share each key's rows, so that a key with a third of all rows is no hot spot.
    """
    table = checkpointed(table)
    texts = [F.coalesce(F.length(c), F.lit(0)) if kind == "string" else F.lit(0) for c, kind in table.dtypes]
    size = table.agg(F.sum(sum(texts, F.lit(64)))).head()[0] or 0
    if size <= limit:
        return rows.join(F.broadcast(table), key, "left")
    (salt,) = scratch(rows.join(table, key), "salt")
    spread = table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(spread, [key, salt], "left").drop(salt)


def in_parts(texts: pa.Array, size: int = 256) -> Iterator[list]:
    """The values of an Arrow array by small lists, so that a task never holds a whole batch as Python objects."""
    for start in range(0, len(texts), size):
        yield texts.slice(start, size).to_pylist()


_shipped: set[str] = set()
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def ship(spark: SparkSession) -> None:
    """Give the Python workers of every machine this package, once for an application, and bound Arrow batches by bytes.

    A batch of 10,000 rows, which is the default, may be any size; a worker holds one or two of them.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_SETTING) in (None, "67108864b"):  # as it is by default
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        held = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(held)
        _shipped.add(context.applicationId)
