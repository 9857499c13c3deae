"""Every candle query against its DuckDB counterpart, or for its rows alone."""

from __future__ import annotations

import pytest
from compare import TINY, assert_same, tables

from tidewick.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, name):
    assert_same(registry.QUERIES[name](spark, TINY).toPandas(), tables(TINY).sql(registry.ORACLES[name]).df())


def test_batches_are_bounded(spark):
    batches = registry.QUERIES["training_batches"](spark, TINY).toPandas()
    assert batches.groupby(["split", "shard", "batch"]).size().max() <= 64


def test_entry_and_names(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
