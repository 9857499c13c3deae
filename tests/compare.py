"""Compares a query's rows with its DuckDB counterpart's, in any order."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TINY = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    found = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        found.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return found


def ordered(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows[sorted(rows.columns)]
    rows = rows.assign(**{c: pd.to_datetime(rows[c]) for c in rows.columns if "date" in str(rows[c].dtype) or c == "trade_day"})
    return rows.sort_values(list(rows.columns)).reset_index(drop=True)


def assert_same(found: pd.DataFrame, expected: pd.DataFrame) -> None:
    found, expected = ordered(found), ordered(expected)
    assert list(found.columns) == list(expected.columns)
    assert len(found) == len(expected)
    for c in found.columns:
        same = (found[c] == expected[c]) | (found[c].isna() & expected[c].isna())
        assert same.all(), (c, found[c][~same].head(), expected[c][~same].head())
