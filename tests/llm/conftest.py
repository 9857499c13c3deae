from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, kind int, statistics string, row int, key string, pii string"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, long and repeated texts, repeated rows, and columns named like the operators' own."""
    from tidewick.llm.common import ship

    ship(spark)
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000)) + " mail a.b@c.example.com"
    extra = ("d", 1, "s", 2, "k", "p")
    rows = [
        (1, None, None, None, None, *extra), (2, "", "en", "a", 0, *extra), (3, "   \n\t ", "en", "a", 5, *extra), (4, long, "en", "a", len(long), *extra),
        (5, "one two three four five six seven eight nine ten", None, "b", None, *extra), (6, "One TWO three four five six seven eight nine ten", "en", None, 1, *extra),
        (6, "One TWO three four five six seven eight nine ten", "en", None, 1, *extra), (None, "only text without an id 😀 ünï", "en", "b", 3, *extra), (8, "short", "en", "b", 5, *extra), (9, "two words", "en", "b", 5, *extra),
    ]
    return spark.createDataFrame([tuple(r) for r in rows], ODD)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
