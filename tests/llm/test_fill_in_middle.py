"""The automaton scan against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from compare import TINY, assert_same, tables
from pyspark.sql import functions as F

from tidewick.llm import queries
from tidewick.llm.fill_in_middle import CHUNK, MARK, PIECE, Scan, automaton, fill_in_middle, restored


def begins(text: str, units: str) -> list[int]:
    """Where units begin, in code points."""
    if units == "code_points":
        return list(range(len(text)))
    if units == "words":
        return [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return [0, *[k + 1 for k, c in enumerate(text) if c == "\n" and k + 1 < len(text)]] if text else []


def plainly(doc_id, text: str | None, units: str = "code_points") -> tuple:
    text, h = text or "", hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    at = begins(text, units)
    n = len(at)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (0 if k == 0 else len(text) if k == n else at[k] for k in (lo, hi))
    if n == 0:
        a = b = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", lo, hi - lo, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", lo, hi - lo, f"<P>{p}<S>{s}<M>{m}")


TEXTS = ["", " ", "\n", "a", "é", "<", "<P", "<P>", "x<S>y", "<<M>", "<P<S", "<P\n>", "< M>", "\n\n a\n\nb", "<P>" * 3, "ünï 😀\tzwei  drei\n\n", "P><S", "word " * 400, "é😀" * 700 + "<M", "a" * 300 + "<S>", "line\n" * 130]


@pytest.mark.parametrize("units", ["code_points", "words", "lines"])
@pytest.mark.parametrize("chunk", [1, 3, 200, CHUNK])
def test_cuts(spark, odd, units, chunk):
    rows = [(k, t) for k, t in enumerate(TEXTS * 3)] + [(None, None), (None, "no id"), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    made = fill_in_middle(docs, units, chunk=chunk).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert sorted((repr((r["doc_id"], r["text"], r["n"], r["form"], r["prefix_units"], r["middle_units"], r["output"])) for r in made)) == sorted(repr((i, t, *plainly(i, t, units))) for i, t in rows)
    assert all(r["back"] == (r["text"] or "") for r in made)


def test_functions_compose():
    """Any cut into two segments gives the function of the whole, from every state."""
    rng = random.Random(1)
    text = "".join(rng.choice("<<PSM>> \né😀a") for _ in range(3 * PIECE)).encode()
    raw = np.frombuffer(text, dtype=np.uint8)
    for units in ("code_points", "words", "lines"):
        auto = automaton(units)
        function = lambda a, b: [x[0] for x in Scan(auto, raw, np.array([a]), np.array([b - a])).composed(auto.starts[None])[:2]]  # noqa: E731, B023
        ends, counts = function(0, len(raw))
        assert sum(text.count(s) for s in (b"<P>", b"<S>", b"<M>")) == counts[0] >> MARK
        for cut in rng.sample(range(len(raw) + 1), 20):
            (e1, c1), (e2, c2) = function(0, cut), function(cut, len(raw))
            place = e1 // auto.width
            assert (e2[place] == ends).all() and (c1 + c2[place] == counts).all()


def test_odd_rows(odd, none):
    made = fill_in_middle(odd.withColumnRenamed("lang", "form").withColumn("known", F.lit(1)).withColumn("output", F.lit("old")), chunk=1000)
    assert set(made.columns) == {*odd.columns, "known", "n", "form", "prefix_units", "middle_units", "output"} - {"lang"}
    for r in made.collect():
        assert (r["n"], r["form"], r["prefix_units"], r["middle_units"], r["output"]) == plainly(r["doc_id"], r["text"])
    assert fill_in_middle(none).count() == 0


def test_query(spark):
    assert_same(queries.QUERIES["op13_fill_in_middle"](spark, TINY).toPandas(), tables(TINY).sql(queries.ORACLES["op13_fill_in_middle"]).df())
