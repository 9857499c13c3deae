"""Runs of words against a plain search of all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from compare import TINY
from pyspark.sql import functions as F

from tidewick.llm import periodic_runs, queries
from tidewick.llm.periodic_runs import Suffixes, runs_of, with_runs


def runs(w: list, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """All stretches of a period and maximal, of the smallest period."""
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q) and not any(w[i : j + q - p] == w[i + p : j + q] for p in range(1, q)):
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w: list[str], found: list) -> str:
    gone = {k for start, length, q in found for k in range(start + q, start + length)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def made(rng: random.Random) -> list[str]:
    n = rng.choice([0, 1, 5, 6, 7, 20, 60, 150])
    w = [f"w{rng.randrange(rng.choice([1, 2, 3, 30]))}" for _ in range(n)]
    if n > 8 and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randint(1, n // 4)
        w = [w[min(n - 1, a + (k - a) % p)] if k >= a else w[k] for k in range(n)]
    return w * rng.randint(1, 5) + w[: rng.randint(0, 3)] if rng.random() < 0.3 else w


@pytest.mark.parametrize("seed", range(4))
def test_runs_are_all_found(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = [made(rng) for _ in range(rng.randint(1, 6))]
        for w, (n, found, kept) in zip(texts, runs_of([" ".join(w).encode() for w in texts])):
            assert (n, found, kept.decode()) == (len(w), runs(w), collapsed(w, found))


def test_vocabulary_is_complete(monkeypatch):
    """Every square of every type is found, not only those of long runs."""
    monkeypatch.setattr(periodic_runs, "TIMES", 2)
    monkeypatch.setattr(periodic_runs, "LEAST", 2)
    rng = random.Random(1)
    for _ in range(400):
        w = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(1, 60))]
        assert sorted(Suffixes(np.array(w)).runs(len(w)), key=lambda r: (r[0], r[2])) == runs(w, 2, 2)


def test_groups_and_long_texts(monkeypatch):
    """Texts that are longer than what is searched at once, and many of them."""
    monkeypatch.setattr(periodic_runs, "GROUP", 50)
    rng = random.Random(2)
    long = [f"x{rng.randrange(40)}" for _ in range(700)] * 5 + ["a"] * 3000 + ["b", "c"] * 9
    texts = [made(rng) for _ in range(60)] + [long]
    for w, (_, found, kept) in zip(texts, runs_of([" ".join(w).encode() for w in texts])):
        assert found == runs(w) and kept.decode() == collapsed(w, found)


def test_white_space_and_letters(spark):
    texts = ["a\ta\na\x0ba\x0ca\ra", "A a A a A a a a a a a a", " x y x y x y x y ", "a a " * 7, "é é é é é é", "a a a a a", None, "", "  "]
    rows = with_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(2)).collect()
    for r in rows:
        w = words(texts[r["doc_id"]])
        assert (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) == (len(w), runs(w), collapsed(w, runs(w)))


def test_odd_rows(odd, none):
    found = with_runs(odd.withColumnRenamed("lang", "runs").withColumn("collapsed", F.lit(3)).withColumn("chunk", F.lit(1)))
    assert set(found.columns) == {*odd.columns, "chunk", "n_words", "runs", "collapsed"} - {"lang"}
    for r in found.collect():
        assert (r["n_words"], [tuple(x) for x in r["runs"]]) == (len(words(r["text"])), runs(words(r["text"])) if len(words(r["text"])) < 1000 else [])
    assert with_runs(none).count() == 0


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_periodic_runs"](spark, TINY).collect()
    assert len(rows) == len(texts)
    some = 0
    for r in rows:
        w, h = words(texts[r["doc_id"]]), zlib.crc32(str(r["doc_id"]).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        found = runs(w)
        some += len(found)
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(found), *best, 1000 * best[1] // best[2] if found else None)
        assert (r["runs_sha256"], r["collapsed_sha256"]) == (sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(collapsed(w, found)))
    assert some > 10
