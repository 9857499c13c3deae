"""SetSketch registers, their likelihood, and components against all pairs."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from compare import TINY

from tidewick.llm import queries, set_links, set_sketch
from tidewick.llm.set_sketch import BANDS, REGISTERS, band_keys, estimate, near_duplicates, possible, sketches


def hashes(rng: np.random.Generator, n: int) -> np.ndarray:
    return rng.integers(0, 1 << 64, n, dtype=np.uint64)


def pair(rng, n: int, m: int, both: int) -> list[np.ndarray]:
    every = hashes(rng, n + m - both)
    return [every[:n], every[n - both :]]


def test_registers_merge():
    """The union's registers are the greater ones; order and number of texts sketched at once don't matter."""
    rng = np.random.default_rng(1)
    sets = [hashes(rng, n) for n in (0, 1, 2, 30, 190, 700, 5000)]
    whole = sketches(sets)
    assert (whole[0] == 0).all() and all((sketches([s[::-1]])[0] == row).all() for s, row in zip(sets, whole))
    for i in range(1, 7):
        for j in range(i):
            assert (sketches([np.concatenate([sets[i], sets[j]])])[0] == np.maximum(whole[i], whole[j])).all()


def test_registers_are_spread_as_minima():
    """The least variable of n shingles is exponential with rate n, in every register and independent of the others."""
    rng = np.random.default_rng(2)
    for n in (1, 7, 400):
        least = set_sketch._least([hashes(rng, n) for _ in range(300)]) * n
        assert abs(least.mean() - 1) < 0.03 and abs((least < np.log(2)).mean() - 0.5) < 0.02
        assert abs(np.corrcoef(least[:, :20].T)[np.triu_indices(20, 1)]).mean() < 0.08


@pytest.mark.parametrize(("n", "m", "both"), [(100, 100, 92), (1000, 900, 880), (60, 400, 50), (300, 300, 100), (20, 20, 20), (50, 50, 0)])
def test_estimates(n, m, both):
    rng = np.random.default_rng(n + both)
    found, agree = [], []
    for _ in range(60):
        a, b = sketches(pair(rng, n, m, both))
        found.append(float(estimate(np.array(n / (n + m)), np.array((a > b).sum()), np.array((a < b).sum()))))
        agree.append((a == b).mean())
    true = both / (n + m - both)
    assert abs(np.mean(found) - true) < 0.015 and np.std(found) < np.sqrt(true * (1 - true) / REGISTERS) * 1.4 + 0.002
    assert abs(np.mean(agree) - true) < 0.02


def test_bands_and_filter_miss_no_linked_pair():
    rng = np.random.default_rng(5)
    missed = kept = 0
    for k in range(400):
        n = int(rng.integers(20, 900))
        both = int(np.ceil(0.85 * 2 * n / 1.85))  # just linked
        a, b = sketches(pair(rng, n, n, both))
        missed += not (band_keys(a[None]) == band_keys(b[None])).any() or not possible(np.array([n, n]), [a, b], 85)[0, 1]
        c, d = sketches(pair(rng, n, n, n // 2))
        kept += possible(np.array([n, n]), [c, d], 85)[0, 1]
    assert missed == 0 and kept == 0 and REGISTERS % BANDS == 0


@pytest.mark.parametrize(("words", "percent", "block"), [(5, 85, 250), (3, 85, 9)])
def test_components_equal_all_pairs(spark, monkeypatch, words, percent, block):
    monkeypatch.setattr(set_links, "BLOCK_ROWS", block)
    r = random.Random(words)
    base = [[r.choice([f"w{i}" for i in range(80)]) for _ in range(r.choice((2, 8, 40, 150)))] for _ in range(20)]
    texts = []
    for k in range(200):
        w = list(r.choice(base))
        for _ in range(r.choice((0, 0, 1, 1, 2, 4))):
            w[r.randrange(len(w))] = f"n{r.randrange(400)}"
        texts.append(" ".join(w if k % 3 else w + ["tail"]))
    rows = [*enumerate(texts), (900, None), (901, " \t"), (902, texts[0].upper()), (903, "x"), (904, "X"), (905, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = {x["doc_id"]: (x["component_id"], x["n_shingles"]) for x in near_duplicates(frame, words, percent).collect()}
    plain = brute.components(rows, words, percent)
    assert found == {i: (plain[i], len(brute.shingles(t, words))) for i, t in rows}


def test_odd_rows(odd, none):
    rows = near_duplicates(odd, 3, 70).collect()
    got = {(x["doc_id"], x["n_shingles"]): x["component_id"] for x in rows}
    assert len(rows) == 10 and got[6, 8] == 5 and got[1, 0] == 1 and got[2, 0] == 2 and got[None, 5] is None
    kept = set_sketch.keep_one_of_each(odd, 3, 70)
    assert kept.columns == odd.columns and sorted(x["doc_id"] or 0 for x in kept.collect()) == [0, 1, 2, 3, 4, 5, 8, 9]
    assert near_duplicates(none).count() == 0 == set_sketch.keep_one_of_each(none).count()


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    plain = brute.components(rows, 5, 85)
    found = queries.QUERIES["op12_setsketch_components"](spark, TINY).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found} == {(i, len(brute.shingles(t, 5)), plain[i], plain[i] == i) for i, t in rows}
    assert len(found) == len(rows) > len(set(plain.values()))
