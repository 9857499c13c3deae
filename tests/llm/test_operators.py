"""Each operator against a plain version on small tables, and on odd ones."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib

import brute
import numpy as np
import public_tokenizers as tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from compare import TINY, assert_same, tables
from tidewick.llm import bpe, exact_dedup, fingerprints, html_text, jaccard_join, packing, personal_data, quality, queries, secrets, set_links, url_filter
from tidewick.llm.shingles import shingle_sets

RANKS = tokenizers.path("byte_bpe_50k.tiktoken")
JSON = tokenizers.path("byte_bpe_50k.json")


def docs_of(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


@pytest.fixture(scope="session")
def texts():
    return dict(tables(TINY).sql("SELECT doc_id, text FROM documents").fetchall())


# Exact dedup.


def test_copies_oracle(spark):
    assert_same(queries.QUERIES["op8_exact_dedup"](spark, TINY).toPandas(), tables(TINY).sql(queries.ORACLES["op8_exact_dedup"]).df())


@pytest.mark.parametrize("heavy", [1, 8])
def test_copies(spark, odd, none, heavy):
    rows = exact_dedup.label_copies(odd, heavy=heavy, tracked=8).collect()
    by = {(r["doc_id"], r["text_sha256"]): r for r in rows}
    assert len(rows) == 10 and sum(r["kept"] for r in rows) == 8
    assert by[1, brute.sha("")]["keep_id"] == 2 and by[2, brute.sha("")]["group_size"] == 2
    assert sorted(r["kept"] for r in rows if r["doc_id"] == 6) == [False, True]
    kept = exact_dedup.drop_copies(odd, heavy=heavy, tracked=8)
    assert kept.columns == odd.columns and kept.count() == 8
    assert exact_dedup.label_copies(none).count() == 0 == exact_dedup.drop_copies(none).count()


# Personal data.


def test_pii_matches_brute_force(spark, texts):
    tricky = ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "999.1.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (23) 45-678", "+1 2", "x" * 50_000 + "@" + "y." * 5_000 + "z", "1" * 100_000, "1 " * 50_000, "💥 +49 30 1234567 é@é a@b.de", "00001.2.3.255", "@@a@b..c", "1.2.3.256"]
    rows = personal_data.with_spans(docs_of(spark, [*texts.values(), *tricky, None]), "found").collect()
    assert len(rows) == len(texts) + len(tricky) + 1
    for r in rows:
        base = [(x["kind"], x["start"], x["end"]) for x in r["found"] if x["kind"] in ("email", "ip", "card", "phone")]
        assert base == brute.pii_spans(r["text"]), r["text"][:60]


def test_pii_checksums_context_and_masks(spark, odd, none):
    found = {r["text"]: r["found"] for r in personal_data.with_spans(docs_of(spark, ["IBAN DE89 3704 0044 0532 0130 00 ok", "DE88 3704 0044 0532 0130 00", "social security 123-45-6789", "part 123-45-6789", "card 4111111111111111", "id 4111111111111111"]), "found").collect()}
    kinds = {t: [x["kind"] for x in f] for t, f in found.items()}
    assert kinds["IBAN DE89 3704 0044 0532 0130 00 ok"][-1] == "iban" and "iban" not in kinds["DE88 3704 0044 0532 0130 00"]
    assert kinds["social security 123-45-6789"] == ["ssn"] and kinds["part 123-45-6789"] == []
    assert found["card 4111111111111111"][0]["score"] > found["id 4111111111111111"][0]["score"]
    masked = personal_data.mask_personal_data(docs_of(spark, ["é to a.b@c.de, 10.0.0.1! 4111 1111 1111 1111@x.de +1 234 567 89", None]).withColumn("n_chars", F.length("text").cast("bigint"))).collect()
    assert masked[0]["text"] == "é to [EMAIL], [IP]! [CARD] [PHONE]" and masked[0]["n_chars"] == len(masked[0]["text"]) and masked[1]["text"] is None
    out = personal_data.mask_personal_data(odd)
    assert out.columns == odd.columns and out.count() == 10 and out.where("text like '%[EMAIL]%'").count() == 1
    assert personal_data.mask_personal_data(none).count() == 0


def test_masks_equal_plain_ones(spark, texts):
    """Masks put in by plain code at the spans found, in texts with few and with many spans."""
    r = random.Random(4)
    many = " é ".join(r.choice(("a.b@c.de", "10.1.2.3", "+49 30 1234567", "4111 1111 1111 1111@x.de", "none", "IBAN DE89 3704 0044 0532 0130 00")) for _ in range(3000))
    docs = docs_of(spark, [*texts.values(), many]).withColumn("pii", F.lit("own"))
    spans = {x["doc_id"]: x["found"] for x in personal_data.with_spans(docs, "found").collect()}
    assert len(spans[len(texts)]) > 2000
    for x in personal_data.mask_personal_data(docs).collect():
        text, at, out = [*texts.values(), many][x["doc_id"]] or "", 0, []
        for span in sorted(spans[x["doc_id"]], key=lambda s: (s["start"], -s["end"])):
            if span["start"] >= at:
                out += [text[at : span["start"]], f"[{span['kind'].upper()}]"]
            at = max(at, span["end"])
        assert (x["text"] or "") == "".join(out) + text[at:] and x["pii"] == "own"
    assert personal_data.with_spans(docs, "pii").columns == ["doc_id", "text", "pii"]


# Byte-level BPE.


@pytest.fixture(scope="session")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(texts, reference):
    codec, r = bpe.TextCodec(RANKS, tokenizers.PATTERN), random.Random(5)
    made = ["".join(r.choice("abcdefgh the ing tion ATAaa  \n\t\x1c\x85\u3000ßñ日😀²Ⅷ٣'’K_-!?%$#123") for _ in range(r.randint(0, 40))) for _ in range(3000)]
    made += ["a" * 4000, "aA" * 3000, "é" * 2000, " " * 3000, "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)), "<|endoftext|>"]
    for text in [*texts.values(), *made]:
        found = codec.pieces(text)
        assert [i for x in found for i in x[0]] == reference.encode_ordinary(text)
        assert b"".join(x[2] for x in found) == text.encode()


def test_bpe_clashing_columns(spark):
    docs = docs_of(spark, ["a b", None]).withColumns({"coded": F.lit("own"), "n_tokens": F.lit(-1), "ids": F.lit("old")})
    rows = bpe.with_tokens(docs, RANKS, tokenizers.PATTERN, ids=True)
    assert sorted(rows.columns) == sorted(["doc_id", "text", "coded", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])
    assert [(r["coded"], r["n_tokens"], len(r["ids"])) for r in rows.orderBy("doc_id").collect()] == [("own", 2, 2), ("own", 0, 0)]


def test_bpe_memo_and_odd_rows(spark, odd, none, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    assert bpe.TextCodec(RANKS, tokenizers.PATTERN).pieces("a b c d e a b c")[0][0] == reference.encode_ordinary("a")
    for r in bpe.with_tokens(odd, RANKS, tokenizers.PATTERN, ids=True).collect():
        ids = reference.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(ids) and r["ids"] == ids
        assert r["ids_sha256"] == brute.sha(" ".join(map(str, ids))) and r["decoded_sha256"] == brute.sha(r["text"] or "")
    assert bpe.with_tokens(none, RANKS, tokenizers.PATTERN).count() == 0


# Packing.


def check_packing(pieces, expected, length=packing.LENGTH):
    assert sorted((p["doc_id"] is None, p["doc_id"] or 0, p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces) == sorted((d is None, d or 0, *rest) for d, *rest in expected)
    by: dict[int, list] = {}
    for p in pieces:
        by.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for held in by.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= length
    return len(by)


def expected_pieces(rows, length=packing.LENGTH):
    library = Tokenizer.from_file(JSON)
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(ids) if len(ids) <= length else (len(ids) - 1) % length + 1
        for k, start in enumerate([0, *range(first, len(ids), length)]):
            part = ids[start : first if k == 0 else start + length]
            yield (doc_id, k, start, len(part), zlib.crc32(part.tobytes()))


def test_packing_places_all_pieces(spark, odd, none):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text")
    more = docs_of(spark, ["<|endoftext|> a <|endoftext|>", None, "", "x" * 9000], 10**6)
    rows = docs.union(more)
    pieces = packing.pack(rows, JSON).collect()
    sequences = check_packing(pieces, list(expected_pieces(rows.collect())))
    assert sequences <= -(-sum(p["length"] for p in pieces) // packing.LENGTH) + 1
    check_packing(packing.pack(odd, JSON).collect(), list(expected_pieces(odd.select("doc_id", "text").collect())))
    assert packing.pack(none, JSON).count() == 0


@pytest.mark.parametrize("make", [lambda r: r.integers(1, 65, 4000), lambda r: np.full(999, 21), lambda r: np.where(r.random(3000) < 0.4, 17, r.integers(1, 65, 3000)), lambda r: np.array([], dtype=int), lambda r: np.array([64, 64, 1])])
def test_plan_covers_histogram(make):
    sizes = make(np.random.default_rng(3))
    histogram = np.bincount(sizes.astype(int), minlength=65)
    placed, filled = np.zeros(65, dtype=int), {}
    for size, rank, count, first, offset, _ in packing.plan(histogram, 64).tolist():
        assert rank == placed[size]
        placed[size] += count
        for s in range(first, first + count):
            filled.setdefault(s, []).append((offset, size))
    assert (placed == histogram).all()
    for held in filled.values():
        assert sum(s for _, s in held) <= 64 and [o for o, _ in sorted(held)] == [sum(s for _, s in sorted(held)[:k]) for k in range(len(held))]


def test_fit_is_least_squares():
    rows = packing.patterns(np.arange(1, 16), 16)
    true = np.zeros(len(rows))
    true[[0, 3, 7]] = [50, 20, 80]
    histogram = np.zeros(17)
    for row, k in zip(rows, true):
        for s in row[row > 0]:
            histogram[s] += k
    rest = histogram.copy()
    for row, k in zip(rows, packing.fit(histogram, rows, 1e-12)):
        for s in row[row > 0]:
            rest[s] -= k
    assert np.abs(rest).max() < 0.5


def test_all_patterns_and_most_pieces():
    """All patterns, whatever the length; the fit leaves little, and patterns place most pieces."""
    assert len(packing.patterns(np.arange(1, 4096), 4096)) == sum(1 for a in range(1, 4096) for b in (min(a, 4096 - a),) if 2 * b >= 4096 - a for _ in range(-(-(4096 - a) // 2), b + 1))
    sizes = np.clip(np.random.default_rng(1).gamma(2, 350, 10_000).astype(int), 1, 2047)
    histogram = np.bincount(sizes, minlength=2049)
    runs = packing.plan(histogram)
    assert runs[runs[:, 5] == 1, 2].sum() > 0.8 * len(sizes)
    assert len({s for _, _, c, f, _, _ in runs.tolist() for s in range(f, f + c)}) <= -(-sizes.sum() // 2048) + 1


# Secrets.


def test_secret_spans(spark, texts, odd, none):
    tricky = ["PASSWORD: 'abc123", "paſſword=abcdef", "api_key = \"x.y/z+1=\"", "token=abc", "AKIAAKIA" + "Z" * 16 + " AKIA123", "a" * 24, "f" * 100_000, "tokentoken=abcdef", "secret=secret=abcdef", None]
    rows = secrets.scan(docs_of(spark, [*texts.values(), *tricky])).collect()
    text_of = dict(enumerate([*texts.values(), *tricky]))
    for r in rows:
        base = [(x["kind"], x["start"], x["end"]) for x in r["spans"] if x["kind"] != "format"]
        assert base == brute.secret_spans(text_of[r["doc_id"]])
    assert secrets.scan(odd).count() == 10 and secrets.scan(none).count() == 0


def test_formats_are_inferred(spark):
    r = random.Random(7)
    code = lambda n, chars: "".join(r.choice(chars) for _ in range(n))
    known = [f"x password={code(20, '0123456789abcdef')} and AKIA{code(16, 'ABCDEFGHIJ234567')} y" for _ in range(120)]
    plain = [f"{code(18, 'abcdefghijklmnopqrstuvwxyz')} {code(20, 'abcdefghilmnoprstuv')}" for _ in range(120)]
    hidden, fine = "see " + code(20, "0123456789abcdef") + " here", "see mail5_examples_of_words_2024 here"
    rows = {x["doc_id"]: x["spans"] for x in secrets.scan(docs_of(spark, [*known, *plain, hidden, fine])).collect()}
    assert [(x["kind"], x["start"], x["end"]) for x in rows[240]] == [("format", 4, 24)] and rows[241] == []


def test_likelihood_equals_plain_product():
    """The product of each step's smoothed share of the state's runs, by counting the training strings themselves."""
    r = random.Random(3)
    strings = ["".join(r.choice("ab1") for _ in range(r.randint(1, 6))) for _ in range(300)]
    learned = secrets.Automaton(strings)
    walks = []
    for x in strings:
        state, steps = 0, []
        for c in secrets.shape(x):
            steps.append((state, c))
            state = learned.next[state][c][0]
        walks += [*steps, (state, "")]
    size = {"a": 6, "0": 10, "g": 20}
    for x in [*strings[:20], "b1a1", "zzz"]:
        state, total = 0, 0.0
        for c in [*secrets.shape(x), ""]:
            at = sum(s == state for s, _ in walks)
            seen = sum(w == (state, c) for w in walks)
            total += np.log((seen + secrets.SMOOTHING) / (at + 12 * secrets.SMOOTHING)) - (np.log(size[c]) if c else 0)
            state = learned.next[state][c][0] if c and seen else state
        assert np.isclose(total, learned.log_likelihood(x))


def test_clean_texts_have_few_format_spans(spark, texts):
    """Credentials of an unseen prefix are found, other texts are left alone."""
    r = random.Random(5)
    key = lambda: "".join(r.choice("0123456789abcdef") for _ in range(32))
    planted = [f"{t[:300]} zk_{key()} {t[300:600]}" for t in list(texts.values())[:20]]
    clean = list(texts.values())
    rows = {x["doc_id"]: [s["kind"] for s in x["spans"]] for x in secrets.scan(docs_of(spark, [*planted, *clean, *(f"token={key()}" for _ in range(50))])).collect()}
    assert sum("format" in rows[k] or "hex" in rows[k] for k in range(20)) == 20
    assert sum("format" in rows[k] for k in range(20, 20 + len(clean))) <= 0.01 * len(clean)


def test_automaton_merges_states():
    learned = secrets.Automaton(["a1" * n for n in range(1, 12)] * 40)
    assert learned.log_likelihood("a1a1a1a1") > learned.log_likelihood("aa11aa11") + 3


SIZES = {"0": 10, "a": 6, "g": 20, "A": 6, "G": 20}


def test_automaton_equals_plain_alergia():
    r = random.Random(8)
    kinds = (lambda: "zk_" + "".join(r.choice("0a") for _ in range(6)), lambda: "".join(r.choice("gA0") for _ in range(r.randint(1, 7))), lambda: "ga" * r.randint(1, 5) + "-0")
    for made in ((0,), (1,), (0, 1, 2), (2, 2, 1)):
        strings = [kinds[r.choice(made)]() for _ in range(r.choice((30, 300)))]
        shapes: dict[str, int] = {}
        for x in strings:
            shapes[secrets.shape(x)] = shapes.get(secrets.shape(x), 0) + 1
        plain, learned = brute.alergia(shapes, secrets.CONFIDENCE), secrets.Automaton(strings)
        for x in [*strings, "zk_0a0a0a", "gagaga-0", "G/G", "0"]:
            assert np.isclose(brute.log_likelihood(plain, secrets.shape(x), secrets.SMOOTHING, SIZES), learned.log_likelihood(x)), x


def test_added_spans_equal_a_plain_scan(spark):
    """All runs of all texts, scored by plain automata of all base spans and other runs; with nulls, repeats and clashing columns."""
    r = random.Random(12)
    code = lambda n, chars: "".join(r.choice(chars) for _ in range(n))
    made = [f"a password={code(12, '0123456789')}-{code(3, 'abcdef')} b {code(r.randint(3, 9), 'ghijklmn')}" for _ in range(80)]
    made += [f"{code(17, 'opqrst')} {code(12, '0123456789')}-{code(3, 'abcdef')}, {code(19, 'ghijkz')}; {code(12, '0123456789')}" for _ in range(6)]
    made += [f"{code(r.randint(16, 22), 'gklmnopq')} {code(r.randint(14, 20), 'abcghij')}" for _ in range(150)] + ["", "  "]
    rows = [*enumerate(made), (3, made[3]), (None, made[82]), (999, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"spans": F.lit(1), "id": F.lit("x"), "kind": F.lit(2)}).repartition(3)
    run = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % 16)
    values: dict[str, set] = {}
    for _, text in rows:
        base = brute.secret_spans(text)
        for kind, a, b in base:
            values.setdefault(kind, set()).add(brute.ASSIGN.match(text, a)[2] if kind == "assign" else text[a:b])
        values.setdefault("word", set()).update(m[0] for m in re.finditer(r"[A-Za-z0-9+/_=-]{6,}", text or "") if not any(a < m.end() and m.start() < b for _, a, b in base))
    shortest = min(len(x) for kind, found in values.items() if kind != "word" for x in found)
    assert shortest == 16
    count = lambda found: {s: sum(secrets.shape(x) == s for x in found) for s in {secrets.shape(x) for x in found if len(x) >= shortest}}
    automata = {kind: brute.alergia(count(found), secrets.CONFIDENCE) for kind, found in values.items()}
    like = lambda kind, x: brute.log_likelihood(automata[kind], secrets.shape(x), secrets.SMOOTHING, SIZES)
    expected = []
    for i, text in rows:
        base = brute.secret_spans(text)
        added = [("format", m.start(), m.end()) for m in run.finditer(text or "") if not any(a < m.end() and m.start() < b for _, a, b in base) and (max(like(k, m[0]) for k in automata if k != "word") - like("word", m[0])) / len(m[0]) >= secrets.MARGIN]
        expected.append((-1 if i is None else i, sorted([*base, *added], key=lambda x: x[1])))
    found = [(-1 if r["doc_id"] is None else r["doc_id"], [(x["kind"], x["start"], x["end"]) for x in r["spans"]]) for r in secrets.scan(frame).collect()]
    assert sorted(found) == sorted(expected) and sum(x[0] == "format" for _, spans in found for x in spans) >= 7


@pytest.mark.parametrize("others", [6_000, 200_000])
def test_rare_formats_stay_known_among_many_others(spark, others):
    """Sixty examples of a format are learned however many others of the kind there are."""
    r = random.Random(13)
    code = lambda: "-".join("".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(4)) for _ in range(3)) + "".join(r.choice("0123456789") for _ in range(6))
    rare = docs_of(spark, [*(f"x token={code()} y" for _ in range(60)), *(f"see {code()} here" for _ in range(5))])
    made = F.translate(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 12 + (F.hash("id") % 5)), "0123", "ghij")
    many = spark.range(1000, 1000 + others).select(F.col("id").alias("doc_id"), F.concat(F.lit("so token="), made, F.lit(" some "), F.translate(F.substring(F.sha2(F.concat(F.lit("w"), "id"), 256), 1, 16), "0123456789", "ghijklmnop"), F.lit(" words")).alias("text"))
    found = secrets.scan(rare.select("doc_id", "text").unionByName(many)).where("doc_id BETWEEN 60 AND 64").collect()
    assert [[x["kind"] for x in r["spans"]] for r in found] == [["format"]] * 5


def test_strata_share_the_sample():
    strata = {"a": (1_000_000, 20.0), "b": (60, 20.0), "c": (500, 40.0), "d": (3, 1e6)}
    rates = secrets.rates(strata, 100_000)
    assert rates["b"] == rates["c"] == 1 and rates["d"] == 0 and 1e6 * 20 * rates["a"] == pytest.approx(100_000 - 60 * 20 - 500 * 40)
    assert set(secrets.rates({"b": (60, 20.0)}, 100_000).values()) == {1.0} and secrets.rates({}, 10) == {}


def test_formats_of_any_length_and_class(spark):
    """Short runs, runs without digits, and formats that are longer or rarer than a sample of the examples would show."""
    r = random.Random(11)
    code = lambda n, chars: "".join(r.choice(chars) for _ in range(n))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    short = lambda: f"{code(2, upper)}-{code(4, upper)}"
    long = lambda: "/".join(code(5, upper) for _ in range(30))
    known = [f"x password={short()} y" for _ in range(600)] + [f"x token={long()} y" for _ in range(60)]
    plain = [f"{code(r.randint(6, 9), lower)} {code(20, lower)}" for _ in range(300)]
    hidden = [short(), long()]
    rows = {x["doc_id"]: x["spans"] for x in secrets.scan(docs_of(spark, [*known, *plain, *(f"see {x} here" for x in hidden)])).collect()}
    assert [[(x["kind"], x["start"], x["end"]) for x in rows[960 + k]] for k in (0, 1)] == [[("format", 4, 4 + len(x))] for x in hidden]
    assert not any(rows[k] for k in range(660, 960))


# Quality.


def test_quality_held_out(spark):
    rows = queries.QUERIES["op1_quality_discriminant"](spark, TINY).toPandas()
    labels = tables(TINY).sql("SELECT doc_id, quality FROM labels").df()
    assert ((rows["score"] >= 0) & (rows["score"] <= 1)).all() and ((rows["score"] >= 0.3) == (rows["predicted"] == 1)).all()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows["doc_id"]]).all()
    both = rows.merge(labels, on="doc_id")
    assert (both["predicted"] == both["quality"]).mean() > 0.95


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (6, None), (None, 0)], "doc_id bigint, quality int")
    assert odd.columns == quality.keep_good(odd, labels).columns
    assert {r["score"] for r in quality.with_quality(odd, labels).collect()} == {1.0}
    assert quality.with_quality(none, labels).count() == 0
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    known = spark.read.parquet(f"{TINY}/labels.parquet")
    kept = {r["doc_id"] for r in quality.keep_good(docs, known).select("doc_id").collect()}
    good = {r["doc_id"] for r in known.where("quality = 1").collect()} & {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert len(good - kept) <= 0.03 * len(good)


def test_keep_good_learns_from_all(spark, odd):
    """Classes that overlap, more rows of each than a sample would hold: the same texts go as by the query."""
    docs = spark.range(80_000).select(F.col("id").alias("doc_id"), F.expr("concat_ws(' ', transform(sequence(1, 6), k -> concat(if(xxhash64(id, k) % 100 < if(id % 4 = 0, 0, 25), 'W', 'w'), pmod(xxhash64(k, id), 90)))) ").alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 4 == 0, 0).otherwise(1).alias("quality"))
    kept = {r["doc_id"] for r in quality.keep_good(docs, labels).select("doc_id").collect()}
    expected = {r["doc_id"] for r in quality.with_quality(docs, labels).where(F.col("score") >= quality.CUT).select("doc_id").collect()}
    assert 0 < len(expected) < 80_000 and kept == expected


# Host reputation.


def test_url_rules(spark):
    urls = ["http://A.Example.COM/en/7?x", "https://com/en/", "ftp://x.com", "x.net/de/8", "http://example.net/de/81#a", "http://notexample.net/de/8", "http://h.org/es/?q", None, "", "a://b://c/d", "http://x.net?/de/", "HTTP://É.Net/de/1"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    outcomes = rows.select(url_filter.host_of(F.col("url")).alias("host"), F.lit(None).cast("int").alias("bad"))
    for r in url_filter.judge(rows, outcomes, queries.URL_RULES).collect():
        host, path = brute.host_and_path(r["url"])
        rule = brute.rule_for(host, path, queries.URL_RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[1] + rule[2])
        assert r["verdict"] == (rule[0] if rule else "allow")


def test_reputation_shrinks(spark):
    rows = [(f"h{i}.good.com", 0) for i in range(20) for _ in range(30)] + [(f"s{i}.bad.com", 1) for i in range(10) for _ in range(30)] + [("new.bad.com", None), ("new.good.com", None), ("one.good.com", 1)]
    found = {r["host"]: r for r in url_filter.reputations(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert found["s1.bad.com"]["bound"] > 0.5 and found["new.bad.com"]["bound"] > found["new.good.com"]["bound"]
    assert found["one.good.com"]["bad_rate"] < 0.5 and found["h1.good.com"]["bound"] < 0.1
    assert url_filter.reputations(spark.createDataFrame([], "host string, bad int")).count() == 0


def test_bad_domain_blocks_its_new_host(spark):
    """Hosts at the corpus's rate, one of them with few labels all bad, a bad host, and a bad domain with a host never seen."""
    r = random.Random(6)
    rows = [(f"www.d{i}.org", int(r.random() < 0.25)) for i in range(200) for _ in range(60)] + [("few.d1.org", 1)] * 2 + [("one.mixed.org", 1)] * 100
    rows += [(f"s{i}.bad.net", int(r.random() < 0.95)) for i in range(10) for _ in range(40)]
    outcomes = spark.createDataFrame(rows, "host string, bad int")
    urls = ["http://www.d7.org/x", "http://few.d1.org/", "http://one.mixed.org/", "http://never.bad.net/x", "http://s1.bad.net/", "http://unknown.example/"]
    pages = spark.createDataFrame([(i, u, "own", "own", 1.0) for i, u in enumerate(urls)] * 2, "page_id int, url string, corpus string, rule string, bound double")
    new = outcomes.unionByName(pages.select(url_filter.host_of(F.col("url")).alias("host"), F.lit(None).cast("int").alias("bad")))
    for limit in (url_filter.BROADCAST, 0):
        judged = url_filter.judge(pages, new, broadcast=limit)
        assert sorted(judged.columns) == sorted(["page_id", "url", "corpus", "host", "path", "rule", "verdict", "bad_rate", "bound"])
        found = judged.collect()
        assert len(found) == 12 and all(x["corpus"] == "own" and x["rule"] is None for x in found)
        assert {x["page_id"]: x["verdict"] for x in found} == {0: "allow", 1: "allow", 2: "block", 3: "block", 4: "block", 5: "allow"}
    assert url_filter.judge(pages.where("false"), new).count() == 0


def test_posteriors_equal_plain_beta_binomials(spark):
    """Each level by its own formulas; a host's posterior by integrating prior times likelihood."""
    r = random.Random(8)
    rows = [(f"h{h}.d{d}.{s}", int(r.random() < rate)) for s, rate0 in (("com", 0.2), ("org", 0.5)) for d in range(6) for h in range(3) for rate in [min(0.95, rate0 * r.choice((0.3, 1, 1.8)))] for _ in range(r.choice((0, 3, 12, 40)))]
    found = {x["host"]: x for x in url_filter.reputations(spark.createDataFrame(rows, "host string, bad int")).collect()}
    level = lambda names: {key: (sum(1 for h, _ in rows if key == names(h)), sum(b for h, b in rows if key == names(h))) for key in {names(h) for h, _ in rows}}
    means = {"": (sum(b for _, b in rows) + 1) / (len(rows) + 2)}
    for names in (lambda h: h.split(".", 2)[2], lambda h: h.split(".", 1)[1], lambda h: h):
        units = {key: (n, k, means[key.split(".", 1)[1] if "." in key else ""]) for key, (n, k) in level(names).items()}
        beyond, room = sum((k - n * m) ** 2 - n * m * (1 - m) for n, k, m in units.values()), sum(n * (n - 1) * m * (1 - m) for n, k, m in units.values())
        strength = 1 / (beyond / room) - 1 if beyond > 0 else url_filter.POOLED
        means |= {key: (k + strength * m) / (n + strength) for key, (n, k, m) in units.items()}
    assert found.keys() == units.keys() and strength < url_filter.POOLED
    grid = np.linspace(0, 1, 200_001)[1:-1]
    for host, (n, k, m) in units.items():
        density = np.log(grid) * (k + strength * m - 1) + np.log1p(-grid) * (n - k + strength * (1 - m) - 1)
        weight = np.exp(density - density.max())
        mean = (grid * weight).sum() / weight.sum()
        deviation = np.sqrt(((grid - mean) ** 2 * weight).sum() / weight.sum())
        assert np.isclose(found[host]["bad_rate"], means[host]) and np.isclose(found[host]["bad_rate"], mean, atol=2e-3)
        assert np.isclose(found[host]["bound"], max(0, found[host]["bad_rate"] - url_filter.Z * found[host]["deviation"])) and np.isclose(found[host]["deviation"], deviation, atol=2e-3)


def test_registered_domains(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "x.y.com", "com", "", "u:p@x.y.com:80", "10.0.0.1", "a.b.ck", "www.ck", "a.www.ck", "z.kobe.jp"]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    plain = {r["host"]: (r["domain"], r["suffix"]) for r in url_filter.registered(frame).collect()}
    assert plain["a.b.co.uk"] == plain["b.co.uk"] == ("b.co.uk", "co.uk") and plain["u:p@x.y.com:80"] == ("y.com", "com") and plain[""] == ("", "")
    assert plain["10.0.0.1"] == ("10.0.0.1", "")
    ruled = {r["host"]: (r["domain"], r["suffix"]) for r in url_filter.registered(frame, ["com", "uk", "co.uk", "*.ck", "!www.ck", "jp", "*.kobe.jp"]).collect()}
    assert ruled["a.b.co.uk"] == ("b.co.uk", "co.uk") and ruled["co.uk"] == ("co.uk", "co.uk") and ruled["x.y.com"] == ("y.com", "com")
    assert ruled["a.b.ck"] == ("a.b.ck", "b.ck") and ruled["www.ck"] == ("www.ck", "ck") and ruled["a.www.ck"] == ("www.ck", "ck") and ruled["z.kobe.jp"] == ("z.kobe.jp", "z.kobe.jp")


# Main text.


PAGES = [
    ("<html><head><title>t</title></head><body><nav>menu</nav><article class='post-12'><h1>A &amp; B</h1><p>One<b>two</b> three<p>four</article><footer>f</footer>", "A & B Onetwo three four"),
    ("<body class='has-sidebar'><div id=hdr><ul><li><a href='x>y'>home</a></ul></div><div class=content><h1>T</h1><p>body text goes here</p><div class='ad-box'>buy</div><form>f</form><ul><li>a<li>b</ul></div><div class=comments><p>first! second comment</p></div>", "T body text goes here a b"),
    ("", ""), (None, ""), ("<p>caf&eacute;\n\n  &#233; &lt;x&gt;", "café é <x>"), ("<div>a<script>if (x < 1) '</p>'</script>b<!-- c --><style>d</style></div>", "ab"), ("plain < text", "plain < text"),
]


def test_main_text(spark):
    rows = spark.createDataFrame([(i, f"http://h{i}.com/", p) for i, (p, _) in enumerate(PAGES)], "page_id bigint, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_text.with_main_text(rows).collect()}
    assert [found[i] for i in range(len(PAGES))] == [t for _, t in PAGES]
    assert html_text.with_main_text(rows.where("false")).count() == 0


def test_consensus_overrides_a_page(spark):
    page = lambda story, side: f"<body><div class=story><p>{story}</p></div><div class=box-7><p>{side}</p></div></body>"
    rows = [(i, "http://x.org/a", page("long story text " * 20, "side")) for i in range(5)] + [(9, "http://x.org/b", page("short", "a side box that is longer than the story of this page"))]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_text.with_main_text(frame).collect()}[9] == "short"


def test_all_containers_vote(spark):
    """The story lies in page-specific levels inside one shared div."""
    story = lambda slug: "".join(f"<div class={slug}{x}>" for x in "xyz") + f"<p>{slug} story text</p>" * (20 if slug != "five" else 1) + "</div>" * 3
    page = lambda slug, side: f"<body><div class=story>{story(slug)}</div><div class={slug}-box><p>{side}</p></div></body>"
    rows = [(i, "http://x.org/a", page(slug, "")) for i, slug in enumerate(f"{x}page" for x in "abcdefghi")] + [(9, "http://x.org/b", page("five", "a side box that is longer than the story"))]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_text.with_main_text(frame).collect()}[9] == "five story text"


def test_deep_pages():
    """Nesting has no limit: what is left out stays so at any depth, in time in proportion to the page."""
    for depth in (10, 405, 50_000):
        page = "<div>" * depth + "<nav>MENU</nav>body"
        assert html_text.extract(page, None) == "body"
        assert len(html_text.votes_of(page)) == depth
    assert html_text.extract("<b>" * 20_000 + "<p>x</p><li>y</li>" * 5_000, None).split() == ["x", "y"] * 5_000


def test_unclosed_rows_and_items_end_each_other():
    rows = html_text.parse("<table><tr><td>a<td>b<tr><td>c</table>").parts[0].parts
    assert [(r.tag, [c.tag for c in r.parts]) for r in rows] == [("tr", ["td", "td"]), ("tr", ["td"])]
    items = html_text.parse("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>").parts[0].parts
    assert [i.tag for i in items] == ["li", "li"] and html_text.text_under(items[0]) == "a b c"


def test_words_of_content_and_of_boxes():
    inside = lambda x: html_text.extract(f"<body><article><p>Begin.</p>{x}<p>End.</p></article></body>", None)
    for content in ("<p class='share-price'>X</p>", "<div class='alert-history'>X</div>", "<p class='search-results-study'>X</p>", "<h2 id='related-work'>X</h2>", "<p class='form-of-address'>X</p>"):
        assert inside(content) == "Begin. X End.", content
    for box in ("<div class='share-buttons'>X</div>", "<div class='share'>X</div>", "<div id='related'>X</div>", "<p class='notice'>X</p>", "<div class='alert alert-2'>X</div>", "<div class='newsletter-signup'>X</div>", "<section class='commentList'><p>X</p></section>", "<div class='ad'>X</div>", "<p hidden>X</p>"):
        assert inside(box) == "Begin. End.", box


def test_names_of_what_the_text_is_about():
    """A word of a menu, an advert or comments on content stays, unless the content is mostly links."""
    inside = lambda x: html_text.extract(f"<body><article><p>Begin.</p>{x}<p>End.</p></article></body>", None)
    for content in ("<div class='menu-du-jour'>X</div>", "<p class='ad-astra'>X</p>", "<section class='modal-logic'>X</section>", "<div class='content'><div class='comment-policy-article'>X</div></div>", "<div class='content'><p class='toc-note'>X</p></div>", "<p class='cookie-recipe'>X</p>"):
        assert inside(content) == "Begin. X End.", content
    for box in ("<div class='menu-du-jour'><a>X</a> <a>Y</a></div>", "<div class='article-comments'>X</div>", "<div class='user-comment-12'>X</div>", "<div class='ad-slot-3'>X</div>", "<ul id='site-nav-links'><li>X</ul>", "<div class='post-sidebar'>X</div>", "<div class='toc-of-part'><ul><li><a>X</a></ul></div>"):
        assert inside(box) == "Begin. End.", box


def test_references_are_decoded_in_each_text_node():
    text = lambda x: html_text.extract(f"<article><p>{x}</p></article>", None)
    assert text("&am<b>p;</b>") == "&amp;" and text("&lt<b>;</b>") == "<;" and text("&amp;lt; &lt;b&gt; &#x41;&eacute;") == "&lt; <b> Aé" and text("a&nbsp;&nbsp;b") == "a b"


def test_votes_are_counted(spark):
    """Winners of hosts by adding up each page's votes; ties go to the deeper path, then by digest."""
    r = random.Random(3)
    rows = []
    for k in range(120):
        host = f"h{k % 7}.org"
        body = "".join(f"<div class='{r.choice(('story', 'box', 'x-1', 'x-22'))}'><p>{'word ' * r.randint(0, 30)}</p><a>{'link ' * r.randint(0, 9)}</a></div>" for _ in range(r.randint(0, 4)))
        rows.append((k, f"http://{host}/{k}", f"<body>{body}</body>"))
    total: dict = {}
    for _, url, page in rows:
        for path, depth, share in html_text.votes_of(page):
            votes = total.setdefault(url.split("/")[2], {}).setdefault(path, [0, depth])
            votes[0] += round(share * 1000)
    expected = {host: max((n, depth, path) for path, (n, depth) in paths.items()) for host, paths in total.items()}
    found = {x["host"]: (x["votes"], x["depth"], x["path"]) for x in html_text.consensus(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert found == expected and len(found) == 7


def test_main_text_odd_rows(spark, monkeypatch):
    """Repeated rows, clashing names, nulls; winners beyond the broadcast are joined by salted hosts."""
    rows = [(1, "http://a.b/1", "<p>x</p>", "h", "p", 1, "old"), (1, "http://a.b/1", "<p>x</p>", "h", "p", 1, "old"), (2, None, None, "h", "p", 1, "old"), (None, "http://A.b/2", "<div class=story><p>y " + "z " * 50_000 + "</p></div>", "h", "p", 1, None)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, path string, salt int, text string")
    for size in (html_text.BROADCAST, 0):
        found = html_text.with_main_text(frame, broadcast=size)
        assert found.columns == frame.columns
        assert sorted((r["page_id"] or 0, r["text"], r["host"]) for r in found.collect()) == [(0, "y " + "z " * 49_999 + "z", "h"), (1, "x", "h"), (1, "x", "h"), (2, "", "h")]


@pytest.mark.parametrize("page", ["<a " * 50_000, "<a x=\"" * 50_000, "<div>" * 20_000 + "x", "</p>" * 50_000, "<!-- " * 50_000, "<" * 200_000])
def test_broken_pages_end(page):
    html_text.extract(page, None)


def test_generated_pages(spark):
    rows = queries.QUERIES["op5_main_text"](spark, TINY).toPandas().set_index("page_id")
    for page_id, page in tables(TINY).sql("SELECT page_id, html FROM pages").fetchall():
        inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        expected = " ".join(re.sub(r"<[^>]*>", " ", re.sub("</?b>", "", inner)).replace("&middot;", "·").replace("&amp;", "&").split())
        assert rows["text"][page_id] == expected and rows["n_chars"][page_id] == len(expected)


# Fingerprints.


def test_fingerprints(spark, texts):
    rows = queries.QUERIES["op6_imatch_fingerprints"](spark, TINY).toPandas().set_index("doc_id")
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        text, after = texts[i], texts[order[(k + 1) % len(order)]]
        n = len(text)
        assert rows["n_chars"][i] == n and rows["edited_sha256"][i] == brute.sha(text[: n - n // 2] + after[: n // 2])
    same = {}
    for i, t in texts.items():
        assert same.setdefault(t, rows["fingerprint"][i]) == rows["fingerprint"][i]
    assert ((rows["near_edited"] >= 0) & (rows["near_edited"] <= 1)).all()
    assert (rows["near_edited"] > rows["near_next"]).mean() > 0.9


@pytest.mark.parametrize("broadcast", [fingerprints.BROADCAST, 0])
def test_fingerprints_equal_plain_imatch(spark, texts, monkeypatch, broadcast):
    """Likenesses, and which fingerprints are equal, with the lexicon broadcast and joined."""
    monkeypatch.setattr(fingerprints, "BROADCAST", broadcast)
    rows = {i: texts[i] for i in sorted(texts)[:120]} | {10**6: None, 10**6 + 1: "", 10**6 + 2: "once-only 😀 terms", 10**6 + 3: "ONCE only TERMS"}
    frame = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    plain = brute.imatch(rows, 0.02, 0.3, fingerprints.HALVES, fingerprints.SCALES)
    found = {r["doc_id"]: r for r in fingerprints.with_fingerprints(frame, low=0.02, high=0.3).collect()}
    assert found.keys() == plain.keys()
    known: dict = {}
    for i, (own, new, near_edited, near_next) in plain.items():
        assert np.isclose(found[i]["near_edited"], near_edited) and np.isclose(found[i]["near_next"], near_next)
        for subsets, told in ((own, found[i]["fingerprint"]), (new, found[i]["edited_fingerprint"])):
            assert len(told) == 16 * (2 if "whole" in subsets else len(subsets))
            assert known.setdefault(repr(sorted((repr(k), sorted(v)) for k, v in subsets.items())), told) == told
    assert len(set(known.values())) == len(known)


def test_texts_without_common_terms_are_told_apart(spark):
    frame = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a"), "id", F.lit(" b"), "id").alias("text"))
    assert fingerprints.with_fingerprints(frame).agg(F.countDistinct("fingerprint"), F.max("near_next")).head() == (20_000, 0.0)


def test_fingerprints_odd_rows(spark, odd, none):
    rows = fingerprints.with_fingerprints(odd).collect()
    assert len(rows) == 10
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert prints[5] == prints[6] and prints[1] == prints[2] == prints[3]
    assert fingerprints.with_fingerprints(none).count() == 0
    alone = fingerprints.with_fingerprints(odd.where("doc_id = 5")).head()
    assert alone["edited_sha256"] == brute.sha("one two three four five s" + "one two three four five ")[:0] + hashlib.sha256(("one two three four five six seven eight nine ten"[:24] + "one two three four five six seven eight nine ten"[:24]).encode()).hexdigest()
    assert alone["near_next"] == 1.0


# Jaccard join.


def test_shingle_sizes():
    r = random.Random(2)
    made = [" ".join(r.choice(("a", "B", "cc", "é", "x\x1fy")) for _ in range(r.randint(0, 12))) for _ in range(300)] + ["A\x0bb\x0cc", "x" * 3_000_000 + " y z", ""]
    for n in (1, 3, 5):
        assert [len(s) for s in shingle_sets(made, n)] == [len(brute.shingles(t, n)) for t in made]


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_components_equal_all_pairs(spark, words, percent):
    r = random.Random(words)
    base = [[r.choice([f"w{i}" for i in range(60)]) for _ in range(r.choice((2, 8, 30, 80)))] for _ in range(25)]
    texts = []
    for k in range(220):
        w = list(r.choice(base))
        for _ in range(r.choice((0, 0, 1, 1, 2, 4))):
            w[r.randrange(len(w))] = f"n{r.randrange(400)}"
        texts.append(" ".join(w if k % 3 else w + ["tail"]))
    rows = [*enumerate(texts), (900, None), (901, " \t"), (902, texts[0].upper())]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = {x["doc_id"]: x["component_id"] for x in jaccard_join.similarity_components(frame, words, percent).collect()}
    assert found == brute.components(rows, words, percent)


def test_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(set_links, "BLOCK_ROWS", 7)
    r = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(60):
        w = list(base)
        for _ in range(k % 3):
            w[r.randrange(60)] = f"n{k}"
        rows.append((k, " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {x["doc_id"]: x["component_id"] for x in jaccard_join.similarity_components(frame, 3, 80).collect()}
    assert found == brute.components(rows, 3, 80)


def test_jaccard_odd_rows(spark, odd, none):
    rows = jaccard_join.similarity_components(odd, 3, 90).collect()
    got = {(x["doc_id"], x["n_shingles"]): x["component_id"] for x in rows}
    assert len(rows) == 10 and got[6, 8] == 5 and got[1, 0] == 1 and got[2, 0] == 2 and got[None, 5] is None
    kept = jaccard_join.keep_one_of_each(odd, 3, 90)
    assert kept.columns == odd.columns and sorted(x["doc_id"] or 0 for x in kept.collect()) == [0, 1, 2, 3, 4, 5, 8, 9]
    assert jaccard_join.similarity_components(none).count() == 0 == jaccard_join.keep_one_of_each(none).count()


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    assert {x["node"]: x["root"] for x in set_links.components(edges).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_words_of_a_pattern_do_not_meet():
    """A Thue-Morse word and its complement have equal values of any polynomial modulo a power of two."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    other = word.translate(str.maketrans("ab", "ba"))
    for n in (1, 3):
        one, two = shingle_sets([word, other], n)
        assert len(one) == len(two) == 1 and one[0] != two[0]


def test_links_count_true_shingles(monkeypatch):
    """Sets that only agree by their hashes don't link."""
    texts = ["one two three four", "five six seven eight", "one two three four"]
    monkeypatch.setattr(set_links, "shingle_sets", lambda texts, words: [np.arange(2, dtype=np.uint64)] * len(texts))
    assert set_links.linked(texts, 3, 90) == [[0, 2]]


def test_slices_of_long_texts(monkeypatch):
    from tidewick.llm import shingles

    texts = [" ".join(f"w{i % 89}" for i in range(400)), "x" * 300 + " y z", " ", "", "é\x0bÜ a b c"]
    whole = shingle_sets(texts, 3)
    monkeypatch.setattr(shingles, "CHUNK", 50)
    assert all((a == b).all() for a, b in zip(whole, shingle_sets(texts, 3), strict=True))


@pytest.mark.parametrize("rows_in_block", [3, 7])
def test_open_rows_meet_all_blocks(spark, monkeypatch, rows_in_block):
    """A bucket of several components, of which pivots see few, and lone texts that share its rare words."""
    monkeypatch.setattr(set_links, "BLOCK_ROWS", rows_in_block)
    monkeypatch.setattr(set_links, "PIVOTS", 1)
    r = random.Random(9)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for k in range(90):
        w = list(base)
        for j in range(k % 9):  # from near copies to texts that share only some words
            w[(5 * j + k // 9) % 40] = f"n{k // 3}" if j < 3 else f"m{r.randrange(30)}"
        rows.append((k, " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for words, percent in ((3, 60), (1, 80)):
        found = {x["doc_id"]: x["component_id"] for x in jaccard_join.similarity_components(frame, words, percent).collect()}
        assert found == brute.components(rows, words, percent)
        assert len(set(found.values())) > 1


def test_filter_keeps_all_linked_pairs():
    """Pairs that samples exclude are under the similarity, whatever the sets' sizes."""
    r = random.Random(6)
    for percent in (50, 80, 90):
        base = [r.randrange(1 << 48) for _ in range(120)]
        sets = [np.array(sorted({*r.sample(base, r.randint(1, 120)), *(r.randrange(1 << 48) for _ in range(r.randint(0, 9)))})) for _ in range(80)]
        sets += [np.array(sorted({*base[: r.randint(90, 120)], r.randrange(1 << 48)})) for _ in range(40)]
        n = np.array([len(s) for s in sets])
        samples = [s[: jaccard_join._sample_size(set_links.unshared(len(s), percent))] for s in sets]
        both = set_links.overlaps(sets)
        assert all(both[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(0, 120, 7) for j in range(120) if i != j)
        true = 100 * both >= percent * (n[:, None] + n[None, :] - both)
        np.fill_diagonal(true, False)
        for short in (0, 17, 40):  # bits left out, as in the filter
            fits = jaccard_join.possible(n, [x >> short for x in samples], percent)
            assert fits[true].all() and fits.sum() < true.size


def test_template_pages_are_not_compared(spark, monkeypatch):
    """Texts of one template that differ enough are left out by their rarest shingles: what is dealt doesn't grow by pairs."""
    monkeypatch.setattr(set_links, "BLOCK_ROWS", 20)
    second = []
    monkeypatch.setattr(set_links, "_second_tasks", lambda rows, f=set_links._second_tasks: second.append(rows.count()) or f(rows))
    template = [f"w{i}" for i in range(40)]
    rows = [(k, " ".join(template + [f"n{k}x{j}" for j in range(8)])) for k in range(300)] + [(300 + k, " ".join(template + [f"n{k}x{j}" for j in range(8)] + ["more"])) for k in range(3)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {x["doc_id"]: x["component_id"] for x in jaccard_join.similarity_components(frame, 3, 90).collect()}
    assert found == {**{k: k for k in range(300)}, 300: 0, 301: 1, 302: 2}
    assert sum(second) <= 12


def test_rows_of_one_id_go_by_their_text(spark):
    base = " ".join(f"w{i}" for i in range(50))
    near = base + " tail"
    rows = [(1, base), (2, near), (2, "a clean text of its own that shares no shingle"), (None, near + " end"), (None, "another clean text"), (7, "seven"), (7, "seven"), (8, ""), (8, "")]
    kept = jaccard_join.keep_one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(1, base), (2, rows[2][1]), (0, "another clean text"), (7, "seven"), (8, "")])


def test_quality_equals_plain_discriminant(texts):
    """Differences by the densities' own formulas, on the same statistics."""
    x = np.array([quality.statistics(t) for t in texts.values()])
    label = np.arange(len(x)) % 3 == 0
    own = [x[~label], x[label]]
    model = quality.Discriminant(np.array([len(o) for o in own]), np.array([o.sum(axis=0) for o in own]), np.array([o.T @ o for o in own]))
    size = len(quality.NAMES)
    pooled = sum(len(o) * np.cov(o.T, bias=True) for o in own) / len(x)
    pooled = (1 - quality.TO_IDENTITY) * pooled + quality.TO_IDENTITY * (np.trace(pooled) / size + 1e-9) * np.eye(size)
    logs = []
    for o in own:
        c, d = (1 - quality.TO_POOLED) * np.cov(o.T, bias=True) + quality.TO_POOLED * pooled, x - o.mean(axis=0)
        logs.append(np.log(len(o) / len(x)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * (d * np.linalg.solve(c, d.T).T).sum(axis=1))
    apart = logs[1] - logs[0]
    assert np.allclose(model.difference(x), np.sign(apart) * np.sqrt(np.abs(apart)), atol=1e-5)
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-np.clip(model.difference(x), -30, 30))))


def test_fit_equals_plain_moments_and_likelihood(spark, texts):
    """Sums over tasks give each class's own moments; the calibration is where the plain log-likelihood, less its ridge, is flat."""
    x = np.array([quality.statistics(t) for t in texts.values()])
    label = (np.arange(len(x)) * 7 + (x[:, 0] > np.median(x[:, 0]))) % 3 == 0
    rows = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, label)], "x array<double>, label int").repartition(5)
    model = quality.fit(rows)
    own = [x[~label], x[label]]
    plain = quality.Discriminant(np.array([len(o) for o in own]), np.array([o.sum(axis=0) for o in own]), np.array([o.T @ o for o in own]))
    assert np.allclose(model.mean, [o.mean(axis=0) for o in own]) and np.allclose(model.difference(x), plain.difference(x), atol=1e-4)
    at = np.round(np.clip(plain.difference(x), -50, 50) * (quality.BINS / 100)) / (quality.BINS / 100)

    def worth(slope: float, shift: float) -> float:
        p = 1 / (1 + np.exp(-(slope * at + shift)))
        return np.log(np.where(label, p, 1 - p)).sum() - 0.005 * ((slope - 1) ** 2 + shift**2)

    best = worth(model.slope, model.shift)
    assert all(worth(model.slope + a, model.shift + b) <= best + 1e-6 for a in (-0.02, 0, 0.02) for b in (-0.02, 0, 0.02))


def test_quality_clashing_columns(spark, odd):
    labels = spark.createDataFrame([(5, 1), (5, 0)], "doc_id bigint, quality int")
    docs = odd.withColumns({c: F.lit("own") for c in ("label", "labelled", "x", "id", "score", "held_out", "quality")})
    rows = quality.with_quality(docs, labels)
    assert set(rows.columns) == set(docs.columns) - {"text"}
    assert all(r["label"] == r["labelled"] == r["x"] == r["id"] == r["quality"] == "own" and 0 <= r["score"] <= 1 for r in rows.collect())
    assert quality.keep_good(docs, labels).columns == docs.columns
