"""I-Match fingerprints over randomised subsets of a lexicon.

The lexicon holds the terms whose document frequency, counted over all texts, lies in a band of shares of all texts: rarer
terms are noise, more frequent ones tell nothing. A text's distinct lexicon terms are sorted, and for each of several
random subsets of the lexicon those in the subset are hashed. Subsets keep from a half down to 1/2048 of the lexicon, so
that coarse ones agree only for near-equal texts, and fine ones, which hold a term or two of a text, agree about as often
as the texts' terms do. Likeness is the share of agreeing subsets among those that either text has terms in.

Each term names the few subsets that it is in, by bits of its hash; the pairs of subset and term are sorted, and one pass
over them hashes each subset's run by 64 bits. A fingerprint holds a number for each subset with terms: 7 bits of its name
and 57 of its hash.

Native: only SQL functions. The lexicon has at most (mean distinct terms of a text) / ``LOW`` terms, whatever the number of
texts. Where it has ``BROADCAST`` terms at most it goes to all tasks with the plan, as an array of small buckets by hash in which
each text's terms are looked up in place, so that no terms are shuffled. A larger one is joined by a shuffle, where adaptive
execution can split the most frequent terms. Texts are shuffled once, by id, with their fingerprints; the part of a text that its
neighbour's edited text needs goes there with the fingerprint, so that nothing else is shuffled.

Defined cases: a null text counts as empty; very long texts are read whole; a text without lexicon terms has two
hashes of all its terms, of 114 bits together, so that only equal sets of terms agree; a null id comes last; of rows that repeat an id the greatest beginning is
the one before's neighbour, and the greatest fingerprint stands for it; each repeated row gets its result; the only id is its
own neighbour; only id and text are read, so that other columns may have any names; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, text_of

LOW, HIGH = 0.002, 0.2
BROADCAST, IN_BUCKET = 500_000, 2  # terms of a lexicon that goes with the plan, and of a bucket on average
WORD = r"[^\p{L}\p{N}]+"
HALVES = 4
# Subsets by the bits of a term's hash that decide: (first bit, bits, subsets); of 2**bits equal parts the first ones are used.
SCALES = ((4, 3, 8), (7, 5, 32), (12, 8, 32), (20, 11, 16))
NAME_BITS, NO_SUBSETS = 7, (126, 127)
NO_ID = -(2**63)


def terms(text: Column) -> Column:
    """Hashes of the distinct terms."""
    words = F.filter(F.split(F.lower(text), WORD), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(texts: DataFrame, text_col: str, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Rows (term) of the band, of frequency 2 at least."""
    counted = texts.select(F.explode(terms(F.col(text_col))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = texts.count()
    return checkpointed(counted.where((F.col("df") >= max(2.0, low * n)) & (F.col("df") <= max(2.0, high * n))).select("term"))


def _part(h: Column, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(2**bits - 1).cast("bigint"))


def _named(subset: Column, h: Column) -> Column:
    """A subset's name above the hash's other bits."""
    return F.shiftleft(subset.cast("bigint"), 64 - NAME_BITS).bitwiseOR(F.shiftrightunsigned(h, NAME_BITS))


def _name(code: Column) -> Column:
    return F.shiftrightunsigned(code, 64 - NAME_BITS)


def _in_subsets(term: Column) -> Column:
    """The term under the name of each subset that it is in, null for those it isn't in."""
    found = [F.when(_part(term, bit, 1) == 1, _named(F.lit(bit), term)) for bit in range(HALVES)]
    first = HALVES
    for shift, bits, kept in SCALES:
        part = _part(term, shift, bits)
        code = _named(part + first, term)
        found.append(code if kept == 2**bits else F.when(part < kept, code))
        first += kept
    return F.array(*found)


def whole(terms: Column) -> Column:
    """The entries that tell a text by all of its terms."""
    order = F.sort_array(terms)
    return F.array(*[_named(F.lit(name), F.xxhash64(order, F.size(terms), F.lit(name))) for name in NO_SUBSETS])


def fingerprint(found: Column, whole: Column) -> Column:
    """From a text's lexicon terms and the entries of all its terms, a number for each subset with terms, in order of subsets."""
    codes = F.sort_array(F.array_compact(F.flatten(F.transform(found, _in_subsets))))
    none = F.array().cast("array<bigint>")
    start = F.struct(F.lit(-1).cast("bigint").alias("name"), F.lit(0).cast("bigint").alias("h"), none.alias("out"))
    put = lambda state: F.when(state["name"] >= 0, F.concat(state["out"], F.array(_named(state["name"], state["h"])))).otherwise(state["out"])

    def follow(state: Column, code: Column) -> Column:
        same = state["name"] == _name(code)
        return F.struct(_name(code).alias("name"), F.xxhash64(F.when(same, state["h"]).otherwise(0).cast("bigint"), code).alias("h"), F.when(same, state["out"]).otherwise(put(state)).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(codes, start, follow, put)).otherwise(whole)


def likeness(a: Column, b: Column) -> Column:
    """The share of agreeing subsets among those that either has terms in."""
    agree = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(F.transform(a, _name), F.transform(b, _name)))
    return agree / either


def shown(print_: Column) -> Column:
    return F.array_join(F.transform(print_, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def neighbours(ids: DataFrame) -> DataFrame:
    """From distinct (key, n), rows (key, n, next): the next lower key, after the least one the greatest.

    Keys are range-partitioned and put in order within partitions; only the partitions' first keys meet in one place.
    """
    ranged = checkpointed(ids.repartitionByRange(F.col("key").desc()).withColumn("part", F.spark_partition_id()))
    inner = Window.partitionBy("part").orderBy(F.col("key").desc())
    heads = ranged.groupBy("part").agg(F.max("key").alias("head"))
    every = Window.orderBy("part")
    first = F.first("head").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follows = heads.select("part", F.coalesce(F.lead("head").over(every), first).alias("head"))
    return ranged.withColumn("next", F.lead("key").over(inner)).join(F.broadcast(follows), "part").select("key", "n", F.coalesce("next", "head").alias("next"))


def _known(band: DataFrame) -> Callable[[Column], Column]:
    """Whether a term is in the lexicon, as a column: its bucket, of a few terms, is looked through."""
    terms = [r[0] for r in band.collect()]
    buckets: list[list[int]] = [[] for _ in range(max(1, len(terms) // IN_BUCKET))]
    for t in terms:
        buckets[t % len(buckets)].append(t)
    table = F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), "array<array<bigint>>")
    return lambda t: F.array_contains(F.get(table, F.pmod(t, F.lit(len(buckets))).cast("int")), t)


Cut = Callable[[DataFrame, str], DataFrame]


def _cut(band: DataFrame) -> Cut:
    """What cuts a column of terms to those of the lexicon: in place, or for a large lexicon by a join on terms."""
    if band.count() <= BROADCAST:
        known = _known(band)
        return lambda df, column: df.withColumn(column, F.filter(column, known))

    def joined(df: DataFrame, column: str) -> DataFrame:
        rows = checkpointed(df.withColumn("row", F.monotonically_increasing_id()))
        found = rows.select("row", F.explode(column).alias("term")).join(band, "term").groupBy("row").agg(F.collect_list("term").alias("known_"))
        return rows.join(found, "row", "left").withColumn(column, F.coalesce("known_", F.array().cast("array<bigint>"))).drop("row", "known_")

    return joined


def _with_print(df: DataFrame, text: str, out: str, cut: Cut) -> DataFrame:
    held = cut(df.withColumn("terms", terms(F.col(text))).withColumn("found", F.col("terms")), "found")
    return held.withColumn(out, fingerprint(F.col("found"), whole(F.col("terms")))).drop("terms", "found")


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """For each row: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of its code points replaced by the first as many of the next document, by falling id.
    """
    texts = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("key"), text_of(text_col).alias("text"))
    spark = docs.sparkSession
    cut = _cut(lexicon(texts, "text", low, high))
    # The lexicon is a constant of the plan, whose texts the driver keeps.
    spark.conf.set("spark.sql.maxPlanStringLength", "20000")
    order = checkpointed(neighbours(texts.groupBy("key").agg(F.max(F.length("text")).alias("n"))))
    printed = _with_print(texts, "text", "print", cut)
    # The next document's beginning and fingerprint come to each by its id; of rows that repeat the next id the greatest.
    owned = printed.join(order.select(F.col("key").alias("owner"), F.floor(F.col("n") / 2).cast("int").alias("need"), F.col("next").alias("key")), "key")
    begin = owned.select(F.col("owner").alias("key"), F.expr("substring(text, 1, need)").alias("begin"), F.col("print").alias("after"))
    begin = begin.groupBy("key").agg(F.max("begin").alias("begin"), F.max("after").alias("after"))
    both = printed.join(begin, "key").withColumn("n", F.length("text"))
    half = F.expr("concat(substring(text, 1, n - n div 2), substring(begin, 1, n div 2))")
    rows = _with_print(both.withColumn("edited_text", half).drop("text", "begin"), "edited_text", "edited", cut)
    return rows.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias(id_col),
        F.col("n").cast("bigint").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        shown(F.col("print")).alias("fingerprint"),
        shown(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited")).alias("near_edited"),
        likeness(F.col("print"), F.col("after")).alias("near_next"),
    )
