"""N-gram Jaccard join by grouped prefixes, and its connected components.

Of sets x and y with similarity of t or more, at most d(x) = |x| - ceil(t |x|) shingles of x are not in y. So if each set is
represented by its d + ceil(d / 2) + 1 smallest hashes, two linked sets share all but d of those of the one whose hashes end
first. On these samples, three twentieths of all shingles at t = 0.9, document frequencies are counted exactly, over all
classes of equal sets, and prefix filtering in order of frequency does the rest: only what is left of the rarest ones when the
guaranteed overlap is taken away can lead to a link. Most prefixes hold nothing that any other document holds, and their
documents are done.

Classes with identical prefixes and size are one group. Groups that share a prefix shingle meet in the bucket of the least of
them, and are expanded to their classes. Pairs of a bucket are filtered by their sizes and samples before any text moves: up
to the end of the sample that ends first, both samples are complete, so that neither may hold more shingles that the other
lacks than the sizes allow. What is left is verified on whole texts; see set_links.py, which also says what large buckets
go through.

Defined cases: a null or empty text, or one of white space, has the empty set and is linked with nothing; a text with fewer
words than a shingle is one shingle; very long texts are hashed and compared whole; repeated rows are linked unless empty; a
null id counts as greater than any other; columns of any name may be there, as only id and text are read; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, in_parts
from .set_links import Search, component_ids, least_shared, one_of_each, overlaps, signatures, signed, unshared, unshared_of
from .shingles import shingle_sets

CUT_BITS = 16  # dropped from the 64 of a shingle's hash in samples; alike beginnings only lead to more comparisons
KEPT_BITS = 31  # of what is left, for the filter of pairs, which takes alike beginnings as equal
MADE = "n bigint, sig_a bigint, sig_b bigint, summary array<bigint>"


def _sample_size(d, half=lambda x: -(-x // 2)):
    return d + half(d) + 1


def with_samples(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """docs with the size of each shingle set, signatures of it and as its summary the sample, in place of the text."""

    @F.arrow_udf(MADE)
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes, marks, samples = [], [], []
            for part in in_parts(texts):
                for found in shingle_sets(part, words):
                    marks.append(signatures(found))
                    sizes.append(len(found))
                    samples.append((found[: _sample_size(unshared(len(found), percent))] >> np.uint64(CUT_BITS)).astype(np.int64))
            ends = np.cumsum([0, *map(len, samples)], dtype=np.int32)
            values = np.concatenate(samples) if samples else np.zeros(0, dtype=np.int64)
            both = [signed([x[k] for x in marks]) for k in (0, 1)]
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), *both, pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["n", "sig_a", "sig_b", "summary"])

    return docs.withColumn("made", made("text")).select(*[c for c in docs.columns if c != "text"], "made.*")


def possible(n: np.ndarray, samples: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets of these sizes may be linked by their samples."""
    sets = [np.unique(s) for s in samples]
    ends = np.array([s[-1] for s in sets])
    known = np.array([np.searchsorted(s, ends, side="right") for s in sets])  # of a row's sample, up to the column's end
    lacking, least = known - overlaps(sets), least_shared(n, percent)
    return (least <= np.minimum(n[:, None], n[None, :])) & (lacking <= n[:, None] - least) & (lacking.T <= n[None, :] - least)


def _buckets(classes: DataFrame, percent: int) -> DataFrame:
    """From rows (row, n, summary): rows (bucket, row, n) such that linked classes meet in a bucket."""
    sampled = _sample_size(unshared_of(F.col("n"), percent), lambda d: F.ceil(d / 2))
    tokens = classes.select("row", F.explode("summary").alias("token"))
    # Kept, as heads below, so that joins deal both sides anew and adaptive execution can split a token of very many sets.
    common = checkpointed(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    # As many of the sample as go without the overlap that is certain; those of one document come first in order of frequency.
    least_d = unshared_of(F.ceil(F.col("n") * percent / 100), percent)
    prefix = sampled - F.ceil(least_d / 2)
    own = Window.partitionBy("row")
    shared = tokens.join(common, "token").withColumns({"alike": F.count(F.lit(1)).over(own), "place": F.row_number().over(own.orderBy("df", "token"))})
    ranked = shared.join(classes.select("row", "n"), "row").withColumn("alone", sampled - F.col("alike"))
    prefixes = checkpointed(ranked.where(F.col("alone") + F.col("place") <= prefix).select("row", "n", "token"))
    marks = prefixes.groupBy("row", "n").agg(F.sum(F.hash("token").cast("bigint")).alias("h"), F.bit_xor(F.xxhash64("token")).alias("x"), F.count(F.lit(1)).alias("c"))
    alike = marks.groupBy("n", "h", "x", "c").agg(F.min("row").alias("group"), F.count(F.lit(1)).alias("members"))
    member = checkpointed(marks.join(alike, ["n", "h", "x", "c"]).select("group", "row", "n", "members"))
    posted = prefixes.join(member.where("row = group").select("row", "group"), "row").select("token", "group")
    # A shingle's groups meet in the bucket of the least of them, so that the many shingles of near copies share a few buckets.
    heads = checkpointed(posted.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("group").alias("bucket")).where("c > 1").select("token", "bucket"))
    met = posted.join(heads, "token").select("bucket", "group")
    # A group of several classes is a bucket, too, in case it meets no other.
    alone = member.where("row = group and members > 1").select(F.col("group").alias("bucket"), "group")
    return met.unionByName(alone).distinct().join(member, "group").select("bucket", "row", "n")


def search(words: int, percent: int) -> Search:
    short = F.transform("summary", lambda x: F.shiftright(x, 64 - CUT_BITS - KEPT_BITS).cast("int"))
    return Search(words, percent, lambda docs: with_samples(docs, words, percent), lambda classes: _buckets(classes, percent), short, lambda n, samples: possible(n, samples, percent))


def similarity_components(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: id_col, n_shingles and component_id, the least id reachable by links, its own included.

    Sets link when percent * union <= 100 * intersection.
    """
    return component_ids(docs, search(words, percent), id_col, text_col)


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without near copies: of each component the row with the least id stays (a null id is the greatest).

    Rows are told apart by their id and text, so that of rows which repeat an id with different texts only those go that are
    copies; of rows with equal id and text one stays. Texts are only shuffled for rows that may go or repeat.
    """
    return one_of_each(docs, search(words, percent), id_col, text_col)
