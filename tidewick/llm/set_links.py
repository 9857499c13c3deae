"""Links between documents by the Jaccard similarity of their shingle sets, and connected components of these.

What operators that look for near copies share. Each brings its own way to find candidates: buckets in which linked documents
meet, and a test of pairs by short summaries. Documents with equal sets (by their size and 128 bits of hashes) are one class from
the start; only one document of a class is compared.

1. A bucket is dealt into blocks of ``BLOCK_ROWS`` classes or ``BLOCK_SHINGLES`` shingles. Each block is compared within
   itself and with up to ``PIVOTS`` classes of other blocks, which links most of a large group of near copies. Pairs are
   tested by summaries first; the whole texts of those classes that have a partner left, and only these, are then compared.
2. Large buckets whose classes are not all of one component so far are refined: all shingles of their classes are counted, and the rarest
   ones of each, as many as exact prefix filtering needs (a linked set lacks one shingle less), make new buckets of
   which only those with classes of several components count. So pages of one template that differ enough meet no more.
3. Within new buckets, only classes outside the largest component, and pairs that hold one of them, are left: two of that
   component can't add to it. They are dealt into blocks, and pairs of blocks are compared as before.

Each comparison gives a star for each group of linked texts, not all pairs; a link is added only after the texts' own shingles
were counted, so that no two texts link by a clash of hashes. Components are found by star contraction. Sizes of blocks reach
a bucket's rows by a salted join, so that no bucket is one task anywhere. Texts are only shuffled for classes in a bucket,
as far as a bitmap tells them from the rest on the map side.

Joins by shingle or group have one row for each key on one side, which is kept first, so that adaptive execution can split
large keys of the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, in_parts, scratch, text_of
from .shingles import shingle_sets, true_shingles

MAPS, MAP_BITS = 4096, 32_768  # a bitmap is broadcast in so many parts at most, of so many bits each
FILL = 16  # bits for each wanted row
BLOCK_ROWS, BLOCK_SHINGLES = 250, 250_000
PIVOTS = 8
SALTS = 64
COLUMNS = 2048
TASK = "bucket bigint, i int, j int, row bigint"


@dataclass(frozen=True)
class Search:
    """A way to find candidates among sets of shingles of so many words, for a similarity of so many percent or more.

    ``described`` adds to documents (row, id, text, ...) the size n of each set, its signatures sig_a and sig_b and what
    ``buckets`` needs, which makes rows (bucket, row, n) of classes, such that linked ones meet; ``summary`` is a column of
    those that ``passes`` gets with sizes, to tell which pairs may be linked, as a matrix.
    """

    words: int
    percent: int
    described: Callable[[DataFrame], DataFrame]
    buckets: Callable[[DataFrame], DataFrame]
    summary: Column
    passes: Callable[[np.ndarray, list[np.ndarray]], np.ndarray]


def unshared(n: int, percent: int) -> int:
    """The most of n shingles that a set with the similarity can lack."""
    return n - -(-percent * n // 100)


def unshared_of(n: Column, percent: int) -> Column:
    return F.floor(n * (100 - percent) / 100)


def least_shared(n: np.ndarray, percent: int) -> np.ndarray:
    """For all pairs of sets of these sizes, the fewest common shingles of linked ones."""
    return -(-percent * (n[:, None] + n[None, :]) // (100 + percent))


def signatures(found: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """Two sums over a set's hashes, which tell equal sets."""
    with np.errstate(over="ignore"):
        spread = (found ^ (found >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return found.sum(dtype=np.uint64), (spread ^ (spread >> np.uint64(27))).sum(dtype=np.uint64)


def signed(values: list) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def components(edges: DataFrame) -> DataFrame:
    """The least node reachable from each node of the edges (a, b): rows (node, root). Star contraction, by rounds."""
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).head()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state
        # Each node links its greater neighbours to the least one; then its lesser neighbours and itself.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = checkpointed(small.select("e.*").where("a <> b").distinct())


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of sorted sets share, by products of blocks of columns, one for each value of two sets or more."""
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.where(times > 1, np.cumsum(times > 1) - 1, -1).astype(np.int32)[place]
    row = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])[column >= 0]
    del place
    column = column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[row[a:b], column[a:b] - start] = 1
        both += part @ part.T
    return both.astype(np.int64)


def linked(texts: list[str], words: int, percent: int) -> list[list[int]]:
    """Groups of texts, as places, that links connect; percent * union <= 100 * intersection."""
    sets = shingle_sets(texts, words)
    size = np.array([len(s) for s in sets])
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    shingles = lru_cache(4)(lambda i: true_shingles(texts[i], words))

    def truly(i: int, j: int) -> bool:
        one, other = shingles(i), shingles(j)
        return 100 * (both := len(one & other)) >= percent * (len(one) + len(other) - both)

    fits = np.triu((100 + percent) * overlaps(sets) >= percent * (size[:, None] + size[None, :]), 1)
    for i, j in zip(*(x.tolist() for x in np.nonzero(fits))):
        a, b = find(i), find(j)
        if a != b and truly(i, j):
            root[max(a, b)] = min(a, b)
    groups: dict[int, list[int]] = {}
    for i in range(len(sets)):
        groups.setdefault(find(i), []).append(i)
    return [g for g in groups.values() if len(g) > 1]


def _by_task(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """Tasks (bucket, i, j) with their rows' columns. Rows come sorted by task; a task may go on in the next batch."""
    key, held = None, []
    for batch in batches:
        for *keys, values in zip(*(in_parts(batch[c]) for c in ("bucket", "i", "j")), zip(*(_parts(batch[c]) for c in columns))):
            for *now, row in zip(*keys, zip(*values)):
                if now != key:
                    if held:
                        yield key, held
                    key, held = now, []
                held.append(row)
    if held:
        yield key, held


def _parts(column: pa.Array, size: int = 256) -> Iterator[list]:
    """The values of an Arrow array by small lists; those of lists and bytes as arrays of numbers."""
    for start in range(0, len(column), size):
        part = column.slice(start, size)
        if pa.types.is_list(part.type):
            ends, values = part.offsets.to_numpy(), part.values.to_numpy()
            yield [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        elif pa.types.is_binary(part.type):
            yield [np.frombuffer(x.as_buffer(), dtype=np.uint16) for x in part]
        else:
            yield part.to_pylist()


def _possible(passes: Callable):
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The tasks' rows that may be linked with another one of the task, by summaries."""
        out: list[tuple] = []
        made = lambda: pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names=["bucket", "i", "j", "row"])
        for key, rows in _by_task(batches, "row", "n", "summary"):
            # Of two blocks each is tested once with itself; a row may come from both.
            rows = list({r[0]: r for r in rows}.values())
            if len(rows) > 1:
                fits = passes(np.array([r[1] for r in rows]), [r[2] for r in rows])
                np.fill_diagonal(fits, False)
                out += [(*key, rows[k][0]) for k in np.flatnonzero(fits.any(0) | fits.any(1)).tolist()]
            if len(out) > 10_000:
                yield made()
                out.clear()
        yield made()

    return test


def _verified(words: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A star of links for each group of the task's linked texts."""
        out: list[tuple[int, int]] = []
        made = lambda: pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
        for _, rows in _by_task(batches, "row", "text"):
            held = dict(rows)
            if len(held) > 1:
                names = list(held)
                for group in linked(list(held.values()), words, percent):
                    found = sorted(names[k] for k in group)
                    out += [(found[0], x) for x in found[1:]]
            if len(out) > 10_000:
                yield made()
                out.clear()
        yield made()

    return verify


def _blocks(n_rows: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(n_rows / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _salted(rows: DataFrame, large: DataFrame) -> DataFrame:
    """rows with the columns of large, which has a row for some buckets; each bucket's rows meet it in up to SALTS tasks."""
    spread = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(spread, ["bucket", "salt"], "left").drop("salt")


def _first_tasks(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """From rows (bucket, row, n) the tasks' rows (bucket, i, j, row), and the buckets of several blocks with their number."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).where("c > 1")
    large = checkpointed(sizes.select("bucket", _blocks(F.col("c"), F.col("s")).alias("blocks")).where("blocks > 1"))
    if large.isEmpty():
        zero = F.lit(0)
        return rows.select("bucket", zero.alias("i"), zero.alias("j"), "row"), None
    dealt = _salted(rows, large).withColumn("i", F.pmod(F.xxhash64("row", "bucket"), F.coalesce("blocks", F.lit(1))).cast("int"))
    pivots = dealt.where(F.col("i") < F.when(F.col("blocks") > 1, PIVOTS)).groupBy("bucket", "i", "blocks").agg(F.min("row").alias("row"))
    others = pivots.select("bucket", "row", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"))
    return dealt.select("bucket", "i", "row").unionByName(others.select("bucket", "i", "row")).select("bucket", "i", F.col("i").alias("j"), "row"), large


def _open_rows(rows: DataFrame, large: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (row, n, root) of large buckets whose classes are of several components."""
    rooted = checkpointed(
        _salted(rows, large.select("bucket", F.lit(1).alias("many"))).where("many = 1").join(roots.withColumnRenamed("node", "row"), "row", "left").select("bucket", "row", "n", F.coalesce("root", "row").alias("root"))
    )
    several = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket", F.lit(1).alias("several"))
    return checkpointed(_salted(rooted, several).where("several = 1").select("row", "n", "root").distinct())


def _tokens(words: int):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in zip(in_parts(batch["row"]), in_parts(batch["text"])):
                sets = shingle_sets(texts, words)
                ends, values = np.cumsum([0, *map(len, sets)], dtype=np.int32), np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=["row", "tokens"])

    return hashed


def _refined(rows: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """From rows (row, n, root), their texts (row, text): new buckets (bucket, row, n, root) by prefixes of whole sets, of several components each."""
    tokens = checkpointed(texts.mapInArrow(_tokens(words), "row bigint, tokens array<bigint>").select("row", F.explode("tokens").alias("token")))
    common = checkpointed(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    own = Window.partitionBy("row")
    shared = tokens.join(common, "token").withColumns({"alike": F.count(F.lit(1)).over(own), "place": F.row_number().over(own.orderBy("df", "token"))})
    # Shingles that no other set has come first in order of frequency.
    least = shared.join(rows, "row").where(F.col("n") - F.col("alike") + F.col("place") <= unshared_of(F.col("n"), percent) + 1)
    posted = checkpointed(least.select("token", "row", "n", "root"))
    heads = checkpointed(posted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("row").alias("bucket")).where("lo <> hi").select("token", "bucket"))
    return checkpointed(posted.join(heads, "token").select("bucket", "row", "n", "root").distinct())


def _second_tasks(rooted: DataFrame) -> DataFrame:
    """The tasks' rows (bucket, i, j, row) for rows (bucket, row, n, root): all pairs but those within the bucket's largest component."""
    main = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("bucket").agg(F.max_by("root", F.struct("c", "root")).alias("main"))
    told = checkpointed(_salted(rooted, main).select("bucket", "row", "n", (F.col("root") == F.col("main")).alias("inside")))
    some = lambda inside, x: F.sum(F.when(F.col("inside") == inside, x).otherwise(0))
    sizes = told.groupBy("bucket").agg(_blocks(some(False, F.lit(1)), some(False, F.col("n"))).alias("open"), _blocks(some(True, F.lit(1)), some(True, F.col("n"))).alias("closed"))
    dealt = _salted(told, checkpointed(sizes.where("open > 0"))).where("open > 0")
    h = F.xxhash64("row", "bucket", F.lit(1))
    # Blocks of open rows come first; each meets all others, so that closed ones meet the open ones.
    block = F.when(F.col("inside"), F.col("open") + F.pmod(h, F.col("closed"))).otherwise(F.pmod(h, F.col("open"))).cast("int")
    met = F.sequence(F.lit(0), F.when(F.col("inside"), F.col("open") - 1).otherwise(F.col("open") + F.col("closed") - 1))
    pairs = dealt.withColumn("block", block).withColumn("other", F.explode(met)).where("block <> other")
    return pairs.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "row")


def _perhaps(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """rows with a column ``perhaps``: false only where the key is none of the wanted ones.

    The wanted keys' hashes are broadcast as a bitmap, whose size follows their number up to ``MAPS`` parts (16 MB); a fuller
    one only says perhaps more often.
    """
    maps = min(MAPS, max(1, -(-wanted.count() * FILL // MAP_BITS)))
    at = F.pmod(F.xxhash64(F.col(key)), F.lit(maps * MAP_BITS))
    bits = wanted.select(at.alias("at")).groupBy(F.call_function("bitmap_bucket_number", "at").alias("bucket_")).agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", "at")).alias("bits_"))
    place = F.call_function("bitmap_bit_position", at)
    byte = F.conv(F.hex(F.expr("substring(bits_, CAST(place_ DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    found = rows.withColumns({"bucket_": F.call_function("bitmap_bucket_number", at), "place_": place}).join(F.broadcast(checkpointed(bits)), "bucket_", "left")
    held = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (F.col("place_") % 8).cast("int"))) != 0
    return found.withColumn("perhaps", F.coalesce(held, F.lit(False))).select(*rows.columns, "perhaps")


MARKS = ("mark", "mark_b")


def marks_of(text: Column) -> dict[str, Column]:
    """96 bits that tell texts apart."""
    return dict(zip(MARKS, (F.xxhash64(text), F.hash(text))))


def _with_texts(marked: DataFrame, whole: DataFrame) -> DataFrame:
    """marked rows, which have marks, with their texts in place of these."""
    texts = _perhaps(whole, marked.select("mark").distinct(), "mark").where("perhaps").groupBy(*MARKS).agg(F.first("text").alias("text"))
    return marked.join(texts, [*MARKS]).drop(*MARKS)


def _links(tasks: DataFrame, sets: DataFrame, whole: DataFrame, search: Search) -> DataFrame:
    """Links (a, b) between rows that meet in the tasks' rows (bucket, i, j, row)."""
    by_task = lambda rows: rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    possible = by_task(tasks.join(sets.select("row", "n", search.summary.alias("summary")), "row")).mapInArrow(_possible(search.passes), TASK)
    marked = checkpointed(possible.join(sets.select("row", *MARKS), "row"))
    found = by_task(_with_texts(marked, whole)).mapInArrow(_verified(search.words, search.percent), "a bigint, b bigint")
    return checkpointed(found)


def _classes(docs: DataFrame, search: Search, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (row, id, marks, n, signatures) of docs, and the classes of equal sets (n, signatures, least, root)."""
    whole = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumns(marks_of(F.col("text")))
    sets = checkpointed(search.described(whole.withColumn("row", F.monotonically_increasing_id())))
    classes = checkpointed(sets.where("n > 0").groupBy("n", "sig_a", "sig_b").agg(F.min("row").alias("row"), F.min("id").alias("least")))
    met = checkpointed(search.buckets(sets.join(classes.select("row"), "row", "left_semi")))
    texts = whole.select("text", *MARKS)
    tasks, large = _first_tasks(met)
    edges = _links(tasks, sets, texts, search)
    roots = components(edges)
    if large is not None and not (left := _open_rows(met, large, roots)).isEmpty():
        refined = _refined(left, _with_texts(checkpointed(left.select("row").join(sets.select("row", *MARKS), "row")), texts), search.words, search.percent)
        if not refined.isEmpty():
            roots = components(edges.unionByName(_links(_second_tasks(refined), sets, texts, search)))
    joined = classes.join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    return sets.select("row", "id", *MARKS, "n", "sig_a", "sig_b"), joined


def component_ids(docs: DataFrame, search: Search, id_col: str, text_col: str) -> DataFrame:
    """A row for each row of docs: id_col, n_shingles and component_id, the least id reachable by links, its own included."""
    sets, classes = _classes(docs, search, id_col, text_col)
    # Most classes are alone and need no shuffle by root; nor do the others' roots meet in one task, as least ids are partial.
    alone = F.col("root") == F.col("row")
    several = classes.where(~alone).select("root", "least").unionByName(classes.where(alone).select("root", "least"))
    named = classes.join(several.groupBy("root").agg(F.min("least").alias("component")), "root").select("n", "sig_a", "sig_b", "component")
    return sets.join(named, ["n", "sig_a", "sig_b"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, search: Search, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs without near copies: of each component the row with the least id stays (a null id is the greatest).

    Rows are told apart by their id and text, so that of rows which repeat an id with different texts only those go that are
    copies; of rows with equal id and text one stays. Texts are only shuffled for rows that may go or repeat.
    """
    sets, classes = _classes(docs, search, id_col, text_col)
    rows = checkpointed(sets.join(classes.select("n", "sig_a", "sig_b", "root"), ["n", "sig_a", "sig_b"], "left").select("id", *MARKS, "root"))
    order = F.struct(F.col("id").isNull().alias("last"), "id", *MARKS)
    # Kept, so that the join deals both sides anew and adaptive execution can split a large component.
    best = checkpointed(rows.where("root is not null").groupBy("root").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    lost = rows.join(best, "root").where(order != F.col("best")).select("id", *MARKS, F.lit(True).alias("gone"))
    twice = rows.groupBy("id", *MARKS).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("id", *MARKS, F.lit(False).alias("gone"))
    told = checkpointed(lost.unionByName(twice).groupBy("id", *MARKS).agg(F.bool_or("gone").alias("gone")))

    names = dict(zip((*MARKS, "perhaps", "id", "gone"), scratch(docs, *MARKS, "perhaps", "id", "gone")))
    found = told.select([F.col(c).alias(names[c]) for c in (*MARKS, "id", "gone")])
    marked = docs.withColumns({names[c]: x for c, x in marks_of(text_of(text_col)).items()})
    marked = _perhaps(marked, found, names["mark"]).withColumnRenamed("perhaps", names["perhaps"])
    some = marked.where(names["perhaps"]).alias("some")
    same = [F.col(f"some.{id_col}").eqNullSafe(F.col(f"found.{names['id']}")), *[F.col(f"some.{names[c]}") == F.col(f"found.{names[c]}") for c in MARKS]]
    kept = some.join(found.alias("found"), same, "left").select("some.*", names["gone"])
    once = kept.where(F.col(names["gone"]) == False).dropDuplicates([id_col, *[names[c] for c in MARKS]])  # noqa: E712
    left = [marked.where(~F.col(names["perhaps"])), kept.where(F.col(names["gone"]).isNull()), once]
    return left[0].select(*docs.columns).unionByName(left[1].select(*docs.columns)).unionByName(left[2].select(*docs.columns))
