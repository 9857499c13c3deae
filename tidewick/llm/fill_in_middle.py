"""Fill-in-middle transformation by a parallel automaton scan.

A text is cut at two unit boundaries into prefix, middle and suffix, which are put in another order between sentinels. Units
are code points, words or lines. Both their beginnings and sentinels that the text itself holds are found by one finite
automaton over bytes. A stretch of bytes is summed up, without knowing the state that it is entered in, by its function from
state to state and by the units and sentinels that it counts from each state. Such functions are composed, which is
associative: of pieces of ``PIECE`` bytes, side by side in numpy, to chunks of ``CHUNK`` bytes, and of chunks to documents.

Documents of one chunk are scanned where they are. Chunks of larger ones are dealt to all tasks, whatever document they belong
to, and only their functions meet by document (one row is at most 2 GB, so 65,536 chunks). Their composition tells in what
state and after how many units each chunk is entered, and so which chunk each cut lies in; only those are looked into again,
by the task that puts the parts together. Texts of documents are not shuffled but for chunks of large ones.

Cuts come from a digest of seed and id: of four numbers the first two give the cuts, the third which documents stay plain
and the fourth the order of parts. So equal rows give equal results on any machine.

Defined cases: a null text counts as empty, an empty one stays plain, as does one that holds a sentinel; very long texts are
scanned whole; a null id counts as the empty string; both cuts may be at one place, or at an end, which leaves parts empty;
with words, a cut lies before a word, and white space before the first belongs to the first part; repeated rows each get the
same result; columns of the same name as the result's are replaced, others pass through whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST, checkpointed, scratch, text_of

PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
PIECE, CHUNK = 256, 1 << 15
SEED, PLAIN, SPM = 1, 10, 20  # of a hundred, that stay plain, and of the others that begin with the suffix
UNITS = ("code_points", "words", "lines")
MARK = 40  # bits of a count below the number of sentinels
MADE = "n bigint, form string, prefix_units bigint, middle_units bigint, output string"
FUNCTION = "key string, chunk int, first bigint, second bigint, ends array<int>, counts array<bigint>"
PLACES = "key string, n_ bigint, marks_ bigint, chunks_ array<int>, states_ array<int>, left_ array<bigint>"


@dataclass(frozen=True)
class Automaton:
    """Flat tables by state and class of byte; the last class changes nothing. States are multiples of the number of classes."""

    classes: np.ndarray
    width: int
    next: np.ndarray
    counts: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.arange(0, len(self.next), self.width)


@lru_cache
def automaton(units: str) -> Automaton:
    """The product of an automaton that counts beginnings of units and one that counts sentinels."""
    byte = np.arange(256)
    if units == "code_points":
        follow, begins = np.zeros((1, 256), dtype=int), ((byte & 0xC0) != 0x80)[None]
    elif units == "words":
        inside = ~np.isin(byte, [0x20, *range(0x09, 0x0E)])
        follow, begins = np.array([inside, inside]).astype(int), np.array([inside, np.zeros(256, dtype=bool)])
    elif units == "lines":
        inside = byte != 0x0A
        follow, begins = np.array([inside, inside]).astype(int), np.array([np.ones(256, dtype=bool), np.zeros(256, dtype=bool)])
    else:
        raise ValueError(f"units are one of {', '.join(UNITS)}")
    # Sentinels are three bytes: an opening one, one of three letters, a closing one.
    opening, letters, closing = byte == ord(PREFIX[0]), np.isin(byte, [ord(s[1]) for s in SENTINELS]), byte == ord(PREFIX[2])
    mark = np.where(opening, 1, [np.zeros(256, dtype=int), np.where(letters, 2, 0), np.zeros(256, dtype=int)])
    found = np.array([np.zeros(256, dtype=bool), np.zeros(256, dtype=bool), closing])
    state = (follow[:, None, :] * 3 + mark[None]).reshape(-1, 256)
    count = (begins[:, None, :] + (found[None].astype(np.int64) << MARK)).reshape(-1, 256)
    columns, classes = np.unique(np.concatenate([state, count]), axis=1, return_inverse=True)
    n, width = len(state), columns.shape[1] + 1
    still = np.arange(n)[:, None]
    follow, count = np.hstack([columns[:n], still]), np.hstack([columns[n:], 0 * still])
    return Automaton(classes.ravel().astype(np.intp), width, (follow * width).ravel().astype(np.intp), count.ravel().astype(np.int64))


def _of_pieces(auto: Automaton, raw: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Classes of the first bytes of all pieces, then of the second ones and so on."""
    for k in range(int(sizes.max(initial=0))):
        yield np.where(k < sizes, auto.classes[raw[np.minimum(begins + k, len(raw) - 1)]], auto.width - 1)


class Scan:
    """The functions of segments of bytes, and of the pieces that they are made of."""

    def __init__(self, auto: Automaton, raw: np.ndarray, begins: np.ndarray, sizes: np.ndarray):
        self.auto, self.raw = auto, raw
        self.pieces = -(-sizes // PIECE)
        self.first = np.cumsum(self.pieces) - self.pieces
        place = np.arange(self.pieces.sum()) - np.repeat(self.first, self.pieces)
        self.begins = np.repeat(begins, self.pieces) + place * PIECE
        self.sizes = np.minimum(np.repeat(sizes, self.pieces) - place * PIECE, PIECE)
        self.ends = np.tile(auto.starts, (len(place), 1))
        self.counts = np.zeros(self.ends.shape, dtype=np.int64)
        for byte in _of_pieces(auto, raw, self.begins, self.sizes):
            at = self.ends + byte[:, None]
            self.counts += auto.counts[at]
            self.ends = auto.next[at]

    def composed(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """From rows of states that segments are entered in: the states and counts at their ends, and at the entry of each piece."""
        state, count = states.copy(), np.zeros(states.shape, dtype=np.int64)
        entered, before = np.zeros((len(self.begins), states.shape[1]), dtype=np.intp), np.zeros((len(self.begins), states.shape[1]), dtype=np.int64)
        for k in range(int(self.pieces.max(initial=0))):
            some = np.flatnonzero(self.pieces > k)
            piece = self.first[some] + k
            entered[piece], before[piece] = state[some], count[some]
            place = state[some] // self.auto.width
            count[some] += np.take_along_axis(self.counts[piece], place, 1)
            state[some] = np.take_along_axis(self.ends[piece], place, 1)
        return state, count, entered, before

    def places(self, states: np.ndarray, segment: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Where in their segments, entered in the states, units of these numbers begin; every one must be there."""
        _, count, entered, before = (x[:, 0] for x in self.composed(states[:, None]))
        units = lambda x: x & ((1 << MARK) - 1)
        base = np.cumsum(units(count)) - units(count)
        piece = np.searchsorted(np.repeat(base, self.pieces) + units(before), base[segment] + unit, side="right") - 1
        left, state = unit - units(before[piece]), entered[piece]
        found = np.full(len(piece), -1)
        for k, byte in enumerate(_of_pieces(self.auto, self.raw, self.begins[piece], self.sizes[piece])):
            at = state + byte
            left = left - units(self.auto.counts[at])
            found[(left < 0) & (found < 0)] = k
            state = self.auto.next[at]
        return found + (piece - self.first[segment]) * PIECE


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of strings, and where each of them begins, with the last one's end."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
    data = texts.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(1, dtype=np.uint8), ends


def _chunks(chunk: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key, first, second, text = (batch[c][row] for c in ("key", "first", "second", "text"))
                data = text.as_buffer()
                parts = [data.slice(at, min(chunk, data.size - at)).to_pybytes() for at in range(0, data.size, chunk)]
                same = [pa.array([x.as_py()] * len(parts)) for x in (key, first, second)]
                yield pa.RecordBatch.from_arrays([same[0], pa.array(range(len(parts)), pa.int32()), *same[1:], pa.array(parts, pa.binary())], names=["key", "chunk", "first", "second", "data"])

    return cut


def _functions(units: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(units)
        for batch in batches:
            raw, ends = _bytes(batch["data"])
            found = Scan(auto, raw, ends[:-1], np.diff(ends))
            after, counts, *_ = found.composed(np.tile(auto.starts, (batch.num_rows, 1)))
            lists = [pa.array(after.tolist(), pa.list_(pa.int32())), pa.array(counts.tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch[c] for c in ("key", "chunk", "first", "second")] + lists, names=["key", "chunk", "first", "second", "ends", "counts"])

    return scan


def _cuts(n: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one, other = first % (n + 1), second % (n + 1)
    return np.minimum(one, other), np.maximum(one, other)


def _composed(units: str):
    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each document's units and sentinels, and for both cuts the chunk, the state that it is entered in and the units left."""
        width, low = automaton(units).width, (1 << MARK) - 1
        for batch in batches:
            out = []
            for key, first, second, parts in zip(*(batch[c].to_pylist() for c in ("key", "first", "second", "parts"))):
                state, count, entered, before = 0, 0, [], []
                for part in parts:
                    entered.append(state)
                    before.append(count & low)
                    count, state = count + part["counts"][state // width], part["ends"][state // width]
                n = count & low
                cuts = [int(x) for x in _cuts(np.int64(n), np.int64(first), np.int64(second))]
                chunk = [int(np.searchsorted(before, min(c, max(n - 1, 0)), side="right")) - 1 for c in cuts]
                out.append((key, n, count >> MARK, chunk, [entered[k] for k in chunk], [c - before[k] for c, k in zip(cuts, chunk)]))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=["key", "n_", "marks_", "chunks_", "states_", "left_"])

    return compose


def _assembled(units: str, chunk: int, plain: int, spm: int):
    def assemble(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        auto, low = automaton(units), (1 << MARK) - 1
        for texts, *numbers, known, marks, chunks, states, left in batches:
            first, second, third, fourth = (x.to_numpy(zero_copy_only=False) for x in numbers)
            raw, ends = _bytes(texts)
            begins, sizes = ends[:-1], np.diff(ends)
            large = np.array(known.is_valid())
            n, marked = np.array(known.fill_null(0)), np.array(marks.fill_null(0))
            cuts = np.zeros((2, len(texts)), dtype=np.int64)  # in bytes
            small = np.flatnonzero(~large)
            whole = Scan(auto, raw, begins[small], sizes[small])
            start = np.zeros(len(small), dtype=np.intp)
            count = whole.composed(start[:, None])[1][:, 0]
            n[small], marked[small] = count & low, count >> MARK
            units_at = np.array(_cuts(n, first, second))
            for k in range(2):
                some = np.flatnonzero((units_at[k, small] > 0) & (units_at[k, small] < n[small]))
                cuts[k, small[some]] = whole.places(start, some, units_at[k, small[some]])
                for row in np.flatnonzero(large & (units_at[k] > 0) & (units_at[k] < n)).tolist():
                    at = chunks[row][k].as_py() * chunk
                    part = Scan(auto, raw, begins[row : row + 1] + at, np.minimum(sizes[row : row + 1] - at, chunk))
                    cuts[k, row] = at + part.places(np.array([states[row][k].as_py()]), np.zeros(1, dtype=int), np.array([left[row][k].as_py()]))[0]
            cuts = np.where(units_at == n, sizes, cuts)
            stays = (sizes == 0) | (marked > 0) | (third % 100 >= 100 - plain)
            form = np.where(stays, "plain", np.where(fourth % 100 < spm, "spm", "psm"))
            out = []
            for begin, end, a, b, kind in zip(begins.tolist(), ends[1:].tolist(), (begins + cuts[0]).tolist(), (begins + cuts[1]).tolist(), form.tolist()):
                p, m, s = (raw[x:y].tobytes() for x, y in ((begin, a), (a, b), (b, end)))
                out.append(p + m + s if kind == "plain" else b"".join((PREFIX.encode(), p, SUFFIX.encode(), s, MIDDLE.encode(), m) if kind == "psm" else (SUFFIX.encode(), s, PREFIX.encode(), p, MIDDLE.encode(), m)))
            sizes_of = [pa.array(x, pa.int64(), mask=stays) for x in (units_at[0], units_at[1] - units_at[0])]
            yield pa.StructArray.from_arrays([pa.array(n), pa.array(form.tolist(), pa.string()), *sizes_of, pa.array(out, pa.binary()).cast(pa.string())], ["n", "form", "prefix_units", "middle_units", "output"])

    return F.arrow_udf(assemble, MADE)


def fill_in_middle(
    docs: DataFrame, units: str = "code_points", seed: int = SEED, plain: int = PLAIN, spm: int = SPM, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """docs with n (the text's units), form (plain, psm or spm), prefix_units, middle_units (null where plain) and output."""
    names = scratch(docs, "digest", "key", "known")
    digest, key, known = (F.col(c) for c in names)
    numbers = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
    text = text_of(text_col)
    seeded = docs.withColumn(names[0], F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256))
    # Rows of one key have equal ids and texts, and so equal results.
    keyed = seeded.withColumn(names[1], F.when(F.octet_length(text) > chunk, F.concat_ws(":", digest, F.xxhash64(text), F.hash(text), F.octet_length(text))))
    large = keyed.where(key.isNotNull()).select(key.alias("key"), numbers[0].alias("first"), numbers[1].alias("second"), text.cast("binary").alias("text"))
    parts = large.mapInArrow(_chunks(chunk), "key string, chunk int, first bigint, second bigint, data binary").repartition("key", "chunk")
    functions = parts.mapInArrow(_functions(units), FUNCTION)
    grouped = functions.groupBy("key", "first", "second").agg(F.sort_array(F.collect_set(F.struct("chunk", "ends", "counts"))).alias("parts"))
    placed = checkpointed(grouped.mapInArrow(_composed(units), PLACES).select(F.col("key").alias(names[1]), F.struct("n_", "marks_", "chunks_", "states_", "left_").alias(names[2])))
    assemble = _assembled(units, chunk, plain, spm)

    def made(rows: DataFrame) -> DataFrame:
        found = [F.col(f"{names[2]}.{c}") for c in ("n_", "marks_", "chunks_", "states_", "left_")]
        results = MADE.replace(" bigint", "").replace(" string", "").split(", ")
        kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in results]
        return rows.withColumn("made_", assemble(text.cast("binary"), *numbers, *found)).select(*kept, "made_.*")

    # A row for each large document, of a few hundred bytes.
    if placed.count() * 512 <= BROADCAST:
        return made(keyed.join(F.broadcast(placed), names[1], "left"))
    nothing = F.lit(None).cast(placed.schema[names[2]].dataType)
    return made(keyed.where(key.isNull()).withColumn(names[2], nothing)).unionByName(made(keyed.where(key.isNotNull()).join(placed, names[1], "left")))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""

    def two(between: str) -> tuple[Column, Column, Column]:
        after = F.substr(output, F.lit(len(PREFIX) + 1))
        first = F.substring_index(after, between, 1)
        later = F.substr(after, F.length(first) + len(between) + 1)
        second = F.substring_index(later, MIDDLE, 1)
        return first, second, F.substr(later, F.length(second) + len(MIDDLE) + 1)

    prefix, suffix, middle = two(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = two(PREFIX)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))
