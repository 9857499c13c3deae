"""Secret scans with inferred formats.

Fixed patterns find three kinds of credentials: assigned values, access keys and long hexadecimal strings. Those found are
labelled examples, from which a probabilistic automaton is inferred for each kind (ALERGIA): the prefix tree of the examples
is built and states whose frequencies of stopping and of each next symbol agree within Hoeffding's bound are merged. An
automaton of all unlabelled runs is inferred likewise. Then every other run of credential characters in every text, from
the length of the shortest example on, is scored by the logarithm of its best format likelihood over its likelihood as an
ordinary run; those above ``MARGIN`` a character become spans of kind ``format``.

Symbols are character classes with equally likely members, so that automata tell formats, not values. Values themselves are
never stored, only digests that tell equal ones, with their shapes. All distinct examples and runs are counted by strata: kind,
length and the classes that occur. Automata are inferred from a sample of ``SAMPLE`` characters a kind, in which every
stratum has an equal part as far as it has that much, chosen by digest; of a kind with fewer characters all is learned. So a
format of few examples isn't lost among many others, however large the table, and the driver holds ``SAMPLE`` nodes of a kind at most.
The automaton of ordinary runs then gets its frequencies from all of them, which Spark counts.

Defined cases: a null text counts as empty; very long texts and runs are read whole; without examples of a kind its
automaton is left out, without any no span is added; spans of one start come in the order of kinds, ``format`` last; repeated
rows each get their own result, and count once for the formats; only id and text are read, so that other columns may have
any names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from hashlib import blake2b
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_of

SHORTEST = 6
SAMPLE = 100_000
EXACT = 64  # lengths up to this are strata of their own, longer ones by doublings
HELD = 100_000
CONFIDENCE = 0.05
SMOOTHING = 0.1
MARGIN = 0.35
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# A text without any of these, in lower case, holds no assigned value; looking for them is faster than the pattern.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
RUN = "[A-Za-z0-9+/_=-]{%d,}"
FOUND = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"
# A class's symbol is its first member; other characters are their own symbols.
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ")
SYMBOL = {ord(c): chars[0] for chars in CLASSES for c in chars}
LOG_SIZE = {chars[0]: math.log(len(chars)) for chars in CLASSES}


def shape(s: str) -> str:
    return s.translate(SYMBOL)


def tree_nodes(shapes: Iterable[tuple[str, int]]) -> dict[int, list]:
    """Nodes of the prefix tree of counted shapes, by a hash of their prefix: the node above, symbol, times seen, times stopped."""
    found: dict[int, list] = {0: [0, "", 0, 0]}
    for s, times in shapes:
        node = 0
        found[0][2] += times
        for c in s:
            above, node = node, ((node * 6364136223846793005 + (ord(c) + 1) * 1442695040888963407) ^ (node >> 29)) % (1 << 63)
            found.setdefault(node, [above, c, 0, 0])[2] += times
        found[node][3] += times
    return found


class Automaton:
    """A probabilistic deterministic automaton inferred from strings, or from counted shapes."""

    def __init__(self, strings: Iterable[str] = (), shapes: Iterable[tuple[str, int]] | None = None):
        shapes = Counter(map(shape, strings)).items() if shapes is None else shapes
        self.build([(node, *x) for node, x in tree_nodes(shapes).items()])

    def build(self, nodes: list[tuple]) -> None:
        """Merge the states of a prefix tree, of rows (node, above, symbol, seen, stops)."""
        place = {0: 0} | {node: k for k, node in enumerate((x[0] for x in nodes if x[0]), 1)}
        self.seen, self.stops, self.next = [0] * len(place), [0] * len(place), [{} for _ in place]  # next: symbol -> [state, times]
        for node, above, symbol, seen, stops in nodes:
            self.seen[place[node]], self.stops[place[node]] = seen, stops
            if node:
                self.next[place[above]][symbol] = [place[node], seen]
        self._merge()
        self._left_out()

    def walked(self, shapes: Iterable[tuple[str, int]]) -> Counter:
        """How often shapes take each symbol at each state, and stop there (the empty symbol); without an edge they go on from the first state."""
        found = Counter()
        for s, times in shapes:
            state = 0
            for c in s:
                found[state, c] += times
                state = self.next[state][c][0] if c in self.next[state] else 0
            found[state, ""] += times
        return found

    def count(self, walked: dict[tuple[int, str], int]) -> None:
        """Set all frequencies to those of a walk, and leave out states that it never met."""
        place = {state: k for k, state in enumerate(sorted({0} | {state for state, _ in walked}))}
        seen, stops, edges = [0] * len(place), [0] * len(place), [{} for _ in place]
        for (state, symbol), times in walked.items():
            seen[place[state]] += times
            if symbol:
                edges[place[state]][symbol] = [place[self.next[state][symbol][0]] if symbol in self.next[state] else 0, times]
            else:
                stops[place[state]] += times
        self.seen, self.stops, self.next = seen, stops, edges

    def _left_out(self) -> None:
        """Leave out states that were folded into others."""
        order, place = [0], {0: 0}
        for state in order:
            for symbol in sorted(self.next[state]):
                to = self.next[state][symbol][0]
                if to not in place:
                    place[to] = len(order)
                    order.append(to)
        self.seen, self.stops = [self.seen[s] for s in order], [self.stops[s] for s in order]
        self.next = [{symbol: [place[to], times] for symbol, (to, times) in self.next[s].items()} for s in order]

    def _differ(self, a: int, n: int, b: int, m: int) -> bool:
        return abs(a / n - b / m) > math.sqrt(0.5 * math.log(2 / CONFIDENCE)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _alike(self, one: int, other: int) -> bool:
        pairs, done = [(one, other)], set()
        while pairs:
            p, q = pair = pairs.pop()
            if pair in done:
                continue
            done.add(pair)
            n, m = self.seen[p], self.seen[q]
            if self._differ(self.stops[p], n, self.stops[q], m):
                return False
            for symbol in self.next[p].keys() | self.next[q].keys():
                x, y = self.next[p].get(symbol), self.next[q].get(symbol)
                if self._differ(x[1] if x else 0, n, y[1] if y else 0, m):
                    return False
                if x and y:
                    pairs.append((x[0], y[0]))
        return True

    def _fold(self, into: int, other: int) -> None:
        pairs = [(into, other)]
        while pairs:
            p, q = pairs.pop()
            self.seen[p] += self.seen[q]
            self.stops[p] += self.stops[q]
            for symbol, (state, times) in self.next[q].items():
                if symbol in self.next[p]:
                    self.next[p][symbol][1] += times
                    pairs.append((self.next[p][symbol][0], state))
                else:
                    self.next[p][symbol] = [state, times]

    def _merge(self) -> None:
        """Settle states breadth first: each new one is folded into the first settled state like it, or settled itself."""
        settled, fringe = {0: None}, deque((0, s) for s in sorted(self.next[0]))  # in order of settling
        while fringe:
            above, symbol = fringe.popleft()
            state = self.next[above][symbol][0]
            if state in settled:
                continue
            same = next((s for s in settled if self._alike(s, state)), None)
            if same is None:
                settled[state] = None
                fringe += [(state, s) for s in sorted(self.next[state])]
            else:
                self.next[above][symbol][0] = same
                before = {s: set(self.next[s]) for s in settled}
                self._fold(same, state)
                fringe += [(s, x) for s in settled for x in sorted(self.next[s].keys() - before[s])]

    def log_likelihood(self, s: str) -> float:
        state, total = 0, 0.0
        for c in shape(s):
            edge = self.next[state].get(c)
            # A symbol that was never seen here counts a little, and the walk stays where it is.
            total += math.log(((edge[1] if edge else 0) + SMOOTHING) / (self.seen[state] + 12 * SMOOTHING)) - LOG_SIZE.get(c, 0.0)
            state = edge[0] if edge else state
        return total + math.log((self.stops[state] + SMOOTHING) / (self.seen[state] + 12 * SMOOTHING))


class Formats:
    """Scores strings by the formats inferred from labelled examples against ordinary runs."""

    def __init__(self, kinds: dict[str, Automaton], words: Automaton | None, shortest: int):
        self.kinds, self.words, self.shortest = kinds, words, shortest
        self.known: dict[str, float] = {}

    def score(self, s: str) -> float:
        """Log-likelihood ratio a character of the best format; minus infinity without examples. Equal shapes score equally."""
        if not self.kinds:
            return -math.inf
        if (found := self.known.get(key := shape(s))) is None:
            # Without words to learn from, every one of 66 characters is as likely.
            word = self.words.log_likelihood(s) if self.words else -math.log(66) * len(s)
            found = (max(a.log_likelihood(s) for a in self.kinds.values()) - word) / len(s)
            if len(self.known) >= HELD:
                self.known.clear()
            self.known[key] = found
        return found


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Spans of the fixed patterns, by start, then by kind as listed."""
    low = text.lower()
    out = [("assign", m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 6] if any(x in low for x in NAMES) else []
    out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def other_runs(text: str, base: list[tuple[str, int, int, str]], pattern: re.Pattern) -> Iterator[re.Match]:
    """Runs that overlap no base span; those are known already. Both are in order of start."""
    i = 0
    for m in pattern.finditer(text):
        while i < len(base) and base[i][2] <= m.start():
            i += 1
        if i == len(base) or base[i][1] >= m.end():
            yield m


def _values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests and shapes of examples and, of kind word, other runs; repeated ones are left out as far as a task remembers them."""
    held: dict[str, set[str]] = {kind: set() for kind in (*KINDS, "word")}
    pattern = re.compile(RUN % SHORTEST)

    def told() -> pd.DataFrame:
        digest = lambda x: int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "big", signed=True)
        rows = [(kind, digest(x), shape(x)) for kind, found in held.items() for x in found]
        for found in held.values():
            found.clear()
        return pd.DataFrame(rows, columns=["kind", "digest", "shape"])

    for batch in batches:
        for text in batch["text"]:
            base = base_spans(text)
            for x in base:
                held[x[0]].add(x[3])
            held["word"].update([m[0] for m in other_runs(text, base, pattern)] if base else pattern.findall(text))
            if sum(map(len, held.values())) > HELD:
                yield told()
    yield told()


def rates(strata: dict[tuple, tuple[int, float]], sample: int) -> dict[tuple, float]:
    """For strata with numbers of strings and mean lengths, the share of each to take: an equal number of characters, so many in all.

    Strings that are longer than a stratum's part are left out, unless all strings are taken.
    """
    total = lambda key: strata[key][0] * strata[key][1]
    if sum(map(total, strata)) <= sample:
        return dict.fromkeys(strata, 1.0)
    taken = lambda part: {key: min(total(key), part) if strata[key][1] <= part else 0.0 for key in strata}
    lo, hi = 0.0, float(sample)
    for _ in range(60):
        middle = (lo + hi) / 2
        lo, hi = (middle, hi) if sum(taken(middle).values()) <= sample else (lo, middle)
    return {key: characters / total(key) for key, characters in taken(lo).items()}


STRATUM = ("kind", "long", "classes")
PARTS = 1 << 30  # of digests, to take a share of


def _with_strata(values: DataFrame) -> DataFrame:
    """Values with what tells their stratum: there are (EXACT + 31) * 64 of a kind at most."""
    size = F.length("shape")
    classes = sum((F.contains("shape", F.lit(chars[0])).cast("int") * 2**k for k, chars in enumerate(CLASSES)), F.rlike("shape", F.lit("[^0aAgG]")).cast("int") * 2 ** len(CLASSES))
    return values.withColumns({"long": F.when(size <= EXACT, size).otherwise(EXACT + F.floor(F.log2(size)).cast("int")), "classes": classes})


def infer(texts: DataFrame) -> Formats:
    """Automata of the examples of each kind and of all other runs of the texts."""
    values = checkpointed(texts.mapInPandas(_values, "kind string, digest bigint, shape string").distinct())
    shortest = values.where("kind <> 'word'").agg(F.min(F.length("shape"))).head()[0]
    if shortest is None:
        return Formats({}, None, SHORTEST)
    values = _with_strata(values.where(F.length("shape") >= shortest))
    strata: dict[str, dict] = {}
    for *key, n, mean in values.groupBy(*STRATUM).agg(F.count(F.lit(1)), F.avg(F.length("shape"))).collect():
        strata.setdefault(key[0], {})[tuple(key)] = n, mean
    taken = [(*key, int(rate * PARTS)) for found in strata.values() for key, rate in rates(found, SAMPLE).items()]
    share = texts.sparkSession.createDataFrame(taken, "kind string, long int, classes int, share bigint")
    sampled = values.join(F.broadcast(share), [*STRATUM]).where(F.pmod("digest", F.lit(PARTS)) < F.col("share")).groupBy("kind", "shape").agg(F.count(F.lit(1)).alias("times"))
    shapes: dict[str, list[tuple[str, int]]] = {}
    for kind, x, times in sorted(map(tuple, sampled.collect())):
        shapes.setdefault(kind, []).append((x, times))
    automata = {kind: Automaton(shapes=found) for kind, found in shapes.items()}
    words = automata.pop("word", None)
    if words and any(rate < PARTS for kind, *_, rate in taken if kind == "word"):
        shared = texts.sparkSession.sparkContext.broadcast(words)

        def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [(*at, times) for at, times in shared.value.walked(zip(batch["shape"], batch["times"].tolist())).items()]
                yield pd.DataFrame(rows, columns=["state", "symbol", "times"])

        every = values.where("kind = 'word'").groupBy("shape").agg(F.count(F.lit(1)).alias("times")).mapInPandas(walk, "state int, symbol string, times bigint")
        # As many rows as the automaton has edges.
        words.count({(state, symbol): times for state, symbol, times in every.groupBy("state", "symbol").agg(F.sum("times")).collect()})
    return Formats(automata, words, shortest)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """A row for each row of docs: its id and its spans (kind, start, end, score); the base kinds have no score."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))
    formats = docs.sparkSession.sparkContext.broadcast(infer(texts.select("text")))

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learned = formats.value
        pattern = re.compile(RUN % learned.shortest)
        plain: set[str] = set()  # runs that are known to score less
        score = lru_cache(HELD)(learned.score)

        def added(text: str, base: list) -> Iterator[tuple]:
            if not learned.kinds:
                return
            fresh = set(pattern.findall(text)) - plain
            low = {x for x in fresh if score(x) < margin}
            if len(plain) > HELD:
                plain.clear()
            plain.update(low)
            if len(low) < len(fresh):
                for m in other_runs(text, base, pattern):
                    if m[0] in fresh and (found := score(m[0])) >= margin:
                        yield "format", m.start(), m.end(), found

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["id"], batch["text"]):
                base = base_spans(text)
                spans = [(kind, start, end, None) for kind, start, end, _ in base]
                spans += added(text, base)
                spans.sort(key=lambda x: x[1])  # stable: base kinds come in listed order, format last
                rows.append((doc_id, [dict(zip(("kind", "start", "end", "score"), x)) for x in spans]))
            yield pd.DataFrame(rows, columns=["doc_id", "spans"]).astype({"doc_id": "Int64"})

    return texts.mapInPandas(scanned, FOUND).withColumnRenamed("doc_id", id_col)
