"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re

import regex
import xxhash

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pii_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    # A text without the characters that a match must hold isn't searched: long runs take these patterns quadratic time.
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)] if "@" in text else []
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text if text.count(".") >= 3 else "") if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return out


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secret_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text: str | None, n: int) -> frozenset:
    w = words_of(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < n else frozenset(zip(*(w[i:] for i in range(n))))


def components(rows: list[tuple[int, str | None]], n: int, percent: int) -> dict[int, int]:
    """The least id reachable, comparing all pairs."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingles(t, n)) for i, t in rows]
    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def host_and_path(url: str | None) -> tuple[str, str]:
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def rule_for(host: str, path: str, rules) -> tuple | None:
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fits, key=lambda r: len(r[1] + r[2]), default=None)


def edited_texts(rows: dict[int, str | None]) -> tuple[dict[int, str], dict[int, int]]:
    """Each text with its last half replaced from the next one's beginning, and which that is."""
    order = sorted(rows, reverse=True)
    follows = {i: order[(k + 1) % len(order)] for k, i in enumerate(order)}
    text = {i: t or "" for i, t in rows.items()}
    return {i: t[: len(t) - len(t) // 2] + text[follows[i]][: len(t) // 2] for i, t in text.items()}, follows


def imatch(rows: dict[int, str | None], low: float, high: float, halves: int, scales) -> dict[int, tuple]:
    """For each id: the terms of each subset, of its text and its edited text, and both likenesses."""
    terms_of = lambda t: {w for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if w}
    hashed = lambda w: xxhash.xxh64(w.encode(), seed=42).intdigest()
    edited, follows = edited_texts(rows)
    own, new = {i: terms_of(t or "") for i, t in rows.items()}, {i: terms_of(t) for i, t in edited.items()}
    df: dict[str, int] = {}
    for found in own.values():
        for w in found:
            df[w] = df.get(w, 0) + 1
    band = {w for w, n in df.items() if max(2, low * len(rows)) <= n <= max(2, high * len(rows))}

    def subsets(found: set) -> dict:
        out: dict = {}
        for w in found & band:
            h = hashed(w)
            places = [(0, bit) for bit in range(halves) if h >> bit & 1]
            places += [(k + 1, h >> shift & (1 << bits) - 1) for k, (shift, bits, kept) in enumerate(scales) if (h >> shift & (1 << bits) - 1) < kept]
            for place in places:
                out.setdefault(place, set()).add(w)
        return out or {"whole": found}

    def like(a: dict, b: dict) -> float:
        return sum(a[k] == b[k] for k in a.keys() & b.keys()) / len(a.keys() | b.keys())

    prints, news = {i: subsets(x) for i, x in own.items()}, {i: subsets(x) for i, x in new.items()}
    return {i: (prints[i], news[i], like(prints[i], news[i]), like(prints[i], prints[follows[i]])) for i in rows}


class Node:
    def __init__(self):
        self.n = self.stops = 0
        self.to: dict[str, Node] = {}


def alergia(shapes: dict[str, int], alpha: float) -> Node:
    """The prefix tree of counted strings, whose states are merged where they agree within Hoeffding's bound; by recursion."""
    root = Node()
    for word, times in shapes.items():
        node = root
        node.n += times
        for c in word:
            node = node.to.setdefault(c, Node())
            node.n += times
        node.stops += times

    def far(a, n, b, m):
        return abs(a / n - b / m) > (0.5 * math.log(2 / alpha)) ** 0.5 * (n**-0.5 + m**-0.5)

    def alike(p, q, on=frozenset()):
        if (id(p), id(q)) in on:
            return True
        on = on | {(id(p), id(q))}
        if far(p.stops, p.n, q.stops, q.n) or any(far(edge(p, c), p.n, edge(q, c), q.n) for c in p.to.keys() | q.to.keys()):
            return False
        return all(alike(p.to[c], q.to[c], on) for c in p.to.keys() & q.to.keys())

    flow: dict[tuple[int, str], int] = {}

    def edge(node, c):
        return flow.get((id(node), c), 0)

    def counted(node):
        for c, child in node.to.items():
            flow[id(node), c] = child.n
            counted(child)

    def fold(into, other):
        into.n += other.n
        into.stops += other.stops
        for c, child in other.to.items():
            flow[id(into), c] = edge(into, c) + edge(other, c)
            if c in into.to:
                fold(into.to[c], child)
            else:
                into.to[c] = child

    counted(root)
    red, queue = [root], [(root, c) for c in sorted(root.to)]
    while queue:
        above, c = queue.pop(0)
        node = above.to[c]
        if any(node is r for r in red):
            continue
        same = next((r for r in red if alike(r, node)), None)
        if same is None:
            red.append(node)
            queue += [(node, x) for x in sorted(node.to)]
        else:
            above.to[c] = same
            before = [set(r.to) for r in red]
            fold(same, node)
            queue += [(r, x) for r, old in zip(red, before) for x in sorted(r.to.keys() - old)]
    root.flow = flow
    return root


def log_likelihood(root: Node, word: str, smoothing: float, size: dict[str, int]) -> float:
    node, total = root, 0.0
    for c in word:
        total += math.log((root.flow.get((id(node), c), 0) + smoothing) / (node.n + 12 * smoothing)) - math.log(size.get(c, 1))
        node = node.to.get(c, node)
    return total + math.log((node.stops + smoothing) / (node.n + 12 * smoothing))
