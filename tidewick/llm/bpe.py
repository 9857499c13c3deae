"""Byte-level BPE by longest matches and backtracking.

Merging pairs by rank takes time beyond linear in a piece's length. Instead, bytes are mapped to Latin-1, an Aho-Corasick
automaton finds the longest token that begins at each place, and the encoder walks left to right, taking the longest token
that may stand beside the last one; where none may, it steps back. Two tokens may stand side by side when merging their
joint bytes gives back just these two, which only looks at how each was last merged; answers are memoised. The only
sequence whose neighbours all agree is the one that merging gives.

Pieces (matches of the pattern) recur, so that each task keeps what it has found for up to ``MEMO`` of them; the memo is
emptied when full, so that memory stays bounded.

Defined cases: a null text counts as empty and has no tokens; very long texts and pieces are encoded whole; equal texts have
equal results, and repeated rows each get theirs; columns named like a result are replaced, others pass through, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, text_of

MEMO = 300_000
PAIRS = 1_000_000


class Encoder:
    """Encodes and decodes bytes by a list of tokens, whose places are their ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.rank_of = ranks
        self.joint: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.pair_memo: dict[tuple[int, int], bool] = {}
        self.size = {rank: len(token) for rank, token in self.bytes_of.items()}
        self.shown = {rank: str(rank) for rank in self.bytes_of}
        self.of_byte = [ranks.get(bytes([b])) for b in range(256)]
        self.longest = ahocorasick.Automaton()
        for rank, token in sorted(self.bytes_of.items()):
            if len(token) > 1:
                self.longest.add_word(token.decode("latin-1"), (len(token) - 1, rank))
            self.parts[rank] = (rank, rank)
            # A token's last merge joins two older ones that may stand side by side without it.
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None and left < rank and right < rank and self._agree(left, right):
                    self.parts[rank], self.joint[left, right] = (left, right), rank
                    break
        self.longest.make_automaton()
        self.shorter = {rank: self._shorter(token) for token, rank in ranks.items()}

    def _shorter(self, token: bytes) -> int | None:
        """The longest token that is a true prefix of this one."""
        return next((r for n in range(len(token) - 1, 0, -1) if (r := self.rank_of.get(token[:n])) is not None), None)

    def _agree(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just these two.

        Undoing the later merge of the two that meet at the seam shows each state of the seam in turn, newest first; the
        pair fails if tokens then at the seam would have been merged before that.
        """
        limit = len(self.rank_of) + 1
        while True:
            joint = self.joint.get((left, right))
            if joint is not None and joint < limit:
                return False
            later_left = left > right
            for side in (later_left, not later_left):
                if side:
                    limit, inner = left, self.parts[left][1]
                    moved, left = inner != left, inner
                else:
                    limit, inner = right + 1, self.parts[right][0]
                    moved, right = inner != right, inner
                if moved:
                    break
            else:
                return True

    def agree(self, left: int, right: int) -> bool:
        known = self.pair_memo.get((left, right))
        if known is None:
            if len(self.pair_memo) >= PAIRS:
                self.pair_memo.clear()
            known = self.pair_memo[left, right] = self._agree(left, right)
        return known

    def encode(self, piece: bytes) -> list[int]:
        whole = self.rank_of.get(piece)
        if whole is not None:
            return [whole]
        # For each place, the longest token that begins there: of all tokens, by their ends, the last.
        first = [self.of_byte[b] for b in piece]
        for last, (before, rank) in self.longest.iter(piece.decode("latin-1")):
            first[last - before] = rank
        size, shorter, known = self.size, self.shorter, self.pair_memo.get
        end, dead, out, at = len(piece), set(), [], 0
        token = first[0] if end else None
        while at < end:
            while token is not None:
                ahead = at + size[token]
                if ahead not in dead:
                    if not out:
                        break
                    fits = known((out[-1], token))
                    if fits or (fits is None and self.agree(out[-1], token)):
                        break
                token = shorter[token]
            if token is None:
                # No token fits here, so that no encoding passes this place: try less of the last one.
                dead.add(at)
                token = out.pop()
                at -= size[token]
                token = shorter[token]
                continue
            out.append(token)
            at = ahead
            token = first[at] if at < end else None
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file with a token in base64 and its rank on each line, kept for a worker's next tasks."""
    with open(path, "rb") as lines:
        return Encoder({base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())})


class TextCodec:
    """Encodes whole texts, each match of the pattern separately."""

    def __init__(self, path: str, pattern: str):
        self.encoder, self.pattern = encoder(path), regex.compile(pattern)
        self.memo: dict[str, tuple[list[int], str, bytes]] = {}

    def piece(self, piece: str) -> tuple[list[int], str, bytes]:
        """A piece's ids, the ids as text, and the bytes that they decode to."""
        if len(self.memo) >= MEMO:
            self.memo.clear()
        ids = self.encoder.encode(piece.encode())
        shown = self.encoder.shown
        found = self.memo[piece] = (ids, " ".join([shown[i] for i in ids]), self.encoder.decode(ids))
        return found

    def pieces(self, text: str) -> list[tuple[list[int], str, bytes]]:
        known, piece = self.memo.get, self.piece
        return [known(x) or piece(x) for x in self.pattern.findall(text)]


def with_tokens(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids: bool = False) -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256 of each whole text, and with ids their array.

    ids_sha256 is of the decimal ids joined by one space, decoded_sha256 of the bytes that the ids decode to. The file at
    path is read by each Python worker once and must be at the same place on every machine.
    """
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")

    @F.pandas_udf(schema)
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = TextCodec(path, pattern)
        for texts in batches:
            rows = []
            for text in texts:
                found = codec.pieces(text)
                row = (
                    sum([len(x[0]) for x in found]),
                    hashlib.sha256(" ".join([x[1] for x in found]).encode()).hexdigest(),
                    hashlib.sha256(b"".join([x[2] for x in found])).hexdigest(),
                )
                rows.append((*row, [i for x in found for i in x[0]]) if ids else row)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    names = [c.split()[0] for c in schema.split(", ")]
    (held,) = scratch(docs, "coded")
    return docs.withColumn(held, coded(text_of(text_col))).select(*[c for c in docs.columns if c not in names], f"{held}.*")
