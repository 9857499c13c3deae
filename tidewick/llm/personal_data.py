"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score.

Native: only SQL functions. A pattern's matches come from ``regexp_extract_all`` and the text between them from ``split``
by the same pattern, so that positions in code points are running sums of lengths. The patterns are possessive and begin
at the start of a run, so that a long run of digits or letters costs time in proportion to its length.

Kinds: email, ip, card (Luhn), phone, which are always kept once their rule holds, then iban (mod-97) and ssn, which are
kept from a score of ``THRESHOLD`` on. A span's score is its kind's prior, raised by a confirming checksum and by a word
of its kind's context within ``NEAR`` characters before it.

Defined cases: a null text counts as empty and has no spans (masking leaves it null); very long texts are searched whole; ties
between kinds keep the listed order, and of spans that begin at one place the longest is masked; repeated rows each get
their own result; a column named like the result is replaced, others pass through, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch, text_of

NEAR = 40
THRESHOLD = 0.5
BLOCK = 128  # matches or spans that are put together at a time


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    prior: float
    context: str
    base: bool


KINDS = (
    # An address may follow the last one's domain at once, as in a@b.c_d@e.f.
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "mail|contact|write|schreib|escrib", True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, r"\bip\b|host|server|address|adress", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.4, "card|visa|credit|karte|carte|tarjeta", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, r"\btel|phone|call|mobil|fax", True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", 0.2, "iban|account|konto|compte|cuenta", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, r"\bssn\b|social|security", False),
)
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CHECKSUM = 0.4
CONTEXT = 0.25


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _mod97(value: Column) -> Column:
    """Whether an IBAN's rearranged number leaves 1 when divided by 97."""
    compact = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(compact, 5, 60), F.substring(compact, 1, 4))
    # A digit adds one place, a letter (A is 10) two.
    step = lambda rest, ch: F.when(ch.rlike("[0-9]"), (rest * 10 + F.ascii(ch) - 48) % 97).otherwise((rest * 100 + F.ascii(ch) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, ch: F.when(ch == "", rest).otherwise(step(rest, ch))) == 1


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        number = _digits(value)
        # Only a number of the right length goes to the checksum.
        return F.when(F.length(number).between(16, 19), F.call_function("luhn_check", number)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(value, " ", "")).between(15, 34)
    return F.lit(True)


def _score(kind: Kind, value: Column, before: Column) -> Column:
    checked = F.lit(CHECKSUM) if kind.name == "card" else F.when(_mod97(value), CHECKSUM).otherwise(0.0) if kind.name == "iban" else F.lit(0.0)
    near = F.when(F.lower(before).rlike(kind.context), CONTEXT).otherwise(0.0)
    return F.least(F.lit(1.0), F.lit(kind.prior) + checked + near)


SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(values: Column) -> Column:
    """The values of an array that has some, as an array of arrays of BLOCK values."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda k: F.slice(values, k * BLOCK + 1, F.lit(BLOCK)))


def _spans(kind: Kind, hits: Column, gaps: Column) -> Column:
    """Spans of one kind in order of start.

    Appending to an array copies it, so that positions are summed by blocks of matches: a long text with many matches takes
    time in proportion to their number.
    """
    pairs = F.arrays_zip(hits.alias("hit"), F.slice(gaps, 1, F.size(hits)).alias("gap"))
    zero = F.lit(0).cast("bigint")

    def width(block: Column) -> Column:
        return F.aggregate(block, zero, lambda total, pair: total + F.length(pair["gap"]) + F.length(pair["hit"]))

    def place_block(state: Column, block: Column) -> Column:
        here = F.array(F.struct(state["at"].alias("at"), block.alias("pairs")))
        return F.struct((state["at"] + width(block)).alias("at"), F.concat(state["found"], here).alias("found"))

    def place(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        found = F.array(F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("hit"), F.right(pair["gap"], F.lit(NEAR)).alias("before")))
        return F.struct(end.alias("at"), F.when(_holds(kind.name, pair["hit"]), F.concat(state["found"], found)).otherwise(state["found"]).alias("found"))

    no_blocks = F.array().cast("array<struct<at:bigint,pairs:array<struct<hit:string,gap:string>>>>")
    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string,before:string>>")
    blocks = F.aggregate(_bound(pairs, _blocks), F.struct(zero.alias("at"), no_blocks.alias("found")), place_block, lambda state: state["found"])
    placed = F.flatten(F.transform(blocks, lambda b: F.aggregate(b["pairs"], F.struct(b["at"].alias("at"), none.alias("found")), place, lambda state: state["found"])))
    scored = F.transform(placed, lambda x: F.struct(F.lit(kind.name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), _score(kind, x["hit"], x["before"]).alias("score")))
    return scored if kind.base else F.filter(scored, lambda x: x["score"] >= THRESHOLD)


def with_spans(docs: DataFrame, out: str = "pii", text_col: str = "text") -> DataFrame:
    """docs with an array of spans (kind, start, end, score): by kind as listed, then by start."""
    text, digit = scratch(docs, "pii_text", "pii_digit")
    work = docs.withColumn(text, text_of(text_col)).withColumn(digit, F.col(text).rlike("[0-9]"))
    parts = []
    for kind in KINDS:
        hits, gaps, part = scratch(work, f"{kind.name}_hits", f"{kind.name}_gaps", f"{kind.name}_spans")
        # Every kind but email holds a digit; a text without the needed character isn't searched.
        needed = F.contains(F.col(text), F.lit("@")) if kind.name == "email" else F.col(digit)
        if kind.name == "phone":
            needed &= F.contains(F.col(text), F.lit("+"))
        work = work.withColumn(hits, F.when(needed, F.regexp_extract_all(F.col(text), F.lit(kind.pattern), F.lit(0))))
        work = work.withColumn(gaps, F.when(F.size(hits) > 0, F.split(F.col(text), kind.pattern, -1)))
        work = work.withColumn(part, F.when(F.size(hits) > 0, _spans(kind, F.col(hits), F.col(gaps))).otherwise(F.array().cast(SPAN)).cast(SPAN))
        parts.append(part)
    return work.withColumn(out, F.concat(*parts)).select(*[c for c in docs.columns if c != out], out)


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping ones, replaced by its first kind in brackets.

    Each block of spans cuts its part out of the text once, and its spans cut that part, so that a long text isn't walked
    through anew for each span. spans: one or more.
    """
    order = lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["end"] > b["end"], -1).when(a["end"] < b["end"], 1).otherwise(0)
    cut = lambda value, start, end: F.substring(value, (start + 1).cast("int"), (end - start).cast("int"))
    last = lambda block: F.array_max(F.transform(block, lambda x: x["end"]))
    zero = F.lit(0).cast("bigint")

    def place_block(state: Column, block: Column) -> Column:
        end = F.greatest(state["at"], last(block))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(F.struct(state["at"].alias("at"), end.alias("end"), block.alias("spans")))).alias("found"))

    def pieces(block: Column) -> Column:
        def follow(part: Column):
            def step(state: Column, span: Column) -> Column:
                # The mask counts as put once a span begins beyond what is masked so far.
                kept = cut(part, state["at"] - block["at"], span["start"] - block["at"])
                mask = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
                out = F.when(span["start"] >= state["at"], F.concat(state["out"], F.array(kept, mask))).otherwise(state["out"])
                return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

            start = F.struct(block["at"].alias("at"), F.array().cast("array<string>").alias("out"))
            return F.aggregate(block["spans"], start, step, lambda state: state["out"])

        return _bound(cut(text, block["at"], block["end"]), follow)

    no_blocks = F.array().cast(f"array<struct<at:bigint,end:bigint,spans:{SPAN}>>")
    blocks = F.aggregate(_bound(F.array_sort(spans, order), _blocks), F.struct(zero.alias("at"), no_blocks.alias("found")), place_block, lambda state: state["found"])
    masked = F.array_join(F.flatten(F.transform(blocks, pieces)), "")
    return F.concat(masked, F.substring(text, (last(spans) + 1).cast("int"), F.length(text)))


def mask_personal_data(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """docs with personal data masked in the text; length_col, where there is one, gets the new length. Null texts stay."""
    (spans,) = scratch(docs, "pii_spans")
    found = with_spans(docs, spans, text_col)
    out = found.withColumn(text_col, F.when(F.size(spans) > 0, redacted(text_of(text_col), F.col(spans))).otherwise(F.col(text_col)))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(F.size(spans) > 0, F.length(text_col)).otherwise(F.col(length_col)).cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)
