"""The queries of this subpackage, one or more for each operator, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers as tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, fill_in_middle, fingerprints, html_text, jaccard_join, packing, periodic_runs, personal_data, quality, secrets, set_sketch, url_filter
from .common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(function)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = shipped
    return shipped


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.label_copies(table(spark, sf_dir, "documents"))


ORACLES["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _number(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.with_spans(table(spark, sf_dir, "documents"), "pii")
    base = [k.name for k in personal_data.KINDS if k.base]
    return found.select(
        "doc_id",
        *[_number("pii", kind) for kind in base],
        F.sha2(_joined(F.filter("pii", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        _joined(F.col("pii")).alias("spans"),
        F.transform("pii", lambda x: x["score"]).alias("scores"),
    )


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.with_tokens(docs, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN).drop("text")


@query
def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_50k.json"))


@query
def op4_secret_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] != "format")
    return found.select(
        "doc_id",
        *[_number("spans", kind) for kind in secrets.KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


# action, host, path
URL_RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)


@query
def op2_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of the document that its url names by number: bad when of low quality or toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.greatest(1 - F.col("quality"), F.col("toxic")).alias("bad"))
    number = F.try_to_number(F.regexp_extract(url_filter.path_of(F.col("url")), "^/[^/]*/([0-9]{1,18})", 1), F.lit("9" * 18)).cast("bigint")
    # Urls that name the same document are counted before labels are joined; those that name none only tell of their host.
    named = pages.groupBy(url_filter.host_of(F.col("url")).alias("host"), number.alias("doc_id")).agg(F.count(F.lit(1)).alias("times"))
    told = named.where("doc_id IS NOT NULL").join(labels, "doc_id", "left").select("host", "bad", "times")
    outcomes = told.unionByName(named.where("doc_id IS NULL").select("host", F.lit(None).cast(labels.schema["bad"].dataType).alias("bad"), "times"))
    return url_filter.judge(pages, outcomes, URL_RULES).drop("url")


@query
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.with_main_text(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op1_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.with_quality(docs, table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", F.when(F.col("score") >= quality.CUT, 1).otherwise(0))


@query
def op10_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_components(table(spark, sf_dir, "documents"), words=3, percent=90)


@query
def op6_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_fingerprints(table(spark, sf_dir, "documents"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op13_fill_in_middle"] = """
WITH digests AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents
), cuts AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM digests
), parts AS (
  SELECT *, least(x, y) AS lo, greatest(x, y) - least(x, y) AS mid, substr(t, 1, least(x, y)) AS p,
         substr(t, least(x, y) + 1, greatest(x, y) - least(x, y)) AS m, substr(t, greatest(x, y) + 1) AS s FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN mid END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


def _planted(docs: DataFrame) -> DataFrame:
    """Every tenth document, by crc32 of its id, goes on periodically from one of its words on; others stay as they are."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g, n = F.floor(h / 10), F.size("words")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    some = docs.withColumn("words", F.when(h % 10 == 0, words)).withColumns({"a": g % n, "g": g})
    some = some.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    text = F.array_join(F.transform("words", lambda w, i: F.get("words", at(i))), " ")
    return some.withColumn("text", F.when(n > 0, text).otherwise(F.col("text"))).select(*docs.columns)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.with_runs(_planted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    more = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, x: F.when(more(x, best), x).otherwise(best))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_setsketch_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = set_sketch.near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=85)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
