"""Exact deduplication with a split for heavy hitters.

Texts are compared by their SHA-256. A Misra-Gries summary (the frequent-items sketch behind approx_top_k, bounded in
size and merged from partial summaries) proposes digests that may be frequent; exact partial counts verify them and find
the row that stays. These few winners, at most ``heavy`` rows, are broadcast: rows with a frequent digest are decided on
the map side and never shuffled, so that a text held by a third of all rows lands in no single task. The summary holds
every digest above 1/``tracked`` of the rows or so, and all other digests go through an ordinary shuffle.

Defined cases: a null text equals an empty one; very long texts are hashed whole; a null doc_id loses to any other; of the
greatest doc_id several rows may have, and repeated rows (same doc_id and text) are copies of one another, of which one
stays; labels read only id and text, and rows that stay keep all their columns, whatever their names; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, scratch, text_of

HEAVY = 512
TRACKED = 8192


def _heavy(keys: DataFrame, digest: str, order: str, heavy: int, tracked: int) -> DataFrame:
    """At most ``heavy`` rows: digest, the greatest order value and the number of rows, counted exactly."""
    proposed = (
        keys.agg(F.expr(f"approx_top_k(`{digest}`, {heavy}, {tracked})").alias("top"))
        .select(F.explode("top").alias("top"))
        .where("top.count > 1")
        .select(F.col("top.item").alias(digest))
    )
    return checkpointed(
        keys.join(F.broadcast(proposed), digest)
        .groupBy(digest)
        .agg(F.max(order).alias("best"), F.count(F.lit(1)).alias("copies"))
    )


def label_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept and text_sha256; the greatest id of equal texts is kept."""
    keys = checkpointed(
        docs.select(
            F.col(id_col).alias("id"), F.sha2(text_of(text_col), 256).alias("digest"), F.monotonically_increasing_id().alias("row")
        )
    ).withColumn("order", F.struct("id", "row"))
    winners = _heavy(keys, "digest", "order", heavy, tracked)
    split = keys.join(F.broadcast(winners), "digest", "left")
    frequent = split.where("best is not null")
    groups = Window.partitionBy("digest")
    rare = split.where("best is null").withColumns({"best": F.max("order").over(groups), "copies": F.count(F.lit(1)).over(groups)})
    return frequent.unionByName(rare).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """The rows of docs that stay, with their columns; of equal texts, one row with the greatest id."""
    digest, best, copies, place = scratch(docs, "digest", "best", "copies", "place")
    hashed = docs.withColumn(digest, F.sha2(text_of(text_col), 256))
    winners = _heavy(hashed.select(F.col(digest).alias("digest"), F.col(id_col).alias("id")), "digest", "id", heavy, tracked).select(
        F.col("digest").alias(digest), F.col("best").alias(best), F.col("copies").alias(copies)
    )
    # On the map side all copies of a frequent text go but the winner, which then meets only rows that repeat it.
    left = hashed.join(F.broadcast(winners), digest, "left").where(F.col(copies).isNull() | F.col(id_col).eqNullSafe(F.col(best)))
    ranked = left.withColumn(place, F.row_number().over(Window.partitionBy(digest).orderBy(F.col(id_col).desc_nulls_last())))
    return ranked.where(F.col(place) == 1).select(*docs.columns)
