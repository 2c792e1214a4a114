"""Sharding by proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked; the k-th
of a source's n rows gets the fraction (k + 1/2) / n.  Sorted by fraction,
every stretch holds each source in proportion, so cutting the order into
equal pieces gives shards that all match the mixture of the whole.

Both orders are global sorts by range (no source is gathered in one task);
row numbers come from partition numbers and per-partition counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``row_index`` 0.. in the order of the columns ``order``, and ``row_count``.

    The sorted rows are written with their partition and place, then counted;
    the counts (one row per partition) become offsets.  Rows that tie in all
    of ``order`` are numbered in any order, once.
    """
    mid = F.monotonically_increasing_id()
    rows = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_at", mid), name)
    part = F.shiftright("_at", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort: a single small task by construction.
    upto = W.orderBy("_part")
    before = upto.rowsBetween(W.unboundedPreceding, -1)
    whole = upto.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                            F.sum("_n").over(whole).alias("row_count"))
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
                .withColumn("row_index", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
                .drop("_at", "_part", "_before"))


def interleave(rows: DataFrame, source_col: str, key_cols: list[str], shards: int,
               seed: int = 0) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: shuffled within each source, mixed in proportion.

    Row counts of shards differ by one at most and slots are gapless from 0.
    A null source is a source of its own.  ``key_cols`` identify a row; rows
    that tie in them are interchangeable.  An empty table stays empty.
    """
    key = F.concat_ws("\x1f", F.lit(str(seed)),
                      *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    shuffled = rows.withColumn("_source", F.coalesce(F.concat(F.lit("s"), source_col), F.lit("")))
    shuffled = shuffled.withColumn("_draw", F.md5(key))
    placed = number_rows(shuffled, ["_source", "_draw", *key_cols], "by-source")
    # Written first, so that the join may split a source that holds much of the rows.
    per_source = materialize(placed.groupBy("_source").agg(F.min("row_index").alias("_first"),
                                                           F.count(F.lit(1)).alias("_n")), "sources")
    share = (2 * (F.col("row_index") - F.col("_first")) + 1) / (2 * F.col("_n"))
    mixed = (placed.join(per_source, "_source").withColumn("_share", share)
                   .drop("row_index", "row_count", "_first", "_n"))
    numbered = number_rows(mixed, ["_share", "_source", "_draw", *key_cols], "by-share")
    # Whole-number arithmetic: the first row of shard s is ceil(s * row_count / shards).
    shard = f"(row_index * {shards}) div row_count"
    slot = f"row_index - (shard * row_count + {shards - 1}) div {shards}"
    return (numbered.withColumn("shard", F.expr(shard)).withColumn("slot", F.expr(slot))
                    .withColumn("shard", F.col("shard").cast("int"))
                    .drop("_source", "_draw", "_share", "row_count", "row_index"))


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 0, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Plan of the shards: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows`` (counts at most one apart), so a changed shard count
    moves rows freely and ``grown_shard`` is null.  ``size`` is the text's
    UTF-8 bytes plus 1.  Only ids, sizes and checksums are sorted; texts stay
    where they are.  A null text has no bytes; null or repeated ids are placed
    like others; an empty table gives no rows; further columns are ignored.
    """
    data = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       (F.octet_length(data) + 1).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"))
    placed = interleave(rows, "source", ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 0,
                 id_col: str = "doc_id") -> None:
    """Whole rows of ``docs`` (unique ids) as files below ``path/shard=k``, ordered by slot.

    A shard of any size is spread over as many tasks as its slots fill ranges.
    """
    plan = shard_documents(docs, shards, seed, id_col).select(
        F.col("doc_id").alias(id_col), "shard", "slot")
    (docs.join(plan, id_col).repartitionByRange("shard", "slot")
         .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
