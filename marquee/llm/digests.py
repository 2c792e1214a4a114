"""Exact de-duplication over a persistent digest index.

The index is a Parquet table ``(digest, keep_id, group_size)``, bucketed and
sorted by the digest.  A new batch is digested, reduced to one row per digest
(with map-side combine, so a text that fills a third of the corpus sends one
row per task), and anti-joined with the index by a sort-merge join that moves
only the batch: the index is read in its own buckets.  What is new is
appended in the same layout.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, materialize

INDEX_SCHEMA = T.StructType([
    T.StructField("digest", T.BinaryType()),
    T.StructField("keep_id", T.LongType()),
    T.StructField("group_size", T.LongType()),
])


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased; a null counts as the empty text."""
    return F.unhex(F.sha2(F.encode(ascii_lower(F.coalesce(text, F.lit(""))), "UTF-8"), 256))


COUNTS_SCHEMA = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("more", T.LongType())])


def digested(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest) of every row."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(F.col(text_col)).alias("digest"))


class DigestIndex:
    """Digests of every text taken in so far, bucketed and sorted by hash.

    ``path`` names the folder of the table (its counts lie in ``path`` + "-again");
    ``None`` leaves both in the session's warehouse.  An index that exists at
    ``path`` is opened with its ``buckets``, else it starts empty.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64,
                 table: str | None = None):
        self.spark, self.buckets = spark, buckets
        self.table = table or f"digest_index_{uuid.uuid4().hex[:12]}"
        self.again = f"{self.table}_again"
        for name, schema, place in ((self.table, INDEX_SCHEMA, path), (self.again, COUNTS_SCHEMA, path and f"{path}-again")):
            if not spark.catalog.tableExists(name):
                columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
                place = " LOCATION '{}'".format(place.replace("'", "\\'")) if place else ""
                spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (digest) "
                          f"SORTED BY (digest) INTO {buckets} BUCKETS{place}")

    def read(self) -> DataFrame:
        """One row per text: digest, keep_id, and group_size when it was first met."""
        return self.spark.table(self.table)

    def entries(self) -> DataFrame:
        """One row per text: digest, keep_id, group_size with all that came later; no shuffle, both tables have one layout."""
        more = self.spark.table(self.again).groupBy("digest").agg(F.sum("more").alias("more"))
        return self.read().hint("merge").join(more, "digest", "left").select(
            "digest", "keep_id", (F.col("group_size") + F.coalesce("more", F.lit(0))).alias("group_size"))

    def _append(self, rows: DataFrame, table: str, schema: T.StructType) -> None:
        # The bucket function is the hash partitioning of the same count, so
        # each task writes the one file of its bucket.
        rows.select(*schema.fieldNames()).repartition(self.buckets, "digest").write.insertInto(table)
        self.spark.catalog.refreshTable(table)

    def add_digests(self, rows: DataFrame) -> DataFrame:
        """Take in a batch of (doc_id, digest); returns the digests not met before, now appended."""
        batch = materialize(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                                       F.count(F.lit(1)).alias("group_size")), "batch")
        known = self.read().select("digest").hint("merge")
        fresh = materialize(batch.join(known, "digest", "left_anti"), "digests")
        met = materialize(batch.join(known, "digest", "left_semi").select("digest", F.col("group_size").alias("more")), "met")
        self._append(fresh, self.table, INDEX_SCHEMA)
        self._append(met, self.again, COUNTS_SCHEMA)
        return fresh

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Take in a batch: digests not met before are appended, and returned.

        Of equal texts within the batch the row with the largest id stays; a
        null id is smaller than any other.  Texts that the index holds already
        keep the row that came first, as it may be in use; their number grows.
        Any other columns of ``docs`` are ignored; an empty batch appends nothing.
        """
        return self.add_digests(digested(docs, id_col, text_col))

    def drop(self) -> None:
        """Drop both tables (files at a ``path`` of one's own stay)."""
        for table in (self.table, self.again):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                index: DigestIndex | None = None, batches: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The rows go into the index in ``batches`` of falling ids (of about equal
    size), those without an id last: what comes first stays, so of equal texts
    the row with the largest id does.  Without ``index`` a fresh one is made and
    dropped afterwards; a text that a given index holds keeps the row it came with.

    Defined cases: a null text equals the empty text; rows with a null id stay
    only if no other row has their text; rows that repeat an id and a text are
    each returned, all kept if theirs is the largest id; an empty table gives
    an empty result; further columns are ignored whatever their names.
    """
    spark, own = docs.sparkSession, index is None
    index = index or DigestIndex(spark)
    rows = materialize(digested(docs, id_col, text_col), "text-digests")  # each text is digested once
    shares = [F.lit(k / batches) for k in range(batches - 1, 0, -1)]
    cuts = rows.agg(F.percentile_approx("doc_id", F.array(*shares)).alias("c")).first()["c"] or []
    upper = None
    for cut in [*dict.fromkeys(cuts), None]:
        low = F.lit(True) if cut is None else F.col("doc_id") >= cut
        high = F.lit(True) if upper is None else (F.col("doc_id") < upper) | F.col("doc_id").isNull()
        index.add_digests(rows.filter(F.coalesce(low, F.lit(False)) & high))
        upper = cut
    # Written, so that a join of two plain tables may split a digest with very many rows.
    entries = materialize(index.entries(), "entries")
    if own:
        index.drop()
    return rows.join(entries, "digest", "left").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
