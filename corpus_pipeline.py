"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and is written as Parquet before the next one reads it.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontam, linediff, minhash, packing, toxicity
from marquee.llm.common import materialize
from marquee.llm.queries import vocabulary
from marquee.sources.tables import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the span tagger scores below one half; each row is judged by its text, whatever its id."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out()))
    return toxicity.reject(docs, model).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line blocks that an earlier document has are cut; documents that were nothing else go."""
    out = linediff.line_dedup(docs, partners="all")
    emptied = (F.col("n_cut") > 0) & (F.trim(F.col("text")) == "")
    return (out.filter(~F.coalesce(emptied, F.lit(False)))
               .withColumn("n_chars", F.when(F.col("n_cut") > 0, F.length("text").cast("long"))
                                       .otherwise(F.col("n_chars")))
               .select(*COLUMNS))


def named_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_name``, a number for each row: its id, or one made of id and text where the id does not tell rows apart.

    Rows that agree in a repeated (or null) id and in the text are one row from here on.
    """
    again = materialize(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
                            .filter("_n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_again")), "repeated-ids")
    if not again.limit(1).count():  # every id tells its row apart
        return docs.withColumn("_name", F.col("doc_id").cast("long"))
    known = docs.join(again, docs["doc_id"].eqNullSafe(again["_again"]), "left_anti")
    others = docs.join(again, docs["doc_id"].eqNullSafe(again["_again"]), "left_semi")
    made = -1 - F.xxhash64("doc_id", "text").bitwiseAND((1 << 62) - 1)
    return (known.withColumn("_name", F.col("doc_id").cast("long"))
                 .unionByName(others.dropDuplicates(["doc_id", "text"]).withColumn("_name", made)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word shingles, similarity 0.8) stays: the first.

    Rows without an id, or with one that other rows have too, are compared by
    their texts like all others; rows that agree in id and text count once.
    """
    rows = named_rows(docs)
    groups = minhash.near_duplicates(rows, width=5, percent=80, id_col="_name")
    # Written, so that its size is known when the join is planned: a short list is broadcast and no text is shuffled.
    gone = materialize(groups.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct(), "near-copies")
    return rows.join(gone, rows["_name"] == gone["_gone"], "left_anti").select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item; rows without an id of their own are judged by their texts too."""
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontam.decontaminate(named_rows(docs), items, id_col="_name").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, with their ids."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), size=4096, end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("packing", pack_sequences),
]

#: Training, alignment and tokenising are beyond SQL; tests hold the stages against planted rows and plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
