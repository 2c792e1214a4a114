"""Registered queries of this folder's operators, and their DuckDB SQL."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import (decontam, digests, licenses, linediff, minhash, oracle, packing, prefixes, runs, shards, suffixes, topk,
               toxicity, urlgraph)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups among all documents: 4-word shingles, Jaccard 0.8."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return minhash.near_duplicates(docs, width=4, percent=80)


#: Rules of the URL query (host, path, verdict).
URL_RULES = [
    urlgraph.Rule("com", "/", "allow"),
    urlgraph.Rule("example.com", "/en/", "block"),
    urlgraph.Rule("www.example.com", "/en/", "allow"),
    urlgraph.Rule("net", "/es/", "block"),
    urlgraph.Rule("net", "/fr/", "block"),
]


def op2_link_graph_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages by rules, else by trust and distrust spread over the links of hosts."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return urlgraph.filter_urls(pages, URL_RULES)


def op3_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards that each match the mixture of sources."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return shards.shard_documents(docs, shards=16, seed=17)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of all documents without 400-byte strings that start elsewhere too."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    out = suffixes.substring_dedup(docs, length=400)
    left = F.octet_length("kept").cast("long")
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - left).alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"),
                      left.alias("kept_bytes"), (F.size("removed") > 0).alias("has_repeats"))


def op5_patience_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and remaining text (as a digest) of all documents after block deletion."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    out = linediff.line_dedup(docs, partners="all")
    return out.select("doc_id", "n_lines", "n_cut", F.octet_length("text").alias("n_bytes"),
                      F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))


def op6_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in all documents, with their place."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return decontam.contaminated(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def vocabulary(name: str) -> str:
    """Path of a public tokenizers file; every machine has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), size=4096, end_id=2, with_ids=False)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents by a fresh persistent digest index."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return digests.exact_dedup(docs)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return licenses.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by the span tagger, learnt outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.train_and_score(docs, labels)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, each on the head of the first of its hundred."""
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return prefixes.conversation_trie(turns, span=100, most=6)


def op12_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best vectors by whole-number inner product for every vector whose id 50 divides."""
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.exact_top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5, scale=256)


def repeated_tails(doc_ids: list, counts: np.ndarray) -> np.ndarray:
    """The word at each place of the documents, where every tenth one's tail repeats its first words (drawn by id)."""
    out = []
    for doc_id, n in zip(doc_ids, counts.tolist()):
        places = np.arange(n)
        draw, tenth = divmod(zlib.crc32(b"%d" % doc_id), 10) if doc_id is not None else (0, 1)
        if tenth == 0 and n:
            a = draw % n
            places[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + draw % 8))
        out.append(places)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, and digests of the texts without repeats."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return runs.run_digests(runs.periodic_runs(docs, shortest=6, exponent=4, rewrite=repeated_tails))


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_link_graph_filter": op2_link_graph_filter,
    "op3_stratified_shards": op3_stratified_shards,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_patience_line_dedup": op5_patience_line_dedup,
    "op6_simhash_decontamination": op6_simhash_decontamination,
    "op7_online_packing": op7_online_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_crf_toxicity": op10_crf_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_pivot_top_k": op12_pivot_top_k,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE = {
    "op1_minhash_near_dedup": oracle.NEAR_DEDUP,
    "op2_link_graph_filter": oracle.url_filter(URL_RULES),
    "op3_stratified_shards": oracle.SHARDS,
    "op4_suffix_dedup": oracle.SUBSTRINGS,
    "op8_exact_dedup": oracle.EXACT_DEDUP,
    "op9_license_scan": oracle.license_scan(licenses.TEMPLATES),
    "op11_prefix_trie": oracle.TRIE,
    "op12_pivot_top_k": oracle.TOP_K,
}
