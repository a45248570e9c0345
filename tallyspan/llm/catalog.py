"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tallyspan.llm import (
    arc_warc, bloom_dedup, chunked_bpe, fenwick_fim, label_shards, line_dedup, mil_quality, partenum, prefix_trie, suffix_refine,
    token_files, toxicity, winnowing,
)
from tallyspan.llm.oracle import ARCHIVE_SQL, HITS_SQL, LINE_SQL, MIDDLE_SQL, NEAR_SQL, REPEATS_SQL, TRIE_SQL
from tallyspan.llm.staging import table


def op1_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_chunked_bpe(spark, sf_dir):
    return chunked_bpe.token_digests(table(spark, sf_dir, "documents"))


def op3_partenum(spark, sf_dir):
    found = partenum.similarity_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op4_arc_warc(spark, sf_dir):
    return arc_warc.round_trip(table(spark, sf_dir, "pages"))


def op5_label_shards(spark, sf_dir):
    return label_shards.shard_documents(table(spark, sf_dir, "documents"))


def op6_bloom_dedup(spark, sf_dir):
    return bloom_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op7_token_files(spark, sf_dir):
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op8_winnowing(spark, sf_dir):
    return winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_mil_quality(spark, sf_dir):
    return mil_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_suffix_refine(spark, sf_dir):
    return suffix_refine.repeat_digests(table(spark, sf_dir, "documents"))


def op11_fenwick_fim(spark, sf_dir):
    return fenwick_fim.fim_digests(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark, sf_dir):
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_chunked_bpe, op3_partenum, op4_arc_warc, op5_label_shards, op6_bloom_dedup,
        op7_token_files, op8_winnowing, op9_mil_quality, op10_suffix_refine,
        op11_fenwick_fim, op12_line_dedup, op13_prefix_trie,
    )
}

ORACLE = {
    "op6_bloom_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op3_partenum": NEAR_SQL,
    "op4_arc_warc": ARCHIVE_SQL,
    "op8_winnowing": HITS_SQL,
    "op10_suffix_refine": REPEATS_SQL,
    "op11_fenwick_fim": MIDDLE_SQL,
    "op12_line_dedup": LINE_SQL,
    "op13_prefix_trie": TRIE_SQL,
}
