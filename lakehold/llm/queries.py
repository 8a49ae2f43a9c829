"""The registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakehold.llm import arc_warc, bond_negatives, disclosure, hnsw, language, licences, merkle, mixing, ngram_rtree, piece_bpe, redirects, simple8b, variant_trie
from lakehold.llm._base import table
from lakehold.sources.scratch import new_path

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC files, converted to WARC files, and those read back."""
    path = new_path(spark, "warc")
    arc_warc.write_warc(arc_warc.from_arc(arc_warc.pages_to_arc(table(spark, sf_dir, "pages"))), path)
    read = arc_warc.resolve_revisits(arc_warc.read_warc(spark, path))
    return read.selectExpr("key AS page_id", "payload_bytes", "payload_digest", "warc_type AS record_type", "refers_to")


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest_neighbours(table(spark, sf_dir, "embeddings"), every=100, count=10)


def op3_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    simple8b.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary(BYTE_BPE), end_id=0)
    return simple8b.read_token_files(spark, path)


def op4_language_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op5_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.judge(table(spark, sf_dir, "pages"), RULES)


def op6_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_next(table(spark, sf_dir, "documents"))


def op7_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_licence_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_corpus(table(spark, sf_dir, "documents"))


def op9_piece_prefix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(table(spark, sf_dir, "documents"), vocabulary(PIECE_BPE))


def op10_ngram_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_rtree.link_components(table(spark, sf_dir, "documents"), width=3, num=9, den=10)


def op11_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.report(table(spark, sf_dir, "documents"))


def op12_variant_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_trie.variants(table(spark, sf_dir, "documents"))


def op13_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bond_negatives.mine(table(spark, sf_dir, "embeddings"))


OPERATORS = [op1_arc_to_warc, op2_hnsw, op3_simple8b, op4_language_viterbi, op5_redirect_equivalence,
             op6_merkle_fingerprint, op7_entropy_balancing, op8_licence_classifier, op9_piece_prefix_table,
             op10_ngram_rtree, op11_disclosure, op12_variant_trie, op13_bond_negatives]

ORACLE = {
    "op1_arc_to_warc": """
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
  FROM (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages) p) q""",
    "op13_bond_negatives": """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS parts
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
    CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.parts, b.parts)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.parts) = len(b.parts) WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE own = label QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND n.own <> n.label AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 3""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
