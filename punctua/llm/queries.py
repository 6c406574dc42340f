"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from punctua.llm import conversation_trie, entropy_mix, hmm_lm, html_tree, lattice_dedup, packing, phrases, piece_codec, pii, quality_rules, simhash_dedup, site_quality, warc
from punctua.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The byte-level vocabulary: BPE file and rank file.
BYTE_BPE = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))

#: The SentencePiece model.
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

#: Key of the surrogates; a real run passes a secret one.
PII_KEY = "surrogates-1"

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of (spark, folder)."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op9_simhash_near_dedup")
def op9(spark, sf):
    return simhash_dedup.near_duplicates(table(spark, sf, "documents"))


@query("op3_best_fit_packing")
def op3(spark, sf):
    return packing.pack(table(spark, sf, "documents"), *BYTE_BPE)


@query("op7_entropy_balanced_mix")
def op7(spark, sf):
    return entropy_mix.mix(table(spark, sf, "documents"))


@query("op1_quality_rules")
def op1(spark, sf):
    docs = table(spark, sf, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf, "labels")))


@query("op2_pii_surrogates")
def op2(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pii.replace(docs, PII_KEY)


@query("op6_site_quality")
def op6(spark, sf):
    docs = table(spark, sf, "documents")
    return site_quality.classify(docs, site_quality.fit(docs, table(spark, sf, "labels")))


@query("op8_lattice_near_dedup", """
    WITH RECURSIVE v AS MATERIALIZED (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
    links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
    SELECT vec_id, coalesce(n, 0) AS n_links, m AS component_id, vec_id = m AS kept
    FROM embeddings JOIN (SELECT a AS vec_id, min(b) AS m FROM reach GROUP BY a) USING (vec_id)
    LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
""")
def op8(spark, sf):
    return lattice_dedup.near_duplicates(table(spark, sf, "embeddings"))


@query("op5_hmm_scoring")
def op5(spark, sf):
    return hmm_lm.score(table(spark, sf, "documents"))


@query("op4_html_main_text")
def op4(spark, sf):
    pages = table(spark, sf, "pages")
    return html_tree.main_texts(pages, html_tree.fit(pages))


@query("op10_warc_index", """
    WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS x, strlen(coalesce(html, '')) AS payload_bytes,
                      split_part(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*:(//)?', ''), '#', 1) AS u FROM pages),
    h AS (SELECT *, split_part(u, '/', 1) AS site, min(page_id) OVER (PARTITION BY x) AS first FROM p),
    r AS (SELECT page_id, payload_bytes, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to,
                 array_to_string(flatten([[substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(x, 5 * k + 1, 5) AS INTEGER) >> CAST(s AS INTEGER)) & 31) + 1, 1) FOR s IN [15, 10, 5, 0]] FOR k IN range(8)]), '') AS payload_digest,
                 array_to_string(list_reverse(string_split(regexp_replace(regexp_replace(lower(site), '^www[0-9]*[.]', ''), ':(80|443)?$', ''), '.')), ',')
                     || ')/' || substr(u, length(site) + 2) AS url_key,
                 strftime(TIMESTAMP '2020-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured_at FROM h)
    SELECT *, row_number() OVER (ORDER BY url_key, captured_at, page_id) - 1 AS position FROM r
""")
def op10(spark, sf):
    rows = warc.archive(table(spark, sf, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "position")


@query("op13_sentencepiece_round_trip")
def op13(spark, sf):
    return piece_codec.round_trip(table(spark, sf, "documents"), PIECE_BPE)


@query("op12_phrase_collocations")
def op12(spark, sf):
    return phrases.collocations(table(spark, sf, "documents"))


@query("op11_conversation_trie")
def op11(spark, sf):
    return conversation_trie.trie(table(spark, sf, "conversations"))
