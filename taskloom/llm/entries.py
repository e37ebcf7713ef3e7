"""The queries over the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bitplane, bpe, collocations, editcount, jaccard, lines, packing, pll, quality, runs, suffix, tiling, warc
from .common import table


def op1_bitplane_tokens(spark, sf_dir):
    return bitplane.bitplane_tokens(spark, table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_masked_likelihood(spark, sf_dir):
    return pll.pseudo_likelihood(spark, table(spark, sf_dir, "documents"))


def op3_string_tiling(spark, sf_dir):
    return tiling.tile_coverage(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark, sf_dir):
    return suffix.remove_repeats(spark, table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(spark, table(spark, sf_dir, "documents"))


def op7_line_dedup(spark, sf_dir):
    out = lines.dedupe_lines(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op8_edit_counts(spark, sf_dir):
    return editcount.count_under_edits(spark, table(spark, sf_dir, "documents"))


def op9_quality_rules(spark, sf_dir):
    out = quality.judge(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_warc_revisits(spark, sf_dir):
    return warc.archive_pages(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op12_collocations(spark, sf_dir):
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark, sf_dir):
    return runs.run_digests(table(spark, sf_dir, "documents"))


_ALL = (
    op1_bitplane_tokens, op2_masked_likelihood, op3_string_tiling, op4_best_fit_packing, op5_suffix_dedup,
    op6_jaccard_join, op7_line_dedup, op8_edit_counts, op9_quality_rules, op10_warc_revisits,
    op11_bpe_round_trip, op12_collocations, op13_periodic_runs,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLE_SQL = {
    "op6_jaccard_join": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0),
        n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1),
        i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n r ON r.doc_id = b WHERE 100 * i.c >= 75 * (p.c + r.c - i.c)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        k(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, k.c FROM k JOIN e ON e.a = k.doc_id)
        SELECT d.doc_id, CAST(coalesce(any_value(n.c), 0) AS BIGINT) AS n_shingles, min(k.c) AS component_id
        FROM documents d JOIN k ON k.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op10_warc_revisits": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM f""",
}
