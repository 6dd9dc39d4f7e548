"""The registered queries of this subpackage: ``opN_<name>`` applies operator N to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from txrisk.llm import archives, conversations, decontaminate, fill_in_middle, licences, line_templates, ngram_join, packing, quality, secrets, token_files, url_filter, wavelet
from txrisk.llm.common import table

#: Vocabulary of operators 1 and 5, and its end-of-document id.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_OF_TEXT = 49407

#: Vocabulary of operator 13.
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, by separator scan over flat token files: doc_id, n_tokens."""
    return token_files.document_token_counts(table(spark, sf_dir, "documents"), VOCABULARY, END_OF_TEXT)


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families named in every document: doc_id, n_paragraphs, n_licensed, families."""
    docs = table(spark, sf_dir, "documents")
    found = licences.scan(docs, licences.train(docs))
    return found.select("doc_id", "n_paragraphs", F.size("licences").cast("long").alias("n_licensed"),
                        F.array_join(F.array_sort(F.array_distinct(F.col("licences.family"))), ",").alias("families"))


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of recurring templates: doc_id, n_lines, n_dropped, text."""
    return line_templates.dedup(table(spark, sf_dir, "documents")).select("row.doc_id", "n_lines", "n_dropped", "text")


def op4_multi_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by 4-word shingles at Jaccard 0.85."""
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-two-fit packing into 4096-token sequences: one row per piece."""
    return packing.pack(packing.tokenised_pieces(table(spark, sf_dir, "documents"), VOCABULARY))


def op6_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that give away benchmark items, with each item's coverage by greedy string tiling."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_char_cnn_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: pattern matches and what the network adds."""
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, secrets.train(docs)))


def op8_url_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: the longest rule's, else the regression's."""
    pages = table(spark, sf_dir, "pages")
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(pages, url_filter.RULES, model)


def op9_zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC records of all pages, written into ZIP packages and read back by range."""
    packages = archives.write_packages(archives.typed(table(spark, sf_dir, "pages")))
    return archives.read_packages(packages).drop("payload")


def op10_ngram_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and perplexity bands: the verdict on every document."""
    return quality.judge(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op11_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations repaired by the cheapest edits: faults, cost, edits, digest of the repaired turns."""
    given = table(spark, sf_dir, "conversations")
    return conversations.report(given, conversations.damage(conversations.turns_of(given)))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as fill-in-the-middle text: units, form, piece lengths, digests of the output and of the text rebuilt from it."""
    made = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents in wavelet files, read back: doc_id, start, n_tokens, ids_crc32."""
    return wavelet.read_documents(wavelet.write_shards(table(spark, sf_dir, "documents"), BYTE_VOCABULARY))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_licence_scan": op2_licence_scan,
    "op3_line_templates": op3_line_templates,
    "op4_multi_order_join": op4_multi_order_join,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_string_tiling": op6_string_tiling,
    "op7_char_cnn_secrets": op7_char_cnn_secrets,
    "op8_url_regression": op8_url_regression,
    "op9_zip_archives": op9_zip_archives,
    "op10_ngram_perplexity": op10_ngram_perplexity,
    "op11_suffix_automaton": op11_suffix_automaton,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_wavelet_files": op13_wavelet_files,
}

_SHA1_BASE32 = """
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::BIGINT, 1) for i in range(32)], '')
"""

ORACLE: dict[str, str] = {
    "op3_line_templates": """
        WITH split_up AS (
            SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        lines AS (
            SELECT doc_id, i, [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END
                               for t in regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+') if t <> ''] AS tk
            FROM (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM split_up)),
        counted AS (
            SELECT tk, len(tk) AS size, tk[1:3] AS lead, count(DISTINCT doc_id) AS n, min(doc_id) AS first
            FROM lines WHERE len(tk) >= 3 GROUP BY tk),
        hot AS (
            SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY size, lead) AS total FROM counted WHERE size >= 6) WHERE total >= 10),
        places AS (SELECT *, unnest(range(size)) AS place, unnest(tk) AS t FROM hot),
        stays AS (
            SELECT size, lead, place, t FROM places WHERE place >= 3 AND t <> '<*>'
            GROUP BY size, lead, place, t, total HAVING sum(n) >= 10 AND sum(n) >= 0.05 * total),
        shaped AS (
            SELECT p.tk, p.n, p.first, p.size, p.lead, count(*) AS fixed, list((p.place, p.t) ORDER BY p.place) AS shape
            FROM places p LEFT JOIN stays s ON s.size = p.size AND s.lead = p.lead AND s.place = p.place AND s.t = p.t
            WHERE p.t <> '<*>' AND (p.place < 3 OR s.t IS NOT NULL) GROUP BY p.tk, p.n, p.first, p.size, p.lead),
        templates AS (
            SELECT tk, min(first) OVER (PARTITION BY size, lead, shape) AS first, sum(n) OVER (PARTITION BY size, lead, shape) AS docs
            FROM shaped WHERE fixed >= 0.7 * size),
        recurring AS (
            SELECT tk, min(first) AS first
            FROM (SELECT tk, first FROM templates WHERE docs >= 10 UNION ALL SELECT tk, first FROM counted WHERE n >= 10) GROUP BY tk),
        dropped AS (SELECT l.doc_id, list(l.i) AS gone FROM lines l JOIN recurring r ON r.tk = l.tk WHERE l.doc_id <> r.first GROUP BY l.doc_id)
        SELECT s.doc_id, CASE WHEN s.text IS NULL THEN 0 ELSE len(s.ls) END AS n_lines, coalesce(len(d.gone), 0) AS n_dropped,
               CASE WHEN d.gone IS NULL THEN s.text
                    ELSE array_to_string([s.ls[j + 1] for j in range(len(s.ls)) if NOT list_contains(d.gone, j)], chr(10)) END AS text
        FROM split_up s LEFT JOIN dropped d ON d.doc_id = s.doc_id""",
    "op9_zip_archives": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_SHA1_BASE32} AS payload_digest,
               CASE WHEN page_id = min(page_id) OVER (PARTITION BY h) THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> min(page_id) OVER (PARTITION BY h) THEN min(page_id) OVER (PARTITION BY h) END AS refers_to
        FROM p""",
    "op11_suffix_automaton": """
        WITH RECURSIVE lots AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
                list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')]),
                lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                                           lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295::BIGINT) % 20 AS lot
            FROM conversations),
        rows AS (
            SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
                   CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) AS copy
            FROM lots WHERE lot <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i FROM rows),
        faults AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                           WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' END AS fault,
                   role[1:1] AS initial, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM placed),
        own AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faults GROUP BY conv_id),
        cheapest AS (
            SELECT conv_id, n + 1 AS i, 0::BIGINT AS c0, 6::BIGINT AS c1, 3::BIGINT AS c2, 0::BIGINT AS c3, '' AS p0, 'ua' AS p1, 'a' AS p2, '' AS p3 FROM own
            UNION ALL
            SELECT conv_id, i, v0, v1, v2, v3,
                   CASE WHEN v0 = d0 OR v0 <> 3 + v2 THEN q0 WHEN v2 = d2 OR v2 <> 3 + v3 THEN 'u' || q2 ELSE 'ua' || q3 END,
                   CASE WHEN v1 = d1 OR v1 <> 3 + v2 THEN q1 WHEN v2 = d2 OR v2 <> 3 + v3 THEN 'u' || q2 ELSE 'ua' || q3 END,
                   CASE WHEN v2 = d2 OR v2 <> 3 + v3 THEN q2 ELSE 'a' || q3 END, CASE WHEN v3 = d3 OR v3 <> 3 + v2 THEN q3 ELSE 'u' || q2 END
            FROM (
                SELECT *, least(b0, 3 + b2, 6 + b3) AS v0, least(b1, 3 + b2, 6 + b3) AS v1, least(b2, 3 + b3) AS v2, least(b3, 3 + b2) AS v3
                FROM (
                    SELECT *, least(d0, k0, r0) AS b0, least(d1, k1, r1) AS b1, least(d2, k2, r2) AS b2, least(d3, k3, r3) AS b3,
                           CASE WHEN d0 <= least(k0, r0) THEN 'D' || p0 WHEN k0 <= r0 THEN 'K' || CASE initial WHEN 's' THEN p1 ELSE p2 END ELSE 'U' || p2 END AS q0,
                           CASE WHEN d1 <= least(k1, r1) THEN 'D' || p1 WHEN k1 <= r1 THEN 'K' || p2 ELSE 'U' || p2 END AS q1,
                           CASE WHEN d2 <= least(k2, r2) THEN 'D' || p2 WHEN k2 <= r2 THEN 'K' || p3 ELSE 'A' || p3 END AS q2,
                           CASE WHEN d3 <= least(k3, r3) THEN 'D' || p3 WHEN k3 <= r3 THEN 'K' || p2 ELSE 'U' || p2 END AS q3
                    FROM (
                        SELECT f.conv_id, f.i, f.initial, c.p0, c.p1, c.p2, c.p3, 4 + c0 AS d0, 4 + c1 AS d1, 4 + c2 AS d2, 4 + c3 AS d3,
                               e + 3 + c2 AS r0, e + 3 + c2 AS r1, e + 3 + c3 AS r2, e + 3 + c2 AS r3,
                               e + CASE f.initial WHEN 's' THEN c1 WHEN 'u' THEN c2 ELSE 1000000000 END AS k0, e + CASE f.initial WHEN 'u' THEN c2 ELSE 1000000000 END AS k1,
                               e + CASE f.initial WHEN 'a' THEN c3 ELSE 1000000000 END AS k2, e + CASE f.initial WHEN 'u' THEN c2 ELSE 1000000000 END AS k3
                        FROM cheapest c
                        JOIN (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 3 ELSE 0 END AS e FROM faults) f
                          ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.i = c.i - 1)))),
        plans AS (SELECT conv_id, c0 AS cost, p0 AS plan FROM cheapest WHERE i = 1),
        edits AS (SELECT conv_id, plan, unnest(range(length(plan))) AS j FROM plans),
        signs AS (SELECT conv_id, j, plan[j + 1:j + 1] AS sign, length(regexp_replace(plan[1:j], '[ua]', '', 'g')) + 1 AS i FROM edits),
        lines AS (
            SELECT s.conv_id, s.j, CASE lower(s.sign) WHEN 'u' THEN 'user' WHEN 'a' THEN 'assistant' ELSE f.role END || ':'
                                   || CASE WHEN s.sign IN ('u', 'a') THEN '' ELSE f.text END AS line
            FROM signs s LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i WHERE s.sign <> 'D'),
        joined AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY j) AS content FROM lines GROUP BY conv_id)
        SELECT a.conv_id, coalesce(o.gaps, 0) AS gaps, coalesce(o.blank, 0) AS blank, coalesce(o.duplicate, 0) AS duplicate, coalesce(o.truncated, 0) AS truncated,
               coalesce(o.illegal, 0) AS illegal, coalesce(p.cost, 0) AS cost, coalesce(translate(p.plan, 'uaUA', 'IIRR'), '') AS audit,
               sha256(coalesce(j.content, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN own o ON o.conv_id IS NOT DISTINCT FROM a.conv_id
        LEFT JOIN plans p ON p.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN joined j ON j.conv_id IS NOT DISTINCT FROM a.conv_id""",
    "op12_fill_in_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        u AS (
            SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
                   ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
            FROM d),
        c AS (
            SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM u),
        p AS (
            SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix
            FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
        FROM p""",
}
