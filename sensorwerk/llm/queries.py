"""The registered ``opN_*`` queries with production parameters, and their DuckDB twins."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from sensorwerk.llm import (collocations, decontaminate, exact_dedup, hard_negatives, html_extract, langid, line_dedup, mixing,
                            packing, pivot_search, simhash, substring_dedup, tokens)
from sensorwerk.llm.common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_pivot_search(spark, sf):
    return pivot_search.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_html_extract(spark, sf):
    return html_extract.extract(table(spark, sf, "pages"))


def op3_substring_dedup(spark, sf):
    return substring_dedup.deduplicate(table(spark, sf, "documents")).drop("kept_text")


def op4_token_shards(spark, sf):
    shards = tokens.write_shards(table(spark, sf, "documents"), BYTE_BPE, keeps_space=True, end_id=2)
    return tokens.read_shards(shards)


def op5_simhash(spark, sf):
    return simhash.simhash_dedup(table(spark, sf, "documents")).drop("kept")


def op6_exact_dedup(spark, sf):
    return exact_dedup.exact_dedup(table(spark, sf, "documents"))


def op7_language_id(spark, sf):
    return langid.identify(table(spark, sf, "documents"))


def op8_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), WORD_BPE, keeps_space=False, end_id=0)


def op9_line_dedup(spark, sf):
    return line_dedup.deduplicate(table(spark, sf, "documents"))


def op10_mixing(spark, sf):
    return mixing.mix_sources(table(spark, sf, "documents"))


def op11_hard_negatives(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_decontaminate(spark, sf):
    return decontaminate.report(decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


def op13_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))


QUERIES = {
    "op1_pivot_search": op1_pivot_search,
    "op2_html_extract": op2_html_extract,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_token_shards": op4_token_shards,
    "op5_simhash": op5_simhash,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_language_id": op7_language_id,
    "op8_packing": op8_packing,
    "op9_line_dedup": op9_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_decontaminate": op12_decontaminate,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL = {
    "op1_pivot_search": """
        WITH v AS (
            SELECT row_number() OVER () AS rid, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.rid AS query_rid, a.vec_id AS query_id, b.rid, b.vec_id,
                   CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.rid <> b.rid AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_rid ORDER BY score DESC, vec_id, rid) AS rank FROM s)
        WHERE rank <= 5""",
    "op3_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
        k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM s),
        m AS (SELECT h, min(doc_id) AS lo FROM k GROUP BY h),
        r AS (SELECT k.doc_id, k.i FROM k JOIN m USING (h) WHERE k.doc_id > m.lo),
        gone AS (SELECT DISTINCT doc_id, i + o AS i FROM r, (SELECT unnest(range(0, 50)) AS o)),
        t AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
        kept AS (
            SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) AS text, count(*) AS n
            FROM t ANTI JOIN gone ON t.doc_id = gone.doc_id AND t.i = gone.i GROUP BY t.doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
        FROM d""",
    "op9_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS line_no,
                   unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
        w AS (
            SELECT doc_id, line_no, list_sort(list_distinct(list_filter(
                string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS s FROM l),
        u AS (SELECT s, row_number() OVER () AS id, len(s) AS n, min(struct_pack(d := doc_id, k := line_no)) AS f
              FROM w WHERE len(s) > 0 GROUP BY s),
        t AS (SELECT id, n, unnest(s) AS x FROM u),
        df AS (SELECT x, count(*) AS c FROM t GROUP BY x),
        r AS (SELECT id, n, x, row_number() OVER (PARTITION BY id ORDER BY c, x) AS pos FROM t JOIN df USING (x)),
        p AS (SELECT id, n, x FROM r WHERE pos <= n - ceil(0.8 * n - 1e-9) + 1),
        pairs AS (SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b ON a.x = b.x AND a.id <> b.id
                  WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
        m AS (
            SELECT DISTINCT b.id FROM pairs JOIN u a ON a.id = pairs.a JOIN u b ON b.id = pairs.b
            WHERE a.f < b.f AND 9 * len(list_intersect(a.s, b.s)) >= 4 * (a.n + b.n)),
        v AS (
            SELECT w.doc_id, w.line_no,
                   coalesce(m.id IS NOT NULL OR u.f <> struct_pack(d := w.doc_id, k := w.line_no), false) AS removed
            FROM w LEFT JOIN u ON w.s = u.s LEFT JOIN m ON m.id = u.id)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
               coalesce(string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) FILTER (removed), '') AS removed_lines
        FROM v GROUP BY doc_id""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT row_number() OVER () AS rid, vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.rid AS anchor_rid, a.vec_id AS anchor_id, b.rid, b.vec_id, a.label = b.label AS same,
                   CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.rid <> b.rid AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
        p AS (
            SELECT anchor_rid, anchor_id, vec_id AS positive_id, score AS positive_score,
                   row_number() OVER (PARTITION BY anchor_rid ORDER BY score DESC, vec_id, rid) AS place FROM s WHERE same),
        n AS (
            SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY s.anchor_rid, place ORDER BY s.score DESC, s.vec_id, s.rid) AS rank
            FROM p JOIN s ON p.anchor_rid = s.anchor_rid AND NOT s.same
            WHERE place <= 5 AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 5""",
    "op12_decontaminate": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        p AS (
            SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
            FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
                  FROM b WHERE len(w) > 0)),
        t AS (
            SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
            FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM d CROSS JOIN (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
        m AS (SELECT rid, i, t.n, item FROM t JOIN p ON t.n = p.n AND t.phrase = p.phrase),
        hit AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM m) GROUP BY rid),
        named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)""",
    "op13_collocations": r"""
        WITH pieces AS (
            SELECT row_number() OVER () AS piece, lang, regexp_extract_all(part, '[^\x20\x09]+') AS w
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS part
                  FROM documents)),
        f AS (
            SELECT lang, k, phrase, count(*) AS a
            FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
                  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                        FROM pieces CROSS JOIN (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k))
            GROUP BY lang, k, phrase),
        total AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
        cuts AS (
            SELECT c.lang, c.phrase, c.a, cut, x.a AS l, y.a AS r,
                   (CAST(c.a AS HUGEINT) * c.a * 1000000) // (CAST(x.a AS HUGEINT) * y.a) AS score
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
            JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:c.k], ' ')),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inside AS (
            SELECT lang, phrase, max(a) AS longer
            FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3)
            GROUP BY lang, phrase),
        top AS (
            SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
            FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.phrase = i.phrase
            WHERE longer IS NULL OR 100 * longer < 50 * a)
        SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM top JOIN total USING (lang) WHERE rank <= 2000""",
}
