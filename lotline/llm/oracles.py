"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from lotline.llm.common import LOWER, UPPER


def lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def jaccard_components(shingle: int, more: str = "") -> str:
    """Components of documents that share 80 % of their distinct shingles, by recursion."""
    return f"""
        WITH RECURSIVE w AS MATERIALIZED (
          SELECT row_number() OVER () AS r, doc_id,
                 regexp_extract_all({lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS MATERIALIZED (
          SELECT DISTINCT r, array_to_string(w[i:i + {shingle - 1}], ' ') AS s
          FROM w, unnest(generate_series(1, greatest(len(w) - {shingle - 1}, 1))) AS t(i) WHERE len(w) > 0),
        n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
        pairs AS (SELECT x.r AS a, y.r AS b, count(*) AS m FROM s x JOIN s y USING (s) WHERE x.r < y.r GROUP BY 1, 2),
        links AS MATERIALIZED (
          SELECT a, b FROM pairs JOIN n na ON na.r = a JOIN n nb ON nb.r = b
          WHERE 100 * m >= 80 * (na.n + nb.n - m)),
        steps AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(a, b) AS (
          SELECT a, a FROM steps UNION SELECT reach.a, steps.b FROM reach JOIN steps ON reach.b = steps.a),
        low AS (SELECT reach.a AS r, min(w.doc_id) AS component_id FROM reach JOIN w ON w.r = reach.b GROUP BY 1)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id{more}
        FROM w LEFT JOIN n USING (r) LEFT JOIN low USING (r)"""


def codebook_round(at: int) -> str:
    """One round: the nearest entry of each part, then the mean of each entry's parts."""
    near = f"""near{at} AS MATERIALIZED (
          SELECT p.r, p.part, arg_min(e.entry, (d.gap, e.entry)) AS entry, min(d.gap) AS gap
          FROM parts p JOIN book{at} e USING (part),
               LATERAL (SELECT list_sum(list_transform(list_zip(p.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS gap) d
          GROUP BY p.r, p.part)"""
    means = f"""means{at} AS (
          SELECT part, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS x
          FROM (SELECT part, entry, i, sum(x[i])::DOUBLE AS total, count(*) AS n
                FROM near{at} JOIN parts USING (r, part), unnest(generate_series(1, len(x))) AS t(i)
                GROUP BY part, entry, i) GROUP BY part, entry),
        book{at + 1} AS MATERIALIZED (
          SELECT part, entry, coalesce(m.x, b.x) AS x FROM book{at} b LEFT JOIN means{at} m USING (part, entry))"""
    return near if at == 2 else f"{near}, {means}"


SQL = {
    "op9_rtree_jaccard_join": jaccard_components(5),
    "op13_bbit_minhash": jaccard_components(2, ", coalesce(component_id, doc_id) IS NOT DISTINCT FROM doc_id AS kept"),
    "op11_hilbert_codebooks": f"""
        WITH kept AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label,
                 list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        parts AS MATERIALIZED (
          SELECT r, CAST(part AS INTEGER) AS part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS x
          FROM kept, unnest(generate_series(0, 15)) AS t(part)),
        book0 AS MATERIALIZED (SELECT part, r AS entry, x FROM parts WHERE r < 64),
        {codebook_round(0)}, {codebook_round(1)}, {codebook_round(2)},
        coded AS (
          SELECT r, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code,
                 CAST(sum(gap) AS BIGINT) AS error FROM near2 GROUP BY r),
        digest AS (
          SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM kept JOIN coded USING (r), digest""",
    "op12_fill_in_middle": """
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS body, length(body) AS n,
                 sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        draws AS (
          SELECT *, CAST('0x' || h[1:8] AS UBIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS UBIGINT) % (n + 1) AS c2,
                 CAST('0x' || h[17:24] AS UBIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS UBIGINT) % 100 AS h4 FROM d),
        cuts AS (
          SELECT *, CAST(least(c1, c2) AS BIGINT) AS a, CAST(greatest(c1, c2) AS BIGINT) AS b,
                 CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 >= 90
                      THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM draws),
        done AS (
          SELECT *, substr(body, 1, a) AS p, substr(body, a + 1, b - a) AS m, substr(body, b + 1) AS s FROM cuts)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(body) AS restored_sha256 FROM done""",
    "op1_warc_round_trip": """
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS body,
                          max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper FROM pages),
        -- SHA-1 as base32: five bits at a time of its 160.
        d AS (SELECT *, CAST(('0x' || substr(sha1(body), 1, 20)) AS UHUGEINT) AS a,
                     CAST(('0x' || substr(sha1(body), 21, 20)) AS UHUGEINT) AS b FROM p)
        SELECT page_id, url, CAST(strlen(body) AS BIGINT) AS payload_bytes,
               list_reduce(list_transform(generate_series(15, 0, -1), lambda i:
                 substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((a >> CAST(5 * i AS UHUGEINT)) & 31 AS INTEGER) + 1, 1)), lambda x, y: x || y)
               || list_reduce(list_transform(generate_series(15, 0, -1), lambda i:
                 substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((b >> CAST(5 * i AS UHUGEINT)) & 31 AS INTEGER) + 1, 1)), lambda x, y: x || y)
                 AS payload_digest,
               CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> keeper THEN keeper END AS refers_to
        FROM d""",
    "op2_suffix_array_decontamination": f"""
        WITH words_of AS (
          SELECT doc_id, text, regexp_extract_all({lower("coalesce(text, '')")},
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        items AS (
          SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({lower("coalesce(text, '')")},
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
        windows AS MATERIALIZED (
          SELECT DISTINCT item, least(13, len(w)) AS size,
                 array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
          FROM items, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS t(i)
          WHERE len(w) > 0),
        docs AS (SELECT row_number() OVER () AS r, doc_id, w FROM words_of),
        places AS MATERIALIZED (
          SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
          FROM docs, (SELECT DISTINCT size FROM windows), unnest(generate_series(1, len(w) - size + 1)) AS t(i)),
        found AS (SELECT DISTINCT r, i, size, item FROM places JOIN windows USING (size, win)),
        hits AS (SELECT r, count(DISTINCT i + j) AS n_hit
                 FROM found, unnest(generate_series(0, size - 1)) AS t(j) GROUP BY r),
        names AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
                  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN hits USING (r) LEFT JOIN names USING (r)""",
    "op5_radix_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {lower("coalesce(text, '')")} AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size, doc_id = keep_id AS kept,
               sha256(body) AS text_sha256 FROM n""",
}
