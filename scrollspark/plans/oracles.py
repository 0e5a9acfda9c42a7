"""DuckDB SQL with the same results as the queries of the catalog."""

from __future__ import annotations

from scrollspark.functions.stemming import STEP_2, STEP_3, STEP_4, WHOLE_WORDS
from scrollspark.operators.search import STOP_WORDS

#: Flags of a paper from a document's id and its label (null without one); valid in Spark and DuckDB.
PAPER_FLAGS = {
    "has_content": "_label IS NOT NULL",
    "pdf_downloaded": "doc_id % 3 = 0",
    "pdf_download_error": "CASE WHEN doc_id % 7 = 0 THEN 'HTTP 404' END",
    "ocr_processed": "_label IS NOT NULL AND doc_id % 4 = 0",
    "has_ocr": "_label IS NOT NULL AND doc_id % 4 IN (0, 1)",
    "ocr_error": "CASE WHEN toxic = 1 THEN 'bad page' END",
}
_P = (
    "p AS (SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, text, lang || ' ' || source AS categories, "
    + ", ".join(f"{sql} AS {name}" for name, sql in PAPER_FLAGS.items())
    + " FROM documents LEFT JOIN (SELECT doc_id AS _label, toxic FROM labels) ON doc_id = _label)"
)
_WORDS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"
_ARTICLES = "a AS (SELECT o_custkey, CAST(year(min(o_orderdate)) AS INTEGER) AS y, count(*) AS n FROM orders GROUP BY 1)"

#: Items of a block of a list; small, so that the tests' tables have several.
LIST_BLOCK = 256

ORACLE_SQL = {
    "profile_year_histogram": f"WITH {_ARTICLES} SELECT y AS year, count(*) AS articles FROM a GROUP BY 1",
    "profile_last_years": f"WITH {_ARTICLES} SELECT y AS year, count(*) AS articles FROM a GROUP BY 1 ORDER BY 1 DESC LIMIT 3",
    "profile_version_histogram": f"""
        WITH {_ARTICLES}, h AS (SELECT n AS n_versions, count(*) AS articles FROM a GROUP BY 1), t AS (SELECT count(*) AS total FROM a)
        SELECT n_versions, articles, articles > total * 0.001 AS kept, round(articles / total * 100.0, 4) AS pct FROM h, t""",
    "profile_summary": f"""
        WITH {_ARTICLES}, t AS (SELECT count(*) AS total, min(y) AS min_year, max(y) AS max_year FROM a),
        pk AS (SELECT y AS peak_year FROM a GROUP BY y ORDER BY count(*) DESC, y LIMIT 1), h AS (SELECT n, count(*) AS c FROM a GROUP BY 1), k AS (SELECT h.* FROM h, t WHERE c > total * 0.001)
        SELECT total, min_year, max_year, peak_year, (SELECT max(n) FROM k) AS max_versions, CAST((SELECT sum(c) FROM k WHERE n > 1) AS BIGINT) AS multi_version FROM t, pk""",
    "ingest_parse_errors": "SELECT count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) FILTER (WHERE event_type <> 'error') AS parsed FROM events",
    "date_parse": "SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS update_date FROM orders",
    "status_counts": f"""
        WITH {_P} SELECT count(*) AS total, count(*) FILTER (WHERE has_content) AS with_pdfs, count(*) FILTER (WHERE NOT has_content) AS need_pdfs,
        count(*) FILTER (WHERE pdf_download_error IS NOT NULL) AS failed, count(*) FILTER (WHERE ocr_processed) AS ocr_done, count(*) FILTER (WHERE has_ocr) AS with_ocr,
        count(*) FILTER (WHERE ocr_error IS NOT NULL) AS ocr_failed FROM p""",
    "flag_reconcile": f"WITH {_P} SELECT count(*) FILTER (WHERE has_content AND NOT pdf_downloaded) AS need_true, count(*) FILTER (WHERE NOT has_content AND pdf_downloaded) AS need_false FROM p",
    "flag_reconciled": f"WITH {_P} SELECT id, has_content AS pdf_downloaded FROM p",
    "papers_needing_pdf": f"WITH {_P} SELECT id FROM p WHERE NOT has_content",
    "download_candidates": f"WITH {_P} SELECT id FROM p WHERE NOT pdf_downloaded AND pdf_download_error IS NULL AND (categories ILIKE '%EN src1%' OR categories ILIKE '%fr%')",
    "ocr_fetch": f"WITH {_P} SELECT id FROM p WHERE has_content AND NOT ocr_processed AND ocr_error IS NULL ORDER BY id LIMIT 20 OFFSET 5",
    "keyset_page": f"WITH {_P} SELECT id, pdf_downloaded FROM p WHERE id > '150' ORDER BY id LIMIT 30",
    "list_available": f"WITH {_P} SELECT id, substr(text, 1, 60) AS title, ocr_processed FROM p WHERE has_ocr ORDER BY id LIMIT 20",
    "category_vocabulary": "SELECT DISTINCT c AS category FROM (SELECT unnest(string_split(p_name, ' ')) AS c FROM part) WHERE c <> ''",
    "paper_category_links": "SELECT DISTINCT p_partkey AS paper_id, c AS category FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS c FROM part) WHERE c <> ''",
    "category_counts": f"WITH {_P} SELECT category, count(*) AS papers FROM (SELECT DISTINCT id, unnest(string_split(categories, ' ')) AS category FROM p) GROUP BY 1",
    "replace_links": """
        WITH old AS (SELECT DISTINCT p_partkey AS paper_id, unnest(string_split(p_name, ' ')) AS category FROM part),
        new AS (SELECT p_partkey AS paper_id, p_brand AS category FROM part WHERE p_partkey % 5 = 0)
        SELECT * FROM old WHERE paper_id NOT IN (SELECT paper_id FROM new) UNION ALL SELECT * FROM new""",
    "ingest_new_records": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "upsert_merge": """
        WITH src AS (SELECT c_custkey + 10 AS id, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS title FROM customer WHERE c_custkey % 2 = 0)
        SELECT coalesce(t.c_custkey, s.id) AS id, CASE WHEN s.id IS NOT NULL THEN s.title ELSE t.c_mktsegment END AS title, round(t.c_acctbal, 2) AS preserved
        FROM customer t FULL OUTER JOIN src s ON t.c_custkey = s.id""",
    "file_load_match": "SELECT page_id AS file_id, d.doc_id IS NOT NULL AS matched, octet_length(encode(html)) AS bytes FROM pages LEFT JOIN documents d ON d.doc_id = page_id * 5",
    "fs_sync": f"""
        WITH {_P}, f AS (SELECT CAST(page_id AS VARCHAR) AS id FROM pages)
        SELECT p.id, f.id IS NOT NULL AS pdf_downloaded, (f.id IS NOT NULL) <> p.pdf_downloaded AS changed FROM p LEFT JOIN f ON p.id = f.id""",
    "run_summary": """
        SELECT count(*) FILTER (WHERE html LIKE '<!DOCTYPE%') AS success, count(*) FILTER (WHERE html NOT LIKE '<!DOCTYPE%') AS errors,
        CAST(sum(octet_length(encode(html))) AS BIGINT) AS total_bytes FROM pages""",
    "download_outcomes": f"""
        WITH {_P} SELECT id, CASE WHEN quality = 1 THEN true ELSE pdf_downloaded END AS pdf_downloaded,
        CASE WHEN quality IS NULL THEN pdf_download_error WHEN quality = 0 THEN 'HTTP 500' END AS pdf_download_error, quality IS NOT NULL AS attempted
        FROM p LEFT JOIN labels USING (doc_id)""",
    "payload_check": """
        SELECT page_id, CASE WHEN octet_length(encode(html)) > 8000 THEN 'too large' WHEN substr(html, 1, 9) <> '<!DOCTYPE' THEN 'bad signature' ELSE 'ok' END AS outcome FROM pages""",
    "id_normalize": r"""
        WITH s AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN '../' || page_id WHEN 1 THEN 'cs.AI/' || page_id WHEN 2 THEN ' ' || page_id || '.0001 '
                   WHEN 3 THEN 'a/b/' || page_id WHEN 4 THEN 'x\' || page_id ELSE '~' || page_id END AS raw FROM pages),
        n AS (SELECT page_id, replace(trim(raw), '\', '/') AS v FROM s)
        SELECT page_id, CASE WHEN regexp_full_match(v, '[A-Za-z0-9._-]+(/[A-Za-z0-9._-]+)?') AND NOT list_contains(string_split(v, '/'), '.')
               AND NOT list_contains(string_split(v, '/'), '..') THEN replace(v, '/', '__') || '.pdf' END AS file_name FROM n""",
    "box_labels": """
        SELECT conv_id, turn, CASE role WHEN 'user' THEN '#ff9800' WHEN 'assistant' THEN '#00bcd4' ELSE '#808080' END AS colour, (turn + 1) || '. ' || role AS caption FROM conversations""",
    "ocr_page_plan": """
        WITH t AS (SELECT conv_id, least(max(turn) + 3, 8) AS target FROM conversations GROUP BY 1),
        need AS (SELECT conv_id, page FROM t, range(0, 8) r(page) WHERE page < target EXCEPT SELECT conv_id, turn FROM conversations WHERE turn % 2 = 0),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY page) - 1 AS pos FROM need) SELECT conv_id, page, pos // 2 AS batch FROM o WHERE pos < 4""",
    "ocr_build_results": "SELECT conv_id, string_agg(role, '|' ORDER BY turn) AS results, count(*) AS processed_pages FROM conversations GROUP BY 1",
    "ocr_finalize_status": """
        WITH s AS (SELECT conv_id, count(*) AS processed, count(*) FILTER (WHERE role = 'system') AS errs, count(*) > 6 AS is_partial FROM conversations GROUP BY 1)
        SELECT conv_id, CASE WHEN errs > 0 THEN 'failed' WHEN processed >= 4 AND NOT is_partial THEN 'complete' ELSE 'partial' END AS status FROM s""",
    "ocr_text_extract": "SELECT conv_id, coalesce(string_agg(trim(text), chr(10) ORDER BY length(role), turn) FILTER (WHERE text <> ''), '') AS text FROM conversations GROUP BY 1",
    "ocr_text_counts": f"SELECT doc_id, CAST(len({_WORDS}) AS INTEGER) AS words, CAST(length(text) AS INTEGER) AS chars FROM documents",
    "ocr_mock_run": "SELECT conv_id, CAST(turn AS INTEGER) AS page, 'Mock Content ' || turn AS content, CAST(NULL AS VARCHAR) AS error FROM conversations",
    "ppl_windows": f"""
        WITH n AS (SELECT doc_id, len({_WORDS}) AS n FROM documents),
        w AS (SELECT doc_id, n, k AS chunk, k * 64 AS b, least(k * 64 + 128, n) AS e FROM n, range(0, (SELECT max(n) // 64 + 2 FROM n)) r(k) WHERE n > 1 AND (k = 0 OR (k - 1) * 64 + 128 < n))
        SELECT doc_id, chunk, b AS begin_loc, e AS end_loc, CASE WHEN n <= 128 THEN n WHEN chunk = 0 THEN e - b - 1 WHEN 64 < e - b THEN e - b - 64 ELSE e - b END AS scored FROM w""",
    "ppl_chunk_scores": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents), tok AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
        f AS (SELECT w, count(*) AS c FROM tok GROUP BY 1), g AS (SELECT sum(c) AS n, count(*) AS v FROM f)
        SELECT doc_id, CASE WHEN i < 128 THEN 0 ELSE (i - 128) // 64 + 1 END AS chunk, round(avg(-ln((c + 1.0) / (n + v))), 4) AS nll, count(*) AS scored
        FROM tok JOIN f USING (w), g WHERE i > 0 GROUP BY 1, 2""",
    "ppl_stats": """
        WITH c AS (SELECT o_custkey AS doc_id, 1.0 + o_totalprice / 100000.0 AS ppl, 1 + o_orderkey % 7 AS n FROM orders)
        SELECT doc_id, round(exp(sum(ln(ppl) * n) / sum(n)), 4) AS mean_ppl, round(quantile_cont(ppl, 0.5), 4) AS median_ppl, round(quantile_cont(ppl, 0.9), 4) AS p90,
        round(quantile_cont(ppl, 0.95), 4) AS p95, round(quantile_cont(ppl, 0.99), 4) AS p99, round(max(ppl), 4) AS max_ppl, round(min(ppl), 4) AS min_ppl,
        round(sqrt(avg(ppl * ppl)), 4) AS penalized_ppl, count(*) AS num_chunks, CAST(sum(n) AS BIGINT) AS total_tokens FROM c GROUP BY 1""",
    "ppl_worst_chunks": """
        SELECT o_custkey AS doc_id, o_orderkey AS chunk, CAST(rk AS INTEGER) AS rk
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rk FROM orders) WHERE rk <= 5""",
    "ppl_band": """
        SELECT doc_id, CASE WHEN n_chars < 10 THEN 'Very low' WHEN n_chars < 50 THEN 'Low' WHEN n_chars < 100 THEN 'Moderate' WHEN n_chars < 500 THEN 'High' ELSE 'Very high' END AS band FROM documents""",
    "stream_ingest": "SELECT CAST(doc_id AS VARCHAR) AS id, lang AS title FROM documents",
}

_LINES = """
    l AS (SELECT doc_id AS o, CASE WHEN doc_id % 7 <> 0 THEN 'cs/' || CASE WHEN doc_id % 3 = 1 THEN doc_id - 1 ELSE doc_id END END AS id, lang || '-' || doc_id AS title, lang, source
          FROM documents WHERE doc_id % 11 <> 0),
    old AS (SELECT 'cs/' || doc_id AS id FROM documents WHERE doc_id % 10 = 0),
    one AS (SELECT l.* FROM l JOIN (SELECT id, {pick}(o) AS o FROM l WHERE id IS NOT NULL GROUP BY 1) f ON l.id = f.id AND l.o = f.o)"""
_FIRST, _LAST = _LINES.format(pick="min"), _LINES.format(pick="max")
_S_STEM = r"CASE WHEN regexp_matches(t, '[^ea]ies$') THEN regexp_replace(t, 'ies$', 'y') WHEN regexp_matches(t, '[^aeo]es$') THEN regexp_replace(t, 's$', '') WHEN regexp_matches(t, '[^us]s$') THEN regexp_replace(t, 's$', '') ELSE t END"
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
_TERMS = rf"""
    raw AS (SELECT doc_id, unnest(regexp_split_to_array(lower(concat_ws(' ', source, text)), '[^\p{{L}}\p{{N}}]+')) AS t FROM documents),
    terms AS (SELECT doc_id, {_S_STEM} AS term FROM raw WHERE t <> '' AND t NOT IN ({_STOPS}))"""
_CHUNKS = "c AS (SELECT o_custkey AS doc_id, o_orderkey AS chunk, 1.0 + o_totalprice / 100000.0 AS ppl, 1 + o_orderkey % 7 AS n FROM orders)"

#: The English stemmer, step by step with regular expressions: an ending is the longest that fits, which is the leftmost match of one alternative.
_SHORT = r"(regexp_matches({x}, '[^aeiouy][aeiouy][^aeiouywxY]$') OR regexp_matches({x}, '^[aeiouy][^aeiouy]$'))"
_STEP_2 = "CASE e WHEN 'li' THEN '' " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in STEP_2.items() if a != "li") + " END"
_STEP_3 = "CASE e " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in STEP_3.items()) + " END"
_CUT = "substr(w, 1, length(w) - length(e))"
_STEMS = rf"""
    y0 AS (SELECT t, regexp_replace(regexp_replace(t, '^y', 'Y'), '([aeiouy])y', '\1Y', 'g') AS w FROM vocabulary),
    y1 AS (SELECT t, w, CASE WHEN regexp_matches(w, '^(gener|commun|arsen)') THEN length(regexp_extract(w, '^(gener|commun|arsen)'))
                             WHEN regexp_matches(w, '[aeiouy][^aeiouy]') THEN length(regexp_extract(w, '^.*?[aeiouy][^aeiouy]')) ELSE length(w) END AS r1 FROM y0),
    y2 AS (SELECT t, w, r1, CASE WHEN regexp_matches(substr(w, r1 + 1), '[aeiouy][^aeiouy]') THEN r1 + length(regexp_extract(substr(w, r1 + 1), '^.*?[aeiouy][^aeiouy]')) ELSE length(w) END AS r2 FROM y1),
    s1 AS (SELECT t, r1, r2, CASE WHEN w LIKE '%sses' THEN substr(w, 1, length(w) - 2)
                                  WHEN regexp_matches(w, '(ied|ies)$') THEN substr(w, 1, length(w) - CASE WHEN length(w) > 4 THEN 2 ELSE 1 END)
                                  WHEN regexp_matches(w, '(us|ss)$') THEN w WHEN regexp_matches(w, '[aeiouy].+s$') THEN substr(w, 1, length(w) - 1) ELSE w END AS w FROM y2),
    s2 AS (SELECT *, regexp_extract(w, '(eedly|ingly|edly|eed|ing|ed)$') AS e, w IN ('inning', 'outing', 'canning', 'herring', 'earring', 'proceed', 'exceed', 'succeed') AS whole FROM s1),
    s3 AS (SELECT *, {_CUT} AS x FROM s2),
    s4 AS (SELECT t, r1, r2, whole, w AS a, CASE WHEN e IN ('eed', 'eedly') THEN CASE WHEN length(x) >= r1 THEN x || 'ee' ELSE w END
                                         WHEN e = '' OR NOT regexp_matches(x, '[aeiouy]') THEN w
                                         WHEN regexp_matches(x, '(at|bl|iz)$') THEN x || 'e'
                                         WHEN regexp_matches(x, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN substr(x, 1, length(x) - 1)
                                         WHEN r1 >= length(x) AND {_SHORT.format(x="x")} THEN x || 'e' ELSE x END AS w FROM s3),
    s5 AS (SELECT t, r1, r2, whole, a, regexp_replace(w, '^(.+[^aeiouy])[yY]$', '\1i') AS w FROM s4),
    s6 AS (SELECT *, regexp_extract(w, '({"|".join(STEP_2)})$') AS e FROM s5),
    s7 AS (SELECT t, r1, r2, whole, a, CASE WHEN e = '' OR length(w) - length(e) < r1 OR (e = 'ogi' AND w NOT LIKE '%logi') OR (e = 'li' AND NOT regexp_matches(w, '[cdeghkmnrt]li$')) THEN w
                                     ELSE {_CUT} || {_STEP_2} END AS w FROM s6),
    s8 AS (SELECT *, regexp_extract(w, '({"|".join(STEP_3)})$') AS e FROM s7),
    s9 AS (SELECT t, r1, r2, whole, a, CASE WHEN e = '' OR length(w) - length(e) < CASE WHEN e = 'ative' THEN greatest(r1, r2) ELSE r1 END THEN w ELSE {_CUT} || {_STEP_3} END AS w FROM s8),
    s10 AS (SELECT *, regexp_extract(w, '({"|".join(STEP_4)})$') AS e FROM s9),
    s11 AS (SELECT t, r1, r2, whole, a, CASE WHEN e = '' OR length(w) - length(e) < r2 OR (e = 'ion' AND NOT regexp_matches(w, '[st]ion$')) THEN w ELSE {_CUT} END AS w FROM s10),
    s12 AS (SELECT *, substr(w, 1, length(w) - 1) AS x FROM s11),
    s13 AS (SELECT t, whole, a, CASE WHEN w LIKE '%e' AND (length(x) >= r2 OR (length(x) >= r1 AND NOT {_SHORT.format(x="x")})) THEN x WHEN w LIKE '%ll' AND length(x) >= r2 THEN x ELSE w END AS w FROM s12),
    stems AS (SELECT t, CASE WHEN length(t) <= 2 THEN t {" ".join(f"WHEN t = '{a}' THEN '{b}'" for a, b in WHOLE_WORDS.items())} WHEN whole THEN a ELSE replace(w, 'Y', 'y') END AS stem FROM s13)"""
_RAW = r"SELECT doc_id, unnest(regexp_split_to_array(lower(concat_ws(' ', source, text)), '[^\p{L}\p{N}]+')) AS t FROM"
_REVISED = "SELECT doc_id, source, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN {new} ELSE text END AS text FROM documents"

ORACLE_SQL |= {
    "fts_index": f"WITH {_TERMS} SELECT term, doc_id, count(*) AS tf FROM terms GROUP BY 1, 2",
    "fts_search": f"WITH {_TERMS} SELECT doc_id FROM terms WHERE term IN ('und', 'der') GROUP BY 1 HAVING count(DISTINCT term) = 2",
    "ppl_percentiles": "SELECT l_returnflag, "
    + ", ".join(f"round(CAST(quantile_cont(l_extendedprice, {q}) AS DOUBLE), 4) AS {name}" for name, q in (("median_ppl", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99)))
    + " FROM lineitem GROUP BY 1",
    "ppl_chunk_list_blocks": f"""
        WITH r AS (SELECT l_returnflag, l_orderkey * 10 + l_linenumber AS line, l_extendedprice AS x, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey * 10 + l_linenumber, l_extendedprice) - 1 AS k,
            count(*) OVER (PARTITION BY l_returnflag) AS total FROM lineitem)
        SELECT l_returnflag, k // {LIST_BLOCK} AS block, CAST(ceil(total / {LIST_BLOCK}) AS BIGINT) AS blocks, total, md5(string_agg(line || ':' || CAST(round(x * 100) AS BIGINT), ' ' ORDER BY k)) AS digest
        FROM r GROUP BY 1, 2, 3, 4""",
    "ocr_result_blocks": f"""
        WITH r AS (SELECT role, text, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS k, count(*) OVER (PARTITION BY role) AS total FROM conversations)
        SELECT role, k // {LIST_BLOCK} AS block, CAST(ceil(total / {LIST_BLOCK}) AS BIGINT) AS blocks, total AS processed_pages, md5(string_agg(coalesce(text, '-'), '|' ORDER BY k)) AS digest
        FROM r GROUP BY 1, 2, 3, 4""",
    "fts_stems": rf"""
        WITH vocabulary AS (SELECT DISTINCT t FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+')) AS t FROM documents) WHERE t <> ''), {_STEMS}
        SELECT t AS term, stem FROM stems""",
    "fts_kept_index": f"""
        WITH docs AS ({_REVISED.format(new="'Revised editions: ' || lang")}), raw AS ({_RAW} docs), words AS (SELECT * FROM raw WHERE t <> '' AND t NOT IN ({_STOPS})),
        vocabulary AS (SELECT DISTINCT t FROM words), {_STEMS}
        SELECT stem AS term, doc_id, count(*) AS tf FROM words JOIN stems USING (t) GROUP BY 1, 2""",
    "fts_kept_search": f"""
        WITH docs AS ({_REVISED.format(new="'und der ' || lang")}), raw AS ({_RAW} docs)
        SELECT doc_id FROM raw WHERE t IN ('und', 'der') GROUP BY 1 HAVING count(DISTINCT t) = 2""",
    "ranged_merge": """
        WITH l AS (SELECT l_orderkey, max(l_quantity) AS most, max(l_returnflag) AS flag FROM lineitem GROUP BY 1)
        SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN flag = 'R' THEN 'returned' END AS note FROM orders LEFT JOIN l ON o_orderkey = l_orderkey
        UNION ALL SELECT -l_orderkey, 'N', 'large' FROM l WHERE most >= 50
        UNION ALL SELECT l_orderkey, 'N', 'returned' FROM l WHERE flag = 'R' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
    "ranged_lookup": "WITH a AS (SELECT o_custkey, min(o_orderkey) AS id FROM orders GROUP BY 1) SELECT a.id, a.o_custkey, o_totalprice FROM a JOIN orders ON o_orderkey = a.id",
    "ranged_page": "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderkey > 500 AND o_orderstatus = 'O' ORDER BY 1 LIMIT 50",
    "first_new_of_files": "SELECT CAST(doc_id AS VARCHAR) AS id, lang AS title FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 25",
    "ingest_load": f"""
        WITH {_FIRST} SELECT id, title, lang || '  ' || source || '  ' || lang AS categories, false AS pdf_downloaded, true AS created FROM one WHERE id NOT IN (SELECT id FROM old)
        UNION ALL SELECT id, 'old', NULL, true, false FROM old""",
    "ingest_refresh": f"""
        WITH {_LAST} SELECT coalesce(old.id, one.id) AS id, coalesce(one.title, 'old') AS title, old.id IS NOT NULL AS pdf_downloaded, one.id IS NOT NULL AS updated
        FROM one FULL JOIN old ON one.id = old.id""",
    "ingest_links": f"""
        WITH {_LAST} SELECT id AS paper_id, lang AS category FROM one UNION SELECT id, source FROM one UNION SELECT id, 'old' FROM old WHERE id NOT IN (SELECT id FROM one)""",
    "ingest_categories": f"""
        WITH {_FIRST}, new AS (SELECT * FROM one WHERE id NOT IN (SELECT id FROM old)) SELECT lang AS category, true AS created FROM new UNION SELECT source, true FROM new UNION SELECT 'old', false""",
    "ingest_limited": f"""
        WITH {_FIRST}, p AS (SELECT * FROM one WHERE o < 600), new AS (SELECT * FROM p WHERE id NOT IN (SELECT id FROM old) ORDER BY o LIMIT 40)
        SELECT id, 'new' AS kind FROM new UNION ALL SELECT id, 'known' FROM p WHERE id IN (SELECT id FROM old) AND o < (SELECT max(o) FROM new)""",
    "first_new": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 25",
    "known_records": "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "numbered_lines": "SELECT * FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ordinal, CAST(doc_id AS VARCHAR) AS id FROM documents) WHERE ordinal < 700",
    "ingest_stream": """
        SELECT CAST(doc_id AS VARCHAR) AS id, lang || '-' || CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 2 END AS title, source AS category FROM documents""",
    "record_fields": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE '' END AS title, o_orderstatus AS journal_ref,
        CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS report_no, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_authors, CAST(0 AS INTEGER) AS n_versions,
        CAST(o_orderdate AS DATE) AS update_date FROM orders""",
    "snapshot_publish": "SELECT doc_id, upper(lang) AS lang, 'a' AS part FROM documents UNION ALL SELECT doc_id, lang, 'b' FROM documents",
    "migrated_papers": """
        SELECT CAST(doc_id AS VARCHAR) AS id, lang AS title, doc_id % 10 = 0 AS pdf_downloaded, true AS no_error, CAST(20 AS INTEGER) AS n_columns, CAST(25 AS INTEGER) AS n_head FROM documents""",
    "schema_violations": """
        WITH p AS (SELECT CASE WHEN p_partkey % 50 <> 0 THEN repeat('p' || (p_partkey % 700), CASE WHEN p_partkey % 90 = 7 THEN 20 ELSE 1 END) END AS id FROM part),
        c AS (SELECT CASE WHEN p_partkey % 400 <> 0 THEN p_brand END AS category FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 400 = 0),
        k AS (SELECT 'p' || (p_partkey % 800) AS paper_id, CASE WHEN p_size < 45 THEN p_brand ELSE 'none' END AS category FROM part)
        SELECT 'papers: id is null' AS "constraint", count(*) AS "rows" FROM p WHERE id IS NULL
        UNION ALL SELECT 'papers: id is too long', count(*) FROM p WHERE length(id) > 50
        UNION ALL SELECT 'papers: id is not unique', count(*) FROM (SELECT id FROM p GROUP BY id HAVING count(*) > 1)
        UNION ALL SELECT 'categories: category is null', count(*) FROM c WHERE category IS NULL
        UNION ALL SELECT 'categories: category is not unique', count(*) FROM (SELECT category FROM c GROUP BY category HAVING count(*) > 1)
        UNION ALL SELECT 'links: pair is not unique', count(*) FROM (SELECT paper_id FROM k GROUP BY paper_id, category HAVING count(*) > 1)
        UNION ALL SELECT 'links: paper is missing', count(*) FROM k WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.id = k.paper_id)
        UNION ALL SELECT 'links: category is missing', count(*) FROM k WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.category = k.category)""",
    "upsert_legacy": """
        WITH s AS (SELECT doc_id + 100 AS id, source AS title, '/new/' || doc_id AS pdf_path FROM documents WHERE doc_id % 3 = 0)
        SELECT coalesce(d.doc_id, s.id) AS id, CASE WHEN s.id IS NULL THEN d.lang ELSE s.title END AS title, coalesce(s.pdf_path, '/old') AS pdf_path,
        CASE WHEN d.doc_id IS NULL THEN false ELSE d.doc_id % 2 = 0 END AS pdf_downloaded, s.id IS NOT NULL AS updated FROM documents d FULL JOIN s ON d.doc_id = s.id""",
    "categories_added": """
        WITH k AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS category FROM part WHERE p_partkey % 40 = 0),
        w AS (SELECT DISTINCT unnest(string_split(p_name || ' ' || p_type, ' ')) AS category FROM part)
        SELECT category, CASE WHEN category IN (SELECT category FROM k) THEN 'known' END AS label FROM (SELECT * FROM w UNION SELECT * FROM k) WHERE category <> ''""",
    "paper_cascade": """
        WITH k AS (SELECT DISTINCT p_partkey AS id, CASE c WHEN 'small' THEN 'ring' WHEN 'ring' THEN 'band' ELSE c END AS category FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS c FROM part) WHERE c <> '')
        SELECT p_partkey AS id, category FROM part LEFT JOIN k ON p_partkey = k.id WHERE p_size <= 20""",
    "outcomes_legacy": f"""
        WITH {_P} SELECT id, CASE WHEN quality IS NULL THEN pdf_downloaded ELSE quality <> 0 END AS pdf_downloaded,
        CASE WHEN quality IS NULL THEN pdf_download_error WHEN quality = 0 THEN 'HTTP 500' END AS pdf_download_error FROM p LEFT JOIN labels USING (doc_id)""",
    "files_from_folder": """
        SELECT 'p/' || (page_id * 5) AS id, octet_length(encode('%PDF-' || html)) AS length, sha256('%PDF-' || html) AS sha256, page_id * 5 IN (SELECT doc_id FROM documents) AS matched FROM pages""",
    "files_loaded": f"""
        WITH {_P}, f AS (SELECT page_id * 3 AS doc_id, html FROM pages)
        SELECT id, CAST(octet_length(encode('%PDF-' || html)) AS INTEGER) AS bytes, f.html IS NOT NULL OR pdf_downloaded AS pdf_downloaded, pdf_download_error FROM p LEFT JOIN f USING (doc_id)
        UNION ALL SELECT CAST(doc_id AS VARCHAR), CAST(-1 AS INTEGER), NULL, 'no paper' FROM f WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
    "paths_and_urls": """
        SELECT page_id, '/data/cs__' || page_id || '.pdf' AS path, 'https://x.org/pdf/cs/' || page_id || '.pdf' AS url, 'cs/' || page_id AS id, page_id % 4 <> 1 AS type_ok FROM pages""",
    "downloads": """
        SELECT CAST(page_id AS VARCHAR) AS id, CASE WHEN page_id % 5 <> 0 AND page_id % 7 <> 0 AND page_id % 11 <> 0 AND page_id % 13 <= 11 THEN CAST(5 + page_id % 13 AS INTEGER) END AS bytes,
        CASE WHEN page_id % 5 = 0 THEN 'HTTP 404' WHEN page_id % 7 = 0 THEN 'unexpected content type text/html' WHEN page_id % 13 > 11 THEN 'too large' WHEN page_id % 11 = 0 THEN 'bad signature' END AS error FROM pages""",
    "pages_rendered": """
        WITH b AS (SELECT page_id, hex(encode(html)) AS h, octet_length(encode(html)) AS n FROM pages)
        SELECT CAST(page_id AS VARCHAR) AS id, CAST(k AS INTEGER) AS page, md5(unhex(substr(h, CAST(8000 * k + 1 AS BIGINT), 8000))) AS image_md5 FROM b, range(0, (SELECT max(n) // 4000 + 1 FROM b)) r(k) WHERE 4000 * k < n""",
    "ocr_save": f"""
        WITH {_P}, q AS (SELECT p.*, l.doc_id IS NOT NULL AS has, quality, toxic, coalesce(quality = 1 AND toxic = 0, false) AS done FROM p LEFT JOIN labels l USING (doc_id))
        SELECT id, CASE WHEN has AND quality = 1 THEN 'new' WHEN doc_id % 2 = 0 THEN 'old' END AS ocr_results, done OR doc_id % 5 = 0 AS ocr_processed, done AS timed,
        CASE WHEN done THEN NULL WHEN toxic = 1 THEN 'bad page' WHEN doc_id % 3 = 0 THEN 'old error' END AS ocr_error FROM q""",
    "ocr_last_results": "SELECT conv_id, turn % 3 AS page_index, max(turn) AS position, arg_max(role, turn) AS role FROM conversations GROUP BY 1, 2",
    "ocr_page_log": """
        SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS page, 'Mock Content ' || (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) AS content
        FROM conversations WHERE conv_id IS NOT NULL""",
    "ocr_errors": """
        SELECT conv_id, string_agg(role || ' ' || turn, '; ' ORDER BY turn) AS error FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations) WHERE k <= 3 GROUP BY 1""",
    "ocr_dpi": "SELECT DISTINCT conv_id, CAST(200 AS INTEGER) AS dpi, CAST(72 AS INTEGER) AS wanted FROM conversations",
    "ocr_boxes": """
        SELECT conv_id, CAST(0 AS INTEGER) AS page_index, '#808080' AS colour, row_number() OVER (PARTITION BY conv_id ORDER BY turn) || '. ' || role || ' (0.50)' AS caption,
        CAST(length(role) AS DOUBLE) AS top FROM conversations""",
    "json_scrub": """
        SELECT conv_id, turn, CAST(CASE WHEN text IS NULL THEN json_object('layout', json_object('page_index', turn), 'role', role)
        ELSE json_object('content', text, 'layout', json_object('page_index', turn), 'role', role) END AS VARCHAR) AS document FROM conversations""",
    "ppl_model_scores": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents), n AS (SELECT doc_id, ws, len(ws) AS n FROM d),
        w AS (SELECT doc_id, ws, n, k AS chunk, k * 64 AS b, least(k * 64 + 128, n) AS e FROM n, range(0, (SELECT max(n) // 64 + 2 FROM n)) r(k) WHERE n > 1 AND (k = 0 OR (k - 1) * 64 + 128 < n)),
        s AS (SELECT doc_id, chunk, ws, b, e, CASE WHEN n <= 128 THEN n WHEN chunk = 0 THEN e - b - 1 WHEN 64 < e - b THEN e - b - 64 ELSE e - b END AS scored FROM w),
        f AS (SELECT *, CASE WHEN chunk = 0 THEN b + 2 ELSE e - scored + 1 END AS a FROM s)
        SELECT doc_id, chunk, round(list_avg(list_transform(ws[a : e], lambda x: length(x))), 6) AS nll, scored FROM f""",
    "ppl_report": f"""
        WITH {_CHUNKS}, g AS (SELECT doc_id, exp(sum(ln(ppl) * n) / sum(n)) AS m, max(ppl) AS x, count(*) AS k, sum(n) AS t FROM c GROUP BY 1)
        SELECT c_custkey * 2 AS doc_id, coalesce(round(m, 4), CAST('Infinity' AS DOUBLE)) AS mean_ppl, coalesce(round(x, 4), CAST('Infinity' AS DOUBLE)) AS max_ppl, coalesce(k, 0) AS num_chunks,
        CAST(coalesce(t, 0) AS BIGINT) AS total_tokens FROM customer LEFT JOIN g ON doc_id = c_custkey * 2""",
    "ppl_chunk_lists": f"WITH {_CHUNKS} SELECT doc_id, string_agg(chunk || ':' || CAST(round(ppl * 1000) AS BIGINT), ' ' ORDER BY chunk) AS chunks FROM c GROUP BY 1",
    "run_rate": """
        WITH e AS (SELECT count(*) FILTER (WHERE event_type <> 'error') AS records, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM events)
        SELECT records, round(seconds, 3) AS seconds, round(records / seconds, 6) AS rate FROM e""",
    "profile_years_of_lines": "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS articles FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 5 > 0 GROUP BY 1",
}
