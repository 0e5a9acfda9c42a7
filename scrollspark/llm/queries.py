"""One thin query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrollspark.llm import chat_format, decontamination, exact_dedup, fill_in_middle, jaccard_join, jpeg_media, mixing, ranked_search, sentencepiece_nbest, suffix_dedup, toxicity, url_rules, warc
from scrollspark.llm.tables import table

URL_RULES = (
    url_rules.Rule("block", "com", "/en/"),
    url_rules.Rule("allow", "example.com", "/en/7"),
    url_rules.Rule("allow", "net", "/de/"),
    url_rules.Rule("block", "example.net", "/de/8"),
    url_rules.Rule("block", "org", "/es/"),
)


#: A conversation whose text holds the template's own control strings.
PROBE = tuple((-7, turn, role, r"\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant")))


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id bigint, turn bigint, role string, text string")
    return chat_format.read_back(chat_format.formatted(source.unionByName(probe)))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    id_type = pages.schema["page_id"].dataType
    number = lambda c: F.col(c).cast(id_type)
    return warc.archived(pages, least_bytes=100).select(
        number("id").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), number("refers_to").alias("refers_to")
    )


#: Scores from here on are rejected.
TOXIC_FROM = toxicity.CUT


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    out = toxicity.scored(docs, model)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"))


#: The public vocabulary of the encoding query, read by the driver; executors get its contents.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 3


def op4_sentencepiece_nbest(spark: SparkSession, sf_dir: str, model_file: str = PIECE_MODEL) -> DataFrame:
    vocabulary = sentencepiece_nbest.Vocabulary.load(model_file)
    return sentencepiece_nbest.summarised(table(spark, sf_dir, "documents"), vocabulary, N_BEST)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document the words of all passages of 50 words or more that it shares with another one."""
    found = suffix_dedup.repeats(table(spark, sf_dir, "documents"), gram=8, least=50)
    words = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, x: total + x["end"] - x["start"])
    text = F.array_join(F.transform("spans", lambda x: F.concat(x["start"], F.lit("-"), x["end"])), ",")
    return found.select("doc_id", F.size("spans").alias("n_spans"), words.alias("repeated_words"), text.alias("spans"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.joined(table(spark, sf_dir, "documents"), shingle=5, percent=80)


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = jpeg_media.encoded(table(spark, sf_dir, "documents"))
    return jpeg_media.described(media, keep=("n_bytes",)).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"
    )


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"), keep="max")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), target_entropy=0.95, max_repeats=4.0)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    hit = decontamination.hit_words(F.col("spans"))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (hit > 0).alias("contaminated")
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transformed(table(spark, sf_dir, "documents"), seed="1", plain_from=90, spm_below=20)
    digests = (F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_warc": op2_warc,
    "op3_toxicity": op3_toxicity,
    "op4_sentencepiece_nbest": op4_sentencepiece_nbest,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_media_columns": op7_media_columns,
    "op8_url_filters": op8_url_filters,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mixing": op10_mixing,
    "op11_ranked_search": op11_ranked_search,
    "op12_decontamination": op12_decontamination,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_RULE_ROWS = ", ".join(f"('{r.action}', '{r.host}', '{r.path}', {i})" for i, r in enumerate(URL_RULES))

#: formatted_chars: a turn's header and end take 14 characters besides the role's name.
_CHAT_SQL = r"""
    WITH probe(conv_id, turn, role, text) AS (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
    t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL FROM probe),
    d AS (SELECT *, CASE WHEN regexp_matches(text, '\\(\\|###|</turn>)|\\$') THEN replace(text, '\', '\\') ELSE text END AS doubled FROM t),
    e AS (SELECT *, replace(replace(doubled, '###', '\###'), '</turn>', '\</turn>') AS body FROM d)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(body) + length(role) + 14) AS BIGINT) AS formatted_chars
    FROM e GROUP BY conv_id"""

#: Words of every document, and the set of its shingles.
_WORDS_SQL = r"""
    w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents)"""

_REPEATS_SQL = f"""
    WITH {_WORDS_SQL},
    win AS (SELECT doc_id, unnest(range(0, len(ws) - 49)) AS i, unnest(list_transform(range(0, len(ws) - 49), lambda j: md5(array_to_string(ws[j + 1 : j + 50], ' ')))) AS k FROM w WHERE len(ws) >= 50),
    rep AS (SELECT k FROM win GROUP BY k HAVING count(DISTINCT doc_id) > 1),
    hit AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM win JOIN rep USING (k)),
    isl AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM hit),
    span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM isl GROUP BY doc_id, n),
    by_doc AS (SELECT doc_id, count(*) AS n, sum(b - a) AS t, string_agg(a || '-' || b, ',' ORDER BY a) AS s FROM span GROUP BY doc_id)
    SELECT d.doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_spans, CAST(coalesce(t, 0) AS BIGINT) AS repeated_words, coalesce(s, '') AS spans FROM documents d LEFT JOIN by_doc USING (doc_id)"""

_JACCARD_SQL = f"""
    WITH RECURSIVE {_WORDS_SQL},
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS g FROM w WHERE len(ws) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    l AS (SELECT u, v FROM c JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
    r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.v, r.root FROM r JOIN l ON l.u = r.doc_id)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.root AS component_id
    FROM documents d JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) m USING (doc_id) LEFT JOIN n USING (doc_id)"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

_RANKED_SQL = f"""
    WITH tok AS (SELECT doc_id, unnest(regexp_extract_all({_FOLDED}, {_TERM})) AS t FROM documents),
    item AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_FOLDED}, {_TERM})) AS t FROM benchmark),
    len AS (SELECT doc_id, count(*) AS n FROM tok GROUP BY doc_id),
    al AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM len),
    tf AS (SELECT doc_id, t, count(*) AS tf FROM tok WHERE t IN (SELECT t FROM item) GROUP BY doc_id, t),
    w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, al GROUP BY t, n_docs),
    imp AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS impact FROM tf JOIN len USING (doc_id) JOIN w USING (t), al),
    s AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM item JOIN imp USING (t) GROUP BY item_id, doc_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""

_LEAKS_SQL = f"""
    WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, {_TERM}) AS ws FROM documents),
    i AS (SELECT item_id, ws, least(len(ws), 10) AS m FROM (SELECT item_id, regexp_extract_all({_FOLDED}, {_TERM}) AS ws FROM benchmark) WHERE len(ws) > 0),
    win AS (SELECT DISTINCT item_id, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda j: array_to_string(ws[j : j + m - 1], ' '))) AS k FROM i),
    cand AS (SELECT doc_id, m, unnest(range(1, len(ws) - m + 2)) AS j, unnest(list_transform(range(1, len(ws) - m + 2), lambda j: array_to_string(ws[j : j + m - 1], ' '))) AS k
             FROM d, (SELECT DISTINCT m FROM win) WHERE len(ws) >= m),
    hit AS (SELECT doc_id, item_id, cand.m, j FROM cand JOIN win ON win.k = cand.k AND win.m = cand.m),
    word AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + m)) AS x FROM (SELECT DISTINCT doc_id, j, m FROM hit)) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)"""

_MIDDLE_SQL = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS x, len(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
    g AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
    f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
    p AS (SELECT *, substr(x, 1, a) AS pre, substr(x, a + 1, b - a) AS mid, substr(x, b + 1) AS suf FROM f)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(x) AS restored_sha256 FROM p"""

ORACLE_SQL = {
    "op1_chat_formatting": _CHAT_SQL,
    "op2_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first < page_id THEN first END AS refers_to FROM d LEFT JOIN f USING (payload_digest)""",
    "op5_suffix_dedup": _REPEATS_SQL,
    "op6_jaccard_join": _JACCARD_SQL,
    "op8_url_filters": f"""
        WITH rules(action, rhost, rpath, k) AS (VALUES {_RULE_ROWS}),
        u AS (SELECT page_id, coalesce(url, '') AS url, instr(coalesce(url, ''), '://') AS sep FROM pages),
        r AS (SELECT page_id, CASE WHEN sep > 0 THEN substr(url, sep + 3) ELSE '' END AS rest FROM u),
        p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
        m AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath) * 100 - k) AS rule,
                     arg_max(action, length(rhost || rpath) * 100 - k) AS action
              FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
        SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.action, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
    "op9_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
        g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(x) AS text_sha256 FROM t JOIN g USING (x)""",
    "op11_ranked_search": _RANKED_SQL,
    "op12_decontamination": _LEAKS_SQL,
    "op13_fill_in_middle": _MIDDLE_SQL,
}
