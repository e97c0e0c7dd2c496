"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .chat import ANNOUNCE, format_chats
from .common import table
from .decontaminate import decontamination_digest, find_benchmark_spans
from .html_text import extract_main_text
from .near_dup import near_duplicates
from .packing import pack
from .quality_classifier import classify, train_classifier
from .quality_rules import judge_quality
from .token_counts import count_tokens
from .token_files import token_file_digest
from .tokens import tokenizer_path
from .url_filter import filter_urls

#: verdict, host, path
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_digest(find_benchmark_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digest(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=1024)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=1, capacity=2048)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, train_classifier(docs, table(spark, sf_dir, "labels")))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), threshold=75)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "verdict string, host string, path string")
    return filter_urls(table(spark, sf_dir, "pages"), rules, default="allow")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_html_extraction": op2_html_extraction,
    "op3_token_files": op3_token_files,
    "op4_token_counts": op4_token_counts,
    "op5_packing": op5_packing,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_near_dedup": op7_near_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_url_filter": op9_url_filter,
    "op10_chat_formatting": op10_chat_formatting,
}

_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)

#: Reply order by recursion over the branches; equal (conv_id, turn) rows do not occur in the tables.
_CHAT = r"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS rid, conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
ln AS (SELECT rid, conv_id, turn, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i, unnest(string_split(text, chr(10))) AS x FROM m),
lv AS (SELECT rid, conv_id, turn, i, len(regexp_replace(regexp_extract(x, '^[ \t]*((?:>[ \t]?)*)', 1), '[^>]', '', 'g')) AS level, regexp_replace(x, '^[ \t]*(?:>[ \t]?)*', '') AS words FROM ln),
nx AS (SELECT *, coalesce(lead(level) OVER (PARTITION BY rid ORDER BY i), 0) AS after FROM lv),
cl AS (SELECT rid, regexp_replace(trim(string_agg(rtrim(words), chr(10) ORDER BY i), chr(10)), '\n{3,}', chr(10) || chr(10), 'g') AS clean FROM nx
       WHERE level = 0 AND NOT (after > 0 AND regexp_matches(words, 'ANNOUNCE')) GROUP BY rid),
un AS (SELECT conv_id, turn, level, trim(regexp_replace(lower(w), '[^\p{L}\p{N}]+', ' ', 'g')) AS said
       FROM (SELECT conv_id, turn, level, words AS w FROM lv UNION ALL SELECT conv_id, turn, level, string_agg(words, ' ' ORDER BY i) FROM lv GROUP BY rid, conv_id, turn, level)),
u AS (SELECT DISTINCT * FROM un WHERE said <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL),
lk AS (SELECT q.conv_id, q.turn, q.level, (SELECT max(o.turn) FROM u o WHERE o.level = 0 AND o.conv_id = q.conv_id AND o.said = q.said AND o.turn < q.turn) AS target FROM u q WHERE q.level > 0),
re AS (SELECT conv_id, turn, count(*) AS n_quotes, count(target) AS n_linked, coalesce(max(target) FILTER (WHERE level = 1), max(target)) AS reply_to FROM lk GROUP BY conv_id, turn),
tu AS (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL)),
br AS (SELECT conv_id, turn AS start, reply_to AS spot FROM re JOIN tu USING (conv_id, turn) WHERE reply_to < before),
up AS (SELECT b.conv_id, b.start, b.spot, (SELECT max(o.start) FROM br o WHERE o.conv_id = b.conv_id AND o.start <= b.spot) AS above FROM br b),
pa(conv_id, start, path) AS (SELECT conv_id, start, [spot, start] FROM up WHERE above IS NULL UNION ALL SELECT up.conv_id, up.start, list_concat(pa.path, [up.spot, up.start]) FROM up JOIN pa ON up.conv_id = pa.conv_id AND up.above = pa.start),
hd AS (SELECT m.*, coalesce(cl.clean, '') AS clean, (SELECT max(b.start) FROM br b WHERE b.conv_id = m.conv_id AND b.start <= m.turn) AS branch FROM m LEFT JOIN cl USING (rid)),
al AS (SELECT h.*, coalesce(pa.path, CAST([] AS BIGINT[])) AS path FROM hd h LEFT JOIN pa ON pa.conv_id = h.conv_id AND pa.start = h.branch)
SELECT al.conv_id, al.turn, al.role, al.clean AS text, '<|' || coalesce(al.role, 'user') || '|>' || chr(10) || al.clean AS message, coalesce(re.n_quotes, 0) AS n_quotes, coalesce(re.n_linked, 0) AS n_linked, re.reply_to,
       CASE WHEN al.conv_id IS NOT NULL AND al.turn IS NOT NULL THEN row_number() OVER (PARTITION BY al.conv_id ORDER BY list_concat(al.path, [al.turn, -1]), al.role, al.clean) - 1 END AS position, CAST(len(al.path) // 2 AS BIGINT) AS depth
FROM al LEFT JOIN re ON re.conv_id = al.conv_id AND re.turn = al.turn
""".replace("ANNOUNCE", ANNOUNCE)

ORACLES = {
    "op10_chat_formatting": _CHAT,
    "op1_benchmark_decontamination": r"""
WITH dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
bw AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
pat AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM bw WHERE len(w) > 0)),
ms AS (SELECT DISTINCT m FROM pat),
grams AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
          FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, ms WHERE len(w) >= m)),
occ AS (SELECT doc_id, m, i, item_id FROM grams JOIN pat USING (m, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id AS s FROM occ) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
""",
    "op9_url_filter": rf"""
WITH r(verdict, host, path) AS (VALUES {_RULE_ROWS}),
p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
m AS (SELECT q.*, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS k
      FROM q LEFT JOIN r ON (q.host = r.host OR ends_with(q.host, '.' || r.host)) AND starts_with(q.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
""",
}
