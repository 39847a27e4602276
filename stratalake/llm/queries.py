"""The queries of this subpackage over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontaminate, html_main, jaccard_groups, language, licenses, merkle, packing, pieces, token_counts, topk, toxicity, trie, url_filter
from stratalake.llm.store import held_out, table, training_row
from stratalake.llm.tree_sql import MERKLE_SQL, TRIE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
STATEMENTS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = build
        if sql is not None:
            STATEMENTS[name] = sql
        return build

    return register


@query("op3_token_counts")
def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), str(public_tokenizers.path("piece_bpe_32k.model")), limit=4096)


@query("op4_license_scan")
def _license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_rules")


@query("op6_best_fit_packing")
def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN)


@query("op7_language_id")
def _language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.language(table(spark, sf_dir, "documents"), training_row())
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op10_toxicity")
def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), training_row())
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted", F.col("n_clauses"))


#: Words of a text, and windows of an item, in DuckDB.
_DOC_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
DECONTAMINATE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_DOC_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_DOC_WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, least(len(w), 10) AS n, list_slice(w, s + 1, s + least(len(w), 10)) AS g
       FROM i, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS t(s) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM iw),
dg AS (SELECT r, s, n, list_slice(w, s + 1, s + n) AS g FROM d, lens, unnest(range(0, greatest(len(w) - n + 1, 0))) AS t(s)),
m AS (SELECT dg.r, dg.s, dg.n, iw.item_id FROM dg JOIN (SELECT DISTINCT item_id, n, g FROM iw) iw ON dg.n = iw.n AND dg.g = iw.g),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, s, n FROM m), unnest(range(s, s + n)) AS t(p) GROUP BY r),
it AS (SELECT r, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256 FROM m GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""


@query("op5_decontaminate", DECONTAMINATE_SQL)
def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query("op9_html_main_text")
def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"))


#: 64-bit whole vectors and scores in DuckDB.
TOP_K_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@query("op2_exact_top_k", TOP_K_SQL)
def _top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: Fetch day of a page, and the entry of the list log that comes from it, both from its id.
FETCH_DAY, ENTRY_DAY = "page_id * 37 % 997", "page_id * 53 % 887"

URL_FILTER_SQL = r"""
WITH p AS (SELECT page_id, url, (page_id * 37 % 997)::INTEGER AS day, (page_id * 53 % 887)::INTEGER AS entry_day,
           lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)) AS host,
           list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS parts FROM pages),
l AS (SELECT *, string_split(host, '.') AS labels FROM p),
e AS (SELECT CASE page_id % 3 WHEN 0 THEN host WHEN 1 THEN array_to_string(labels[greatest(len(labels) - 1, 1):], '.') ELSE host || '/' || coalesce(parts[1], '') END AS key,
      entry_day AS day, CASE page_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 ELSE 3 END AS state FROM l WHERE url IS NOT NULL),
d AS (SELECT key, day, max(state) AS state FROM e GROUP BY key, day),
i AS (SELECT key, state, day AS since, lead(day) OVER (PARTITION BY key ORDER BY day) AS until FROM d),
k AS (SELECT DISTINCT url, day, unnest(list_concat(list_concat(list_transform(range(1, len(labels) + 1), lambda n: array_to_string(labels[n:], '.')), [host || '/']),
      list_transform(range(1, len(parts) + 1), lambda n: host || '/' || array_to_string(parts[:n], '/')))) AS key FROM l WHERE host <> ''),
a AS (SELECT k.url, k.day, k.key, i.state FROM k JOIN i USING (key) WHERE state > 1 AND since <= k.day AND (until IS NULL OR k.day < until)),
j AS (SELECT url, day, count(*) AS n_active, max_by(key, (contains(key, '/')::INTEGER * 1000000 + length(key))) AS decided_by,
      max_by(state, (contains(key, '/')::INTEGER * 1000000 + length(key))) AS state FROM a GROUP BY url, day)
SELECT page_id, l.url, l.day, coalesce(n_active, 0)::BIGINT AS n_active, decided_by, CASE j.state WHEN 3 THEN 'block' WHEN 2 THEN 'allow' ELSE 'none' END AS verdict
FROM l LEFT JOIN j ON l.url = j.url AND l.day = j.day
"""


@query("op1_url_filter", URL_FILTER_SQL)
def _url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page is a capture; the list log has one entry per page, about its host, domain or first path part."""
    pages = table(spark, sf_dir, "pages")
    url = F.col("url")
    key = F.expr("page_id % 3")
    entries = pages.where("url IS NOT NULL").select(
        F.when(key == 0, url_filter.host(url)).when(key == 1, url_filter.domain_key(url)).otherwise(url_filter.prefix_key(url)).alias("key"),
        F.expr(f"cast({ENTRY_DAY} as int)").alias("day"),
        F.expr("CASE page_id % 5 WHEN 0 THEN 'remove' WHEN 1 THEN 'allow' WHEN 2 THEN 'allow' ELSE 'block' END").alias("operation"),
    )
    return url_filter.judge(pages.select("page_id", "url", F.expr(f"cast({FETCH_DAY} as int)").alias("day")), entries)


@query("op8_jaccard_groups")
def _jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups.jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op11_prefix_trie", TRIE_SQL)
def _trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


@query("op12_sentencepiece")
def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), str(public_tokenizers.path("piece_bpe_32k.model")))


@query("op13_merkle_manifest", MERKLE_SQL)
def _merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))
