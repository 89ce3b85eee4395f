"""One registered query per operator, with the SQL for its rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, byte_bpe, decontaminate, exact_dedup, html_text, language, near_dedup, packing, periodic_runs, quality, secret_scan, sharding, url_filter
from tidemark.session import utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(utc(spark), sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Lower-cases A-Z only.
_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(rf"""
    WITH RECURSIVE
    tokens AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, unnest(
            CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
        FROM tokens),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
        WHERE 100 * c >= 75 * (p.n + q.n - c)),
    both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach AS (
        SELECT doc_id AS x, doc_id AS y FROM documents
        UNION SELECT reach.x, both_ways.y FROM reach JOIN both_ways ON reach.y = both_ways.x),
    smallest AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM smallest LEFT JOIN sizes USING (doc_id)
""")
def op1_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query(r"""
    WITH normal AS (
        SELECT doc_id, length(coalesce(text, '')) AS n_points,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents)
    SELECT doc_id,
           first_value(doc_id) OVER (PARTITION BY plain ORDER BY n_points DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY plain) AS group_size,
           doc_id = first_value(doc_id) OVER (PARTITION BY plain ORDER BY n_points DESC, doc_id) AS kept,
           sha256(plain) AS text_sha256
    FROM normal
""")
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query()
def op10_sampled_splitters(spark, sf_dir):
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


@query(rf"""
    WITH
    words AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    items AS (SELECT item_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n,
               unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS s
        FROM items WHERE len(w) > 0),
    lengths AS (SELECT DISTINCT n FROM windows),
    runs AS (
        SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM words, lengths WHERE len(w) >= n),
    found AS (
        SELECT runs.doc_id, runs.n, runs.i, windows.item_id
        FROM runs JOIN windows ON runs.n = windows.n AND array_to_string(runs.w[runs.i:runs.i + runs.n - 1], ' ') = windows.s),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op9_aho_corasick_decontamination(spark, sf_dir):
    found = decontaminate.find_benchmark_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.covered_words("hits").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


@query()
def op8_tree_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query()
def op4_random_index_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score(docs, quality.held_in(labels))
    return scored.select("doc_id", (language.remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query()
def op6_bitmask_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query()
def op3_block_tree_html(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


#: Entries and captures derived from the pages: every page lists its host or the parent domain,
#: or takes it off again, and is fetched, at some second of four days; several fall on one time.
_HOST = r"regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1)"
_LISTED_AT, _FETCHED_AT = "page_id * 37 % 977 * 353", "page_id * 91 % 3989 * 85"


@query(rf"""
    WITH
    entries AS (
        SELECT CASE WHEN page_id % 2 = 0 THEN {_HOST} ELSE regexp_replace({_HOST}, '^[^.]+\.', '') END AS pattern,
               CASE page_id % 5 WHEN 0 THEN 'allow' WHEN 1 THEN 'off' ELSE 'block' END AS action,
               TIMESTAMP '2024-01-01' + to_seconds({_LISTED_AT}) AS listed_on, page_id AS seq
        FROM pages),
    by_time AS (SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY pattern, listed_on ORDER BY seq DESC) = 1),
    valid AS (SELECT pattern, action, listed_on, lead(listed_on) OVER (PARTITION BY pattern ORDER BY listed_on) AS until FROM by_time),
    captures AS (SELECT page_id, url, TIMESTAMP '2024-01-01' + to_seconds({_FETCHED_AT}) AS fetched_at, {_HOST} AS host FROM pages),
    judged AS (
        SELECT page_id, pattern, action, listed_on FROM captures JOIN valid
        ON (host = pattern OR ends_with(host, '.' || pattern))
           AND listed_on <= fetched_at AND (until IS NULL OR fetched_at < until) AND action IN ('block', 'allow')
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC) = 1)
    SELECT page_id, url, fetched_at, pattern, action, listed_on, coalesce(action = 'block', false) AS blocked
    FROM captures LEFT JOIN judged USING (page_id)
""")
def op7_temporal_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    host, start = url_filter.host_of("url"), F.lit("2024-01-01").cast("timestamp_ntz")
    entries = pages.select(
        F.when(F.col("page_id") % 2 == 0, host).otherwise(F.regexp_replace(host, r"^[^.]+\.", "")).alias("pattern"),
        F.expr("CASE page_id % 5 WHEN 0 THEN 'allow' WHEN 1 THEN 'off' ELSE 'block' END").alias("action"),
        F.timestamp_add("SECOND", F.expr(_LISTED_AT), start).alias("listed_on"),
        F.col("page_id").alias("seq"),
    )
    captures = pages.select("page_id", "url", F.timestamp_add("SECOND", F.expr(_FETCHED_AT), start).alias("fetched_at"))
    return url_filter.judge(captures, entries)


@query()
def op5_random_field_secrets(spark, sf_dir):
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


@query()
def op11_lyndon_runs(spark, sf_dir):
    told = periodic_runs.repeated_tails(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.find_runs(told))


@query()
def op12_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op13_hashed_alignment(spark, sf_dir):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    encoded = alignment.encode(table(spark, sf_dir, "documents"), *paths)
    return alignment.summarize(encoded, alignment.count_pairs(encoded))
