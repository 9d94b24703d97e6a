"""One query per operator, over its whole table, with the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from grantline.llm import (
    bpe,
    compression_quality,
    hard_negatives,
    lm_whole,
    max_score,
    near_dedup,
    packing,
    periodic_runs,
    piece_coding,
    substring_dedup,
    target_ratio,
    url_rules,
    warc_revisits,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, _tokenizer()).select("doc_id", "token_ids")
    return bpe.decode(coded, _tokenizer()).select(
        "doc_id",
        F.expr("octet_length(token_ids) div 4").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _captures(pages: DataFrame) -> DataFrame:
    """Two records for each page: a full response, and a later or (every eleventh) earlier
    revisit, with validators that agree, differ or are missing."""
    time = F.lit(1_700_000_000) + F.col("page_id") % 1000 * 3600 + F.col("page_id")
    again = F.col("page_id") % 3 * 86_400 + 100
    etag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    day = F.when(F.col("page_id") % 5 != 0, F.concat(F.lit("day "), F.col("page_id") % 365))
    full = pages.select(
        (2 * F.col("page_id")).alias("record_id"),
        "url",
        time.alias("time"),
        F.lit(False).alias("revisit"),
        etag.alias("etag"),
        day.alias("last_modified"),
        F.md5("html").alias("digest"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Content-Length"), F.length("html").cast("string"),
            F.lit("ETag"), etag,
            F.lit("Cache-Control"), F.lit("max-age=60"),
        ).alias("headers"),
    )
    revisit = pages.select(
        (2 * F.col("page_id") + 1).alias("record_id"),
        F.concat("url", F.lit("#again")).alias("url"),
        F.when(F.col("page_id") % 11 == 0, time - 10_000_000).otherwise(time + again).alias("time"),
        F.lit(True).alias("revisit"),
        F.when(F.col("page_id") % 7 == 0, '"other"')
        .when(F.col("page_id") % 5 != 1, F.concat(F.lit("W/"), etag))
        .alias("etag"),
        day.alias("last_modified"),
        F.lit(None).cast("string").alias("digest"),
        F.create_map(
            F.lit("cache-control"), F.lit("max-age=600"),
            F.lit("content-length"), F.lit("0"),
            F.lit("Date"), F.concat(F.lit("d"), F.col("page_id")),
        ).alias("headers"),
    )
    return full.unionByName(revisit)


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _captures(_table(spark, sf_dir, "pages"))
    pairs = F.transform(
        F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return warc_revisits.resolve(records).withColumn(
        "headers", F.array_join(F.array_sort(pairs), ";")
    )


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = url_rules.labelled_pages(pages, _table(spark, sf_dir, "labels"))
    return url_rules.judge(pages, url_rules.mine(labelled)).select(
        "page_id", *url_rules.RESULTS
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, _tokenizer())).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op5_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return max_score.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op6_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = compression_quality.fit(docs, _table(spark, sf_dir, "labels"))
    return compression_quality.score(docs, model)


def op7_target_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    table = target_ratio.ratios(docs, _table(spark, sf_dir, "labels"))
    return target_ratio.judged(docs, table).select(
        "doc_id", *target_ratio.RESULTS, "base_failed", "kept", "target_score"
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op10_lm_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lm_whole.score(docs, _table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, moved)


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth text, by a checksum of its id, repeats a block of its words from some word
    on; the words are joined by one space. Other texts, null ids included, stay as they are."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    check = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(F.col("check_") % 10 == 0, F.lit(False))
    rest = F.expr("slice(words_, start_ + 1, period_)")
    times = F.expr("int(ceil((n_ - start_) / period_))")
    repeated = F.concat(F.expr("slice(words_, 1, start_)"), F.flatten(F.array_repeat(rest, times)))
    return (
        docs.withColumn("check_", check)
        .withColumn("words_", F.when(chosen, words))
        .withColumn("n_", F.size("words_"))
        .withColumn("g_", F.expr("check_ div 10"))
        .withColumn("start_", F.when(F.col("n_") > 0, F.expr("int(g_ % n_)")))
        .withColumn("period_", F.expr("int(1 + (n_ - start_) div (3 + g_ % 8))"))
        .withColumn(
            "text",
            F.when(
                F.col("n_") > 0, F.array_join(F.slice(repeated, F.lit(1), F.col("n_")), " ")
            ).otherwise(F.col("text")),
        )
        .select(docs.columns)
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.col("n_runs") > 0, "\n").otherwise(""))
    exponent = F.expr("1000 * best.length div best.period")
    return periodic_runs.find_runs(docs).select(
        "doc_id",
        "n_runs",
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        exponent.alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def op13_piece_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_coding.encode(docs, path).select("doc_id", "token_ids")
    decimal = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return piece_coding.decode(coded, path).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def all_queries() -> dict[str, Query]:
    found = {n: v for n, v in globals().items() if n.startswith("op") and callable(v)}
    ordered = dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
    return ordered | {"pipeline": corpus_pipeline.run}


#: Reference SQL on the given tables, where SQL can express the query.
_TOKENS = """
    list_sort(list_distinct(list_filter(list_concat([
      'scheme:' || split_part(url, '://', 1),
      'depth:' || least(len(seg), 5),
      CASE WHEN regexp_matches(path, '[0-9]') THEN 'number' END,
      'ending:' || nullif(regexp_extract(path, '\\.(\\w+)$', 1), ''),
      CASE WHEN contains(url, '#') THEN 'fragment' END],
      list_transform(part, lambda s: 'label:' || s),
      CASE WHEN length(host) <= 253 THEN list_transform(range(1, len(part)),
        lambda i: 'domain:' || array_to_string(list_slice(part, i, len(part)), '.')) END,
      list_transform(list_filter(seg, lambda s: regexp_matches(s, '[^0-9]')),
        lambda s: 'segment:' || s),
      list_transform(list_filter(list_transform(
          string_split(regexp_extract(url, '^[\\s\\S]*?://[^?#]*\\?([^#]*)', 1), '&'),
          lambda k: split_part(k, '=', 1)),
        lambda k: k <> ''), lambda k: 'key:' || k)
    ), lambda t: t IS NOT NULL)))"""
_SUBSETS = """
    list_transform(range(1, CAST(1 << len(common) AS BIGINT)),
      lambda m: list_filter(common, lambda t, i: (m >> (i - 1)) & 1 = 1))"""

ORACLES = {
    "op2_warc_revisits": """
        WITH p AS (
          SELECT page_id, md5(html) AS digest, length(html) AS size,
            1700000000 + page_id % 1000 * 3600 + page_id AS t,
            CASE WHEN page_id % 5 <> 0 THEN 'day ' || (page_id % 365) END AS day,
            split_part(trim(url), '#', 1) AS bare
          FROM pages
        ), u AS (
          SELECT *, lower(split_part(bare, '://', 1)) AS scheme,
            regexp_extract(bare, '^[^:/?]+://([^/?]*)', 1) AS authority,
            regexp_extract(authority, '^([\\s\\S]*@)', 1) AS userinfo,
            lower(regexp_extract(authority, '([^@]*)$', 1)) AS h,
            regexp_extract(bare, '^[^:/?]+://[^/?]*([^?]*)', 1) AS path,
            array_to_string(list_sort(list_filter(
              string_split(regexp_extract(bare, '\\?([\\s\\S]*)$', 1), '&'),
              lambda k: k <> '' AND NOT regexp_matches(k, '^utm_'))), '&') AS query
          FROM p
        ), k AS (
          SELECT *, scheme || '://' || userinfo
            || regexp_replace(h, CASE WHEN scheme = 'https' THEN ':443$' ELSE ':80$' END, '')
            || CASE WHEN path = '' THEN '/' ELSE path END
            || CASE WHEN query = '' THEN '' ELSE '?' || query END AS url_key
          FROM u
        ), v AS (
          SELECT 2 * page_id + 1 AS record_id, page_id, url_key, day,
            CASE WHEN page_id % 11 = 0 THEN t - 10000000
              ELSE t + page_id % 3 * 86400 + 100 END AS t,
            CASE WHEN page_id % 7 = 0 THEN '"other"'
              WHEN page_id % 5 <> 1 THEN '"' || digest || '"' END AS etag
          FROM k
        ), m AS (
          SELECT v.*, max({'t': k.t, 'id': 2 * k.page_id}) AS found
          FROM v LEFT JOIN k ON k.url_key = v.url_key AND k.t < v.t
          GROUP BY ALL
        )
        SELECT record_id, m.url_key, found.id AS response_id,
          CASE WHEN found.id IS NULL THEN 'orphan'
            WHEN coalesce(etag = '"' || f.digest || '"', m.day = f.day) THEN 'resolved'
            WHEN coalesce(etag = '"' || f.digest || '"', m.day = f.day) IS NULL THEN 'unverified'
            ELSE 'changed' END AS outcome,
          CASE WHEN found.id IS NOT NULL THEN
            'cache-control=max-age=600;content-length=' || f.size
            || ';content-type=text/html;date=d' || m.page_id
            || ';etag="' || f.digest || '"' END AS headers
        FROM m LEFT JOIN k f ON 2 * f.page_id = found.id
    """,
    "op3_url_rules": f"""
        WITH s AS (
          SELECT page_id, url,
            coalesce(translate(regexp_extract(url, '^[\\s\\S]*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
            coalesce(regexp_extract(url, '^[\\s\\S]*?://[^/?#]*([^?#]*)', 1), '') AS path
          FROM pages
        ), t AS (
          SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS seg,
            list_filter(string_split(host, '.'), lambda x: x <> '') AS part FROM s
        ), u AS (
          SELECT *, CASE WHEN host <> '' THEN {_TOKENS} END AS tokens FROM t
        ), l AS (
          SELECT doc_id, max(quality = 0 OR coalesce(toxic = 1, false)) AS bad FROM labels
          WHERE quality IS NOT NULL GROUP BY doc_id
        ), b AS (
          SELECT page_id, tokens, bad FROM u JOIN l ON doc_id =
            try_cast(regexp_extract(path, '/([0-9]{{1,18}})(?:/|\\.\\w+)?$', 1) AS BIGINT)
          WHERE tokens IS NOT NULL
        ), m AS (
          SELECT greatest(1, ceil(count(*) * {url_rules.SUPPORT})) AS needed FROM b
        ), g AS (
          SELECT list(token) AS known FROM (
            SELECT token FROM (SELECT unnest(tokens) AS token, bad FROM b) GROUP BY token
            HAVING count(*) FILTER (bad) >= (SELECT needed FROM m))
        ), h AS (
          SELECT tokens, list_sort(list_intersect(tokens, known)) AS common
          FROM (SELECT DISTINCT tokens FROM u), g
        ), n AS (
          SELECT common, bad, count(*) AS n FROM b JOIN h USING (tokens) GROUP BY common, bad
        ), r AS (
          SELECT part FROM (SELECT unnest({_SUBSETS}) AS part, bad, n FROM n) GROUP BY part
          HAVING coalesce(sum(n) FILTER (bad), 0) >= (SELECT needed FROM m)
            AND coalesce(sum(n) FILTER (bad), 0) >= {url_rules.CONFIDENCE} * sum(n)
        ), o AS (
          SELECT DISTINCT common FROM (
            SELECT common, unnest({_SUBSETS}) AS part FROM (SELECT DISTINCT common FROM h))
          JOIN r USING (part)
        ), x AS (
          SELECT page_id FROM u JOIN h USING (tokens) JOIN o USING (common)
        ), f AS (
          SELECT u.*, CASE
            WHEN (host = 'example.org' OR ends_with(host, '.example.org'))
              AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN (host = 'example.org' OR ends_with(host, '.example.org'))
              AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/'
            END AS rule
          FROM u
        )
        SELECT page_id, host, path, rule,
          CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN page_id IN (SELECT page_id FROM x) THEN 'block' ELSE 'allow' END AS verdict
        FROM f
    """,
    "op5_max_score": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
          FROM embeddings
          WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        ), r AS (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
          FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op9_substring_dedup": """
        WITH w AS (
          SELECT doc_id,
            regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
          FROM documents
        ), s AS (
          SELECT doc_id, unnest(range(1, len(words) - 11)) AS b, words FROM w
        ), x AS (
          SELECT doc_id, b, list_slice(words, b, b + 12) AS passage FROM s
        ), f AS (
          SELECT passage, min(doc_id) AS first_id FROM x GROUP BY passage
        ), g AS (
          SELECT DISTINCT doc_id, unnest(range(b, b + 13)) AS place
          FROM x JOIN f USING (passage) WHERE first_id < doc_id
        ), d AS (
          SELECT doc_id, list(place) AS places FROM g GROUP BY doc_id
        ), k AS (
          SELECT doc_id, words,
            list_filter(range(1, len(words) + 1),
              lambda i: NOT coalesce(list_contains(places, i), false)) AS stay
          FROM w LEFT JOIN d USING (doc_id)
        )
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
          CAST(len(words) - len(stay) AS BIGINT) AS n_removed,
          sha256(array_to_string(list_transform(stay, lambda i: words[i]), ' ')) AS kept_sha256
        FROM k
    """,
    "op11_hard_negatives": """
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
          FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
            CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
          FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id
        ), p AS (
          SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r
          FROM s WHERE same
        ), n AS (
          SELECT anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id,
            p.score AS positive_score, s.score AS negative_score,
            row_number() OVER (
              PARTITION BY anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
          FROM p JOIN s USING (anchor_id)
          WHERE r <= 5 AND NOT s.same
            AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
        )
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id,
          positive_score, negative_score
        FROM n WHERE rank <= 3
    """,
}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
