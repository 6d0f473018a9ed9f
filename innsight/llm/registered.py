"""The dealt operators as registered queries over whole tables, and their DuckDB spelling where SQL has one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innsight.llm import ann, decontaminate, hmm, jaccard, language, packing, pieces, quality, rans, toxicity, urls, variants, whitening


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels"), folds=5, fold=0)
    scored = toxicity.with_toxicity(docs, model).withColumn("held_out", toxicity.held_out(F.col("doc_id"), 5, 0))
    return scored.select("doc_id", "held_out", "toxicity.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_quality(_read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "quality.*")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = toxicity.held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs, out)
    scored = language.with_language(docs.select("doc_id", "text"), model).withColumn("held_out", out)
    return scored.select("doc_id", "held_out", "language.*")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.with_verdict(_read(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "judged.*")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.round_trip(_read(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.with_pieces(_read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pieces.*")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_read(spark, sf_dir, "documents"))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(_read(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated", "n_near")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_read(spark, sf_dir, "documents"))


def _quality_sql() -> str:
    lengths = [3, *quality.MOST_REPEATED]
    gram = lambda n: " || ' ' || ".join(f"lead(w, {k}) OVER o" if k else "w" for k in range(n))
    symbols = "[" + quality.SYMBOLS + "]"
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
    g AS (SELECT doc_id, i, length(w) AS c, {', '.join(f'{gram(n)} AS g{n}' for n in lengths)} FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    t AS (SELECT doc_id, i, c, {', '.join(f'g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{n}) > 1 AS t{n}' for n in lengths)} FROM g),
    u AS (SELECT doc_id, c, {', '.join(f'bool_or(t{n}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS u{n}' for n in lengths)} FROM t),
    s AS (SELECT doc_id, count(*) AS n_words, sum(c) AS word_chars, count(*) FILTER (u3) AS n_repeat_words,
        {', '.join(f'coalesce(sum(c) FILTER (u{n}), 0) AS dup_{n}gram_chars' for n in quality.MOST_REPEATED)} FROM u GROUP BY doc_id),
    l AS (SELECT doc_id, line, count(*) AS n, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS c
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) GROUP BY ALL),
    r AS (SELECT doc_id, sum(n - 1) AS n_dup_lines, coalesce(sum(n * c) FILTER (n > 1), 0) AS dup_line_chars FROM l WHERE c > 0 GROUP BY doc_id),
    a AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        length(text) - length(regexp_replace(text, '{symbols}', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars,
        {', '.join(f'coalesce(dup_{n}gram_chars, 0)::BIGINT AS dup_{n}gram_chars' for n in quality.MOST_REPEATED)}
        FROM d LEFT JOIN s USING (doc_id) LEFT JOIN r USING (doc_id))
    SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        NOT (n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND n_symbols <= {quality.MOST_SYMBOLS} * n_words
        AND dup_line_chars <= {quality.MOST_REPEATED_LINES} * word_chars
        AND {' AND '.join(f'dup_{n}gram_chars <= {most} * word_chars' for n, most in quality.MOST_REPEATED.items())} AS kept
    FROM a"""


def _url_sql() -> str:
    name = r"translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rules = " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND path LIKE '{p}%' THEN {{'rule': '{h}{p}', 'verdict': '{v}'}}"
        for h, p, v in sorted(urls.RULES, key=lambda r: (-len(r[0]) - len(r[1]), r))
    )
    ranked = sorted(urls.GLOBS, key=lambda g: (-sum(c not in "*?" for c in g[0]), g[1] != "block", g[0]))
    globs = " ".join(f"WHEN canonical GLOB '{g}' THEN {{'glob': '{g}', 'verdict': '{v}'}}" for g, v in ranked)
    return rf"""
    WITH p AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
    a AS (SELECT page_id, url, {name} AS host, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
        list_filter(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]*|gclid|fbclid|ref)(=|$)')) AS kept FROM p),
    c AS (SELECT page_id, host, path, regexp_replace(regexp_replace(host, '^.*@', ''), '\.?(:[0-9]*)?$', '') || CASE WHEN path = '' THEN '/' ELSE path END
        || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical FROM a),
    j AS (SELECT *, CASE {rules} END AS r, CASE {globs} ELSE {{'glob': NULL, 'verdict': '{urls.DEFAULT}'}} END AS g FROM c)
    SELECT page_id, host, path, canonical, r.rule AS rule, CASE WHEN r IS NULL THEN g.glob END AS glob, coalesce(r.verdict, g.verdict) AS verdict FROM j"""


def _jaccard_sql() -> str:
    n, percent = jaccard.WORDS, jaccard.PERCENT
    gram = " || ' ' || ".join(f"lead(w, {k}) OVER o" if k else "w" for k in range(n))
    return rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS ws FROM documents),
    w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, {gram} AS g FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE g IS NOT NULL
        UNION ALL SELECT doc_id, array_to_string(ws, ' ') AS g FROM d WHERE len(ws) BETWEEN 1 AND {n - 1}),
    z AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS MATERIALIZED (SELECT x, y FROM p JOIN z zx ON zx.doc_id = x JOIN z zy ON zy.doc_id = y WHERE 100 * c >= {percent} * (zx.n + zy.n - c)),
    r AS (SELECT doc_id AS x, doc_id AS y FROM z UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
    SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
    FROM d LEFT JOIN z ON z.doc_id = d.doc_id LEFT JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) m ON m.x = d.doc_id"""


def _decontamination_sql() -> str:
    size, span, k = decontaminate.WINDOW, decontaminate.SPAN, decontaminate.NEAR_TERMS
    cut = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    seen = [f"max(i) FILTER (r = {j}) OVER so_far AS p{j}" for j in range(1, k + 1)]
    last = [f"CASE WHEN k >= {j} THEN coalesce(p{j}, -1000000000000) ELSE i END" for j in range(1, k + 1)]
    return rf"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {cut} AS ws FROM documents),
    b AS MATERIALIZED (SELECT item_id, {cut} AS ws, least(len({cut}), {size}) AS n FROM benchmark),
    w AS MATERIALIZED (SELECT DISTINCT item_id, n, list_slice(ws, s, s + n - 1) AS g FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS s FROM b WHERE n > 0)),
    t AS MATERIALIZED (SELECT row, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
    g AS (SELECT row, i, n, list_slice(ws, i, i + n - 1) AS g FROM (SELECT row, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b WHERE n > 0))),
    m AS MATERIALIZED (SELECT row, i, w.n, item_id FROM g JOIN w ON w.n = g.n AND w.g = g.g),
    h AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM m) GROUP BY row),
    q AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM m WHERE item_id IS NOT NULL) GROUP BY row),
    c AS MATERIALIZED (SELECT w, count(*) AS held FROM t WHERE w IN (SELECT unnest(ws) FROM b) GROUP BY w),
    v AS (SELECT item_id, x.w, held, row_number() OVER (PARTITION BY item_id ORDER BY held NULLS FIRST, x.w) AS r FROM (SELECT DISTINCT item_id, unnest(ws) AS w FROM b) x LEFT JOIN c ON c.w = x.w),
    y AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS k, count(held) OVER (PARTITION BY item_id) AS found FROM v WHERE r <= {k}),
    z AS (SELECT row, item_id, k, i, {', '.join(seen)} FROM t JOIN y ON y.w = t.w AND k = found WINDOW so_far AS (PARTITION BY row, item_id ORDER BY i)),
    o AS (SELECT row, count(DISTINCT item_id) AS n_near FROM z WHERE i - least({', '.join(last)}) < {span} GROUP BY row)
    SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
    FROM d LEFT JOIN h USING (row) LEFT JOIN q USING (row) LEFT JOIN o USING (row)"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_rules": op2_quality_rules,
    "op3_language": op3_language,
    "op4_nearest": op4_nearest,
    "op5_packing": op5_packing,
    "op6_url_filter": op6_url_filter,
    "op7_token_files": op7_token_files,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_language_model": op10_language_model,
    "op11_decontamination": op11_decontamination,
    "op12_whitening": op12_whitening,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE = {"op2_quality_rules": _quality_sql(), "op6_url_filter": _url_sql(), "op9_jaccard_join": _jaccard_sql(), "op11_decontamination": _decontamination_sql()}
