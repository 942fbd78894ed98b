"""Registered queries of the operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import (bpe_trie, decontaminate, importance, jaccard_join, language_id, quality, secret_scan, sentencepiece, sharding,
               token_alignment, token_rollup, toxicity, url_filter)
from .graph import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def _crc32_sql(text: str) -> str:
    """DuckDB SQL of the unsigned crc32 of a text's UTF-8 bytes, bit by bit."""
    return f"""xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(generate_series(1, strlen({text})),
                 lambda i: ('0x' || substr(hex({text}), 2 * i - 1, 2))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                             lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


#: Members and components of the 5-word shingle join at 0.8; `{docs}` is the input relation.
JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM {docs}),
g AS (
  SELECT doc_id, list_distinct(CASE
      WHEN words IS NULL OR len(words) = 0 THEN []
      WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
      ELSE list_transform(generate_series(1, len(words) - 4), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS s
  FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM g),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM x a JOIN x b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM g
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
member AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
"""


@query("op6_ngram_jaccard", JACCARD_SQL.format(docs="documents") + """
SELECT g.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, m.component_id
FROM g JOIN member m USING (doc_id)""")
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = jaccard_join.ngram_jaccard(_read(spark, sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "component_id")


def _crc(modulus: int):
    """crc32 of doc_id as text, modulo ``modulus`` (of an empty text where doc_id is null)."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text, and whether decoding them gives the text again."""
    coded = sentencepiece.encode(_read(spark, sf_dir, "documents"), ["doc_id", "text"])
    back = sentencepiece.decode(coded.select("doc_id", "text", "ids"), ["doc_id", "text", "ids"])
    return back.select("doc_id", F.size(F.coalesce("ids", F.array().cast("array<int>"))).cast("long").alias("n_ids"),
                       F.xxhash64("ids").alias("ids_hash"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@query("op2_token_rollup")
def op2_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents.

    1 inserts every document with the counts of both tokenizer versions; 2
    deletes the exact copies (all but the least doc_id of each text); 3 revises
    the counts of the first version (out with the old ones, in with those of
    the texts with every run of white space made one space); 1 is delivered
    again and changes nothing. Copies without a doc_id are not deleted.
    """
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    single = F.regexp_replace("text", r"\s+", " ")
    outer = F.coalesce(F.col("text") != single, F.lit(False))
    counted = materialize(spark, token_rollup.count(
        docs.withColumns({"h": F.sha2(F.coalesce("text", F.lit("")), 256), "outer": outer}),
        ["doc_id", "source", "lang", "h", "outer"]), "rollup-counted")
    store = token_rollup.Rollup(spark, scratch_path(spark, "rollup"))
    insert = token_rollup.signed(counted, 1)
    store.commit("1-insert", insert)
    least = counted.groupBy("h").agg(F.min("doc_id").alias("least"))
    copies = materialize(spark, counted.join(least, "h").filter("doc_id <> least").drop("least"), "rollup-copies")
    store.commit("2-delete", token_rollup.signed(copies, -1))
    version = next(iter(token_rollup.TOKENIZERS))
    old = counted.filter(F.col("outer") & (F.col("tokenizer") == version)).join(
        copies.select("doc_id").distinct(), "doc_id", "left_anti")
    new = token_rollup.count(docs.filter(outer).join(copies.select("doc_id").distinct(), "doc_id", "left_anti")
                             .withColumn("text", single), ["source", "lang"], {version: token_rollup.TOKENIZERS[version]})
    store.commit("3-revise", token_rollup.signed(old, -1), token_rollup.signed(new, 1))
    store.commit("1-insert", insert)
    return store.totals()


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(_crc(4) != 2))
    return language_id.identify(docs, ["doc_id"], model).select(
        "doc_id", (_crc(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_read(spark, sf_dir, "documents"), ["doc_id"])
    base = "filter(findings, x -> x.kind in ('assign', 'access', 'hex'))"
    joined = "array_join(transform({}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    counts = {f"n_{k}": F.expr(f"size(filter(findings, x -> x.kind = '{k}'))").cast("long") for k in secret_scan.BASE}
    return found.select("doc_id", *(c.alias(k) for k, c in counts.items()),
                        F.sha2(F.expr(joined.format(base)), 256).alias("base_sha256"),
                        F.expr(joined.format("findings")).alias("spans"))


@query("op5_decontaminate")
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def captures(pages: DataFrame) -> DataFrame:
    """Pages as captures: the fetch time is derived from the page id (2024, to the minute)."""
    return pages.select("page_id", "url", F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(crc32(cast(page_id as string)) % 525600 as int))")
        .alias("fetched_at"))


def list_events(pages: DataFrame) -> DataFrame:
    """Dated list entries derived from the hosts of the pages: every third host is blocked for part of the year,
    and of those every third has its first folder allowed for another part."""
    host = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
    hosts = pages.select(F.expr(host).alias("host"), F.expr(
        "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]+)', 1)").alias("folder")).filter("host <> ''")
    hosts = hosts.groupBy("host").agg(F.min("folder").alias("folder")).withColumn(
        "c", F.expr("crc32(cast(host as binary))")).filter("c % 3 = 0")
    day = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast({} as int))"
    rows = ("stack(4, 'block', 'add', host, {a}, 'block', 'remove', host, {b}, "
            "'allow', 'add', concat(host, folder), {c}, 'allow', 'remove', concat(host, folder), {d}) "
            "as (list, action, pattern, at)").format(
        a=day.format("c % 120"), b=day.format("180 + c % 180"), c=day.format("30 + c % 90"), d=day.format("150 + c % 90"))
    return hosts.selectExpr("c", "folder", rows).filter("list = 'block' or (folder <> '' and c % 9 = 0)").select(
        "list", "action", "pattern", "at")


_URL = "^[A-Za-z][A-Za-z0-9+.-]*://"
URL_SQL = rf"""
WITH cut AS (
  SELECT page_id, url, lower(regexp_extract(url, '{_URL}(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
         regexp_extract(url, '{_URL}[^/?#]+(/[^/?#]+)', 1) AS folder,
         array_to_string(list_filter(string_split(lower(regexp_extract(url, '{_URL}[^/?#]+(/[^?#]*)', 1)), '/'),
                                     lambda x: x <> ''), '/') AS path,
         TIMESTAMP '2024-01-01' + to_minutes({_crc32_sql('page_id::VARCHAR')} % 525600) AS fetched_at
  FROM pages),
listed AS (SELECT host, {_crc32_sql('host')} AS c, min(folder) AS folder FROM cut WHERE host <> '' GROUP BY host),
entries AS (
  SELECT 'block' AS list, host AS at_host, '' AS at_path, TIMESTAMP '2024-01-01' + to_days((c % 120)::INTEGER) AS since,
         TIMESTAMP '2024-01-01' + to_days((180 + c % 180)::INTEGER) AS until
  FROM listed WHERE c % 3 = 0
  UNION ALL
  SELECT 'allow', host, lower(substr(folder, 2)), TIMESTAMP '2024-01-01' + to_days((30 + c % 90)::INTEGER),
         TIMESTAMP '2024-01-01' + to_days((150 + c % 90)::INTEGER)
  FROM listed WHERE c % 9 = 0 AND folder <> ''),
judged AS (
  SELECT page_id, url, fetched_at, list, at_host || CASE WHEN at_path = '' THEN '' ELSE '/' || at_path END AS matched
  FROM cut LEFT JOIN entries ON (host = at_host OR ends_with(host, '.' || at_host))
    AND (at_path = '' OR path = at_path OR starts_with(path, at_path || '/'))
    AND fetched_at >= since AND fetched_at < until)
SELECT page_id, url, fetched_at, matched, list, coalesce(list = 'block', FALSE) AS blocked
FROM judged
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(matched) DESC NULLS LAST, list = 'allow' DESC, matched DESC) = 1"""


@query("op7_url_filter", URL_SQL)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return url_filter.judge(captures(pages), list_events(pages))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = toxicity.fit(labels.filter(_crc(3) != 1), docs)
    return toxicity.score(docs, ["doc_id"], model).select(
        "doc_id", (_crc(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans")


@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_read(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "log_perplexity", "lower", "upper")


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests, _ = token_alignment.align_corpus(_read(spark, sf_dir, "documents"))
    return digests.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


#: Words of a table's texts.
_IMPORTANCE_WORDS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"""
IMPORTANCE_SQL = f"""
WITH d AS (SELECT doc_id, rowid AS r, {_IMPORTANCE_WORDS} AS word FROM {{docs}}),
per AS (SELECT doc_id, r, word, count(*) AS n FROM d GROUP BY ALL),
aim AS (SELECT word, count(*) AS n FROM (SELECT {_IMPORTANCE_WORDS} AS word FROM {{target}}) GROUP BY word),
hashed AS (SELECT word, {_crc32_sql('word')} % 10000 AS bucket FROM (SELECT word FROM per UNION SELECT word FROM aim)),
s AS (SELECT bucket, sum(n) AS s FROM per JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM aim JOIN hashed USING (word) GROUP BY bucket),
total AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS s, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS t),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * (total.s + 10000)
                                      / ((s.s + 1)::DOUBLE * (total.t + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket) CROSS JOIN total),
weight AS (
  SELECT r, sum(n) AS n_features, sum(n * gain) AS weight
  FROM per JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT x.doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(x.doc_id::VARCHAR, '')),
              1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM (SELECT doc_id, rowid AS r FROM {{docs}}) x LEFT JOIN weight USING (r)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS nth,
         count(*) FILTER (WHERE n_features >= 20) OVER () AS n
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND nth <= 10 * n // 100 THEN nth END AS rank
FROM ranked"""


@query("op12_importance", IMPORTANCE_SQL.format(
    docs="(SELECT *, row_number() OVER () AS rowid FROM documents)", target="benchmark"))
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


@query("op13_bpe_trie")
def op13_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_trie.encode(_read(spark, sf_dir, "documents"), ["doc_id"])
    return bpe_trie.decode(coded, ["doc_id", "n_tokens", "ids"]).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
