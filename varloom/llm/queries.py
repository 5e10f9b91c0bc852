"""One query per training-data operator, over whole tables, and their SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm import (
    bpe,
    collocations,
    decontam,
    langid,
    licenses,
    linededup,
    periodic,
    pii,
    quality,
    sharding,
    simhash,
    topk,
    warc,
)
from varloom.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, folder, "documents").select("doc_id", tokenizer.round_trip("text").alias("b"))
    return docs.select(
        "doc_id",
        F.size("b.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("b.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("b.decoded"), 256).alias("decoded_sha256"),
    )


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontam.find_leaks(docs, table(spark, folder, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*")


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    archives = warc.write_archives(pages, warc.archive_folder(pages))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.read_archives(archives).select(*columns)


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text").withColumn("held_out", held_out())
    trees = quality.learn(docs, table(spark, folder, "labels").filter(~held_out()))
    scored = docs.select("doc_id", "held_out", quality.score(trees).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query
def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), "id % 20 = 0")


@query
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    dealt = sharding.shuffle(table(spark, folder, "documents").select("doc_id", "text"), 40)
    text = F.coalesce(F.col("text"), F.lit(""))
    size, crc = (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return dealt.select("doc_id", size, crc, law, "shard", "slot", grown)


@query
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.learn(docs))
    counts = [pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    base, spans = F.sha2(pii.written("base"), 256), pii.written("spans")
    return found.select("doc_id", *counts, base.alias("base_sha256"), spans.alias("spans"))


@query
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out())
    net = langid.learn(docs.filter("not held_out"))
    return langid.identify(docs, net).select("doc_id", "held_out", "lang_pred", "score")


@query
def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = linededup.drop_repeated(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


@query
def op13_periodic(spark: SparkSession, folder: str) -> DataFrame:
    """Of documents whose identifier's crc32 is divisible by 10, the words repeat from some place on."""
    docs = table(spark, folder, "documents").select("doc_id", periodic.looped("doc_id", "text").alias("text"))
    found = periodic.with_runs(docs)
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLE["op6_licenses"] = licenses.oracle()

# SHA-1 in base32: ten hex digits are eight letters of five bits.
ORACLE["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS sha FROM p),
g AS (SELECT sha, max(page_id) AS last FROM h GROUP BY sha),
letters AS (
  SELECT sha, last, [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
      CAST('0x' || substr(sha, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))::INTEGER) & 31)::INTEGER, 1)
    FOR i IN range(0, 32)] AS l
  FROM g)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, array_to_string(l, '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM h JOIN letters USING (sha)
"""

ORACLE["op7_topk"] = """
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLE["op11_line_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (f.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY r
"""

ORACLE["op12_collocations"] = """
WITH p AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS t
    FROM documents) CROSS JOIN LATERAL (SELECT [w FOR w IN string_split_regex(t, '[ \t]+') IF w <> ''] AS words)),
g AS (
  SELECT lang, words[s:s + m - 1] AS w, count(*) AS f
  FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS s FROM p) CROSS JOIN range(1, 6) AS x(m)
  WHERE s + m - 1 <= len(words) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM g WHERE len(w) = 1 GROUP BY lang),
h AS (SELECT * FROM g WHERE f >= 100),
c AS (SELECT * FROM h WHERE len(w) >= 2),
cuts AS (
  SELECT c.lang, c.w, c.f AS a, k, x.f AS l, y.f AS r, n.n,
    (1000::HUGEINT * c.f * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, len(w))) AS k FROM c) AS c
  JOIN h AS x ON x.lang = c.lang AND x.w = c.w[1:k] JOIN h AS y ON y.lang = c.lang AND y.w = c.w[k + 1:]
  JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
inside AS (
  SELECT lang, w[s:s + m - 1] AS w, max(f) AS longer
  FROM (SELECT *, unnest(range(1, len(w))) AS s FROM c) CROSS JOIN range(2, 5) AS x(m)
  WHERE s + m - 1 <= len(w) AND m < len(w) GROUP BY ALL
  UNION ALL SELECT lang, w[2:], f FROM c WHERE false),
kept AS (
  SELECT best.* FROM best LEFT JOIN (SELECT lang, w, max(longer) AS longer FROM (
    SELECT lang, w, longer FROM inside UNION ALL
    SELECT lang, w[len(w) - m + 1:] AS w, f AS longer FROM c CROSS JOIN range(2, 5) AS x(m) WHERE m < len(w)) GROUP BY ALL) AS i
  ON best.lang = i.lang AND best.w = i.w WHERE longer IS NULL OR 100 * longer < 100 * a),
ranked AS (
  SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
