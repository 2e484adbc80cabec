"""The corpus operators as registered queries, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold.llm import (
    centroids,
    decontaminate,
    line_dedup,
    lm,
    mixing,
    near_dups,
    phrases,
    quality,
    shards,
    token_counts,
    toxicity,
    urls,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql.strip()
        return build

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+')"


@_query(
    rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
    ELSE array_to_string(ws[i:i+4], ' ') END AS s
  FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= 75 * (na.n + nb.n - shared)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""
)
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return near_dups.near_duplicates(_table(spark, sf_dir, "documents"))


_ALNUM = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_query(
    rf"""
WITH d AS (SELECT doc_id, {_ALNUM} AS ws FROM documents),
b AS (SELECT item_id, {_ALNUM} AS ws FROM benchmark),
pattern AS (
  SELECT DISTINCT item_id, len(ws[i:i+9]) AS n, array_to_string(ws[i:i+9], ' ') AS p
  FROM b, unnest(range(1, greatest(len(ws) - 8, 2))) AS t(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM pattern),
place AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i+n-1], ' ') AS p
  FROM d, unnest(range(1, len(ws) + 1)) AS t(i), sizes WHERE i + n - 1 <= len(ws)),
hit AS (SELECT pl.doc_id, pl.i, pl.n, pa.item_id FROM place pl JOIN pattern pa ON pa.p = pl.p AND pa.n = pl.n),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) AS t(k) GROUP BY 1),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN listed l ON l.doc_id = d.doc_id
"""
)
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in passages of the benchmark."""
    found = decontaminate.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@_query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model of the labels that are not held out."""
    documents = _table(spark, sf_dir, "documents")
    scores = toxicity.score(documents, toxicity.fit(documents, _table(spark, sf_dir, "labels")))
    return scores.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


#: Tokenizer of op8_token_counts, by its public name.
TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


@_query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    counted = token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@_query()
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources takes of every document."""
    taken = mixing.mix(_table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source")


_LINE = r"trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


@_query(
    rf"""
WITH l AS (
  SELECT doc_id, i, x, {_LINE} AS line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE text IS NOT NULL)),
w AS (
  SELECT doc_id, i AS low, lead(i, 2) OVER p AS high, line AS a, lead(line) OVER p AS b, lead(line, 2) OVER p AS c
  FROM l WHERE line <> '' WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
later AS (
  SELECT doc_id, low, high FROM (
    SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, low) AS n FROM w WHERE high IS NOT NULL)
  WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(low, high + 1)) AS i FROM later),
texts AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
    string_agg(l.x, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS text
  FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY 1)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN coalesce(t.text, '') END AS text
FROM documents d LEFT JOIN texts t ON t.doc_id = d.doc_id
"""
)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without passages of three lines that stood earlier."""
    return line_dedup.without_repeated_lines(_table(spark, sf_dir, "documents"))


SHARDS = 24


@_query()
def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = shards.shard(rows, SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document against its language's usual text."""
    documents = _table(spark, sf_dir, "documents")
    return quality.quality(documents, quality.references(documents))


@_query()
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL by policy and mined rules."""
    return urls.judge(_table(spark, sf_dir, "pages"))


@_query()
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document by a model of those not held out."""
    scores = lm.score(_table(spark, sf_dir, "documents"), ~lm.held_out(F.col("doc_id")))
    return scores.select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def _round(k: int) -> str:
    """Assignment ``a{k}`` to the centroids ``c{k}`` and the next centroids."""
    return f"""
a{k} AS MATERIALIZED (
  SELECT r, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
    SELECT v.r, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{k} c ON c.i = v.i GROUP BY 1, 2) GROUP BY 1),
c{k + 1} AS MATERIALIZED (
  SELECT c.k, c.i, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN (
    SELECT a.k, v.i, (sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS x
    FROM v JOIN a{k} a ON a.r = v.r GROUP BY 1, 2) m ON m.k = c.k AND m.i = c.i),"""


@_query(
    f"""
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (
  SELECT r, vec_id, generate_subscripts(embedding, 1) AS i,
    CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS HUGEINT) AS x FROM e),
first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM e
  QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id)) <= 8),
c0 AS MATERIALIZED (SELECT f.k, v.i, v.x FROM first f JOIN v ON v.r = f.r),
{"".join(_round(k) for k in range(11)).strip()}
digest AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c10 GROUP BY 1)
SELECT e.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  digest.h AS centroid_sha256
FROM e JOIN a10 a ON a.r = e.r JOIN digest ON digest.k = a.k
"""
)
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds of exact k-means."""
    return centroids.cluster_report(_table(spark, sf_dir, "embeddings"))


@_query(
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS first FROM p WHERE strlen(html) >= 1000 GROUP BY 1)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN p.page_id IS DISTINCT FROM g.first AND g.first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.page_id IS DISTINCT FROM g.first THEN g.first END AS refers_to
FROM p LEFT JOIN g ON g.html = p.html
"""
)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as it is read back from the archives."""
    read = warc.read_records(warc.write_archives(_table(spark, sf_dir, "pages")))
    return read.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


@_query(
    rf"""
WITH p AS (
  SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_FOLDED}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY 1),
w AS (SELECT id, lang, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM p),
runs AS (
  SELECT lang, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY id ORDER BY i)),
f AS MATERIALIZED (
  SELECT lang, len(ws) AS size, array_to_string(ws, ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, unnest([[a], CASE WHEN b IS NOT NULL THEN [a, b] END, CASE WHEN c IS NOT NULL THEN [a, b, c] END]) AS ws
    FROM runs) WHERE ws IS NOT NULL GROUP BY ALL),
cand AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE a >= 10 AND size > 1),
parts AS (
  SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k+1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand)),
cut AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, k,
    CAST((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM parts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp),
scored AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
  SELECT lang, part, max(a) AS a FROM (
    SELECT lang, a, array_to_string(ws[1:2], ' ') AS part FROM cand WHERE size = 3
    UNION ALL SELECT lang, a, array_to_string(ws[2:3], ' ') FROM cand WHERE size = 3) GROUP BY 1, 2),
ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank,
    s.phrase, s.a, s.l, s.r, s.score
  FROM scored s LEFT JOIN around o ON o.lang = s.lang AND o.part = s.phrase
  WHERE o.a IS NULL OR 100 * o.a < 50 * s.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words keep together most."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))
