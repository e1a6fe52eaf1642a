"""The registered queries of the operators and their expected results as SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bannerloom.llm import byte_bpe, embedding_dedup, embedding_whitening, license_scan, line_dedup, lm_score, ngram_join, packing
from bannerloom.llm import quality_classifier, quality_rules, sharding, spelling_variants, url_filter
from bannerloom.llm.common import fold
from bannerloom.llm.url_filter import Rule

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"
# fixed values of the contract
RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def sha256(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


@query(
    "op1_line_dedup",
    r"""WITH l AS (
  SELECT rowid AS r, UNNEST(string_split(COALESCE(text, ''), chr(10))) AS line,
         UNNEST(range(len(string_split(COALESCE(text, ''), chr(10))))) AS i
  FROM (SELECT row_number() OVER () AS rowid, text FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING COUNT(DISTINCT r) >= 10)
SELECT doc_id, COUNT(*) AS n_lines, CAST(COUNT(f.key) AS BIGINT) AS n_dropped,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key)
JOIN (SELECT row_number() OVER () AS r, doc_id FROM documents) d USING (r)
GROUP BY r, doc_id""",
)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more are dropped everywhere."""
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"), least=10)
    return done.select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards whose counts are at most one apart."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return sharding.place(rows, "doc_id", shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(
    "op4_url_filter",
    r"""WITH s AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
r(v, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT page_id, v, h || p AS rule, row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC, length(p) DESC) AS k
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, COALESCE(v, 'allow') AS verdict FROM u LEFT JOIN (SELECT * FROM m WHERE k = 1) USING (page_id)""",
)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url; without a rule it is allowed."""
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op7_quality_rules",
    r"""WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, source, COALESCE(text, '') AS text,
    list_filter(regexp_split_to_array(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT r, words, UNNEST(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
t AS (SELECT r, i FROM (SELECT r, i, COUNT(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n >= 2),
c AS (SELECT r, COUNT(DISTINCT i + d) AS n FROM t, UNNEST([0, 1, 2]) AS u(d) GROUP BY r),
m AS (SELECT w.r, doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  len(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, COALESCE(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, COUNT(*) AS docs, CAST(SUM(CASE WHEN base_failed OR 5 * n_symbols > n_words
  OR word_chars > 12 * n_words OR word_chars < 2 * n_words THEN 1 ELSE 0 END) AS BIGINT) AS failed
  FROM b WHERE source IS NOT NULL GROUP BY source),
a AS (SELECT SUM(failed) / SUM(docs) AS m, VAR_POP(failed / docs) AS v, AVG(1 / docs) AS noise FROM h),
p AS (SELECT m, greatest(m * (1 - m) / greatest(v - m * (1 - m) * noise, 1e-4) - 1, 1.0) AS weight FROM a),
q AS (SELECT source, docs, weight, (failed + m * weight) / (docs + weight) AS rate FROM h, p),
x AS (SELECT source FROM q WHERE rate - 2.0 * sqrt(rate * (1 - rate) / (docs + weight + 1)) > 0.7)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND x.source IS NULL AS kept FROM b LEFT JOIN x USING (source)""",
)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and host verdicts; the host of a document is its source."""
    return quality_rules.judge(table(spark, sf_dir, "documents", "doc_id", "source", "text"), carry=["doc_id"])


@query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that has not seen the labels of fold 2 of 4."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)
    return quality_classifier.score(docs, model).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all whole texts, and the bytes they decode to, as digests."""
    ranks = public_tokenizers.path(BYTE_RANKS)
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"), ranks, public_tokenizers.PATTERN, keep_text=False)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2,048 ids; only the last is padded."""
    pieces = packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(WORD_TOKENIZER), window=2048, end=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query(
    "op10_embedding_dedup",
    """WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS n, vec_id AS c FROM embeddings UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.n WHERE r.c < p.b),
k AS (SELECT n, MIN(c) AS c FROM r GROUP BY n)
SELECT e.vec_id, (SELECT COUNT(*) FROM p WHERE p.a = e.vec_id) AS n_links, k.c AS component_id, e.vec_id = k.c AS kept
FROM embeddings e JOIN k ON k.n = e.vec_id""",
)
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.93 and more between vectors of one label."""
    return embedding_dedup.dedup(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), threshold=0.93)


@query("op5_lm_score")
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the nine folds of ten that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = F.coalesce(fold(F.col("doc_id"), 10) == 0, F.lit(False))
    return lm_score.score(docs, ~out).select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op2_ngram_join")
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return ngram_join.join(table(spark, sf_dir, "documents", "doc_id", "text"), n=3, percent=90)


def license_sql() -> str:
    """The templates as regular expressions over the words of a text, the base phrases as lists of words."""
    templates = license_scan.TEMPLATES
    found = [f"regexp_matches(line, '{license_scan.as_pattern(license_scan.parse(t.text))} ')" for t in templates]
    labels = ", ".join(f"CASE WHEN {f} THEN '{t.label}' END" for t, f in zip(templates, found) if not t.base)
    base = [(t.label, license_scan.parse(t.text)) for t in templates if t.base]
    places = ", ".join(
        f"""list_transform(list_filter(range(1, len(words) + 1), lambda i: {" AND ".join(f"words[i + {k}] = '{w.decode()}'" for k, w in enumerate(phrase))}),
    lambda i: {{'label': '{label}', 'at': i - 1}})"""
        for label, phrase in base
    )
    sure = ", ".join(f"CASE WHEN {f} THEN {license_scan.strength(t)!r} ELSE 0.0 END" for t, f in zip(templates, found))
    return f"""WITH w AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
p AS (SELECT *, ' ' || array_to_string(words, ' ') || ' ' AS line, flatten([{places}]) AS places FROM w),
l AS (SELECT *, list_distinct(list_transform(places, lambda x: x.label)) AS base, list_filter([{labels}], lambda x: x IS NOT NULL) AS more FROM p)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
  list_min(list_transform(places, lambda x: x.at)) AS first_word, list_max(list_transform(places, lambda x: x.at)) AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(base, more))), ',') AS labels,
  CAST(greatest({sure}) AS DOUBLE) AS score FROM l"""


@query("op11_license_scan", license_sql())
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses and notices in all documents, and the places of the three base phrases."""
    scanned = license_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"), carry=["doc_id"])
    base, all_ = F.filter("matches", lambda m: m["base"]), F.col("matches")

    def labels(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda m: m["label"]))), ",")

    at = F.transform(base, lambda m: m["first_word"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        labels(base).alias("base_labels"), labels(all_).alias("labels"),
        F.coalesce(F.array_max(F.transform(all_, lambda m: m["strength"])), F.lit(0.0)).alias("score"),
    )


@query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of seven letters or more, of which every 31st run has lost a letter, with their more frequent forms."""
    found = spelling_variants.variants(table(spark, sf_dir, "documents", "doc_id", "text"), noise=31, least=7, twice=2, times=10)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of all embeddings, a row for each."""
    white = embedding_whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), components=8)
    return white.select("*", F.posexplode("whitened").alias("at", "one")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        F.col("one").alias("whitened"), F.expr("explained[at]").alias("explained"), "identity_error",
    )
