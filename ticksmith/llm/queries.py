"""Registered queries of the training-data operators (one per operator,
production parameters, whole tables) and their SQL twins where SQL can
state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, fingerprints, jaccard, licenses, mixing, neardup, packing, periodic, pii, ppm, quality, toxicity, warc
from .common import fold, read

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

QUALITY_FOLD, TOXIC_FOLD, LANGUAGE_FOLD = (4, 2), (5, 0), (3, 1)     # (folds, held-out remainder)
QUALITY_KEEP, TOXIC_KEEP = 0.7, 0.5


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(query: Query) -> Query:
        REGISTRY[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query
    return put


NEARDUP_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c USING (vec_id) LEFT JOIN deg d USING (vec_id)
"""


@register("op1_embedding_neardup", NEARDUP_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "embeddings"))


@register("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Crf | None:
    folds, out = QUALITY_FOLD
    return quality.train(docs, read(spark, sf_dir, "labels"), fold("doc_id", folds) != out)


@register("op3_quality_crf")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folds, out = QUALITY_FOLD
    scored = quality.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", (fold("doc_id", folds) == out).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_KEEP).cast("int").alias("predicted"))


@register("op4_pack_ffd")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_file())


@register("op5_toxicity_ftrl")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folds, out = TOXIC_FOLD
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), fold("doc_id", folds) != out)
    return toxicity.score(docs, model).select("doc_id", (fold("doc_id", folds) == out).alias("held_out"), "score",
                                              (F.col("score") >= TOXIC_KEEP).cast("int").alias("predicted"))


JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, string_split_regex(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w = [''] THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id FROM sets s JOIN comp c USING (doc_id)
"""


@register("op6_jaccard_trie", JACCARD_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"))


def language_model(docs: DataFrame) -> ppm.Model:
    folds, out = LANGUAGE_FOLD
    return ppm.train(docs, fold("doc_id", folds) != out)


@register("op7_language_ppm")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folds, out = LANGUAGE_FOLD
    return ppm.predict(docs, language_model(docs)).select("doc_id", (fold("doc_id", folds) == out).alias("held_out"), "lang_pred", "score")


@register("op8_mix_pivotal")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op9_fingerprint_lcp")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours(read(spark, sf_dir, "documents"))


WARC_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
d AS (
  SELECT page_id, payload_bytes, translate(array_to_string([lpad(to_base(CAST(('0x' || hex[5 * k + 1:5 * k + 5]) AS BIGINT), 32), 4, '0')
    FOR k IN range(8)], ''), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN f USING (payload_digest)
"""


@register("op10_warc_index", WARC_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(read(spark, sf_dir, "pages"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
own AS (SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source)
  + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM f),
m AS (SELECT lang, term, sum(n) AS n FROM f GROUP BY lang, term),
whole AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER (PARTITION BY lang)
  + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM m),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM own a JOIN own b
  ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value FROM g a
    JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT own.lang, own.source, 'term', own.term, CAST(p - q AS BIGINT) FROM own JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@register("op11_divergence_mph", DIVERGENCE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``: the texts whose crc32 of the id ends in 0 go on
    periodically from a word that the checksum picks.  A null id or a text
    without words is left as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    own = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words")).withColumn("n", F.size("words"))
    long = own.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    long = long.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    head = F.slice("words", F.lit(1), F.col("a"))
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    edited = F.array_join(F.slice(F.concat(head, tail), F.lit(1), F.col("n")), " ")
    return long.select("doc_id", F.when(F.col("n") > 0, edited).otherwise(F.col("text")).alias("text"))


@register("op12_periodic_recompression")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_repeats(read(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), "best.length",
                    (-F.col("best.less")).alias("period"),
                    F.floor(1000 * F.col("best.length") / -F.col("best.less")).alias("exponent_milli"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


@register("op13_pii_lstm_crf")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.train(docs))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
