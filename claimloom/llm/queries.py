"""Registered queries of the numbered operators: thin callers with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import (
    decontamination,
    language_id,
    packing,
    periodic_runs,
    phrases,
    quality,
    repeated_bytes,
    sharding,
    simhash,
    suffix_tree,
    toxicity,
    url_filter,
    vector_search,
)
from claimloom.llm.common import held_out, table


def tokenizer() -> tuple[str, str]:
    """Vocabulary file and pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out("doc_id", 5, 1).alias("held_out"), "text")
    return suffix_tree.score_texts(docs)


RULES = [
    url_filter.Rule(url_filter.ALLOW, "com/"),
    url_filter.Rule(url_filter.BLOCK, "example.com/en/"),
    url_filter.Rule(url_filter.ALLOW, "www.example.com/en/"),
    url_filter.Rule(url_filter.BLOCK, "net/es/"),
    url_filter.Rule(url_filter.BLOCK, "net/fr/"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), RULES)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels of those not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels, ~held_out("doc_id", 4, 2))
    scored = quality.with_quality(docs.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels of those not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels, ~held_out("doc_id", 3, 1))
    scored = toxicity.with_toxicity(docs.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and linked group of every document."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1,024 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), *tokenizer(), with_ids=False, special_ids=True)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out("doc_id", 4, 2).alias("held_out"))
    profiles = language_id.learn_profiles(docs.filter(~F.col("held_out")))
    return language_id.identify_languages(docs.select("doc_id", "held_out", "text"), profiles)


def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every row whose id is divisible by 50."""
    return vector_search.nearest_vectors(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of every language."""
    return phrases.collocations(phrases.frequent_phrases(table(spark, sf_dir, "documents")))


def _with_planted_run(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; in one document of ten, by the digest of its id, the end of the text repeats words before it."""
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    count = F.size("words").cast("long")
    parts = (
        docs.select("doc_id", "text", digest.alias("digest"))
        .withColumn("words", F.when(F.col("digest") % 10 == 0, words))
        .withColumn("start", F.floor(F.col("digest") / 10) % count)
        .withColumn("period", 1 + F.floor((count - F.col("start")) / (3 + F.floor(F.col("digest") / 10) % 8)))
    )
    start, period = F.col("start"), F.col("period")
    place = lambda i: F.when(i < start, i).otherwise(start + (i - start) % period)
    planted = F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda i: F.col("words")[place(i)])
    return parts.select("doc_id", F.when((F.col("digest") % 10 == 0) & (count > 0), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of every document, as digests, and the longest of them."""
    found = periodic_runs.word_runs(_with_planted_run(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("shortness"), r.start, r.period)))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    length = -F.col("longest.shortness")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"), length.alias("length"), F.col("longest.period").alias("period"),
        F.floor(1000 * length / F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that occur elsewhere."""
    found = repeated_bytes.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span.length)
    return found.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {
    "op1_suffix_tree": op1_suffix_tree,
    "op2_url_filter": op2_url_filter,
    "op3_quality": op3_quality,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_sharding": op7_sharding,
    "op4_packing": op4_packing,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op10_nearest_vectors": op10_nearest_vectors,
    "op11_phrases": op11_phrases,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_repeated_bytes": op13_repeated_bytes,
}

ORACLES = {
    "op10_nearest_vectors": """
WITH usable AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.embedding, c.embedding) AS score
  FROM usable q JOIN usable c ON q.n <> c.n AND len(q.embedding) = len(c.embedding)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
""",
    "op11_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
placed AS (
  SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS pos
  FROM worded, (VALUES (1), (2), (3), (4)) lengths(k) WHERE len(words) >= k),
totals AS (SELECT lang, count(*) AS n FROM placed WHERE k = 1 GROUP BY lang),
frequent AS (
  SELECT lang, k, array_to_string(words[pos : pos + k - 1], ' ') AS phrase, count(*) AS f
  FROM placed GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS words, unnest(range(1, k)) AS cut FROM frequent WHERE k > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r,
    (CAST(c.a AS HUGEINT) * 2000000) // (CAST(l.f AS HUGEINT) + r.f) AS score
  FROM cuts c
  JOIN frequent l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1 : c.cut], ' ')
  JOIN frequent r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[c.cut + 1 :], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT lang, a, words, part_length, unnest(range(1, k - part_length + 2)) AS pos
  FROM (SELECT DISTINCT lang, phrase, k, a, words FROM cuts), (VALUES (2), (3)) lengths(part_length) WHERE part_length < k),
covering AS (
  SELECT lang, array_to_string(words[pos : pos + part_length - 1], ' ') AS phrase, max(a) AS longer FROM inner_parts GROUP BY ALL),
ranked AS (
  SELECT w.lang, w.phrase, w.a, w.l, w.r, w.score,
    row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS place
  FROM lowest w LEFT JOIN covering v ON v.lang = w.lang AND v.phrase = w.phrase
  WHERE v.longer IS NULL OR CAST(v.longer AS HUGEINT) * 100 < CAST(w.a AS HUGEINT) * 80)
SELECT ranked.lang, place AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE place <= 2000
""",
    "op13_repeated_bytes": """
WITH numbered AS (SELECT row_number() OVER () AS row_id, doc_id, encode(coalesce(text, '')) AS bytes FROM documents),
hexed AS (SELECT row_id, doc_id, octet_length(bytes) AS n_bytes, hex(bytes) AS digits FROM numbered),
strings AS (SELECT row_id, unnest(range(0, n_bytes - 199)) AS pos FROM hexed WHERE n_bytes >= 200),
named AS (SELECT row_id, pos, md5_number(substr(digits, 2 * pos + 1, 400)) AS name FROM strings JOIN hexed USING (row_id)),
repeated AS (SELECT row_id, pos FROM named WHERE name IN (SELECT name FROM named GROUP BY name HAVING count(*) > 1)),
marked AS (
  SELECT row_id, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY row_id ORDER BY pos) + 200 THEN 0 ELSE 1 END AS opens FROM repeated),
grouped AS (SELECT row_id, pos, sum(opens) OVER (PARTITION BY row_id ORDER BY pos) AS span FROM marked),
spans AS (SELECT row_id, span, min(pos) AS start, max(pos) + 200 AS stop FROM grouped GROUP BY ALL),
borders AS (
  SELECT row_id, start, stop, coalesce(lag(stop) OVER (PARTITION BY row_id ORDER BY start), 0) AS before FROM spans),
kept AS (
  SELECT b.row_id, count(*) AS n_spans, sum(stop - start) AS n_removed, max(stop) AS last_stop,
    string_agg(substr(h.digits, 2 * before + 1, 2 * (start - before)), '' ORDER BY start) AS head
  FROM borders b JOIN hexed h USING (row_id) GROUP BY b.row_id)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head || substr(digits, 2 * last_stop + 1), digits))) AS kept_sha256
FROM hexed LEFT JOIN kept USING (row_id)
""",
}
