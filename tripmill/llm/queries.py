"""One query for each operator over the whole given tables, with SQL where it can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripmill.llm import fertility, language, toxicity
from tripmill.llm.common import LOWER, UPPER, table
from tripmill.llm.decontaminate import find_contamination
from tripmill.llm.line_dedup import dedup_lines
from tripmill.llm.neighbours import nearest
from tripmill.llm.periodic import periodic_runs, run_lines, strongest
from tripmill.llm.pieces import decode_pieces, encode_pieces
from tripmill.llm.repeats import cut_repeats
from tripmill.llm.simhash import hex_of, near_duplicates
from tripmill.llm.token_files import read_token_files, write_token_files
from tripmill.llm.url_filter import judge_urls
from tripmill.llm.whitening import fixed_point, whiten
from tripmill.session import workspace

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block")]


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest other vectors of every hundredth vector."""
    found = nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, 10)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"),
                        "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), hex_of(F.col("fp")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled documents of two thirds of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language.fit(docs.where(~held_out))
    return language.predict(docs, model, label=held_out.cast("string")).select(
        F.col("id").alias("doc_id"), F.col("label").cast("boolean").alias("held_out"),
        F.col("lang").alias("lang_pred"), "score", "rejected")


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document without those inside repeated stretches of 200 bytes."""
    found = cut_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed",
                        F.size("spans").cast("bigint").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines repeated in three or more documents stay only in the largest document id."""
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped",
                       F.sha2("text", 256).alias("kept_sha256"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside windows of ten words of benchmark items."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and verdict of every page."""
    rules = table_of_rules(spark)
    return judge_urls(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, model).select(
        F.col("id").alias("doc_id"), "severity", "grade", "toxic")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, read back from the files they were written to."""
    files = write_token_files(table(spark, sf_dir, "documents"), workspace(spark, "tokens"),
                              public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(files).select(
        F.col("id").alias("doc_id"), "start",
        F.floor(F.length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text they decode to, as digests."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), model), model)
    return found.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, token measures and verdict of every document."""
    found = fertility.quality(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "script", "n_tokens", "chars_per_token",
        "byte_share", "evenness", F.array_join("odd", ",").alias("odd"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sixteen strongest components of every vector, scaled to unit variance."""
    rows = table(spark, sf_dir, "embeddings")
    found, model, error = whiten(rows, fixed_point(F.col("embedding"), 64, 1_000_000))
    shares = [v / model.trace for v in model.values] if error is not None else []
    explained = F.array(*map(F.lit, shares)).cast("array<double>")
    return found.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("bigint").alias("n"),
        F.col("deviation").try_cast("bigint").alias("deviation"), "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, after a tenth of them were given one by rule."""
    docs = with_given_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(docs).withColumn("best", strongest(F.col("runs")))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(run_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_given_runs(docs: DataFrame) -> DataFrame:
    """Documents whose id's CRC-32 ends in 0 go on, from some word, with that stretch repeated."""
    words = r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"
    rows = docs.selectExpr("doc_id", "text", "crc32(CAST(doc_id AS STRING)) AS h")
    rows = rows.selectExpr("doc_id", "text", "h div 10 AS g",
                           f"CASE WHEN h % 10 = 0 THEN {words} END AS words")
    rows = rows.selectExpr("*", "g % nullif(size(words), 0) AS a")
    rows = rows.selectExpr("*", "1 + (size(words) - a) div (3 + g % 8) AS p")
    return rows.selectExpr("doc_id", """
        CASE WHEN size(words) > 0 THEN array_join(transform(
          sequence(0, size(words) - 1),
          i -> words[CAST(CASE WHEN i < a THEN i ELSE a + (i - a) % p END AS INT)]), ' ')
        ELSE text END AS text""")


def table_of_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(URL_RULES, "host string, path string, action string")


QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_simhash": op2_simhash,
    "op3_language": op3_language,
    "op4_repeats": op4_repeats,
    "op5_line_dedup": op5_line_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_url_rules": op7_url_rules,
    "op8_toxicity": op8_toxicity,
    "op9_token_files": op9_token_files,
    "op10_pieces": op10_pieces,
    "op11_fertility": op11_fertility,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES = {
    "op5_line_dedup": f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM split),
keyed AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                    '{UPPER}', '{LOWER}') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, i, line, r.key IS NOT NULL AND r.last <> k.doc_id AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op6_decontamination": rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
    SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i
    FROM item WHERE len(w) > 0)),
doc_window AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM doc_window JOIN item_window USING (n, win)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op7_url_rules": rf"""
WITH split AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
page AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM split),
rule(rhost, rpath, action) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (
  SELECT page_id, rhost || rpath AS rule, action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS place
  FROM page JOIN rule ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM page LEFT JOIN (SELECT * FROM fit WHERE place = 1) USING (page_id)""",
}
