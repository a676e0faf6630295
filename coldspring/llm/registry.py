"""The registered queries of these operators, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldspring.llm import (bpe, chat_format, decontaminate, html_extract, language_id, line_quality, mixing, near_dedup, pairwise_quality, run_detection,
                            suffix_dedup, url_filter, whitening)
from coldspring.workspace import Workspace

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, folder, "documents"), Workspace(spark))


def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    config = near_dedup.NearConfig(width=4)
    return near_dedup.near_groups(_table(spark, folder, "documents"), Workspace(spark), config)


def op3_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return html_extract.extract_pages(pages, html_extract.fit_extractor(pages))


def _fold(folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; ids that are null are in no fold."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    profiles = language_id.learn_profiles(docs.filter(_fold(4) != 2))
    found = language_id.identify(docs, profiles)
    return found.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    ranking = pairwise_quality.learn_ranking(docs, _table(spark, folder, "labels").filter(_fold(5) != 0))
    found = pairwise_quality.score_documents(docs, ranking)
    return found.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations")
    chain = chat_format.learn_chain(turns)
    return chat_format.parse_transcripts(chat_format.written_transcripts(turns), chain, Workspace(spark))


def op7_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    field = line_quality.fit_lines(docs, _table(spark, folder, "labels"))
    return line_quality.judge_documents(docs, field)


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"), Workspace(spark))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    # built as literals: a list of Python rows would be read by a Python worker
    literals = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), rule)]) for rule in RULES]
    rules = spark.range(1).select(F.inline(F.array(*literals)))
    return url_filter.judge_urls(_table(spark, folder, "pages"), rules, Workspace(spark))


def repeating_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one document of ten, by the crc32 of its id, the words from some place on repeat a stretch of
    their own. Rows without an id keep their text."""
    draw = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(draw % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    drawn = docs.select("doc_id", "text", words.alias("_words"), ((draw - draw % 10) / 10).cast("long").alias("_g"))
    placed = drawn.withColumn("_n", F.size("_words")).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    rest = F.col("_n") - F.col("_a")
    period = (1 + F.floor(rest / (3 + F.col("_g") % 8))).cast("int")
    sized = placed.withColumn("_p", period)
    again = F.flatten(F.array_repeat(F.slice("_words", F.col("_a") + 1, F.col("_p")), F.ceil(rest / F.col("_p")).cast("int")))
    text = F.array_join(F.slice(F.concat(F.slice("_words", F.lit(1), F.col("_a")), again), F.lit(1), F.col("_n")), " ")
    return sized.select("doc_id", F.when(F.col("_a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = run_detection.periodic_runs(repeating_texts(_table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("fine"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("_best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.back")).alias("start"), F.col("_best.length").alias("length"),
        (-F.col("_best.fine")).alias("period"), F.expr("(1000 * _best.length) div (-_best.fine)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    merges = bpe.read_merges(public_tokenizers.path("word_bpe_49k.json"))
    found = bpe.encode(_table(spark, folder, "documents"), merges)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors, Workspace(spark)))


_OP9_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS draw
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS words FROM sizes GROUP BY source),
weighed AS (
  SELECT source, words, (2 * words)::DOUBLE AS cap,
         CASE (row_number() OVER (ORDER BY (source IS NULL)::INT, encode(source)) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM per_source),
levels AS (
  SELECT *, coalesce(sum(cap) OVER up, 0) AS cap_before, coalesce(sum(weight) OVER up, 0) AS weight_before,
         sum(weight) OVER () AS weights, 1.5::DOUBLE * sum(words) OVER () AS budget
  FROM weighed
  WINDOW up AS (ORDER BY cap / weight, (source IS NULL)::INT, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (
  SELECT *, cap_before + cap / weight * (weights - weight_before) <= budget AS is_full FROM levels),
targets AS (
  SELECT source, words, CASE WHEN is_full THEN cap ELSE
    (budget - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) / (weights - coalesce(sum(weight) FILTER (is_full) OVER (), 0)) * weight END AS target
  FROM marked),
placed AS (
  SELECT *, (coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS before
  FROM sizes)
SELECT p.doc_id, p.source, p.size, t.words AS source_size, t.target,
       (greatest(0, least(p.size, floor(t.target)::BIGINT - p.before)) + greatest(0, least(p.size, floor(t.target)::BIGINT - t.words - p.before)))::BIGINT AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
"""

_OP10_SQL = r"""
WITH rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
split AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split),
best AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path) * 10000 + length(rule_host)) AS rule,
         arg_max(verdict, length(rule_host || rule_path) * 10000 + length(rule_host)) AS verdict
  FROM parts JOIN rules ON ends_with('.' || host, '.' || rule_host) AND starts_with(path, rule_path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)
"""

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_suffix_dedup, op2_near_dedup, op3_html_extract, op4_language_id, op5_pairwise_quality, op6_chat_format, op7_line_quality, op8_decontaminate, op9_mixing, op10_url_filter,
                                                                                  op11_periodic_runs, op12_bpe_codec, op13_whitening)}
_SQL = {"op9_mixing": _OP9_SQL, "op10_url_filter": _OP10_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
