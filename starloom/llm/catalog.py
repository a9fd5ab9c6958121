"""The operators bound to the benchmark tables, with SQL checks where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog.base import Query, table
from starloom.llm import (
    alignment, chat, classifier, digests, html, mixing, neardup, nearvectors, packing, rules, tokens, urls, whitening,
)

ALL: dict[str, Query] = {}


def _query(sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, sf_dir)

        ALL[build.__name__] = Query(run, sql)
        return build

    return register


@_query()
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urls.train(urls.seed_urls(spark))
    return urls.judge_urls(table(spark, sf_dir, "pages"), model)


@_query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024
    ).select("doc_id", "n_bytes", "n_tokens", "over_limit")


_MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM s),
f AS (
  SELECT *,
    total - coalesce(sum(cap) OVER (ORDER BY source_size / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left
  FROM w),
level AS (
  SELECT max_by(rest, weights_left) AS words, max(weights_left) AS weights
  FROM f WHERE rest * weight <= cap * weights_left),
t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE),
    coalesce(CAST(words AS DOUBLE) * weight / CAST(weights AS DOUBLE), CAST(cap AS DOUBLE))) AS target
  FROM f CROSS JOIN level),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS BIGINT) AS through,
    CAST(sum(d.size) OVER (PARTITION BY d.source, d.h) AS BIGINT) AS same
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS copies,
    CASE WHEN source_size > 0 THEN goal % source_size ELSE 0 END AS quota
  FROM r)
SELECT doc_id, size, source_size, target, CAST(copies * size + CASE
    WHEN through <= quota THEN size
    WHEN through - same >= quota THEN 0
    ELSE size * (quota - through + same) // same END AS BIGINT) AS taken
FROM q
"""


@_query(_MIX_SQL)
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@_query()
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages"))


@_query()
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query()
def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearvectors.link_vectors(table(spark, sf_dir, "embeddings"))


_CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
m AS (
  SELECT *, length(role) + length(text) + 9
      + length(regexp_replace(role || text, '[^\\<\[\]]', '', 'g')) AS marked,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    count(*) OVER (PARTITION BY conv_id) AS turns
  FROM c),
n AS (
  SELECT *, count(*) FILTER (role = 'assistant' OR place = turns) OVER (
      PARTITION BY conv_id ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS examples
  FROM m)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(marked * examples) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""


@_query(_CHAT_SQL)
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what the formatted examples hold, read back from them."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string"
    )
    examples = chat.prefix_targets(turns.unionByName(more))
    said = F.transform(
        chat.turns_of(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    whole = F.when(F.col("covers_all"), F.struct(F.size(said).alias("n"), F.sha2(F.array_join(said, ""), 256).alias("h")))
    read = examples.select(
        "conv_id",
        whole.alias("whole"),
        F.struct(
            "target", chat.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("loss")
        ).alias("piece"),
        F.length("text").cast("long").alias("chars"),
    )
    gathered = read.groupBy("conv_id").agg(
        F.max("whole").alias("whole"),
        F.sort_array(F.collect_list("piece")).alias("pieces"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("pieces", lambda p: p["loss"]), "")
    return gathered.select(
        "conv_id",
        F.col("whole.n").cast("long").alias("n_turns"),
        F.col("whole.h").alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@_query()
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset", "sequence_length", "step_id",
    )


@_query()
def op9_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def _rules_sql() -> str:
    """The rules written out over the counts of a CTE named c."""
    broken = []
    for rule in rules.RULES:
        if rule.least is not None:
            broken.append(f"{rule.part} * 100 < {rule.whole} * {rule.least}")
        if rule.most is not None:
            broken.append(f"{rule.part} * 100 > {rule.whole} * {rule.most}")
    return " OR ".join(broken)


_STOPS = ", ".join(f"'{w}'" for w in rules.STOP_FORMS)
_RULES_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
win AS (
  SELECT r, i, list_slice(w, i, i + 7) AS x FROM (
    SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
again AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, x) > 1),
rep AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again CROSS JOIN (SELECT unnest(range(0, 8)) AS k) GROUP BY r),
c AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    len(regexp_extract_all(t, '[!?]')) AS n_marks,
    len(regexp_extract_all(t, '\p{{Lu}}')) AS n_capitals,
    len(list_filter(w, lambda x: list_contains([{_STOPS}], x))) AS n_stop_words,
    coalesce(list_sum(list_transform(range(0, (len(w) + 999) // 1000),
      lambda k: len(list_distinct(list_slice(w, k * 1000 + 1, k * 1000 + 1000))))), 0) AS n_distinct_words,
    len(l) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({_rules_sql()}) AS kept
FROM b
"""


@_query(_RULES_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[F.col(f"counts.{n}").alias(n) for n in names], "base_failed", "kept")


@_query()
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@_query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)
    return told.withColumn("deviation", F.col("deviation").cast("long"))


@_query()
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.edit_with_next(table(spark, sf_dir, "documents"))
