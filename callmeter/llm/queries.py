"""Registered queries: each applies one operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.llm import (
    chat_format,
    collocations,
    decontaminate,
    embed_dedup,
    langid,
    license_scan,
    line_dedup,
    lm_score,
    periodic_runs,
    quality,
    sentencepiece_codec,
    simhash_dedup,
    topk_search,
)
from callmeter.llm.common import table


def _fold(of: str, folds: int) -> Column:
    """Remainder of the CRC-32 of an id's decimal text."""
    return F.crc32(F.col(of).cast("string")) % folds


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"), _fold("doc_id", 7) == 2)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score_documents(docs, quality.fit(docs))
    return scored.select("doc_id", "votes", "posterior", "score", (F.col("score") >= 0.5).alias("rejected"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.without_recurring_lines(table(spark, sf_dir, "documents"))
    figures = {"n_lines": "__lines", "n_dropped": "__dropped", "emptied": "__emptied"}
    return out.select("doc_id", "text", *(F.col(old).alias(new) for new, old in figures.items()))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_codec.load_pieces()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.encode_documents(docs, pieces, check=True)
    return coded.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).alias("n_pieces"), "round_trip")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(_fold("doc_id", 4) == 2, F.lit(False)))
    model = langid.learn(docs.where("not held_out"))
    return langid.predict(docs, model, keep=("held_out",))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(
        periodic_runs.with_planted_runs(table(spark, sf_dir, "documents")), id_col="id", text_col="text"
    )
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    figures = found.select(
        "id",
        F.size("runs").cast("bigint").alias("n_runs"),
        longest.alias("longest"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return figures.select(
        F.col("id").alias("doc_id"),
        "n_runs",
        F.col("longest.start").alias("start"),
        (-F.col("longest.less")).alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("-1000 * longest.less div longest.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_score,
        op2_quality_classifier,
        op3_chat_format,
        op4_benchmark_decontamination,
        op5_embedding_dedup,
        op6_simhash_dedup,
        op7_line_dedup,
        op8_sentencepiece,
        op9_language_id,
        op10_license_scan,
        op11_topk_search,
        op12_collocations,
        op13_periodic_runs,
    )
}

ORACLE: dict[str, str] = {
    "op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
size AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
places AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM w WHERE len(ws) > 0),
f AS (
  SELECT lang, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase, count(*) AS a
  FROM places, (VALUES (1), (2), (3)) AS sizes(m) WHERE i + m - 1 <= len(ws)
  GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, array_to_string(string_split(phrase, ' ')[1:2], ' ') AS phrase, a FROM f WHERE m = 3
    UNION ALL
    SELECT lang, array_to_string(string_split(phrase, ' ')[2:3], ' '), a FROM f WHERE m = 3) GROUP BY lang, phrase),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k,
    array_to_string(string_split(c.phrase, ' ')[1:k], ' ') AS lhs,
    array_to_string(string_split(c.phrase, ' ')[k + 1 :], ' ') AS rhs
  FROM f c LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase, (VALUES (1), (2)) AS cutting(k)
  WHERE c.m > k AND NOT coalesce(100 * g.most >= 50 * c.a, false) AND c.m > 1),
scored AS (
  SELECT u.lang, u.phrase, u.a, l.a AS l, r.a AS r, k,
    CAST((1000000::HUGEINT * u.a * u.a) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM cuts u JOIN f l ON l.lang = u.lang AND l.phrase = u.lhs JOIN f r ON r.lang = u.lang AND r.phrase = u.rhs),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE cut = 1)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN size USING (lang) WHERE rank <= 2000""",
    "op11_topk_search": """
WITH v AS (SELECT row_number() OVER () AS place, vec_id, embedding FROM embeddings WHERE embedding IS NOT NULL),
c AS (
  SELECT place, vec_id, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS i, len(embedding) AS n FROM v),
usable AS (
  SELECT place, vec_id, i, n, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM c
  WHERE place NOT IN (SELECT place FROM c WHERE x IS NULL OR NOT isfinite(x))),
scored AS (
  SELECT q.vec_id AS query_id, q.place AS query, x.vec_id AS vec_id, CAST(sum(q.x * x.x) AS BIGINT) AS score
  FROM usable q JOIN usable x ON q.i = x.i AND q.n = x.n AND q.place <> x.place
  WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, q.place, x.vec_id, x.place),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id ASC NULLS LAST) AS INT) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
