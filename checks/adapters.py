"""Views of the given test tables in the shapes the library works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.sources.tables import load_dimension, read_table, spread_small

AS_OF = "2024-01-31 00:00:00"
FEATURES_AS_OF = "2001-08-01 00:00:00"
HIGH_STAKES = ("error", "purchase")
GENERIC_TOPICS = ("signup",)


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as conversation turns: the event type is the topic."""
    events = read_table(spark, "events", sf_dir)
    return events.select(
        F.col("event_id").cast("string").alias("ext_id"),
        F.concat(
            F.col("user_id").cast("string"), F.lit("@"), F.date_format("ts", "yyyy-MM-dd")
        ).alias("session_id"),
        (F.col("user_id") % 12).cast("string").alias("rep_id"),
        (F.col("event_id") % 60).cast("string").alias("hcp_id"),
        F.get_json_object("props", "$.k").cast("int").alias("turn_index"),
        F.lit("user").alias("role"),
        F.col("event_type").alias("topic"),
        F.concat("event_type", F.lit(" "), "props").alias("content"),
        F.col("ts").alias("created_at"),
    )


TURNS_SQL = """
turns AS (
  SELECT CAST(event_id AS VARCHAR) AS ext_id,
         CAST(user_id AS VARCHAR) || '@' || strftime(ts, '%Y-%m-%d') AS session_id,
         CAST(user_id % 12 AS VARCHAR) AS rep_id,
         CAST(event_id % 60 AS VARCHAR) AS hcp_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS turn_index,
         'user' AS role, event_type AS topic,
         event_type || ' ' || props AS content, ts AS created_at
  FROM events)"""


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`customer` as the entity dimension: the market segment is the specialty."""
    return load_dimension(
        read_table(spark, "customer", sf_dir).select(
            F.col("c_custkey").cast("string").alias("hcp_id"),
            F.col("c_mktsegment").alias("specialty"),
        ),
        "hcp_id",
        "specialty",
    )


DIMENSION_SQL = """
dim AS (
  SELECT CAST(c_custkey AS VARCHAR) AS hcp_id, c_mktsegment AS specialty
  FROM customer WHERE c_custkey IS NOT NULL)"""


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` with the vector of the same id, where there is one."""
    documents = spread_small(read_table(spark, "documents", sf_dir))
    vectors = read_table(spark, "embeddings", sf_dir)
    return documents.join(vectors, F.col("doc_id") == F.col("vec_id"), "left").select(
        F.col("doc_id").alias("content_id"),
        F.col("source").alias("doc_type"),
        F.col("lang").alias("brand"),
        F.col("text").alias("chunk_text"),
        "embedding",
    )


CORPUS_SQL = """
corpus AS (
  SELECT doc_id AS content_id, source AS doc_type, lang AS brand, text AS chunk_text, embedding
  FROM documents LEFT JOIN embeddings ON doc_id = vec_id)"""


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`benchmark` items as questions: every word is required; the vector is the one of that id.

    Each question belongs to the English tenant, or to another one when its words have accents.
    """
    items = read_table(spark, "benchmark", sf_dir)
    vectors = read_table(spark, "embeddings", sf_dir)
    plain = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{M}\p{N}]+", " ")
    return items.join(vectors, F.col("item_id") == F.col("vec_id"), "left").select(
        F.col("item_id").alias("query_id"),
        F.regexp_replace(plain, r"\bor\b", " ").alias("q"),
        F.col("embedding").alias("qvec"),
        F.when(F.col("text").rlike("[çèéê]"), "fr")
        .when(F.col("text").rlike("[íóñ]"), "es")
        .otherwise("en")
        .alias("brand"),
    )


# Word lists and lengths of every text, and the questions with their distinct required words.
SEARCH_SQL = """
doc_words AS (
  SELECT content_id, brand, list_filter(
    string_split_regex(lower(chunk_text), '[^\\p{L}\\p{M}\\p{N}]+'), lambda w: w <> '') AS words
  FROM corpus WHERE chunk_text IS NOT NULL),
docs AS (
  SELECT *, len(list_filter(words, lambda w: NOT list_contains(%(stop)s, w))) AS n_terms
  FROM doc_words)"""
QUESTIONS_SQL = """
questions AS (
  SELECT item_id AS query_id, embedding AS qvec,
         CASE WHEN regexp_matches(text, '[çèéê]') THEN 'fr'
              WHEN regexp_matches(text, '[íóñ]') THEN 'es' ELSE 'en' END AS brand,
         list_distinct(list_filter(
           string_split_regex(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'),
           lambda w: w <> '' AND NOT list_contains(%(stop)s, w))) AS terms
  FROM benchmark LEFT JOIN embeddings ON item_id = vec_id)"""
