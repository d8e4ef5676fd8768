"""Agent memory: sessions, scoped recall, promotion, fact lookup and lineage."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.functions.keys import all_present, business_key, top_k
from recollect.operators.upsert import add_lineage, insert_if_absent, insert_new

FACT_SCHEMA = (
    "source_key string, rep_id string, hcp_id string, scope string, fact_text string, "
    "confidence double, status string, created_at timestamp_ntz"
)
LINEAGE_SCHEMA = "source_key string, ext_id string"


class Memory(NamedTuple):
    """The durable side of the memory: facts and their links to source turns."""

    facts: DataFrame
    lineage: DataFrame


def _newest(topic: str | None = None, topic_col: str = "topic") -> list[Column]:
    recency = [F.col("created_at").desc_nulls_last(), F.col("ext_id").asc()]
    if topic is None:
        return recency
    return [(F.col(topic_col) == topic).desc_nulls_last(), *recency]


def ingest_turns(
    turns: DataFrame, batch: DataFrame, order_by: Sequence[Column] | None = None
) -> DataFrame:
    """Add a batch of turns once per `ext_id`; re-running adds nothing."""
    return insert_if_absent(turns, batch, ["ext_id"], order_by)


def sessions(turns: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per session: its owner, entity and first moment, taken from its earliest turn."""
    first = F.min_by(
        F.struct("rep_id", "hcp_id"), F.struct(F.col("created_at"), F.col("ext_id"))
    )
    built = (
        turns.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(first.alias("_first"), F.min("created_at").alias("started_at"))
        .select(
            "session_id",
            F.col("_first.rep_id").alias("rep_id"),
            F.col("_first.hcp_id").alias("hcp_id"),
            "started_at",
        )
    )
    return built if existing is None else insert_if_absent(existing, built, ["session_id"], unique=True)


def scoped(turns: DataFrame, rep: str | None = None, hcp: str | None = None) -> DataFrame:
    """Only the turns of this owner and/or entity.

    Apply this to the table itself, before any ranking or limit: a filter after a limit either
    leaks another owner's rows or silently returns too few.
    """
    if rep is None and hcp is None:
        raise ValueError("a scope needs an owner, an entity or both")
    if rep is not None:
        turns = turns.where(F.col("rep_id") == rep)
    if hcp is not None:
        turns = turns.where(F.col("hcp_id") == hcp)
    return turns


def recall_recent(turns: DataFrame, hcp: str, k: int = 5, rep: str | None = None) -> DataFrame:
    """The newest `k` turns about an entity."""
    return scoped(turns, rep, hcp).orderBy(*_newest()).limit(k)


def recall_ranked(
    turns: DataFrame, hcp: str, topic: str, k: int = 5, rep: str | None = None
) -> DataFrame:
    """The `k` best turns about an entity: those on the topic first, then the newest.

    A turn without a topic is no match, so it ranks below every real match.
    """
    return scoped(turns, rep, hcp).orderBy(*_newest(topic)).limit(k)


def recall(
    turns: DataFrame,
    partition_by: Sequence[str] = ("rep_id", "hcp_id"),
    topic: str | None = None,
    k: int = 5,
) -> DataFrame:
    """The `k` best turns of every scope at once, numbered by `rn`."""
    return top_k(turns, partition_by, _newest(topic), k)


def write_recall(
    turns: DataFrame, name: str, path: str, buckets: int, scope: Sequence[str] = ("rep_id", "hcp_id")
) -> DataFrame:
    """Store turns for recall: a catalog table bucketed by scope and sorted newest first in a bucket.

    `recall` on what this returns shuffles nothing: the table's bucketing stands for the exchange, and
    each task keeps the `k` best rows of a scope as it reads. A bucket is one file, written by one task,
    so a scope with a large share of all turns makes a large file; it is streamed, never held.
    """
    age = (-F.unix_micros(F.col("created_at").cast("timestamp"))).alias("_age")
    placed = turns.select("*", age).repartition(buckets, *scope)
    writer = placed.write.mode("overwrite").option("path", path).bucketBy(buckets, *scope)
    writer.sortBy(*scope, "_age", "ext_id").saveAsTable(name)
    return turns.sparkSession.table(name).drop("_age")


def promote(turns: DataFrame, memory: Memory, requests: DataFrame) -> Memory:
    """Turn the newest matching turn of each request into a durable fact.

    `requests` holds (rep_id, hcp_id, topic, fact_text, created_at), one row per scope and topic.
    The source turn must lie inside the request's own scope. A fact that exists already is left
    alone and gets no further link.
    """
    scope = ["rep_id", "hcp_id", "topic"]
    newest = (
        turns.where(all_present([*scope, "ext_id", "created_at"]))
        .groupBy(*scope)
        .agg(F.max(F.struct("created_at", "ext_id"))["ext_id"].alias("ext_id"))
    )
    candidates = requests.join(newest, scope).select(
        business_key("handpromote", *scope).alias("source_key"),
        "rep_id",
        "hcp_id",
        F.lit("hcp").alias("scope"),
        "fact_text",
        F.lit(1.0).alias("confidence"),
        F.lit("active").alias("status"),
        "created_at",
        "ext_id",
    )
    inserted = insert_new(memory.facts, candidates, ["source_key"])
    facts = inserted.table.select(*memory.facts.columns)
    return Memory(facts, add_lineage(memory.lineage, inserted.new_rows))


def _matches_text(column: Column, text: str, escape: bool) -> Column:
    if escape:
        for special in ("\\", "%", "_"):
            text = text.replace(special, "\\" + special)
    return column.ilike(f"%{text}%")


def _by_confidence() -> list[Column]:
    return [F.col("confidence").desc_nulls_last(), F.col("source_key").asc()]


def agent_knows(
    facts: DataFrame,
    text: str,
    rep: str | None = None,
    hcp: str | None = None,
    k: int = 3,
    escape: bool = False,
) -> DataFrame:
    """The `k` most confident active facts that mention `text` and that the caller may see.

    Org facts are shared; an entity fact is visible only to its own owner on that entity. Without
    both owner and entity only org facts are returned. `escape` takes `%` and `_` literally.
    """
    visible = F.col("scope") == "org"
    if rep is not None and hcp is not None:
        own = (F.col("scope") == "hcp") & (F.col("rep_id") == rep) & (F.col("hcp_id") == hcp)
        visible = visible | own
    return (
        facts.where(
            (F.col("status") == "active") & _matches_text(F.col("fact_text"), text, escape) & visible
        )
        .orderBy(*_by_confidence())
        .limit(k)
    )


def agent_knows_per_scope(
    facts: DataFrame, scopes: DataFrame, text: str, k: int = 3, escape: bool = False
) -> DataFrame:
    """`agent_knows` for every (rep_id, hcp_id) of `scopes` (unique, non-null), ranked by `rn`.

    The answer of a scope is the best `k` of its own best `k` and the best `k` org facts. The
    latter are the same `k` rows for everyone, so they travel as one array value, not as a join.
    """
    hits = facts.where(
        (F.col("status") == "active") & _matches_text(F.col("fact_text"), text, escape)
    )
    fields = ["confidence", "source_key", "scope", "fact_text"]
    entry = F.struct(F.col("confidence").isNull().alias("_last"), (-F.col("confidence")).alias("_order"), *fields[1:])
    shared = (
        hits.where(F.col("scope") == "org")
        .orderBy(*_by_confidence())
        .limit(k)
        .agg(F.collect_list(entry).alias("shared"))
        .scalar()
    )
    own = (
        top_k(hits.where(F.col("scope") == "hcp"), ["rep_id", "hcp_id"], _by_confidence(), k)
        .groupBy("rep_id", "hcp_id")
        .agg(F.collect_list(entry).alias("own"))
    )
    nothing = F.array().cast("array<struct<_last:boolean,_order:double,source_key:string,scope:string,fact_text:string>>")
    best = F.slice(F.sort_array(F.concat(F.coalesce("own", nothing), shared)), 1, k)
    return (
        scopes.select("rep_id", "hcp_id")
        .join(own, ["rep_id", "hcp_id"], "left")
        .select("rep_id", "hcp_id", F.posexplode(best).alias("pos", "fact"))
        .select(
            "rep_id",
            "hcp_id",
            (F.col("pos") + 1).alias("rn"),
            F.col("fact.source_key").alias("source_key"),
            F.col("fact.scope").alias("scope"),
            F.col("fact.fact_text").alias("fact_text"),
            (-F.col("fact._order")).alias("confidence"),
        )
    )


def trace(facts: DataFrame, lineage: DataFrame, turns: DataFrame) -> DataFrame:
    """Every fact with each of its source turns."""
    source = turns.select(
        "ext_id",
        F.col("rep_id").alias("turn_rep_id"),
        F.col("hcp_id").alias("turn_hcp_id"),
        F.col("topic").alias("turn_topic"),
        F.col("content").alias("turn_content"),
        F.col("created_at").alias("turn_created_at"),
    )
    return facts.join(lineage, "source_key").join(source, "ext_id")


def resolvable(lineage: DataFrame, turns: DataFrame) -> DataFrame:
    """Keys of the facts with at least one link to a turn that exists."""
    return lineage.join(turns.select("ext_id"), "ext_id", "left_semi").select("source_key").distinct()


def unsupported(facts: DataFrame, lineage: DataFrame, turns: DataFrame) -> DataFrame:
    """Facts without any resolvable source turn."""
    return facts.join(resolvable(lineage, turns), "source_key", "left_anti")


def lineage_coverage(facts: DataFrame, lineage: DataFrame, turns: DataFrame) -> DataFrame:
    """Per scope and status: number of facts, and how many have a resolvable source turn."""
    linked = resolvable(lineage, turns).withColumn("_linked", F.lit(True))
    return (
        facts.join(linked, "source_key", "left")
        .groupBy("scope", "status")
        .agg(
            F.count(F.lit(1)).alias("n_facts"),
            F.count("_linked").alias("n_linked"),
            F.count_if(F.col("_linked").isNull()).alias("n_unlinked"),
        )
    )


def empty_memory(spark: SparkSession) -> Memory:
    """A memory that holds nothing yet."""
    return Memory(
        spark.createDataFrame([], FACT_SCHEMA), spark.createDataFrame([], LINEAGE_SCHEMA)
    )
