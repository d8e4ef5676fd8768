"""Consolidation that reads new turns only.

Between runs it keeps a state of two tables: the summary of every cluster (size and newest turn), which is
mergeable, and a narrow row per turn with what later runs can still need of it. A run adds the new
turns to both and derives again the facts of the clusters, entities and themes that new turns touch.
The facts and links that come out are those of `dream` over all turns on the same memory.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.functions import scoring
from recollect.functions.hooks import Generate
from recollect.functions.keys import business_key
from recollect.operators.consolidate import (
    SAMPLE_CHARS,
    SCOPE,
    Candidates,
    abstract,
    archive_unsupported,
    consolidate,
    decay_cutoff,
    flag_contradictions,
    freshly_supported,
    hold_claims,
    links_to,
    summarise,
    themes,
    usable,
)
from recollect.operators.memory import Memory
from recollect.operators.upsert import insert_if_absent
from recollect.plans.dream import merge_all
from recollect.session import materialise

SUMMARY = "rep_id string, hcp_id string, topic string, n long, newest timestamp_ntz"
MEMBERS = (
    "rep_id string, hcp_id string, topic string, ext_id string, created_at timestamp_ntz, content string"
)


class State(NamedTuple):
    """`summary (rep_id, hcp_id, topic, n, newest)` and `members`, a narrow row per usable turn.

    `content` of a member is whole on exclusive topics, whose turns may be held later, and cut to
    what a sample quotes on all others. Write both with the memory of the same run.
    """

    summary: DataFrame
    members: DataFrame


class Advanced(NamedTuple):
    memory: Memory
    state: State


def empty_state(spark: SparkSession) -> State:
    return State(spark.createDataFrame([], SUMMARY), spark.createDataFrame([], MEMBERS))


def advance(
    new_turns: DataFrame,
    dim: DataFrame,
    memory: Memory,
    state: State,
    as_of: Any,
    generate: Generate | str | None = None,
    high_stakes: Sequence[str] = scoring.HIGH_STAKES,
    exclude_topics: Sequence[str] = ("general",),
    group_col: str = "specialty",
    min_turns: int = 3,
    min_reps: int = 3,
    min_hcps: int = 3,
    exclusive_topics: Sequence[str] = ("preference",),
    min_contradicting: int = 2,
    claim_topic: str = "interaction_claim",
    claim_pattern: str = "%CYP3A4%",
    decay_days: int = 150,
    chunk_turns: int | None = None,
) -> Advanced:
    """One run over the turns that came since the last one; none of them may be in `state` already.

    All runs on one state need the same thresholds, topics and dimension. A model is asked about touched
    clusters only. Turns without key, topic, owner or entity support no cluster; of those a claim is
    still held, and a fact that was linked to one by hand counts as unsupported here.
    """
    exclusive = F.col("topic").isin(*exclusive_topics)
    kept_text = F.when(exclusive, F.col("content")).otherwise(F.left("content", F.lit(SAMPLE_CHARS)))
    added_members = usable(new_turns).select(*SCOPE, "ext_id", "created_at", kept_text.alias("content"))
    added_members = materialise(added_members, "members")
    added = materialise(summarise(added_members), "touched")
    merged = state.summary.unionByName(added).groupBy(*SCOPE).agg(
        F.sum("n").alias("n"), F.max("newest").alias("newest")
    )
    summary = materialise(merged, "clusters")

    touched = summary.join(added.select(*SCOPE), list(SCOPE), "left_semi")
    ripe = touched.where(F.col("n") >= min_turns).select(*SCOPE)
    earlier = state.members.join(ripe, list(SCOPE), "left_semi")
    members = earlier.unionByName(added_members)
    clusters = consolidate(
        members, as_of, generate, min_turns, None, high_stakes, summary=touched, chunk_turns=chunk_turns
    )

    limits = (group_col, min_reps, min_hcps, exclude_topics)
    shared = abstract(added_members, dim, as_of, *limits, summary=summary)
    by = [group_col, "topic"]
    ripened = themes(added_members, dim, *limits, summary=summary).join(
        themes(added_members, dim, *limits, summary=state.summary).select(*by), by, "left_anti"
    )
    grouped = state.members.select("hcp_id", "topic", "ext_id").join(dim.select("hcp_id", group_col), "hcp_id")
    theme_links = shared.links.unionByName(links_to(grouped, ripened, by, business_key("abstract", *by)))

    entities = added.where(exclusive).select("hcp_id", "topic").distinct()
    told = state.members.where(exclusive).unionByName(added_members.where(exclusive))
    told = told.join(entities, ["hcp_id", "topic"], "left_semi")
    conflicts = flag_contradictions(told, as_of, exclusive_topics, min_contradicting, summary)
    claims = hold_claims(new_turns, as_of, claim_topic, claim_pattern)
    held = Candidates(conflicts.facts.unionByName(claims.facts), conflicts.links.unionByName(claims.links))
    facts = merge_all(memory.facts, clusters.facts, shared.facts, held.facts)

    cutoff = decay_cutoff(as_of, decay_days)
    own = business_key("consolidate", *SCOPE).alias("source_key")
    fresh_clusters = summary.where((F.col("newest") > cutoff) & (F.col("n") >= min_turns)).select(own)
    # facts that no cluster stands for, such as promoted ones, are supported by their linked turns
    other = memory.facts.where("status = 'active' AND scope = 'hcp'").join(
        summary.select(own), "source_key", "left_anti"
    )
    other_links = memory.lineage.join(other.select("source_key"), "source_key", "left_semi")
    everyone = state.members.unionByName(added_members)
    fresh_others = freshly_supported(other_links, everyone.select("ext_id", "created_at"), as_of, decay_days)
    facts = archive_unsupported(facts, fresh_clusters.unionByName(fresh_others).distinct())

    new_links = held.links.join(memory.facts.select("source_key"), "source_key", "left_anti")
    links = reduce(DataFrame.unionByName, [clusters.links, theme_links, new_links])
    lineage = insert_if_absent(memory.lineage, links, ["source_key", "ext_id"], unique=True)
    return Advanced(Memory(facts, lineage), State(summary, everyone))
