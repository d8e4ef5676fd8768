"""The whole consolidation job: every pass over the turns, merged into the memory."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.functions import scoring
from recollect.functions.hooks import Generate
from recollect.functions.keys import business_key, null_key_salt
from recollect.operators.consolidate import (
    SCOPE,
    Candidates,
    abstract,
    archive_unsupported,
    consolidate,
    decay_cutoff,
    flag_contradictions,
    freshly_supported,
    hold_claims,
    summarise,
)
from recollect.operators.memory import Memory
from recollect.operators.upsert import add_lineage, insert_if_absent, insert_new, upsert
from recollect.session import materialise

# A stored status a re-run must not change.
STICKY_STATUS = ("review", "archived")


def merge_consolidated(facts: DataFrame, candidates: DataFrame) -> DataFrame:
    """Re-score known facts in place, but never lift one out of review or out of the archive."""
    return upsert(
        facts,
        candidates.select(*facts.columns),
        ["source_key"],
        ["fact_text", "confidence"],
        sticky=("status", STICKY_STATUS),
    )


def merge_themes(facts: DataFrame, candidates: DataFrame) -> DataFrame:
    """Refresh text and confidence of known themes; their status stays whatever it is."""
    return upsert(
        facts, candidates.select(*facts.columns), ["source_key"], ["fact_text", "confidence"]
    )


def merge_held(memory: Memory, candidates: Candidates) -> Memory:
    """Add held facts that are not known yet, and link lineage for those only."""
    held = candidates.facts.select(*memory.facts.columns)
    inserted = insert_new(memory.facts, held, ["source_key"])
    links = candidates.links.join(
        inserted.new_rows.select("source_key"), "source_key", "left_semi"
    )
    return Memory(inserted.table, add_lineage(memory.lineage, links))


def merge_all(
    facts: DataFrame, rescored: DataFrame, refreshed: DataFrame, held: DataFrame
) -> DataFrame:
    """The three merges above in one join: their keys start differently, so no two can collide."""
    columns = facts.columns

    def part(candidates: DataFrame, updates: bool, rescores: bool) -> DataFrame:
        return candidates.select(
            *columns, F.lit(updates).alias("_updates"), F.lit(rescores).alias("_rescores")
        )

    batch = reduce(
        DataFrame.unionByName,
        [part(rescored, True, True), part(refreshed, True, False), part(held, False, False)],
    )
    salt = null_key_salt(["source_key"], columns).alias("_salt")
    old = facts.select("*", salt, F.lit(True).alias("_known")).alias("old")
    new = batch.select("*", salt).alias("new")
    known = F.col("_known").isNotNull()
    updates = F.coalesce("_updates", F.lit(False))
    human = F.col("old.status").isin(*STICKY_STATUS)
    rescores = F.coalesce("_rescores", F.lit(False)) & ~F.coalesce(human, F.lit(False))

    def pick(name: str) -> Column:
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in ("fact_text", "confidence"):
            return F.when(updates | ~known, after).otherwise(before)
        if name == "status":
            return F.when(known & ~rescores, before).otherwise(after)
        return F.when(known, before).otherwise(after)

    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in ("source_key", "_salt")]
    joined = old.join(new, on, "full_outer")
    return joined.select(*[pick(c).alias(c) for c in columns])


def dream(
    turns: DataFrame,
    dim: DataFrame,
    memory: Memory,
    as_of: Any,
    generate: Generate | str | None = None,
    high_stakes: Sequence[str] = scoring.HIGH_STAKES,
    exclude_topics: Sequence[str] = ("general",),
    group_col: str = "specialty",
    min_turns: int = 3,
    min_reps: int = 3,
    min_hcps: int = 3,
    cluster_limit: int | None = None,
    theme_limit: int | None = None,
    exclusive_topics: Sequence[str] = ("preference",),
    min_contradicting: int = 2,
    claim_topic: str = "interaction_claim",
    claim_pattern: str = "%CYP3A4%",
    decay_days: int = 150,
    chunk_turns: int | None = None,
) -> Memory:
    """Consolidate, abstract, flag contradictions, decay and hold claims.

    The result equals running the passes one after another, and running it again on its own output
    changes nothing. All turns are read once, without their text, to write the per-cluster summary to
    the shared folder; the passes start from that summary and go back to the turns only for the text
    of the clusters that become facts, for lineage keys and for the text of held statements. Persist
    both frames (a new version of each table) before the next run reads them.

    `turns` must be unique per `ext_id`, as `memory.ingest_turns` keeps it, and `dim` per `hcp_id`; then
    every link is found once and the lineage needs no second pass over the links.
    """
    summary = materialise(summarise(turns, SCOPE), "clusters")
    clusters = consolidate(
        turns, as_of, generate, min_turns, cluster_limit, high_stakes, summary=summary,
        chunk_turns=chunk_turns,
    )
    shared = abstract(
        turns, dim, as_of, group_col, min_reps, min_hcps, exclude_topics, theme_limit, summary
    )
    conflicts = flag_contradictions(turns, as_of, exclusive_topics, min_contradicting, summary)
    claims = hold_claims(turns, as_of, claim_topic, claim_pattern)

    held = conflicts.facts.unionByName(claims.facts)
    facts = merge_all(memory.facts, clusters.facts, shared.facts, held)

    # A cluster's own newest turn says whether its fact is still supported; only links stored by
    # earlier runs need the join with the turns.
    supported = (F.col("newest") > decay_cutoff(as_of, decay_days)) & (F.col("n") >= min_turns)
    fresh_now = summary.where(supported).select(
        business_key("consolidate", *SCOPE).alias("source_key")
    )
    if cluster_limit is not None:
        fresh_now = fresh_now.join(clusters.facts.select("source_key"), "source_key", "left_semi")
    fresh_before = freshly_supported(memory.lineage, turns, as_of, decay_days)
    facts = archive_unsupported(facts, fresh_now.unionByName(fresh_before).distinct())

    new_links = conflicts.links.unionByName(claims.links).join(
        memory.facts.select("source_key"), "source_key", "left_anti"
    )
    links = reduce(DataFrame.unionByName, [clusters.links, shared.links, new_links])
    return Memory(facts, insert_if_absent(memory.lineage, links, ["source_key", "ext_id"], unique=True))
