"""Every registered query: one callable `(spark, sf_dir) -> DataFrame` per operator family."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters
from checks.adapters import AS_OF, FEATURES_AS_OF, GENERIC_TOPICS, HIGH_STAKES
from recollect.functions import english
from recollect.functions.keys import top_k
from recollect.operators import consolidate as con
from recollect.operators import features as feat
from recollect.operators import memory as mem
from recollect.operators import buckets, digests, graph, quality, search, sync, trigrams
from recollect.operators import upsert as up
from recollect.plans import dream as job
from recollect.plans import incremental
from recollect.plans.publish import publish_stream
from recollect.session import materialise, scratch_path, ship_package
from recollect.sources.sinks import overwrite_table, write_version
from recollect.sources.tables import list_tables, read_table, run_sql, scan, spread_small, table_properties
from recollect.streaming import feeds, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MIDDLE = "2024-01-16 00:00:00"
CLAIM = {"topic": "error", "pattern": '%"k": 7}%'}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        ship_package(spark, Path(__file__).resolve().parent)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def stamp(column: str) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def ntz(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


def before(turns: DataFrame, moment: str) -> DataFrame:
    return turns.where(F.col("created_at") < ntz(moment))


def extractive(turns: DataFrame) -> con.Candidates:
    return con.consolidate(turns, AS_OF, con.EXTRACTIVE, high_stakes=HIGH_STAKES)


FACT = ["source_key", "rep_id", "hcp_id", "scope", "fact_text", "confidence", "status"]


# --- scans and recall -------------------------------------------------------------------------


@query
def scan_scoped_turns(spark, sf_dir):
    turns = mem.scoped(adapters.turns(spark, sf_dir), rep="3", hcp="7")
    return turns.select("ext_id", "rep_id", "hcp_id", "topic", stamp("created_at"))


@query
def scan_filter_limit(spark, sf_dir):
    """The first 30 urgent open orders by key: filter and columns reach the scan."""
    wanted = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    return scan(
        read_table(spark, "orders", sf_dir), wanted,
        ["o_orderkey", "o_custkey", "o_totalprice"], [F.col("o_orderkey")], 30,
    )


@query
def sql_named_parameters(spark, sf_dir):
    return run_sql(
        spark,
        "SELECT event_type, count(*) AS n FROM {events} "
        "WHERE ts >= CAST(:start AS TIMESTAMP_NTZ) AND value > :floor GROUP BY event_type",
        {"start": MIDDLE, "floor": 10.0},
        {"events": read_table(spark, "events", sf_dir)},
    )


@query
def catalog_listing(spark, sf_dir):
    """Tables written to a schema, listed from the catalog with their rows and a table property."""
    path = scratch_path(spark, "schema")
    schema = "listing_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{path}'")
    followed = {"region": "true", "nation": "false", "supplier": "true"}
    for name, value in followed.items():
        overwrite_table(read_table(spark, name, sf_dir), f"{schema}.{name}", {"followed": value})
    rows = [
        read_table(spark, f"{schema}.{r['table_name']}").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(r["table_name"]).alias("table_name"), "n_rows"
        ).join(
            table_properties(spark, f"{schema}.{r['table_name']}").where("key = 'followed'").select(
                (F.col("value") == "true").alias("followed")
            )
        )
        for r in list_tables(spark, schema).collect()
    ]
    found = materialise(reduce(DataFrame.unionByName, rows), "listing")
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return found


@query
def recall_recent(spark, sf_dir):
    turns = mem.recall_recent(adapters.turns(spark, sf_dir), "7", k=5)
    return turns.select("ext_id", "topic", stamp("created_at"))


@query
def recall_ranked(spark, sf_dir):
    turns = mem.recall_ranked(adapters.turns(spark, sf_dir), "7", "purchase", k=5)
    return turns.select("ext_id", "topic", stamp("created_at"))


@query
def recall_topk_per_scope(spark, sf_dir):
    turns = mem.recall(adapters.turns(spark, sf_dir), topic="purchase", k=5)
    return turns.select("rep_id", "hcp_id", F.col("rn").cast("bigint").alias("rn"), "ext_id")


@query
def recall_bucketed(spark, sf_dir):
    """The same from turns that are stored bucketed by scope: nothing is shuffled."""
    path = scratch_path(spark, "recall")
    name = "recall_" + path.rsplit("-", 1)[1]
    stored = mem.write_recall(adapters.turns(spark, sf_dir), name, path, 8)
    found = mem.recall(stored, topic="purchase", k=5)
    found = found.select("rep_id", "hcp_id", F.col("rn").cast("bigint").alias("rn"), "ext_id")
    found = materialise(found, "recalled")
    spark.sql(f"DROP TABLE {name}")
    return found


@query
def recall_conversation_tail(spark, sf_dir):
    talk = read_table(spark, "conversations", sf_dir)
    tail = top_k(talk, ["conv_id"], [F.col("turn").desc()], 3)
    return tail.select("conv_id", "turn", "role", "text")


@query
def session_summary(spark, sf_dir):
    found = mem.sessions(adapters.turns(spark, sf_dir))
    return found.select("session_id", "rep_id", "hcp_id", stamp("started_at"))


@query
def promote_latest(spark, sf_dir):
    turns = adapters.turns(spark, sf_dir)
    requests = turns.groupBy("rep_id", "hcp_id", "topic").agg(
        F.lit("comes back to it").alias("fact_text"), ntz(AS_OF).alias("created_at")
    )
    start = mem.promote(before(turns, MIDDLE), mem.empty_memory(spark), requests)
    done = mem.promote(turns, start, requests)
    return done.facts.join(done.lineage, "source_key").select(*FACT, "ext_id")


# --- writes -----------------------------------------------------------------------------------


@query
def insert_if_absent(spark, sf_dir):
    turns = adapters.turns(spark, sf_dir)

    def delivery(number: int, rows: DataFrame) -> DataFrame:
        text = F.concat(F.lit(f"{number} "), "content").alias("content")
        return rows.select("ext_id", text, F.lit(number).alias("seq"))

    unkeyed = turns.where(F.col("topic") == "error").withColumn("ext_id", F.lit(None).cast("string"))
    batch = delivery(2, turns).unionByName(delivery(1, turns)).unionByName(delivery(3, unkeyed))
    existing = delivery(0, before(turns, MIDDLE)).drop("seq")
    return up.insert_if_absent(
        existing, batch, ["ext_id"], [F.col("seq").asc()]
    ).select("ext_id", "content")


@query
def ingest_conversations(spark, sf_dir):
    """Conversation rows as turns, loaded twice on top of the user turns that are stored already."""
    talk = read_table(spark, "conversations", sf_dir).select(
        F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("ext_id"),
        F.col("conv_id").cast("string").alias("session_id"),
        F.col("turn").cast("int").alias("turn_index"),
        "role",
        F.col("text").alias("content"),
    )
    first = mem.ingest_turns(talk.where(F.col("role") == "user"), talk, [F.col("turn_index").asc()])
    return mem.ingest_turns(first, talk, [F.col("turn_index").asc()])


@query
def additive_columns(spark, sf_dir):
    orders = read_table(spark, "orders", sf_dir)
    cut = ntz("1999-01-01 00:00:00")
    existing = orders.where(F.col("o_orderdate") < cut).select("o_orderkey", "o_custkey")
    batch = orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return up.insert_if_absent(existing, batch, ["o_orderkey"])


def _judged(facts: DataFrame) -> DataFrame:
    """Facts with a status a person or a decay run may have set since."""
    turn = F.col("hcp_id").cast("int") % 3
    status = F.when(turn == 0, "review").when(turn == 1, "archived").otherwise(F.col("status"))
    return facts.withColumn("status", status)


@query
def guarded_upsert(spark, sf_dir):
    turns = adapters.turns(spark, sf_dir)
    existing = _judged(extractive(before(turns, MIDDLE)).facts.select(*FACT, "created_at"))
    batch = extractive(turns).facts.withColumn("created_at", ntz("2024-02-01 00:00:00"))
    merged = job.merge_consolidated(existing, batch)
    return merged.select(*FACT, stamp("created_at"))


@query
def plain_upsert(spark, sf_dir):
    turns, dim = adapters.turns(spark, sf_dir), adapters.dimension(spark, sf_dir)

    def themes(rows: DataFrame) -> DataFrame:
        return con.abstract(rows, dim, AS_OF, min_hcps=10, exclude_topics=GENERIC_TOPICS).facts

    existing = themes(before(turns, MIDDLE)).select(*FACT, "created_at")
    existing = existing.withColumn(
        "status",
        F.when(F.col("source_key").endswith(":click"), "archived").otherwise(F.col("status")),
    )
    return job.merge_themes(existing, themes(turns)).select(*FACT)


@query
def conditional_update(spark, sf_dir):
    stale = (F.col("topic") == "error") & (F.col("created_at") < ntz(MIDDLE))
    turns = up.update_where(
        adapters.turns(spark, sf_dir),
        stale,
        {"content": F.lit("[redacted]"), "role": F.lit("system")},
    )
    return turns.select("ext_id", "role", "content")


@query
def update_by_key(spark, sf_dir):
    customers = read_table(spark, "customer", sf_dir).select(
        "c_custkey", F.lit(0).cast("bigint").alias("n_orders")
    )
    counted = (
        read_table(spark, "orders", sf_dir)
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    return up.update_by_key(customers, counted, ["c_custkey"], ["n_orders"])


@query
def lineage_links(spark, sf_dir):
    links = extractive(adapters.turns(spark, sf_dir)).links
    known = links.where(F.col("source_key").endswith(":view"))
    return up.add_lineage(known, links)


# --- consolidation ----------------------------------------------------------------------------


@query
def cluster_turns(spark, sf_dir):
    turns = adapters.turns(spark, sf_dir)
    clusters = con.cluster_turns(turns)
    return con.cluster_samples(turns, clusters)


@query
def largest_clusters(spark, sf_dir):
    return con.cluster_turns(adapters.turns(spark, sf_dir), limit=12).drop("newest")


@query
def consolidate_facts(spark, sf_dir):
    return extractive(adapters.turns(spark, sf_dir)).facts.select(*FACT, "n")


@query
def consolidate_fallback(spark, sf_dir):
    turns = adapters.turns(spark, sf_dir)
    return con.consolidate(turns, AS_OF, high_stakes=HIGH_STAKES).facts.select(*FACT, "used_fallback")


def _quote_prompt(prompts):
    """Stands in for a model: answers with the snippets it was given, and fails on one topic."""
    return [None if "'signup'" in p else "  noted: " + p.split("\n\n", 1)[1] for p in prompts]


@query
def distil_clusters(spark, sf_dir):
    turns = adapters.turns(spark, sf_dir)
    found = con.consolidate(turns, AS_OF, _quote_prompt, high_stakes=HIGH_STAKES)
    return found.facts.select(*FACT, "used_fallback")


def _touchy_model(prompts):
    """Stands in for a model call that fails as a whole when one of its prompts is about a topic."""
    if any("'signup'" in p for p in prompts):
        raise RuntimeError("refused")
    return _quote_prompt(prompts)


@query
def distil_in_chunks(spark, sf_dir):
    """Prompts of three turns: most clusters need several, and their answers are distilled again."""
    turns = adapters.turns(spark, sf_dir)
    found = con.consolidate(turns, AS_OF, _touchy_model, high_stakes=HIGH_STAKES, chunk_turns=3)
    return found.facts.select(*FACT, "used_fallback")


def _themes(spark, sf_dir) -> con.Candidates:
    return con.abstract(
        adapters.turns(spark, sf_dir),
        adapters.dimension(spark, sf_dir),
        AS_OF,
        min_hcps=10,
        exclude_topics=GENERIC_TOPICS,
    )


@query
def abstract_themes(spark, sf_dir):
    return _themes(spark, sf_dir).facts.select(*FACT, "reps", "hcps", "n")


@query
def theme_lineage(spark, sf_dir):
    return _themes(spark, sf_dir).links


@query
def top_themes(spark, sf_dir):
    return con.themes(
        adapters.turns(spark, sf_dir),
        adapters.dimension(spark, sf_dir),
        exclude_topics=GENERIC_TOPICS,
        limit=5,
    )


def _contradictions(spark, sf_dir) -> con.Candidates:
    return con.flag_contradictions(
        adapters.turns(spark, sf_dir), AS_OF, topics=("purchase",), min_n=40
    )


@query
def contradictions(spark, sf_dir):
    found = _contradictions(spark, sf_dir)
    return found.facts.join(found.links, "source_key").select(*FACT, "ext_id")


@query
def hold_claims(spark, sf_dir):
    found = con.hold_claims(adapters.turns(spark, sf_dir), AS_OF, **CLAIM)
    return found.facts.join(found.links, "source_key").select(*FACT, "ext_id")


@query
def decay_facts(spark, sf_dir):
    turns = adapters.turns(spark, sf_dir)
    found = extractive(turns)
    kept = con.decay(found.facts, found.links, turns, AS_OF, days=7)
    return kept.select("source_key", "confidence", "status")


def _dream(spark, sf_dir, generate=con.EXTRACTIVE) -> mem.Memory:
    return job.dream(
        adapters.turns(spark, sf_dir),
        adapters.dimension(spark, sf_dir),
        mem.empty_memory(spark),
        AS_OF,
        generate,
        high_stakes=HIGH_STAKES,
        exclude_topics=GENERIC_TOPICS,
        min_hcps=10,
        exclusive_topics=("purchase",),
        min_contradicting=40,
        claim_topic=CLAIM["topic"],
        claim_pattern=CLAIM["pattern"],
        decay_days=7,
    )


@query
def dream_incremental(spark, sf_dir):
    """The turns in two runs: the second reads the later turns and the state that the first one left."""
    turns, dim = adapters.turns(spark, sf_dir), adapters.dimension(spark, sf_dir)
    memory, state = mem.empty_memory(spark), incremental.empty_state(spark)
    later = turns.where(F.col("created_at") >= ntz(MIDDLE))
    for rows, as_of in ((before(turns, MIDDLE), MIDDLE), (later, AS_OF)):
        memory, state = incremental.advance(
            rows, dim, memory, state, as_of, con.EXTRACTIVE, high_stakes=HIGH_STAKES,
            exclude_topics=GENERIC_TOPICS, min_hcps=10, exclusive_topics=("purchase",), min_contradicting=40,
            claim_topic=CLAIM["topic"], claim_pattern=CLAIM["pattern"], decay_days=7,
        )
        memory = mem.Memory(*(materialise(frame, "memory") for frame in memory))
    links = memory.lineage.groupBy("source_key").agg(F.count(F.lit(1)).alias("n_links"))
    return memory.facts.join(links, "source_key", "left").select(*FACT, "n_links")


@query
def dream_facts(spark, sf_dir):
    return _dream(spark, sf_dir).facts.select(*FACT)


@query
def dream_model_facts(spark, sf_dir):
    """All passes with a model: a refused prompt only holds its own fact for review."""
    return _dream(spark, sf_dir, _touchy_model).facts.select(*FACT)


@query
def dream_lineage(spark, sf_dir):
    return _dream(spark, sf_dir).lineage


@query
def review_summary(spark, sf_dir):
    return con.review_summary(_dream(spark, sf_dir).facts, CLAIM["pattern"])


@query
def agent_knows(spark, sf_dir):
    found = mem.agent_knows(_dream(spark, sf_dir).facts, "purchase", rep="3", hcp="7", k=3)
    return found.select("source_key", "scope", "fact_text", "confidence")


@query
def agent_knows_per_scope(spark, sf_dir):
    turns = adapters.turns(spark, sf_dir)
    scopes = turns.select("rep_id", "hcp_id").distinct()
    facts = materialise(_dream(spark, sf_dir).facts, "facts")
    found = mem.agent_knows_per_scope(facts, scopes, "click", k=3)
    return found.withColumn("rn", F.col("rn").cast("bigint"))


@query
def trace_facts(spark, sf_dir):
    turns = adapters.turns(spark, sf_dir)
    found = extractive(turns)
    traced = mem.trace(found.facts.drop("topic", "n"), found.links, turns)
    return traced.select(
        "source_key", "ext_id", "turn_rep_id", "turn_hcp_id", "turn_topic",
        "turn_content",
    )


@query
def lineage_coverage(spark, sf_dir):
    turns = adapters.turns(spark, sf_dir)
    memory = _dream(spark, sf_dir)
    return mem.lineage_coverage(memory.facts, memory.lineage, before(turns, MIDDLE))


# --- retrieval --------------------------------------------------------------------------------

WORDS = "ndble tion"


def _english():
    return F.col("brand") == "en"


def _vector(spark, sf_dir) -> list[float]:
    """The stored vector 0, as the vector of a query."""
    return read_table(spark, "embeddings", sf_dir).where(F.col("vec_id") == 0).first()["embedding"]


def _ranked(df: DataFrame, *scores: str) -> DataFrame:
    rounded = [F.round(s, 6).alias(s) for s in scores]
    return df.select(
        *[c for c in df.columns if c not in scores and not c.endswith("rank") and c != "rn"],
        *[F.col(c).cast("bigint").alias(c) for c in df.columns if c.endswith("rank") or c == "rn"],
        *rounded,
    )


@query
def vector_topk(spark, sf_dir):
    found = search.vector_topk(adapters.corpus(spark, sf_dir), _vector(spark, sf_dir))
    return _ranked(found, "distance")


@query
def vector_topk_filtered(spark, sf_dir):
    found = search.vector_topk(
        adapters.corpus(spark, sf_dir), _vector(spark, sf_dir), where=_english()
    )
    return _ranked(found, "distance")


@query
def keyword_match(spark, sf_dir):
    found = search.keyword_match(adapters.corpus(spark, sf_dir), "tion -ndble or ndble")
    return found.select("content_id", F.col("n_terms").cast("bigint").alias("n_terms"))


@query
def keyword_phrase(spark, sf_dir):
    found = search.keyword_match(adapters.corpus(spark, sf_dir), '"thanedble the onbleea" or "in onbleea" -ndble')
    return found.select("content_id", F.col("n_terms").cast("bigint").alias("n_terms"))


@query
def bm25_topk(spark, sf_dir):
    found = search.keyword_topk(adapters.corpus(spark, sf_dir), WORDS, where=_english())
    return _ranked(found, "score")


def _index(spark, sf_dir) -> search.TextIndex:
    built = search.index_postings(adapters.corpus(spark, sf_dir), ["brand"])
    return search.write_index(built, scratch_path(spark, "index"), 1)


@query
def bm25_topk_indexed(spark, sf_dir):
    return _ranked(search.postings_topk(_index(spark, sf_dir), WORDS, where=_english()), "score")


@query
def bm25_topk_stemmed(spark, sf_dir):
    """Inflected forms match each other: the same search on stems."""
    found = search.keyword_topk(
        adapters.corpus(spark, sf_dir), "tions", where=_english(), stem=english.stem
    )
    return _ranked(found, "score")


@query
def hybrid_stemmed(spark, sf_dir):
    found = search.hybrid(
        adapters.corpus(spark, sf_dir), "tions", _vector(spark, sf_dir), k=10, stem=english.stem
    )
    return _ranked(found, "rrf")


@query
def hybrid_rrf(spark, sf_dir):
    found = search.hybrid(adapters.corpus(spark, sf_dir), WORDS, _vector(spark, sf_dir), k=10)
    return _ranked(found, "rrf")


@query
def hybrid_rrf_filtered(spark, sf_dir):
    found = search.hybrid(
        adapters.corpus(spark, sf_dir), WORDS, _vector(spark, sf_dir), k=10, where=_english()
    )
    return _ranked(found, "rrf")


@query
def batch_vector(spark, sf_dir):
    found = search.vector_topk_batch(
        adapters.corpus(spark, sf_dir), adapters.questions(spark, sf_dir)
    )
    return _ranked(found, "distance")


@query
def batch_bm25(spark, sf_dir):
    found = search.keyword_topk_batch(
        adapters.corpus(spark, sf_dir), adapters.questions(spark, sf_dir)
    )
    return _ranked(found, "score")


@query
def batch_bm25_indexed(spark, sf_dir):
    found = search.postings_topk_batch(_index(spark, sf_dir), adapters.questions(spark, sf_dir))
    return _ranked(found, "score")


@query
def batch_hybrid(spark, sf_dir):
    found = search.hybrid_batch(
        adapters.corpus(spark, sf_dir), adapters.questions(spark, sf_dir), k=10
    )
    return _ranked(found, "rrf")


@query
def batch_hybrid_per_tenant(spark, sf_dir):
    found = search.hybrid_batch(
        adapters.corpus(spark, sf_dir), adapters.questions(spark, sf_dir), k=10, tenant="brand"
    )
    return _ranked(found, "rrf")


def _celled(spark, corpus):
    """Centres, and the corpus written by cell: a search reads the folders of its cells only."""
    model = search.fit_cells(corpus, cells=16)
    path = scratch_path(spark, "cells")
    search.assign_cells(corpus, model).write.partitionBy("cell").parquet(path)
    return model, spark.read.parquet(path)


def _graph(spark, corpus):
    """The search graphs of a corpus, written once."""
    return materialise(graph.build_graph(corpus), "graph")


def _every_fiftieth(spark, sf_dir):
    vectors = read_table(spark, "embeddings", sf_dir).where(F.col("vec_id") % 50 == 0)
    return vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qvec"))


@query
def ann_topk(spark, sf_dir):
    corpus = adapters.corpus(spark, sf_dir)
    asked = spark.createDataFrame([(0, _vector(spark, sf_dir))], "query_id long, qvec array<double>")
    found = graph.graph_topk(_graph(spark, corpus), asked)
    return _ranked(found.drop("query_id", "computed"), "distance")


@query
def ann_recall(spark, sf_dir):
    """For every 50th vector: are 19 of its 20 nearest found, with fewer distances than rows?"""
    vectors = read_table(spark, "embeddings", sf_dir)
    corpus = vectors.select(F.col("vec_id").alias("content_id"), "embedding")
    asked = _every_fiftieth(spark, sf_dir)
    found = materialise(graph.graph_topk(_graph(spark, corpus), asked), "found")
    recall = graph.recall_per_query(found, search.vector_topk_batch(corpus, asked))
    spent = found.select("query_id", "computed").distinct()
    rows = corpus.count()
    return recall.join(spent, "query_id").select(
        "query_id", (F.col("recall") >= 0.95).alias("enough"), (F.col("computed") < rows).alias("fewer")
    )


@query
def ann_all_cells(spark, sf_dir):
    """With every cell probed the approximate search is the exact one."""
    corpus = adapters.corpus(spark, sf_dir).where(F.col("embedding").isNotNull())
    model, celled = _celled(spark, corpus)
    return _ranked(search.ann_topk(celled, model, _vector(spark, sf_dir), probes=16), "distance")


def _letter_counts(texts):
    """Stands in for a model: four numbers per text."""
    return [[len(t), t.count("a"), t.count("e"), t.count("\n")] for t in texts]


SUBSTRINGS = ["%tionnd%", "%AND%sh_nd%", "%éa%ê%", "%12%", "%_@%.%", "%none of these%"]


@query
def substring_search(spark, sf_dir):
    """Documents that match ILIKE patterns, by way of a trigram index."""
    documents = spread_small(read_table(spark, "documents", sf_dir).select("doc_id", "text"))
    index = materialise(trigrams.index_trigrams(documents, "doc_id", "text"), "trigrams")
    found = trigrams.ilike_search_all(documents, index, "doc_id", "text", SUBSTRINGS)
    return found.select("pattern", "doc_id")


@query
def embed_corpus(spark, sf_dir):
    rows = adapters.corpus(spark, sf_dir).drop("embedding")
    found = search.embed_corpus(rows, 4, _letter_counts)
    return found.select(
        "content_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(4)]
    )


@query
def embed_corpus_hashed(spark, sf_dir):
    rows = adapters.corpus(spark, sf_dir).drop("embedding")
    found = search.embed_corpus(rows, 64).select("content_id", F.posexplode("embedding").alias("bucket", "x"))
    return found.where("x > 0").select("content_id", "bucket", F.col("x").cast("double").alias("value"))


# --- sync -------------------------------------------------------------------------------------

ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _orders(spark, sf_dir) -> DataFrame:
    return read_table(spark, "orders", sf_dir)


def _mirror(orders: DataFrame) -> DataFrame:
    """A mirror that missed the latest orders, was edited locally, and kept rows deleted since."""
    kept = orders.where(F.col("o_orderdate") < ntz("2001-06-01 00:00:00"))
    edited = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 450000)
    kept = up.update_where(
        kept, edited, {"o_totalprice": F.lit(1.0), "o_orderstatus": F.lit(None).cast("string")}
    )
    gone = orders.where(F.col("o_orderdate") < ntz("1995-02-01 00:00:00"))
    return kept.unionByName(gone.withColumn("o_orderkey", -1 - F.col("o_orderkey")))


@query
def snapshot_sync(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    mirror = sync.sync(orders.select(*ORDER), _mirror(orders).select(*ORDER), "snapshot")
    return write_version(mirror, scratch_path(spark, "mirror"), 1)


@query
def snapshot_diff(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return sync.diff_changes(_mirror(orders).select(*ORDER), orders.select(*ORDER), ["o_orderkey"], 7)


def _feed(orders: DataFrame) -> DataFrame:
    """Three commits per order: all inserted, finished ones re-priced, pending ones deleted."""

    def commit(change: str, version: int, price: F.Column) -> F.Column:
        return F.struct(
            F.lit(change).alias("_change_type"),
            F.lit(version).cast("bigint").alias("_commit_version"),
            price.alias("_price"),
        )

    price = F.col("o_totalprice")
    higher = price + F.lit(1000.0)
    status = F.col("o_orderstatus")
    commits = F.array(
        commit("insert", 1, price),
        F.when(status == "F", commit("update_preimage", 2, price)),
        F.when(status == "F", commit("update_postimage", 2, higher)),
        F.when(status == "P", commit("delete", 3, price)),
    )
    rows = orders.withColumn("_c", F.explode(F.filter(commits, lambda c: c.isNotNull())))
    return rows.select(
        *[F.col("_c._price").alias(c) if c == "o_totalprice" else c for c in ORDER],
        F.col("_c._change_type").alias("_change_type"),
        F.col("_c._commit_version").alias("_commit_version"),
    )


@query
def apply_changes(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return sync.sync(orders, _mirror(orders).select(*ORDER), "triggered", ["o_orderkey"], _feed(orders))


@query
def diff_then_apply(spark, sf_dir):
    orders = _orders(spark, sf_dir).select(*ORDER)
    mirror = _mirror(_orders(spark, sf_dir)).select(*ORDER)
    changes = sync.diff_changes(mirror, orders, ["o_orderkey"], 1)
    return sync.apply_changes(mirror, changes, ["o_orderkey"])


@query
def stream_sync(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    changes = _feed(feeds.stream_table(spark, sf_dir, orders.schema, "orders.parquet"))
    sink, checkpoint = scratch_path(spark, "changes"), scratch_path(spark, "checkpoint")
    feeds.sync_stream(changes, sink, checkpoint, ["o_orderkey"]).awaitTermination()
    base = _mirror(orders).select(*ORDER)
    return feeds.read_mirror(base, sink, changes.schema, ["o_orderkey"])


@query
def stream_continuous(spark, sf_dir):
    """The same feed in continuous mode: the stream keeps running until all that is there was followed."""
    orders = _orders(spark, sf_dir)
    changes = _feed(feeds.stream_table(spark, sf_dir, orders.schema, "orders.parquet"))
    sink, checkpoint = scratch_path(spark, "changes"), scratch_path(spark, "checkpoint")
    running = feeds.sync_stream(changes, sink, checkpoint, ["o_orderkey"], "continuous", interval="1 second")
    running.processAllAvailable()
    running.stop()
    return feeds.read_mirror(_mirror(orders).select(*ORDER), sink, changes.schema, ["o_orderkey"])


@query
def stream_publish(spark, sf_dir):
    """Balances published from a change feed on top of an online table that is behind."""
    columns = ["c_custkey", "c_acctbal", "c_mktsegment"]
    source = read_table(spark, "customer", sf_dir).select(*columns)
    schema = read_table(spark, "customer", sf_dir).schema
    changes = feeds.stream_table(spark, sf_dir, schema, "customer.parquet").select(
        *columns,
        F.lit("update_postimage").alias("_change_type"),
        F.lit(1).cast("bigint").alias("_commit_version"),
    )
    sink, checkpoint = scratch_path(spark, "published"), scratch_path(spark, "checkpoint")
    publish_stream(source, changes, sink, checkpoint, "c_custkey").awaitTermination()
    behind = source.where(F.col("c_mktsegment") != "BUILDING").withColumn("c_acctbal", F.lit(0.0))
    return feeds.read_mirror(behind, sink, changes.schema, ["c_custkey"])


@query
def stream_ingest(spark, sf_dir):
    events = read_table(spark, "events", sf_dir)
    incoming = feeds.stream_table(spark, sf_dir, events.schema, "events.parquet")
    sink = scratch_path(spark, "turns")
    for run in ("first", "replay"):
        checkpoint = scratch_path(spark, "checkpoint")
        feeds.ingest_stream(
            incoming, sink, checkpoint, [F.col("ts").asc()], key="event_id", run=run
        ).awaitTermination()
    stored = feeds.read_batches(spark, sink, events.schema)
    return stored.select("event_id", "user_id", "event_type", feeds.RUN)


@query
def stream_restart(spark, sf_dir):
    """The first checkpoint is lost after everything was stored; a new one delivers it all again."""
    events = read_table(spark, "events", sf_dir)
    sink = scratch_path(spark, "turns")
    for _ in range(2):
        incoming = feeds.stream_table(spark, sf_dir, events.schema, "events.parquet")
        checkpoint = scratch_path(spark, "checkpoint")
        feeds.ingest_stream(incoming, sink, checkpoint, [F.col("ts").asc()], key="event_id").awaitTermination()
    return feeds.read_batches(spark, sink, events.schema).select("event_id", "user_id", "event_type", "value")


@query
def stream_ingest_stateful(spark, sf_dir):
    """Events in three deliveries with repeats; the third comes after a restart from the same checkpoint."""
    events = read_table(spark, "events", sf_dir)
    folder, sink, checkpoint = (scratch_path(spark, n) for n in ("delivered", "turns", "checkpoint"))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before_ = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def deliver(number: int, rows: DataFrame) -> None:
        rows.withColumn("delivery", F.lit(number)).write.mode("append").parquet(folder)

    try:
        schema = events.withColumn("delivery", F.lit(0)).schema
        deliver(1, events.where(F.col("ts") < ntz(MIDDLE)))
        for number in (2, 3):
            deliver(number, events)
            incoming = feeds.stream_table(spark, folder, schema)
            stateful.ingest_stream_stateful(
                incoming, sink, checkpoint, ["delivery"], key="event_id"
            ).awaitTermination()
    finally:
        spark.conf.set(provider, before_)
    return feeds.read_batches(spark, sink, schema).select("event_id", "user_id", "event_type", "delivery")


@query
def bucket_upsert(spark, sf_dir):
    """An upsert of every 500th customer into a table of 16 buckets: which rows' files were rewritten?"""
    columns = ["c_custkey", "c_acctbal", "c_mktsegment"]
    customer = read_table(spark, "customer", sf_dir).select(*columns)
    root = scratch_path(spark, "customers")
    stored = buckets.write_buckets(customer, root, ["c_custkey"], 16)
    files = materialise(stored.select("c_custkey", F.input_file_name().alias("file")), "files")
    batch = customer.where(F.col("c_custkey") % 500 == 0).withColumn("c_acctbal", F.lit(0.0))

    def step(target, rows):
        return up.upsert(target, rows, ["c_custkey"], ["c_acctbal"])

    for _ in range(2):  # the second time is a retry
        buckets.rewrite(root, customer.schema, batch, ["c_custkey"], 16, step)
    after = buckets.read_buckets(spark, root, customer.schema).select(*columns, F.input_file_name().alias("now"))
    return after.join(files, "c_custkey", "left").select(*columns, (F.col("file") != F.col("now")).alias("rewritten"))


@query
def bucket_feed(spark, sf_dir):
    """The change feed of the orders applied bucket by bucket."""
    orders = _orders(spark, sf_dir)
    mirror = _mirror(orders).select(*ORDER)
    root = scratch_path(spark, "orders")
    buckets.write_buckets(mirror, root, ["o_orderkey"], 16)

    def step(target, changes):
        return sync.apply_changes(target, changes, ["o_orderkey"])

    buckets.rewrite(root, mirror.schema, _feed(orders), ["o_orderkey"], 16, step)
    return buckets.read_buckets(spark, root, mirror.schema)


@query
def drifted_by_digest(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return digests.drifted_rows(orders, _mirror(orders), ["o_orderkey"])


@query
def reconcile_counts(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    customer = read_table(spark, "customer", sf_dir)
    return sync.reconcile_counts(
        {
            "orders": (orders, _mirror(orders)),
            "customer": (customer, customer),
            "supplier": (read_table(spark, "supplier", sf_dir), None),
        }
    )


@query
def reconcile_rows(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return sync.reconcile_rows(orders, _mirror(orders), ["o_orderkey"])


@query
def drifted_keys(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    compared = sync.compare_rows(orders, _mirror(orders), ["o_orderkey"])
    return compared.where(F.col("status") != "ok")


# --- features ---------------------------------------------------------------------------------

LOOKUPS = [
    feat.FeatureLookup(
        "customer_features", "c_custkey", ["engagement_90d", "days_since_last_interaction"]
    ),
    feat.FeatureLookup("customer_balance", "c_custkey", ["c_acctbal"]),
]


def _features(spark, sf_dir, scores: DataFrame | None = None) -> DataFrame:
    orders = _orders(spark, sf_dir).withColumnRenamed("o_custkey", "c_custkey")
    return feat.build_features(orders, "c_custkey", "o_orderdate", FEATURES_AS_OF, scores=scores)


def _published(spark, sf_dir) -> dict[str, DataFrame]:
    customer = read_table(spark, "customer", sf_dir)
    return {"customer_features": _features(spark, sf_dir), "customer_balance": customer}


def _labels(spark, sf_dir) -> DataFrame:
    return read_table(spark, "customer", sf_dir).select(
        "c_custkey", (F.col("c_mktsegment") == "BUILDING").cast("int").alias("label")
    )


@query
def feature_build(spark, sf_dir):
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("c_acctbal") / F.lit(-1000.0)))
    scores = read_table(spark, "customer", sf_dir).select("c_custkey", chance.alias("propensity_score"))
    return _ranked(_features(spark, sf_dir, scores).drop("computed_at"), "propensity_score")


@query
def feature_slide(spark, sf_dir):
    """The window features of a day, moved there in two steps from the counts of days."""
    orders = _orders(spark, sf_dir).withColumnRenamed("o_custkey", "c_custkey")
    path = scratch_path(spark, "days")
    counted = feat.day_counts(orders, "c_custkey", "o_orderdate")
    counted.repartitionByRange("day").sortWithinPartitions("day").write.parquet(path)
    days = spark.read.parquet(path)
    first, second, last = "2001-06-01", "2001-07-31", FEATURES_AS_OF[:10]
    state = feat.window_start(days, "c_custkey", first)
    state = feat.window_slide(state, days, "c_custkey", first, second)
    state = feat.window_slide(state, days, "c_custkey", second, last)
    return feat.window_features(state, "c_custkey", FEATURES_AS_OF).drop("computed_at")


@query
def feature_lookup(spark, sf_dir):
    return feat.lookup(_labels(spark, sf_dir), LOOKUPS, _published(spark, sf_dir))


@query
def training_set(spark, sf_dir):
    return feat.training_set(
        _labels(spark, sf_dir), LOOKUPS, _published(spark, sf_dir), exclude=["c_custkey"]
    )


@query
def batch_score(spark, sf_dir):
    published = _published(spark, sf_dir)
    rows = feat.training_set(_labels(spark, sf_dir), LOOKUPS, published, exclude=["c_custkey"])
    names = [n for spec in LOOKUPS for n in spec.feature_names]
    model = feat.train(rows, names)
    keys = read_table(spark, "customer", sf_dir).select("c_custkey")
    return feat.score(keys, LOOKUPS, published, model)


@query
def publish_features(spark, sf_dir):
    source = _features(spark, sf_dir)
    recent = F.col("engagement_90d") > 0
    online = source.where(F.col("days_since_last_interaction") < 600).withColumn(
        "engagement_90d", F.when(recent, F.lit(0)).otherwise(F.col("engagement_90d"))
    )
    stale = source.where(~recent).withColumn("c_custkey", -1 - F.col("c_custkey"))
    published = feat.publish(source, online.unionByName(stale), "c_custkey", "triggered")
    return published.drop("computed_at")


# --- quality ----------------------------------------------------------------------------------

EXPECTED_TABLES = ("customer", "documents", "embeddings", "events", "orders", "ledger")


def _found(spark, sf_dir) -> dict[str, DataFrame | None]:
    found: dict[str, DataFrame | None] = {}
    for name in EXPECTED_TABLES:
        try:
            found[name] = read_table(spark, name, sf_dir)
        except AnalysisException:
            found[name] = None
    return found


@query
def quality_report(spark, sf_dir):
    documents = read_table(spark, "documents", sf_dir)
    embeddings = read_table(spark, "embeddings", sf_dir)
    events = read_table(spark, "events", sf_dir)
    return quality.run_checks(
        [
            quality.no_null_keys(documents, "doc_id", "documents key"),
            quality.min_text_length(documents, "text", 20, "documents text"),
            quality.min_rows(documents, 100, "documents rows"),
            quality.min_rows(documents, 10**12, "documents volume"),
            quality.unique_key(documents, ["doc_id"], "documents unique key"),
            quality.unique_key(documents, ["text"], "documents unique text"),
            quality.vector_width(embeddings, "embedding", 64, "embedding width"),
            quality.values_present(events, "event_type", ["click", "refund", "view"], "event types"),
            quality.values_present(documents, "lang", ["de", "en", "es", "fr"], "languages"),
            quality.scope_isolation(
                mem.scoped(adapters.turns(spark, sf_dir), rep="3"), F.col("rep_id") == "3"
            ),
            quality.scope_isolation(
                mem.scoped(adapters.turns(spark, sf_dir), rep="nobody"),
                F.col("rep_id") == "nobody", "empty scope",
            ),
            quality.counts_match({"orders": (_orders(spark, sf_dir), _mirror(_orders(spark, sf_dir)))}),
        ]
    )


@query
def present_targets(spark, sf_dir):
    counted = quality.table_counts(_found(spark, sf_dir))
    found = counted.where(F.col("present") & (F.col("n_rows") > 0))
    return sync.present_targets(spark, EXPECTED_TABLES, found)


@query
def missing_tables(spark, sf_dir):
    counted = quality.table_counts(_found(spark, sf_dir))
    return counted.where(~F.col("present")).select("table_name")


@query
def table_counts(spark, sf_dir):
    return quality.table_counts(_found(spark, sf_dir))
