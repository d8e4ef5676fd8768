"""DuckDB SQL for the registered queries, over the same parquet tables."""

from __future__ import annotations

from checks.adapters import (
    AS_OF,
    CORPUS_SQL,
    DIMENSION_SQL,
    FEATURES_AS_OF,
    QUESTIONS_SQL,
    SEARCH_SQL,
    TURNS_SQL,
)

MIDDLE = "TIMESTAMP '2024-01-16 00:00:00'"
STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"
ORACLES: dict[str, str] = {}


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def clusters(source: str = "turns", name: str = "clusters") -> str:
    return f"""
{name} AS (
  SELECT rep_id, hcp_id, topic, count(*) AS n,
         string_agg(left(content, 160), ' | ' ORDER BY ext_id) AS sample,
         least(CAST(1.0 AS DOUBLE), CAST(0.4 AS DOUBLE) + CAST(0.1 AS DOUBLE) * count(*)) AS rising
  FROM {source} WHERE topic IS NOT NULL AND ext_id IS NOT NULL
  GROUP BY rep_id, hcp_id, topic HAVING count(*) >= 3)"""


def facts(
    source: str = "clusters",
    name: str = "facts",
    text: str = "topic || ': ' || sample",
    fallback: str = "FALSE",
) -> str:
    return f"""
{name} AS (
  SELECT 'consolidate:' || rep_id || ':' || hcp_id || ':' || topic AS source_key,
         rep_id, hcp_id, topic, 'hcp' AS scope, {text} AS fact_text,
         round(raw, 3) AS confidence,
         CASE WHEN {fallback} THEN 'review' WHEN raw >= 0.6 THEN 'active' ELSE 'review' END AS status,
         {fallback} AS used_fallback, n
  FROM (SELECT *, CASE WHEN topic IN ('error', 'purchase') AND n < 4
                       THEN least(rising, CAST(0.5 AS DOUBLE)) ELSE rising END AS raw
        FROM {source}))"""


def themes(source: str = "turns", name: str = "themes", min_hcps: int = 10) -> str:
    return f"""
{name} AS (
  SELECT specialty, topic, count(*) AS n, count(DISTINCT rep_id) AS reps,
         count(DISTINCT hcp_id) AS hcps
  FROM {source} JOIN dim USING (hcp_id)
  WHERE ext_id IS NOT NULL AND topic IS NOT NULL AND topic <> 'signup'
  GROUP BY specialty, topic
  HAVING count(DISTINCT rep_id) >= 3 AND count(DISTINCT hcp_id) >= {min_hcps})"""


def theme_facts(source: str = "themes", name: str = "theme_facts") -> str:
    return f"""
{name} AS (
  SELECT 'abstract:' || specialty || ':' || topic AS source_key,
         CAST(NULL AS VARCHAR) AS rep_id, CAST(NULL AS VARCHAR) AS hcp_id, 'org' AS scope,
         'Across the ' || specialty || ' segment, ''' || topic || ''' is raised repeatedly (' ||
         reps || ' reps, ' || hcps || ' HCPs, ' || n ||
         ' turns) — an emerging cross-rep theme.' AS fact_text,
         round(least(CAST(1.0 AS DOUBLE), CAST(0.5 AS DOUBLE) + CAST(0.05 AS DOUBLE) * reps), 3)
           AS confidence,
         'active' AS status, reps, hcps, n
  FROM {source})"""


LINKS = """
links AS (
  SELECT 'consolidate:' || t.rep_id || ':' || t.hcp_id || ':' || t.topic AS source_key, ext_id
  FROM turns t JOIN clusters c ON t.rep_id = c.rep_id AND t.hcp_id = c.hcp_id AND t.topic = c.topic)"""
THEME_LINKS = """
theme_links AS (
  SELECT 'abstract:' || m.specialty || ':' || m.topic AS source_key, t.ext_id
  FROM turns t JOIN dim d ON t.hcp_id = d.hcp_id
  JOIN themes m ON m.specialty = d.specialty AND m.topic = t.topic)"""
CONFLICTS = """
conflicts AS (
  SELECT 'contradiction:' || ext_id AS source_key, CAST(NULL AS VARCHAR) AS rep_id, hcp_id,
         'hcp' AS scope, '[contradiction — needs review] ' || content AS fact_text,
         CAST(0.4 AS DOUBLE) AS confidence, 'review' AS status, ext_id
  FROM turns WHERE topic = 'purchase' AND hcp_id IN (
    SELECT hcp_id FROM turns WHERE topic = 'purchase' GROUP BY hcp_id HAVING count(*) >= 40))"""
CLAIMS = """
claims AS (
  SELECT 'claim:' || ext_id AS source_key, CAST(NULL AS VARCHAR) AS rep_id,
         CAST(NULL AS VARCHAR) AS hcp_id, 'org' AS scope,
         '[UNVERIFIED clinical claim — do not surface] ' || content AS fact_text,
         CAST(0.35 AS DOUBLE) AS confidence, 'review' AS status, ext_id
  FROM turns WHERE topic = 'error' AND content ILIKE '%"k": 7}%')"""
DECAYED = f"""
decayed AS (
  SELECT f.* REPLACE (CASE WHEN status = 'active' AND NOT EXISTS (
           SELECT 1 FROM links l JOIN turns t ON t.ext_id = l.ext_id
           WHERE l.source_key = f.source_key
             AND t.created_at > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY)
         THEN 'archived' ELSE status END AS status)
  FROM facts f)"""
FACT = "source_key, rep_id, hcp_id, scope, fact_text, confidence, status"
BASE = (TURNS_SQL, clusters(), facts())
DREAM_PASSES = (
    DIMENSION_SQL, LINKS, themes(), theme_facts(), THEME_LINKS, CONFLICTS, CLAIMS, DECAYED,
    f"""
dreamt AS (
  SELECT {FACT} FROM decayed UNION ALL SELECT {FACT} FROM theme_facts
  UNION ALL SELECT {FACT} FROM conflicts UNION ALL SELECT {FACT} FROM claims)""",
    """
dreamt_links AS (
  SELECT source_key, ext_id FROM links UNION SELECT source_key, ext_id FROM theme_links
  UNION SELECT source_key, ext_id FROM conflicts UNION SELECT source_key, ext_id FROM claims)""",
)
DREAM = (*BASE, *DREAM_PASSES)


def refused(answer: str) -> dict[str, str]:
    """Text and fallback of facts whose model gives `answer` but refuses one topic."""
    sign = "'Recurring ''signup'' discussion pattern observed for this HCP.'"
    return {
        "text": f"CASE WHEN topic = 'signup' THEN {sign} ELSE {answer} END",
        "fallback": "(topic = 'signup')",
    }


def chunked(turns_a_chunk: int, levels: int = 8) -> str:
    """`chunked`: the clusters with the text that a model which quotes its prompt ends with."""
    def chunks(of: str) -> str:
        return f"CAST(ceil({of} / {turns_a_chunk}.0) AS BIGINT)"

    cluster = "rep_id, hcp_id, topic, n"
    parts = [f"""
level0 AS (
  SELECT {cluster}, chunk, chunks, 'noted: ' || string_agg(left(content, 160), ' | ' ORDER BY ext_id) AS text
  FROM (SELECT c.*, t.content, t.ext_id, {chunks('c.n')} AS chunks,
               CAST('0x' || left(md5(t.ext_id), 8) AS BIGINT) % {chunks('c.n')} AS chunk
        FROM turns t JOIN clusters c USING (rep_id, hcp_id, topic))
  GROUP BY {cluster}, chunk, chunks)"""]
    for i in range(1, levels + 1):
        parts.append(f"""
level{i} AS (
  SELECT {cluster}, part % fewer AS chunk, fewer AS chunks, 'noted: ' || string_agg(text, ' | ' ORDER BY part) AS text
  FROM (SELECT *, chunk AS part, {chunks('chunks')} AS fewer FROM level{i - 1} WHERE chunks > 1)
  GROUP BY {cluster}, part % fewer, fewer)""")
    done = " UNION ALL ".join(
        f"SELECT {cluster}, text FROM level{i} WHERE chunks = 1" for i in range(levels + 1)
    )
    parts.append(f"""
chunked AS (
  SELECT c.* REPLACE (d.text AS sample)
  FROM clusters c JOIN ({done}) d USING (rep_id, hcp_id, topic))""")
    return ",".join(parts)

ORACLES["scan_scoped_turns"] = with_(TURNS_SQL) + f"""
SELECT ext_id, rep_id, hcp_id, topic, {STAMP.format('created_at')}
FROM turns WHERE rep_id = '3' AND hcp_id = '7'"""

ORACLES["sql_named_parameters"] = f"""
SELECT event_type, count(*) AS n FROM events
WHERE ts >= {MIDDLE} AND value > 10.0 GROUP BY event_type"""

ORACLES["catalog_listing"] = """
SELECT 'region' AS table_name, count(*) AS n_rows, true AS followed FROM region
UNION ALL SELECT 'nation', count(*), false FROM nation
UNION ALL SELECT 'supplier', count(*), true FROM supplier"""
ORACLES["recall_recent"] = with_(TURNS_SQL) + f"""
SELECT ext_id, topic, {STAMP.format('created_at')} FROM (
  SELECT * FROM turns WHERE hcp_id = '7'
  ORDER BY created_at DESC NULLS LAST, ext_id LIMIT 5)"""

ORACLES["recall_ranked"] = with_(TURNS_SQL) + f"""
SELECT ext_id, topic, {STAMP.format('created_at')} FROM (
  SELECT * FROM turns WHERE hcp_id = '7'
  ORDER BY (topic = 'purchase') DESC NULLS LAST, created_at DESC NULLS LAST, ext_id LIMIT 5)"""

ORACLES["recall_topk_per_scope"] = with_(TURNS_SQL) + """
SELECT rep_id, hcp_id, rn, ext_id FROM (
  SELECT rep_id, hcp_id, ext_id, row_number() OVER (
    PARTITION BY rep_id, hcp_id
    ORDER BY (topic = 'purchase') DESC NULLS LAST, created_at DESC NULLS LAST, ext_id) AS rn
  FROM turns) WHERE rn <= 5"""

ORACLES["recall_bucketed"] = ORACLES["recall_topk_per_scope"]
ORACLES["recall_conversation_tail"] = """
SELECT conv_id, turn, role, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations)
WHERE rn <= 3"""

ORACLES["session_summary"] = with_(TURNS_SQL) + f"""
SELECT session_id, rep_id, hcp_id, {STAMP.format('created_at').replace('AS created_at', 'AS started_at')}
FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY created_at, ext_id) AS rn
      FROM turns WHERE session_id IS NOT NULL) WHERE rn = 1"""

ORACLES["promote_latest"] = with_(
    TURNS_SQL,
    f"""
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY rep_id, hcp_id, topic
    ORDER BY created_at < {MIDDLE} DESC, created_at DESC, ext_id DESC) AS rn
  FROM turns)""",
) + """
SELECT 'handpromote:' || rep_id || ':' || hcp_id || ':' || topic AS source_key, rep_id, hcp_id,
       'hcp' AS scope, 'comes back to it' AS fact_text, CAST(1.0 AS DOUBLE) AS confidence,
       'active' AS status, ext_id
FROM ranked WHERE rn = 1"""

ORACLES["insert_if_absent"] = with_(TURNS_SQL) + f"""
SELECT ext_id, CASE WHEN created_at < {MIDDLE} THEN '0 ' ELSE '1 ' END || content AS content FROM turns
UNION ALL
SELECT NULL AS ext_id, '3 ' || content AS content FROM turns WHERE topic = 'error'"""

ORACLES["additive_columns"] = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders"""

ORACLES["guarded_upsert"] = with_(
    TURNS_SQL,
    f"early AS (SELECT * FROM turns WHERE created_at < {MIDDLE})",
    clusters("early", "old_clusters"), facts("old_clusters", "old_facts"),
    clusters(), facts(),
    """
stored AS (
  SELECT * REPLACE (CASE CAST(hcp_id AS INTEGER) % 3 WHEN 0 THEN 'review' WHEN 1 THEN 'archived'
                    ELSE status END AS status) FROM old_facts)""",
) + f"""
SELECT coalesce(o.source_key, f.source_key) AS source_key,
       coalesce(o.rep_id, f.rep_id) AS rep_id, coalesce(o.hcp_id, f.hcp_id) AS hcp_id,
       coalesce(o.scope, f.scope) AS scope, coalesce(f.fact_text, o.fact_text) AS fact_text,
       coalesce(f.confidence, o.confidence) AS confidence,
       CASE WHEN o.status IN ('review', 'archived') THEN o.status
            ELSE coalesce(f.status, o.status) END AS status,
       CASE WHEN o.source_key IS NULL THEN '2024-02-01 00:00:00.000000'
            ELSE '{AS_OF}.000000' END AS created_at
FROM stored o FULL JOIN facts f ON o.source_key = f.source_key"""

ORACLES["plain_upsert"] = with_(
    TURNS_SQL, DIMENSION_SQL,
    f"early AS (SELECT * FROM turns WHERE created_at < {MIDDLE})",
    themes("early", "old_themes"), theme_facts("old_themes", "old_facts"),
    themes(), theme_facts(),
) + """
SELECT coalesce(o.source_key, f.source_key) AS source_key,
       coalesce(f.rep_id, o.rep_id) AS rep_id, coalesce(f.hcp_id, o.hcp_id) AS hcp_id,
       'org' AS scope, coalesce(f.fact_text, o.fact_text) AS fact_text,
       coalesce(f.confidence, o.confidence) AS confidence,
       CASE WHEN o.source_key LIKE '%:click' THEN 'archived'
            ELSE coalesce(o.status, f.status) END AS status
FROM old_facts o FULL JOIN theme_facts f ON o.source_key = f.source_key"""

ORACLES["conditional_update"] = with_(TURNS_SQL) + f"""
SELECT ext_id,
       CASE WHEN topic = 'error' AND created_at < {MIDDLE} THEN 'system' ELSE role END AS role,
       CASE WHEN topic = 'error' AND created_at < {MIDDLE} THEN '[redacted]' ELSE content END AS content
FROM turns"""

ORACLES["update_by_key"] = """
SELECT c_custkey, count(o_orderkey) AS n_orders
FROM customer LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY c_custkey"""

ORACLES["lineage_links"] = with_(TURNS_SQL, clusters(), LINKS) + """
SELECT DISTINCT source_key, ext_id FROM links"""

ORACLES["cluster_turns"] = with_(TURNS_SQL, clusters(), chunked(256)) + """
SELECT rep_id, hcp_id, topic, n, chunk, chunks, substr(text, 8) AS sample FROM level0"""

ORACLES["largest_clusters"] = with_(TURNS_SQL, clusters()) + """
SELECT rep_id, hcp_id, topic, n FROM clusters ORDER BY n DESC, rep_id, hcp_id, topic LIMIT 12"""

ORACLES["consolidate_facts"] = with_(*BASE) + f"SELECT {FACT}, n FROM facts"

ORACLES["consolidate_fallback"] = with_(
    TURNS_SQL, clusters(),
    facts(
        text="'Recurring ''' || topic || ''' discussion pattern observed for this HCP.'",
        fallback="TRUE",
    ),
) + f"SELECT {FACT}, used_fallback FROM facts"

ORACLES["distil_clusters"] = with_(
    TURNS_SQL, clusters(),
    facts(**refused("'noted: ' || sample")),
) + f"SELECT {FACT}, used_fallback FROM facts"
ORACLES["distil_in_chunks"] = with_(
    TURNS_SQL, clusters(), chunked(3), facts("chunked", **refused("sample"))
) + f"SELECT {FACT}, used_fallback FROM facts"

ORACLES["abstract_themes"] = with_(TURNS_SQL, DIMENSION_SQL, themes(), theme_facts()) + f"""
SELECT {FACT}, reps, hcps, n FROM theme_facts"""

ORACLES["theme_lineage"] = with_(TURNS_SQL, DIMENSION_SQL, themes(), THEME_LINKS) + """
SELECT source_key, ext_id FROM theme_links"""

ORACLES["top_themes"] = with_(TURNS_SQL, DIMENSION_SQL, themes(min_hcps=3)) + """
SELECT specialty, topic, n, reps, hcps FROM themes
ORDER BY reps DESC, n DESC, specialty, topic LIMIT 5"""

ORACLES["contradictions"] = with_(TURNS_SQL, CONFLICTS) + f"SELECT {FACT}, ext_id FROM conflicts"
ORACLES["hold_claims"] = with_(TURNS_SQL, CLAIMS) + f"SELECT {FACT}, ext_id FROM claims"
ORACLES["decay_facts"] = with_(*BASE, LINKS, DECAYED) + """
SELECT source_key, confidence, status FROM decayed"""
ORACLES["dream_facts"] = with_(*DREAM) + f"SELECT {FACT} FROM dreamt"
ORACLES["dream_incremental"] = with_(
    *DREAM,
    clusters(f"(SELECT * FROM turns WHERE created_at < {MIDDLE})", "early"),
    facts("early", "early_facts"),
    f"""
earlier AS (
  SELECT f.source_key, CASE WHEN f.status = 'active' AND max(t.created_at) <= {MIDDLE} - INTERVAL 7 DAY
                            THEN 'archived' ELSE f.status END AS status
  FROM early_facts f JOIN turns t ON t.rep_id = f.rep_id AND t.hcp_id = f.hcp_id AND t.topic = f.topic
  WHERE t.created_at < {MIDDLE} GROUP BY f.source_key, f.status)""",
    """
linked AS (SELECT source_key, count(*) AS n_links FROM dreamt_links GROUP BY source_key)""",
) + """
SELECT d.* REPLACE (CASE WHEN e.status IN ('review', 'archived') THEN e.status ELSE d.status END AS status), n_links
FROM dreamt d LEFT JOIN earlier e USING (source_key) LEFT JOIN linked USING (source_key)"""
ORACLES["dream_model_facts"] = with_(
    TURNS_SQL, clusters(), facts(**refused("'noted: ' || sample")), *DREAM_PASSES
) + f"SELECT {FACT} FROM dreamt"
ORACLES["dream_lineage"] = with_(*DREAM) + "SELECT source_key, ext_id FROM dreamt_links"

ORACLES["review_summary"] = with_(*DREAM) + """
SELECT count(*) FILTER (status = 'review') AS in_review,
       count(*) FILTER (status = 'review' AND fact_text ILIKE '%"k": 7}%') AS review_matches,
       count(*) FILTER (status = 'active' AND fact_text ILIKE '%"k": 7}%') AS visible_matches
FROM dreamt"""

ORACLES["agent_knows"] = with_(*DREAM) + """
SELECT source_key, scope, fact_text, confidence FROM dreamt
WHERE status = 'active' AND fact_text ILIKE '%purchase%'
  AND (scope = 'org' OR (scope = 'hcp' AND rep_id = '3' AND hcp_id = '7'))
ORDER BY confidence DESC NULLS LAST, source_key LIMIT 3"""

ORACLES["agent_knows_per_scope"] = with_(*DREAM) + """
SELECT rep_id, hcp_id, rn, source_key, scope, fact_text, confidence FROM (
  SELECT s.rep_id, s.hcp_id, f.source_key, f.scope, f.fact_text, f.confidence,
         row_number() OVER (PARTITION BY s.rep_id, s.hcp_id
                            ORDER BY f.confidence DESC NULLS LAST, f.source_key) AS rn
  FROM (SELECT DISTINCT rep_id, hcp_id FROM turns) s
  JOIN dreamt f ON f.status = 'active' AND f.fact_text ILIKE '%click%'
   AND (f.scope = 'org' OR (f.scope = 'hcp' AND f.rep_id = s.rep_id AND f.hcp_id = s.hcp_id)))
WHERE rn <= 3"""

ORACLES["trace_facts"] = with_(*BASE, LINKS) + """
SELECT f.source_key, t.ext_id, t.rep_id AS turn_rep_id, t.hcp_id AS turn_hcp_id,
       t.topic AS turn_topic, t.content AS turn_content
FROM facts f JOIN links l ON l.source_key = f.source_key JOIN turns t ON t.ext_id = l.ext_id"""

ORACLES["lineage_coverage"] = with_(*DREAM) + f"""
SELECT scope, status, count(*) AS n_facts, count(r.source_key) AS n_linked,
       count(*) - count(r.source_key) AS n_unlinked
FROM dreamt f LEFT JOIN (
  SELECT DISTINCT l.source_key FROM dreamt_links l
  JOIN turns t ON t.ext_id = l.ext_id AND t.created_at < {MIDDLE}) r ON r.source_key = f.source_key
GROUP BY scope, status"""

# --- retrieval --------------------------------------------------------------------------------

# The usual English stop words of text search, stated apart from the library's own list.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now
""".split()

_stop = {"stop": "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"}
SEARCH = (CORPUS_SQL, SEARCH_SQL % _stop)
COSINE = (
    "1 - list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])) / "
    "(sqrt(list_dot_product(CAST({a} AS DOUBLE[]), CAST({a} AS DOUBLE[]))) * "
    "sqrt(list_dot_product(CAST({b} AS DOUBLE[]), CAST({b} AS DOUBLE[]))))"
)


def vector_leg(where: str = "TRUE", k: int = 20) -> str:
    return f"""
asked AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0),
v AS (
  SELECT content_id, distance, row_number() OVER (ORDER BY round(distance, 12), content_id) AS rank
  FROM (SELECT content_id, {COSINE.format(a='embedding', b='q')} AS distance
        FROM corpus, asked WHERE embedding IS NOT NULL AND {where})
  QUALIFY rank <= {k})"""


def bm25_weight(df: str, tf: str, mean: str = "mean_length", texts: str = "texts") -> str:
    return (
        f"ln(1 + ({texts} - {df} + 0.5) / ({df} + CAST(0.5 AS DOUBLE))) * {tf} * CAST(2.2 AS DOUBLE) / "
        f"({tf} + CAST(1.2 AS DOUBLE) * (0.25 + CAST(0.75 AS DOUBLE) * n_terms / {mean}))"
    )


def keyword_leg(words: list[list[str]], where: str = "TRUE", k: int = 20) -> str:
    """All `words` are needed, each in any of its forms."""
    counts = ", ".join(
        f"count(*) FILTER (list_has_any(words, {forms})) AS df{i}" for i, forms in enumerate(words)
    )
    tfs = ", ".join(
        f"len(list_filter(words, lambda w: list_contains({forms}, w))) AS tf{i}"
        for i, forms in enumerate(words)
    )
    score = " + ".join(bm25_weight(f"df{i}", f"tf{i}") for i in range(len(words)))
    needed = " AND ".join(f"list_has_any(words, {forms})" for forms in words)
    return f"""
own AS (SELECT * FROM docs WHERE {where}),
stats AS (SELECT count(*) AS texts, avg(n_terms) AS mean_length, {counts} FROM own),
t AS (
  SELECT content_id, score, row_number() OVER (ORDER BY round(score, 9) DESC, content_id) AS rank
  FROM (SELECT content_id, {score} AS score
        FROM (SELECT *, {tfs} FROM own WHERE {needed}), stats)
  QUALIFY rank <= {k})"""


WORDS = [["ndble"], ["tion"]]
# The words with the stem of "tions", written out so that the SQL needs no stemmer.
STEMMED = [
    "tion tions tiones tioned tionedly tioning tioningly tionly tionlyed tionlying".split()
]

FUSED = """
SELECT content_id, doc_type, left(chunk_text, 70) AS snippet, v.rank AS vector_rank,
       t.rank AS keyword_rank,
       round(coalesce(CAST(1.0 AS DOUBLE) / (60 + v.rank), 0) +
             coalesce(CAST(1.0 AS DOUBLE) / (60 + t.rank), 0), 6) AS rrf
FROM (v FULL JOIN t USING (content_id)) JOIN corpus USING (content_id)
ORDER BY coalesce(CAST(1.0 AS DOUBLE) / (60 + v.rank), 0) +
         coalesce(CAST(1.0 AS DOUBLE) / (60 + t.rank), 0) DESC, content_id LIMIT 10"""


def batch_legs(tenant: bool) -> str:
    same = "AND d.brand = q.brand" if tenant else ""
    scope = "brand, " if tenant else ""
    group = "GROUP BY brand" if tenant else ""
    on_scope = "AND f.brand = a.brand" if tenant else ""
    on_stats = "JOIN stats s ON s.brand = q.brand" if tenant else "CROSS JOIN stats s"
    corpus_same = "AND c.brand = q.brand" if tenant else ""
    return f"""
{QUESTIONS_SQL.strip() % _stop},
v AS (
  SELECT query_id, content_id, distance, row_number() OVER (
    PARTITION BY query_id ORDER BY round(distance, 12), content_id) AS rank
  FROM (SELECT query_id, content_id, {COSINE.format(a='c.embedding', b='q.qvec')} AS distance
        FROM corpus c JOIN questions q ON c.embedding IS NOT NULL AND q.qvec IS NOT NULL {corpus_same})
  QUALIFY rank <= 20),
stats AS (SELECT {scope} count(*) AS texts, avg(n_terms) AS mean_length FROM docs {group}),
frequency AS (
  SELECT {scope} term, count(*) AS df
  FROM (SELECT brand, unnest(list_distinct(words)) AS term FROM docs) GROUP BY {scope} term),
matched AS (
  SELECT q.query_id, q.brand, d.content_id, d.words, d.n_terms, q.terms
  FROM docs d JOIN questions q ON len(q.terms) > 0 AND list_has_all(d.words, q.terms) {same}),
scored AS (
  SELECT a.query_id, a.content_id, sum({bm25_weight('df', 'tf')}) AS score
  FROM (SELECT *, len(list_filter(words, lambda w: w = term)) AS tf
        FROM (SELECT query_id, brand, content_id, words, n_terms, unnest(terms) AS term FROM matched)) a
  JOIN frequency f ON f.term = a.term {on_scope}
  {on_stats.replace('q.brand', 'a.brand')}
  GROUP BY a.query_id, a.content_id),
t AS (
  SELECT query_id, content_id, score, row_number() OVER (
    PARTITION BY query_id ORDER BY round(score, 9) DESC, content_id) AS rank
  FROM scored QUALIFY rank <= 20)"""


BATCH_FUSED = """
SELECT query_id, content_id, doc_type, left(chunk_text, 70) AS snippet, vector_rank, keyword_rank,
       rn, round(rrf, 6) AS rrf
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, content_id) AS rn
      FROM (SELECT query_id, content_id, v.rank AS vector_rank, t.rank AS keyword_rank,
                   coalesce(CAST(1.0 AS DOUBLE) / (60 + v.rank), 0) +
                   coalesce(CAST(1.0 AS DOUBLE) / (60 + t.rank), 0) AS rrf
            FROM v FULL JOIN t USING (query_id, content_id)))
JOIN corpus USING (content_id) WHERE rn <= 10"""

ORACLES["vector_topk"] = with_(CORPUS_SQL, vector_leg()) + """
SELECT content_id, round(distance, 6) AS distance, rank FROM v"""
ORACLES["vector_topk_filtered"] = with_(CORPUS_SQL, vector_leg("brand = 'en'")) + """
SELECT content_id, round(distance, 6) AS distance, rank FROM v"""
ORACLES["keyword_match"] = with_(*SEARCH) + """
SELECT content_id, n_terms FROM docs
WHERE (list_contains(words, 'tion') AND NOT list_contains(words, 'ndble'))
   OR list_contains(words, 'ndble')"""
ORACLES["keyword_phrase"] = with_(*SEARCH) + """
SELECT content_id, n_terms
FROM (SELECT *, ' ' || array_to_string(words, ' ') || ' ' AS line FROM docs)
WHERE regexp_matches(line, ' thanedble [^ ]+ onbleea ')
   OR (list_contains(words, 'onbleea') AND NOT list_contains(words, 'ndble'))"""
ORACLES["bm25_topk"] = with_(*SEARCH, keyword_leg(WORDS, "brand = 'en'")) + """
SELECT content_id, round(score, 6) AS score, rank FROM t"""
ORACLES["bm25_topk_indexed"] = ORACLES["bm25_topk"]
ORACLES["bm25_topk_stemmed"] = with_(*SEARCH, keyword_leg(STEMMED, "brand = 'en'")) + """
SELECT content_id, round(score, 6) AS score, rank FROM t"""
ORACLES["ann_topk"] = ORACLES["vector_topk"]
ORACLES["ann_recall"] = """
SELECT vec_id AS query_id, true AS enough, true AS fewer FROM embeddings WHERE vec_id % 50 = 0"""
ORACLES["ann_all_cells"] = ORACLES["vector_topk"]
ORACLES["hybrid_stemmed"] = with_(*SEARCH, vector_leg(), keyword_leg(STEMMED)) + FUSED
ORACLES["hybrid_rrf"] = with_(*SEARCH, vector_leg(), keyword_leg(WORDS)) + FUSED
ORACLES["hybrid_rrf_filtered"] = with_(
    *SEARCH, vector_leg("brand = 'en'"), keyword_leg(WORDS, "brand = 'en'")
) + FUSED
ORACLES["batch_vector"] = with_(*SEARCH, batch_legs(False)) + """
SELECT query_id, content_id, round(distance, 6) AS distance, rank FROM v"""
ORACLES["batch_bm25"] = with_(*SEARCH, batch_legs(False)) + """
SELECT query_id, content_id, round(score, 6) AS score, rank FROM t"""
ORACLES["batch_bm25_indexed"] = ORACLES["batch_bm25"]
ORACLES["batch_hybrid"] = with_(*SEARCH, batch_legs(False)) + BATCH_FUSED
ORACLES["batch_hybrid_per_tenant"] = with_(*SEARCH, batch_legs(True)) + BATCH_FUSED
ORACLES["embed_corpus_hashed"] = with_(*SEARCH) + """,
counted AS (
  SELECT content_id, CAST(CAST('0x' || left(md5(term), 8) AS BIGINT) %% 64 AS INTEGER) AS bucket,
         CAST(count(*) AS DOUBLE) AS n
  FROM (SELECT content_id, unnest(list_filter(words, lambda w: NOT list_contains(%(stop)s, w))) AS term
        FROM docs)
  GROUP BY ALL)
SELECT content_id, bucket,
       CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY content_id)) AS FLOAT) AS DOUBLE) AS value
FROM counted""" % _stop
ORACLES["substring_search"] = """
SELECT pattern, doc_id FROM documents,
     (VALUES ('%tionnd%'), ('%AND%sh_nd%'), ('%éa%ê%'), ('%12%'), ('%_@%.%'), ('%none of these%')) AS p (pattern)
WHERE text ILIKE pattern"""
ORACLES["embed_corpus"] = """
SELECT doc_id AS content_id, CAST(length(text) AS DOUBLE) AS e0,
       CAST(length(text) - length(replace(text, 'a', '')) AS DOUBLE) AS e1,
       CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS e2,
       CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS e3
FROM documents"""

# --- sync -------------------------------------------------------------------------------------

ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
MIRROR = """
mirror AS (
  SELECT * REPLACE (
    CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 450000 THEN 1.0 ELSE o_totalprice END
      AS o_totalprice,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 450000 THEN NULL ELSE o_orderstatus END
      AS o_orderstatus)
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-06-01'
  UNION ALL
  SELECT * REPLACE (-1 - o_orderkey AS o_orderkey)
  FROM orders WHERE o_orderdate < TIMESTAMP '1995-02-01')"""
REPRICED = """
repriced AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1000 ELSE o_totalprice END
                    AS o_totalprice)
  FROM orders WHERE o_orderstatus <> 'P')"""
COMPARED = """
compared AS (
  SELECT coalesce(s.o_orderkey, m.o_orderkey) AS o_orderkey,
         CASE WHEN m.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra'
              WHEN s.o_totalprice IS DISTINCT FROM m.o_totalprice
                OR s.o_orderstatus IS DISTINCT FROM m.o_orderstatus THEN 'drifted'
              ELSE 'ok' END AS status
  FROM orders s FULL JOIN mirror m ON s.o_orderkey = m.o_orderkey)"""
APPLIED = with_(MIRROR, REPRICED) + f"""
SELECT {ORDER} FROM repriced UNION ALL
SELECT {ORDER} FROM mirror WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)"""

ORACLES["snapshot_sync"] = f"SELECT {ORDER} FROM orders"
ORACLES["snapshot_diff"] = with_(MIRROR, COMPARED) + f"""
SELECT {ORDER}, 'insert' AS _change_type, CAST(7 AS BIGINT) AS _commit_version
FROM orders JOIN compared USING (o_orderkey) WHERE status = 'missing'
UNION ALL SELECT {ORDER}, 'delete', 7 FROM mirror JOIN compared USING (o_orderkey) WHERE status = 'extra'
UNION ALL SELECT {ORDER}, 'update_preimage', 7
FROM mirror JOIN compared USING (o_orderkey) WHERE status = 'drifted'
UNION ALL SELECT {ORDER}, 'update_postimage', 7
FROM orders JOIN compared USING (o_orderkey) WHERE status = 'drifted'"""
ORACLES["apply_changes"] = APPLIED
ORACLES["stream_sync"] = APPLIED
ORACLES["stream_continuous"] = APPLIED
ORACLES["diff_then_apply"] = f"SELECT {ORDER} FROM orders"
ORACLES["stream_ingest"] = "SELECT event_id, user_id, event_type, 'first' AS feed_run FROM events"
ORACLES["stream_restart"] = "SELECT event_id, user_id, event_type, value FROM events"
ORACLES["stream_ingest_stateful"] = f"""
SELECT event_id, user_id, event_type, CASE WHEN ts < {MIDDLE} THEN 1 ELSE 2 END AS delivery FROM events"""
ORACLES["bucket_upsert"] = """
WITH placed AS (
  SELECT c_custkey, c_acctbal, c_mktsegment,
         ('0x' || left(md5(c_custkey::VARCHAR), 8))::BIGINT % 16 AS bucket FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 500 = 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
       bucket IN (SELECT bucket FROM placed WHERE c_custkey % 500 = 0) AS rewritten
FROM placed"""
ORACLES["bucket_feed"] = APPLIED
ORACLES["reconcile_counts"] = with_(MIRROR) + """
SELECT 'orders' AS table_name, s.n AS src_rows, m.n AS dst_rows,
       CASE WHEN s.n = m.n THEN 'ok' ELSE 'mismatch' END AS status
FROM (SELECT count(*) AS n FROM orders) s, (SELECT count(*) AS n FROM mirror) m
UNION ALL SELECT 'customer', count(*), count(*), 'ok' FROM customer
UNION ALL SELECT 'supplier', count(*), NULL, 'missing' FROM supplier"""
ORACLES["reconcile_rows"] = with_(MIRROR, COMPARED) + """
SELECT status, count(*) AS n_rows FROM compared GROUP BY status"""
ORACLES["drifted_keys"] = with_(MIRROR, COMPARED) + """
SELECT o_orderkey, status FROM compared WHERE status <> 'ok'"""
ORACLES["drifted_by_digest"] = ORACLES["drifted_keys"]

# --- features ---------------------------------------------------------------------------------

FEATURES = f"""
features AS (
  SELECT o_custkey AS c_custkey,
         CAST(count(*) FILTER (o_orderdate > TIMESTAMP '{FEATURES_AS_OF}' - INTERVAL 90 DAY) AS INTEGER)
           AS engagement_90d,
         CAST(date_diff('day', max(o_orderdate), TIMESTAMP '{FEATURES_AS_OF}') AS INTEGER)
           AS days_since_last_interaction
  FROM orders WHERE o_orderdate <= TIMESTAMP '{FEATURES_AS_OF}'
  GROUP BY o_custkey)"""
LOOKED_UP = """
looked_up AS (
  SELECT c_custkey, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS label,
         engagement_90d, days_since_last_interaction, c_acctbal
  FROM customer LEFT JOIN features USING (c_custkey))"""

ORACLES["feature_build"] = with_(FEATURES) + """
SELECT f.*, round(1.0 / (1.0 + exp(c_acctbal / -1000.0)), 6) AS propensity_score
FROM features f LEFT JOIN customer USING (c_custkey)"""
ORACLES["feature_slide"] = with_(FEATURES) + """
SELECT c_custkey, engagement_90d, days_since_last_interaction FROM features"""
ORACLES["feature_lookup"] = with_(FEATURES, LOOKED_UP) + "SELECT * FROM looked_up"
ORACLES["training_set"] = with_(FEATURES, LOOKED_UP) + """
SELECT label, coalesce(engagement_90d, 0) AS engagement_90d,
       coalesce(days_since_last_interaction, 0) AS days_since_last_interaction, c_acctbal
FROM looked_up"""
ORACLES["publish_features"] = with_(FEATURES) + "SELECT * FROM features"

# --- quality ----------------------------------------------------------------------------------

ORACLES["quality_report"] = with_(
    MIRROR,
    """
checked AS (
  SELECT 'documents key' AS "check", count(*) FILTER (doc_id IS NULL) = 0 AS passed,
         count(*) FILTER (doc_id IS NULL) || ' rows with a null key' AS detail FROM documents
  UNION ALL SELECT 'documents text', count(*) FILTER (length(text) < 20) = 0,
         count(*) FILTER (length(text) < 20) || ' texts too short' FROM documents
  UNION ALL SELECT 'documents rows', count(*) >= 100, count(*) || ' rows' FROM documents
  UNION ALL SELECT 'documents volume', count(*) >= 1000000000000, count(*) || ' rows' FROM documents
  UNION ALL SELECT 'documents unique key', count(*) = 0, count(*) || ' keys occur more than once'
  FROM (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING count(*) > 1)
  UNION ALL SELECT 'documents unique text', count(*) = 0, count(*) || ' keys occur more than once'
  FROM (SELECT text FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1)
  UNION ALL SELECT 'embedding width', count(*) FILTER (len(embedding) <> 64) = 0,
         count(*) FILTER (len(embedding) <> 64) || ' vectors of another width' FROM embeddings
  UNION ALL SELECT 'event types', count(*) = 0, 'missing: ' || string_agg(v, ', ' ORDER BY v)
  FROM (VALUES ('click'), ('refund'), ('view')) e(v) WHERE v NOT IN (SELECT event_type FROM events)
  UNION ALL SELECT 'languages', count(*) = 0, 'missing: ' || string_agg(v, ', ' ORDER BY v)
  FROM (VALUES ('de'), ('en'), ('es'), ('fr')) e(v) WHERE v NOT IN (SELECT lang FROM documents)
  UNION ALL SELECT 'scope isolation', count(*) > 0, count(*) || ' rows, 0 out of scope'
  FROM events WHERE user_id % 12 = 3
  UNION ALL SELECT 'empty scope', FALSE, '0 rows, 0 out of scope'
  UNION ALL SELECT 'mirror orders', s.n = m.n,
         CASE WHEN s.n = m.n THEN 'ok' ELSE 'mismatch' END || ' source=' || s.n || ' mirror=' || m.n
  FROM (SELECT count(*) AS n FROM orders) s, (SELECT count(*) AS n FROM mirror) m)""",
) + """
SELECT "check", CASE WHEN passed THEN 'pass' ELSE 'fail' END AS status,
       CASE WHEN passed AND "check" NOT LIKE 'mirror %' THEN 'ok' ELSE detail END AS detail
FROM checked"""

COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, TRUE AS present, count(*) AS n_rows FROM {t}"
    for t in ("customer", "documents", "embeddings", "events", "orders")
) + " UNION ALL SELECT 'ledger', FALSE, NULL"
ORACLES["table_counts"] = COUNTS
ORACLES["missing_tables"] = f"SELECT table_name FROM ({COUNTS}) WHERE NOT present"
ORACLES["present_targets"] = f"SELECT table_name FROM ({COUNTS}) WHERE present AND n_rows > 0"
ORACLES["scan_filter_limit"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 30"""
ORACLES["ingest_conversations"] = """
SELECT CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS ext_id,
       CAST(conv_id AS VARCHAR) AS session_id, CAST(turn AS INTEGER) AS turn_index, role,
       text AS content
FROM conversations"""
ORACLES["stream_publish"] = "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer"
