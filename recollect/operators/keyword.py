"""Keyword search: web-style queries and BM25 on word lists or on an inverted index."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recollect.functions import text as txt
from recollect.functions.keys import top_k
from recollect.functions.text import Stem
from recollect.operators.corpus import ID, LEG_K, TEXT, filtered
from recollect.session import materialise
from recollect.sources.sinks import write_version

# Sets up to these sizes are broadcast; larger ones are joined by shuffling.
SHIPPED_QUERIES = 1024
SHIPPED_WORDS = 200_000
SHIPPED_PAIRS = 500_000

_POSITIONS = "map<string,array<int>>"
_PLACED = T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))


def index_words(corpus: DataFrame, text_col: str = TEXT, stem: Stem | None = None) -> DataFrame:
    """Add the word list and length that keyword search needs.

    Write the result once and search that: the text is then not split again per search. Without it
    the search functions do the same on the fly. With a `stem`, such as `functions.english.stem`,
    inflected forms of a word match each other; searches must then be given the same one.
    """
    if "words" in corpus.columns:
        return corpus
    # The one-element explode keeps Spark from copying the split into every later filter on it.
    listed = corpus.select("*", F.explode(F.array(txt.words(F.col(text_col)))).alias("words"))
    listed = listed.withColumn("n_terms", F.size(txt.without_stop_words("words")))
    return listed if stem is None else listed.withColumn("words", txt.stemmed(F.col("words"), stem))


def _searchable(
    corpus: DataFrame, where: Column | None, stem: Stem | None, *extra: str
) -> DataFrame:
    rows = filtered(corpus, where)
    if "words" not in rows.columns:
        rows = rows.where(F.col(TEXT).isNotNull()).select(ID, TEXT, *extra)
        rows = index_words(rows, stem=stem)
    return rows.where(F.col("words").isNotNull()).select(ID, "words", "n_terms", *extra)


def _matching(
    corpus: DataFrame, alternatives: list, where: Column | None, stem: Stem | None
) -> DataFrame:
    if not alternatives:
        return _searchable(corpus, where, stem).where(F.lit(False))
    if "words" not in corpus.columns and stem is None:
        # Split only the texts that contain the words somewhere.
        corpus = filtered(corpus, where).where(txt.may_match(F.col(TEXT), alternatives))
        where = None
    return _searchable(corpus, where, stem).where(
        txt.query_matches(txt.WordList(F.col("words")), txt.literal_alternatives(alternatives))
    )


def keyword_match(
    corpus: DataFrame, query: str, where: Column | None = None, stem: Stem | None = None
) -> DataFrame:
    """`(content_id, n_terms)` of the rows that match a web-style query.

    See `functions.text.parse_query` for the syntax.
    """
    return _matching(corpus, txt.parse_query(query, stem), where, stem).select(ID, "n_terms")


def _ranked_by_score(scored: DataFrame, k: int) -> DataFrame:
    order = [F.round("score", 9).desc(), F.col(ID).asc()]
    best = scored.orderBy(*order).limit(k)
    return best.select(ID, "score", F.row_number().over(Window.orderBy(*order)).alias("rank"))


def keyword_topk(
    corpus: DataFrame,
    query: str,
    k: int = LEG_K,
    where: Column | None = None,
    stem: Stem | None = None,
) -> DataFrame:
    """`(content_id, score, rank)` of the `k` matching rows with the highest BM25 score.

    Document count, frequencies and mean length are those of the filtered corpus: one aggregate
    row, read by the scoring pass as a scalar subquery. With a `stem` and no word lists the texts are
    split and stemmed once, for the places of the query's words, which are written for both passes.
    """
    alternatives = txt.parse_query(query, stem)
    if stem is not None and alternatives and "words" not in corpus.columns:
        rows = materialise(_placed(corpus, where, stem, txt.all_words(alternatives)), "placed")
        view: txt.Text = txt.WordPositions(F.col("placed"))
        hits = rows.where(txt.query_matches(view, txt.literal_alternatives(alternatives)))
    else:
        rows = _searchable(corpus, where, stem)
        view = txt.WordList(F.col("words"))
        hits = _matching(corpus, alternatives, where, stem)
    scored_terms = sorted({word for a in alternatives for word in a["needed"]})
    if not scored_terms:
        return _ranked_by_score(hits.select(ID, F.lit(0.0).alias("score")), k)
    frequencies = [
        F.count_if(view.has(F.lit(term))).alias(f"df{i}") for i, term in enumerate(scored_terms)
    ]
    stats = rows.agg(
        F.struct(
            F.count(F.lit(1)).alias("texts"), F.avg("n_terms").alias("mean_length"), *frequencies
        ).alias("stats")
    ).scalar()
    score = txt.bm25(
        view, F.col("n_terms"), F.col("_stats.mean_length"), _weights(scored_terms)
    )
    return _ranked_by_score(
        hits.withColumn("_stats", stats).select(ID, score.alias("score")), k
    )


def _placed(corpus: DataFrame, where: Column | None, stem: Stem, asked: Sequence[str]) -> DataFrame:
    """`(content_id, n_terms, placed)` of every text: where the `asked` stems stand in it."""
    rows = _searchable(corpus, where, None)
    wanted = frozenset(asked)

    def place(batches):
        return txt.placed_stems(batches, stem, wanted)

    kept = rows.select(ID, "n_terms")
    schema = T.StructType([*kept.schema.fields, T.StructField("placed", _PLACED)])
    return rows.select(ID, "n_terms", "words").mapInArrow(place, schema)


def _weights(scored_terms: Sequence[str]) -> Column:
    """(term, weight) of the words of one query, from `_stats` with fields texts and df0, df1, …"""
    return F.array(
        *[
            F.struct(
                F.lit(term).alias("term"),
                txt.idf(F.col("_stats.texts"), F.col(f"_stats.df{i}")).alias("weight"),
            )
            for i, term in enumerate(scored_terms)
        ]
    )


def keyword_topk_batch(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = LEG_K,
    where: Column | None = None,
    tenant: str | None = None,
    stem: Stem | None = None,
) -> DataFrame:
    """`(query_id, content_id, score, rank)` for a table of queries (query_id, q); exact.

    A text becomes a candidate of a query only through the query's rarest needed word, so common
    words cost nothing; the whole query is then checked on the candidate. With `tenant`, a column
    of both tables, matches and all statistics stay inside the query's own tenant.

    Only narrow (word, id) rows are ever exploded. All texts are split once, for the rows of the
    asked words, which are written and serve the word counts and the candidates; the texts of candidates
    are split again. Parsed queries, word counts and candidate pairs are written to the shared folder
    too, which also tells their size: small ones are broadcast, so that the corpus is scanned but not
    shuffled.
    """
    scope = [tenant] if tenant else []
    asked = materialise(_parsed_queries(queries, scope, stem), "queries")
    few_queries = _few(asked)
    searchable = _searchable(corpus, where, stem, *scope)
    postings = materialise(_asked_postings(searchable, asked, scope, few_queries), "asked-postings")
    counted = materialise(_word_counts(postings, scope), "word-counts")
    plan = materialise(_candidate_plan(counted, asked, scope), "query-plan")

    keyed = plan.select("query_id", "alternative", "key", *scope)
    pairs = (
        postings.withColumnRenamed("term", "key")
        .join(_shipped(keyed, few_queries), [*scope, "key"])
        .select(ID, "query_id", "alternative")
    )
    pairs = materialise(pairs, "candidates")
    few_pairs = pairs.count() <= SHIPPED_PAIRS

    stored = ["words", "n_terms"] if "words" in corpus.columns else [TEXT]
    texts = filtered(corpus, where).select(ID, *stored).join(_shipped(pairs, few_pairs), ID)
    candidates = index_words(texts, stem=stem).join(
        _shipped(plan.drop("key", *scope), few_queries), ["query_id", "alternative"]
    )
    return _ranked_candidates(candidates, txt.WordList(F.col("words")), k)


def _ranked_candidates(candidates: DataFrame, view: txt.Text, k: int) -> DataFrame:
    """Check the whole query on each candidate, once per text and query, and rank the hits."""
    hits = candidates.where(
        txt.first_match(view, F.col("alternatives")) == F.col("alternative")
    )
    score = txt.bm25(view, F.col("n_terms"), F.col("mean_length"), F.col("weighted"))
    scored = hits.select("query_id", ID, score.alias("score"))
    order = [F.round("score", 9).desc(), F.col(ID).asc()]
    return top_k(scored, ["query_id"], order, k, "rank")


def _keys() -> Column:
    """The distinct words of a text, and the empty word: queries that need no word find it there."""
    return F.array_union(F.array(F.lit("")), F.col("words"))


def _parsed_queries(queries: DataFrame, scope: list[str], stem: Stem | None) -> DataFrame:
    return (
        queries.select("query_id", *scope, txt.parsed(F.col("q"), stem).alias("alternatives"))
        .withColumn("terms", txt.query_terms(F.col("alternatives")))
        .where(F.size("alternatives") > 0)
    )


def _few(asked: DataFrame) -> bool:
    """Whether the parsed queries, all their words included, may be broadcast."""
    mentioned = F.sum(F.size(txt.words_mentioned(F.col("alternatives"))))
    count, words = asked.agg(F.count(F.lit(1)), F.coalesce(mentioned, F.lit(0))).first()
    return count <= SHIPPED_QUERIES and words <= SHIPPED_WORDS


def _shipped(small: DataFrame, bounded: bool) -> DataFrame:
    return F.broadcast(small) if bounded else small


def _asked_postings(
    texts: DataFrame, asked: DataFrame, scope: list[str], few_queries: bool
) -> DataFrame:
    """One row per text and query word that it has, and one at the empty word for every text."""
    wanted = asked.select(
        *scope, F.explode(F.array_union(F.array(F.lit("")), "terms")).alias("term")
    ).distinct()
    postings = texts.select(ID, *scope, "n_terms", F.explode(_keys()).alias("term"))
    return postings.join(_shipped(wanted, few_queries), [*scope, "term"], "left_semi")


def _word_counts(postings: DataFrame, scope: list[str]) -> DataFrame:
    """Per query word the number of texts that have it; at the empty word all texts and lengths."""
    return postings.groupBy(*scope, "term").agg(
        F.count(F.lit(1)).alias("df"),
        F.sum(F.when(F.col("term") == "", F.col("n_terms"))).alias("total_length"),
    )


def _candidate_plan(counted: DataFrame, asked: DataFrame, scope: list[str]) -> DataFrame:
    """One row per alternative of each query: its rarest word, and the weights for scoring."""
    totals = counted.where(F.col("term") == "").select(
        *scope, F.col("df").alias("texts"),
        F.try_divide(F.col("total_length"), F.col("df")).alias("mean_length"),
    )
    if scope:
        asked = asked.join(totals, scope)
    else:
        both = totals.agg(F.first(F.struct("texts", "mean_length"))).scalar()
        asked = asked.withColumn("_totals", both).select("*", "_totals.*").drop("_totals")
        asked = asked.where(F.col("texts").isNotNull())
    weights = (
        asked.select("query_id", "texts", *scope, F.explode("terms").alias("term"))
        .join(counted.drop("total_length"), [*scope, "term"], "left")
        .withColumn("df", F.coalesce("df", F.lit(0)))
        .withColumn("weight", txt.idf(F.col("texts"), F.col("df")))
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(F.struct("term", "weight", "df"))).alias("weighted"))
    )
    rarest = F.array_min(
        F.transform(
            F.filter("weighted", lambda t: F.array_contains(F.col("one.needed"), t["term"])),
            lambda t: F.struct(t["df"], t["term"]),
        )
    )["term"]
    nothing = F.array().cast("array<struct<term:string,weight:double,df:bigint>>")
    return (
        asked.drop("terms", "texts")
        .join(weights, "query_id", "left")
        .withColumn("weighted", F.coalesce("weighted", nothing))
        .select("*", F.posexplode("alternatives").alias("alternative", "one"))
        .withColumn("key", F.coalesce(rarest, F.lit("")))
        .drop("one")
    )


# --- inverted index ---------------------------------------------------------------------------


class TextIndex(NamedTuple):
    """`postings` (term, content_id, n_terms, carried columns, positions) and `texts` (one row per
    text: content_id, n_terms, carried columns)."""

    postings: DataFrame
    texts: DataFrame


def index_postings(
    corpus: DataFrame, carry: Sequence[str] = (), stem: Stem | None = None
) -> TextIndex:
    """The inverted index of a corpus; `carry` names the columns tenant filters need.

    The words of a text are grouped inside its task and written, because range partitioning reads
    its input twice; the postings are then range-partitioned and sorted by (term, content_id) in one
    shuffle. Written as they are, a search reads only the row groups of its words, and a very common
    word is spread over many files.
    """
    rows = _searchable(corpus, None, stem, *carry)
    texts = rows.select(ID, "n_terms", *carry)
    skip = frozenset(["", *(txt.STOP_WORDS if stem is None else ())])

    def group(batches):
        return txt.postings_in(batches, skip)

    fields = [T.StructField("term", T.StringType()), *texts.schema.fields]
    schema = T.StructType([*fields, T.StructField("positions", T.ArrayType(T.IntegerType()))])
    grouped = materialise(rows.select(*texts.columns, "words").mapInArrow(group, schema), "grouped")
    postings = grouped.repartitionByRange("term", ID).sortWithinPartitions("term", ID)
    return TextIndex(postings, texts)


def write_index(index: TextIndex, root: str, version: int) -> TextIndex:
    """Write both parts of an index as one version and return it as read back."""
    return TextIndex(
        write_version(index.postings, f"{root.rstrip('/')}/postings", version),
        write_version(index.texts, f"{root.rstrip('/')}/texts", version),
    )




def _by_text(postings: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per text with the positions of the query's words; as many entries as it has words."""
    entries = F.collect_list(F.struct("term", "positions"))
    return postings.groupBy(*by).agg(F.map_from_entries(entries).alias("placed"))


def postings_topk(
    index: TextIndex,
    query: str,
    k: int = LEG_K,
    where: Column | None = None,
    stem: Stem | None = None,
) -> DataFrame:
    """`keyword_topk` on an inverted index: reads the postings of the query's words only.

    The words are counted first, one row per word of the query. Then only texts that have the
    rarest needed word of an alternative bring their other words, so a common word next to a rare
    one is read but not shuffled.
    """
    alternatives = txt.parse_query(query, stem)
    texts = filtered(index.texts, where)
    if not alternatives:
        return _ranked_by_score(texts.where(F.lit(False)).select(ID, F.lit(0.0).alias("score")), k)
    mentioned = txt.all_words(alternatives)
    postings = filtered(index.postings, where).where(_is_one_of(mentioned))
    counted = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
    frequency = {word: 0 for word in mentioned} | {r["term"]: r["df"] for r in counted}

    if all(a["needed"] for a in alternatives):
        keys = sorted({min(a["needed"], key=lambda w: (frequency[w], w)) for a in alternatives})
        if keys != mentioned:
            ids = postings.where(_is_one_of(keys)).select(ID).distinct()
            few = sum(frequency[w] for w in keys) <= SHIPPED_PAIRS
            postings = postings.join(_shipped(ids, few), ID, "left_semi")
        found = _by_text(postings, [ID, "n_terms"])
    else:
        # An alternative of excluded words only matches texts that have none of the words.
        found = texts.select(ID, "n_terms").join(_by_text(postings, [ID]), ID, "left")
        found = found.withColumn("placed", F.coalesce("placed", F.create_map().cast(_POSITIONS)))
    view = txt.WordPositions(F.col("placed"))
    hits = found.where(txt.query_matches(view, txt.literal_alternatives(alternatives)))
    scored_terms = sorted({word for a in alternatives for word in a["needed"]})
    if not scored_terms:
        return _ranked_by_score(hits.select(ID, F.lit(0.0).alias("score")), k)
    sizes = texts.agg(
        F.struct(
            F.count(F.lit(1)).alias("texts"),
            F.avg("n_terms").alias("mean_length"),
            *[F.lit(frequency[t]).alias(f"df{i}") for i, t in enumerate(scored_terms)],
        ).alias("stats")
    )
    scored = hits.withColumn("_stats", sizes.scalar())
    score = txt.bm25(view, F.col("n_terms"), F.col("_stats.mean_length"), _weights(scored_terms))
    return _ranked_by_score(scored.select(ID, score.alias("score")), k)


def _is_one_of(words: Sequence[str]) -> Column:
    """Written as alternatives of equalities, each of which prunes row groups in the scan."""
    return reduce(lambda a, b: a | b, [F.col("term") == w for w in words])


def postings_topk_batch(
    index: TextIndex,
    queries: DataFrame,
    k: int = LEG_K,
    where: Column | None = None,
    tenant: str | None = None,
    stem: Stem | None = None,
) -> DataFrame:
    """`keyword_topk_batch` on an inverted index, by the same plan: rarest word first, then check.

    The postings are read for the word counts, for the rarest words, and for all words of the
    candidates; no text is read.
    """
    scope = [tenant] if tenant else []
    texts, postings = filtered(index.texts, where), filtered(index.postings, where)
    asked = materialise(_parsed_queries(queries, scope, stem), "queries")
    few_queries = _few(asked)
    by = [*scope, "term"]
    wanted = asked.select(*scope, F.explode("terms").alias("term")).distinct()
    lengths = texts.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("df"), F.sum("n_terms").alias("total_length")
    )
    counted = (
        postings.join(_shipped(wanted, few_queries), by, "left_semi")
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("df"))
        .unionByName(lengths.withColumn("term", F.lit("")), allowMissingColumns=True)
    )
    counted = materialise(counted, "word-counts")
    plan = materialise(_candidate_plan(counted, asked, scope), "query-plan")

    keyed = plan.select("query_id", "alternative", "key", *scope, "alternatives")
    everything = texts.select(ID, "n_terms", *scope, F.lit("").alias("key"))
    pairs = (
        postings.select(ID, "n_terms", *scope, F.col("term").alias("key"))
        .unionByName(everything)
        .join(_shipped(keyed, few_queries), [*scope, "key"])
        .select(
            ID, "n_terms", "query_id", "alternative",
            F.explode_outer(txt.words_mentioned(F.col("alternatives"))).alias("term"),
        )
    )
    pairs = materialise(pairs, "candidates")
    few_pairs = pairs.count() <= SHIPPED_PAIRS
    own = [ID, "n_terms", "query_id", "alternative"]
    own_words = postings.select("term", ID, "positions").join(_shipped(pairs, few_pairs), ["term", ID])
    found = pairs.select(*own).distinct().join(_by_text(own_words, own), own, "left")
    found = found.withColumn("placed", F.coalesce("placed", F.create_map().cast(_POSITIONS)))
    candidates = found.join(
        _shipped(plan.drop("key", *scope), few_queries), ["query_id", "alternative"]
    )
    return _ranked_candidates(candidates, txt.WordPositions(F.col("placed")), k)
