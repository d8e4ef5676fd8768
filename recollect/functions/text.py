"""Text to words, web-style queries to required words, and BM25, as column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

Stem = Callable[[str], str]

# The usual English stop words of full-text search.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
    her hers herself it its itself they them their theirs themselves what which who whom this that
    these those am is are was were be been being have has had having do does did doing a an the and
    but if or because as until while of at by for with about against between into through during
    before after above below to from up down in out on off over under again further then once here
    there when where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don should now
    """.split()
)

# BM25 parameters and the characters that separate words.
BM25_K1 = 1.2
BM25_B = 0.75
NOT_A_WORD = r"[^\p{L}\p{M}\p{N}]+"

# A parsed query is a list of alternatives. One alternative matches a text that has all `needed`
# words and `phrases` and none of the `banned` ones. A phrase word lies `step` words after the first.
PHRASES = "array<array<struct<term:string,step:int>>>"
ALTERNATIVES = (
    "array<struct<needed:array<string>,banned:array<string>,"
    f"phrases:{PHRASES},banned_phrases:{PHRASES}>>"
)


def words(text: Column) -> Column:
    """Lower-case words in order, stop words included."""
    return F.array_remove(F.split(F.lower(text), NOT_A_WORD), "")


def without_stop_words(words_col: str) -> Column:
    """The words of a word-list column that are not stop words, in order.

    Written as SQL text: as a Python lambda each stop word would be its own call into the JVM.
    """
    listed = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return F.expr(f"filter({words_col}, w -> w NOT IN ({listed}))")


def stemmed(word_list: Column, stem: Stem) -> Column:
    """The word list with every word replaced by its stem, and stop words by the empty word.

    The stemmer runs once per distinct word of an Arrow batch.
    """

    @F.arrow_udf("array<string>")
    def call(lists: pa.Array) -> pa.Array:
        coded = lists.flatten().dictionary_encode()
        known = ["" if w in STOP_WORDS else stem(w) for w in coded.dictionary.to_pylist()]
        values = pa.array(known, type=pa.string()).take(coded.indices)
        starts = pc.subtract(lists.offsets, lists.offsets[0])
        return pa.ListArray.from_arrays(starts, values, mask=lists.is_null())

    return call(word_list)


# Words grouped at a time when postings are built; bounds the memory of a task.
GROUPED_WORDS = 1_000_000


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch with the column `words` in parts of about GROUPED_WORDS words, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("words")), 0).to_numpy())
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + GROUPED_WORDS, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def placed_stems(
    batches: Iterator[pa.RecordBatch], stem: Stem, asked: frozenset[str]
) -> Iterator[pa.RecordBatch]:
    """Every text with the positions of the `asked` stems in it, as the column `placed`, for its words.

    The stemmer runs once per distinct word of a part of a batch; stop words have no stem.
    """
    stop_words = frozenset(STOP_WORDS)
    for batch in batches:
        for part in _parts(batch):
            lists = part.column("words")
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            coded = lists.flatten().dictionary_encode()
            stems = ["" if w in stop_words else stem(w) for w in coded.dictionary.to_pylist()]
            wanted = np.array([s in asked for s in stems], dtype=bool)
            codes = coded.indices.to_numpy()
            at = np.flatnonzero(wanted[codes]) if len(codes) else np.empty(0, dtype=np.int64)
            ends = np.cumsum(lengths)
            placed: list[dict[str, list[int]]] = [{} for _ in lengths]
            for text, place, code in zip(np.searchsorted(ends, at, side="right"), at, codes[at], strict=True):
                own = placed[text].setdefault(stems[code], [])
                own.append(int(place - ends[text] + lengths[text]))
            columns = {n: part.column(n) for n in part.schema.names if n != "words"}
            kind = pa.map_(pa.string(), pa.list_(pa.int32()))
            columns["placed"] = pa.array([list(p.items()) for p in placed], type=kind)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def postings_in(
    batches: Iterator[pa.RecordBatch], skip: frozenset[str]
) -> Iterator[pa.RecordBatch]:
    """One row per text and distinct word with the word's positions, grouped inside the task.

    A batch has the columns `words` and any others, which are repeated; `skip` words give no row.
    """
    for batch in batches:
        for part in _parts(batch):
            yield _grouped(part, skip)


def _grouped(batch: pa.RecordBatch, skip: frozenset[str]) -> pa.RecordBatch:
    lists = batch.column("words")
    lengths = pc.list_value_length(lists).to_numpy()
    coded = lists.flatten().dictionary_encode()
    wanted = np.array([w not in skip for w in coded.dictionary.to_pylist()], dtype=bool)
    codes = coded.indices.to_numpy()
    text = np.repeat(np.arange(batch.num_rows), lengths)
    position = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    kept = wanted[codes] if len(codes) else np.empty(0, dtype=bool)
    group = text[kept] * max(1, len(wanted)) + codes[kept]
    order = np.argsort(group, kind="stable")
    group = group[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else group
    offsets = pa.array(np.r_[first, len(group)].astype(np.int32))
    rows = pa.array(text[kept][order][first])
    columns = {"term": coded.dictionary.take(pa.array(codes[kept][order][first]))}
    for name in batch.schema.names:
        if name != "words":
            columns[name] = batch.column(name).take(rows)
    placed = pa.array(position[kept][order].astype(np.int32))
    columns["positions"] = pa.ListArray.from_arrays(offsets, placed)
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _split_words(text: str) -> list[str]:
    """The words of a query, separated as `NOT_A_WORD` does: letters, marks and digits stay."""
    kept = (c if unicodedata.category(c)[0] in "LMN" else " " for c in text.lower())
    return "".join(kept).split()


def parse_query(text: str, stem: Stem | None = None) -> list[dict[str, Any]]:
    """A web-style query: all words required, `-word` excluded, `"a b"` a phrase, `or` alternatives.

    Give the `stem` that the corpus was indexed with.
    """
    stem = stem or str
    alternatives: list[dict[str, Any]] = []
    current = {"needed": [], "banned": [], "phrases": [], "banned_phrases": []}
    for piece in [*re.findall(r'-?"[^"]*"?|[^\s"]+', text), "or"]:
        if piece.lower() == "or":
            if any(current.values()):
                alternatives.append({k: _unique(v) for k, v in current.items()})
            current = {"needed": [], "banned": [], "phrases": [], "banned_phrases": []}
            continue
        negative = piece.startswith("-")
        found = _split_words(piece)
        kept = [(stem(w), i) for i, w in enumerate(found) if w not in STOP_WORDS]
        if '"' in piece and len(kept) > 1:
            phrase = [(w, i - kept[0][1]) for w, i in kept]
            current["banned_phrases" if negative else "phrases"].append(phrase)
            if not negative:
                current["needed"] += [w for w, _ in kept]
        else:
            current["banned" if negative else "needed"] += [w for w, _ in kept]
    return alternatives


def _unique(values: list) -> list:
    return list({repr(v): v for v in values}.values())


def parsed(query: Column, stem: Stem | None = None) -> Column:
    """`parse_query` of each row of a table of queries."""

    @F.pandas_udf(ALTERNATIVES)
    def parse(texts: pd.Series) -> pd.Series:
        def rows(text: str | None) -> list[dict[str, Any]]:
            found = parse_query(text or "", stem)
            for alternative in found:
                for name in ("phrases", "banned_phrases"):
                    alternative[name] = [
                        [{"term": t, "step": s} for t, s in phrase] for phrase in alternative[name]
                    ]
            return found

        return texts.map(rows)

    return parse(query)


def literal_alternatives(alternatives: Sequence[dict[str, Any]]) -> Column:
    """A parsed query as a literal of type `ALTERNATIVES`."""

    def strings(values: Sequence[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    def phrase_list(phrases: Sequence[Sequence[tuple[str, int]]]) -> Column:
        return F.array(
            *[
                F.array(*[F.struct(F.lit(t).alias("term"), F.lit(s).alias("step")) for t, s in p])
                for p in phrases
            ]
        ).cast(PHRASES)

    return F.array(
        *[
            F.struct(
                strings(a["needed"]).alias("needed"),
                strings(a["banned"]).alias("banned"),
                phrase_list(a["phrases"]).alias("phrases"),
                phrase_list(a["banned_phrases"]).alias("banned_phrases"),
            )
            for a in alternatives
        ]
    ).cast(ALTERNATIVES)


def query_terms(alternatives: Column) -> Column:
    """The distinct words a query scores, in alphabetical order."""
    return F.sort_array(F.array_distinct(F.flatten(F.transform(alternatives, lambda a: a["needed"]))))


class WordList:
    """A text as the list of its words."""

    def __init__(self, words_col: Column):
        self.words = words_col

    def has(self, word: Column) -> Column:
        return F.array_contains(self.words, word)

    def count(self, word: Column) -> Column:
        return F.size(F.filter(self.words, lambda w: w == word))

    def has_phrase(self, phrase: Column) -> Column:
        def starts_at(position: Column) -> Column:
            return F.forall(
                phrase,
                lambda p: F.coalesce(
                    F.get(self.words, position + p["step"]) == p["term"], F.lit(False)
                ),
            )

        return F.exists(F.sequence(F.lit(0), F.size(self.words)), starts_at)


class WordPositions:
    """A text as a map from those of its words that matter to their positions."""

    def __init__(self, positions: Column):
        self.positions = positions

    def at(self, word: Column) -> Column:
        return F.coalesce(self.positions[word], F.array().cast("array<int>"))

    def has(self, word: Column) -> Column:
        return F.map_contains_key(self.positions, word)

    def count(self, word: Column) -> Column:
        return F.size(self.at(word))

    def has_phrase(self, phrase: Column) -> Column:
        def starts_at(position: Column) -> Column:
            return F.forall(
                phrase, lambda p: F.array_contains(self.at(p["term"]), position + p["step"])
            )

        return F.exists(self.at(phrase[0]["term"]), starts_at)


Text = WordList | WordPositions


def alternative_matches(text: Text, alternative: Column) -> Column:
    return (
        F.forall(alternative["needed"], text.has)
        & ~F.exists(alternative["banned"], text.has)
        & F.forall(alternative["phrases"], text.has_phrase)
        & ~F.exists(alternative["banned_phrases"], text.has_phrase)
    )


def query_matches(text: Text, alternatives: Column) -> Column:
    """True where any alternative of the query matches the text."""
    return F.exists(alternatives, lambda a: alternative_matches(text, a))


def first_match(text: Text, alternatives: Column) -> Column:
    """Number of the first alternative that matches, from 0; NULL or -1 where none does."""
    return F.array_position(F.transform(alternatives, lambda a: alternative_matches(text, a)), True) - 1


def all_words(alternatives: Sequence[dict[str, Any]]) -> list[str]:
    """Every word a parsed query mentions, excluded ones too."""
    found = set()
    for a in alternatives:
        found |= {*a["needed"], *a["banned"]}
        found |= {w for name in ("phrases", "banned_phrases") for p in a[name] for w, _ in p}
    return sorted(found)


def words_mentioned(alternatives: Column) -> Column:
    """`all_words` of a column of parsed queries."""

    def mentioned(a: Column) -> Column:
        phrases = F.flatten(F.concat(a["phrases"], a["banned_phrases"]))
        return F.concat(a["needed"], a["banned"], F.transform(phrases, lambda p: p["term"]))

    return F.array_distinct(F.flatten(F.transform(alternatives, mentioned)))


def may_match(text: Column, alternatives: Sequence[dict[str, Any]]) -> Column:
    """Cheap necessary condition on the raw text: it contains all needed words of an alternative."""
    lowered = F.lower(text)
    return reduce(
        lambda a, b: a | b,
        [
            reduce(lambda a, b: a & b, [F.contains(lowered, F.lit(w)) for w in a["needed"]], F.lit(True))
            for a in alternatives
        ],
        F.lit(False),
    )


def idf(texts: Column, texts_with_term: Column) -> Column:
    return F.log(
        F.lit(1.0)
        + (texts.cast("double") - texts_with_term + F.lit(0.5))
        / (texts_with_term.cast("double") + F.lit(0.5))
    )


def bm25(text: Text, length: Column, mean_length: Column, weighted: Column) -> Column:
    """BM25 of a text; `weighted` is an array of (term, weight) with the weight an `idf`."""
    spread = F.lit(BM25_K1) * (
        F.lit(1.0 - BM25_B) + F.lit(BM25_B) * F.try_divide(length.cast("double"), mean_length)
    )

    def add(total: Column, entry: Column) -> Column:
        count = text.count(entry["term"]).cast("double")
        return total + entry["weight"] * count * F.lit(BM25_K1 + 1.0) / (count + spread)

    return F.aggregate(weighted, F.lit(0.0), add)
