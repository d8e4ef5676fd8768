"""Substring search on texts by an index of trigrams.

A case-insensitive pattern with `%` and `_` can only match texts that have every three-letter run of its
literal parts. The index holds, for blocks of texts, the keys of the texts that have a trigram, sorted by
trigram; a search reads the rows of the pattern's rarest trigrams, fetches the texts that have them all,
and checks the pattern itself. A pattern without a literal part of three letters, or with common trigrams
only, is checked on all texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH, GRAMS_USED = 3, 4
# Bytes of text of one block, of one text at least; bounds the memory of a task.
BLOCK_BYTES = 1 << 22
# Where the rarest trigram of a pattern is in a larger share of the texts, all texts are read instead.
COMMON_SHARE = 0.1
# Candidates of a search that are sent to all tasks; of more than these the texts are shuffled.
BROADCAST_KEYS = 1 << 20


def _postings(keys: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    """`(gram, n, keys)` of a block of lower-cased texts, sorted by gram: one sort of numbered characters."""
    lengths = pc.utf8_length(texts).to_numpy()
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
    if len(points) < WIDTH:
        return
    seen = np.zeros(int(points.max()) + 1, dtype=np.uint64)
    seen[points] = 1
    alphabet = np.flatnonzero(seen).astype(np.uint32)
    letter_bits, row_bits = int(len(alphabet) - 1).bit_length() or 1, int(len(texts) - 1).bit_length()
    if WIDTH * letter_bits + row_bits > 64:
        half = len(texts) // 2
        yield from _postings(keys[:half], texts[:half])
        yield from _postings(keys[half:], texts[half:])
        return
    letters = (np.cumsum(seen, dtype=np.uint64) - np.uint64(1))[points]
    rows = np.repeat(np.arange(len(texts), dtype=np.uint64), lengths)
    found = letters[: 1 - WIDTH].copy()
    for i in range(1, WIDTH):
        found <<= np.uint64(letter_bits)
        found |= letters[i : len(letters) - WIDTH + 1 + i]
    found = ((found << np.uint64(row_bits)) | rows[: 1 - WIDTH])[rows[: 1 - WIDTH] == rows[WIDTH - 1 :]]
    if not len(found):
        return
    found.sort()
    found = found[np.append(True, found[1:] != found[:-1])]
    grams = found >> np.uint64(row_bits)
    starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    ends = np.append(starts[1:], len(grams))
    mask = np.uint64((1 << letter_bits) - 1)
    parts = [alphabet[(grams[starts] >> np.uint64(letter_bits * i)) & mask] for i in reversed(range(WIDTH))]
    text = np.stack(parts, axis=1).tobytes().decode("utf-32-le")
    members = keys.take(pa.array((found & np.uint64((1 << row_bits) - 1)).astype(np.int64)))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([text[i : i + WIDTH] for i in range(0, len(text), WIDTH)], pa.string()),
            pa.array((ends - starts).astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(np.append(starts, len(grams)).astype(np.int32)), members),
        ],
        names=["gram", "n", "keys"],
    )


def index_trigrams(table: DataFrame, key: str, text_col: str) -> DataFrame:
    """`(gram, n, keys)` per trigram and block of texts, sorted by trigram; write it once and search that.

    `key` must be unique and not null. The texts are read once, and only the lists are shuffled. All rows of
    a trigram are in one file: at most one key per text.
    """
    texts = table.where(F.col(text_col).isNotNull()).select(
        F.col(key).alias("key"), F.lower(text_col).alias("text")
    )
    most = BLOCK_BYTES

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lowered = batch.columns
            ends = np.cumsum(pc.binary_length(lowered).to_numpy(), dtype=np.int64)
            start = 0
            while start < len(ends):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
                yield from _postings(keys[start:stop], lowered[start:stop])
                start = stop

    lists = f"gram string, n long, keys array<{texts.schema['key'].dataType.simpleString()}>"
    return texts.mapInArrow(blocks, lists).repartition("gram").sortWithinPartitions("gram")


def literal_parts(pattern: str) -> list[str]:
    """The parts of an ILIKE pattern between its wildcards, lower-cased; a backslash takes the next as is."""
    parts = [""]
    for escaped, plain in re.findall(r"\\(.)|(.)", pattern, flags=re.DOTALL):
        if plain in ("%", "_") and not escaped:
            parts.append("")
        else:
            parts[-1] += escaped or plain
    return [p.lower() for p in parts if p]


def needed_grams(pattern: str) -> list[str]:
    """The trigrams that every match of the pattern has."""
    parts = literal_parts(pattern)
    return sorted({p[i : i + WIDTH] for p in parts for i in range(len(p) - WIDTH + 1)})


def gram_counts(index: DataFrame, grams: Sequence[str]) -> dict[str, int]:
    """The number of texts that have each of the trigrams; the lists themselves are not read."""
    if not grams:
        return {}
    counted = index.where(F.col("gram").isin(*grams)).groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return dict.fromkeys(grams, 0) | {r["gram"]: r["n"] for r in counted}


def candidate_keys(index: DataFrame, grams: Sequence[str], counts: dict[str, int] | None = None) -> DataFrame:
    """`(key)` of the texts that have the rarest GRAMS_USED of the trigrams: a superset of the matches."""
    frequency = gram_counts(index, grams) if counts is None else counts
    used = sorted(grams, key=lambda g: (frequency[g], g))[:GRAMS_USED]
    rows = index.where(reduce(lambda a, b: a | b, [F.col("gram") == g for g in used]))
    rows = rows.select(F.explode("keys").alias("key"))
    if len(used) == 1:
        return rows
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(used)).select("key")


def _like(lowered: Column, pattern: str) -> Column:
    """Does a lower-cased text match as ILIKE does? Every part between `%` is looked for on its own first.

    That is implied by the match, and spares texts without one of the parts a search from every place
    of the parts before it.
    """
    parts = re.findall(r"(?:\\.|[^%\\])+", pattern, flags=re.DOTALL)
    checked = [*(f"%{p}%" for p in parts if len(parts) > 1), pattern]
    return reduce(lambda a, b: a & b, [F.like(lowered, F.lower(F.lit(p))) for p in checked])


def ilike_search_all(
    table: DataFrame, index: DataFrame, key: str, text_col: str, patterns: Sequence[str]
) -> DataFrame:
    """`(pattern, …)`: the rows of `table` whose text matches a pattern as ILIKE does, once per pattern.

    The index decides which texts a pattern is checked on. All patterns together read the table at most
    twice: once for those that the index narrows, once for those that need all texts. Only the counts of
    the patterns' own trigrams and of the texts come to the driver.
    """
    needed = {p: needed_grams(p) for p in patterns}
    counts = gram_counts(index, sorted({g for grams in needed.values() for g in grams}))
    rarest = {p: min(counts[g] for g in grams) for p, grams in needed.items() if grams}
    common = COMMON_SHARE * table.count() if any(rarest.values()) else 0
    narrowed = [p for p in needed if p in rarest and 0 < rarest[p] <= common]
    read = [p for p in needed if p not in rarest or rarest[p] > common]
    # a pattern that is left out has a trigram that no text has
    columns = [F.col(c) for c in table.columns]
    matching = F.array(*[F.when(_like(F.col("_lower"), p), F.lit(p)) for p in read]).cast("array<string>")
    rows = (table if read else table.limit(0)).withColumn("_lower", F.lower(text_col))
    found = rows.select(F.explode(F.array_compact(matching)).alias("pattern"), *columns)
    if not narrowed:
        return found
    candidates = reduce(
        DataFrame.unionByName,
        [
            candidate_keys(index, needed[p], counts).select(F.lit(p).alias("_pattern"), F.col("key").alias("_key"))
            for p in narrowed
        ],
    )
    if sum(rarest[p] for p in narrowed) <= BROADCAST_KEYS:
        candidates = F.broadcast(candidates)
    matches = reduce(
        lambda a, b: a | b, [(F.col("_pattern") == p) & _like(F.lower(text_col), p) for p in narrowed]
    )
    looked_up = table.join(candidates, F.col(key) == F.col("_key")).where(matches)
    return found.unionByName(looked_up.select(F.col("_pattern").alias("pattern"), *columns))


def ilike_search(table: DataFrame, index: DataFrame, key: str, text_col: str, pattern: str) -> DataFrame:
    """The rows of `table` whose text matches `pattern` as ILIKE does; the index decides what is read."""
    return ilike_search_all(table, index, key, text_col, [pattern]).drop("pattern")
