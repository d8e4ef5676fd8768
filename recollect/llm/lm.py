"""Language-model scores from a log-frequency Bloom filter (Talbot and Osborne, 2007).

Counts of words and of word pairs are quantised: count c has level 1 + floor(log c / log BASE). The filter
holds an n-gram once for every level up to its own, and a reader probes level after level until one
is missing; so an error can only raise a count, by one level with the filter's error rate, by two
with its square. It holds all words and all pairs, those seen once at level 1, at every size of the
corpus: its bits grow with the entries, in one slice per segment of the keys, and the segments with the tokens.

Texts are cut into blocks. Every block sends its distinct keys to the segments once, with their counts in the training
part: that is what the filter is built from, and what it is asked. A segment's task keeps the distinct keys with their
counts and every block's places among them; once the size of all is known it builds its slice of the bits, probes
it for each distinct key, and every block gets its levels back. The form is the same at every size, so disk and time grow
with the texts. Where a caller knows the corpus to be small, `broadcast` sends a filter of at most `MOST_BITS` bits
(64 MB) to the tasks instead; bits and scores are the same. Beside its segment 32 bits of a key are kept: it meets
another key of its segment in at most one of 2,000 cases (a segment has some 2 million tokens); six probes at 14 bits an
entry err in one of 500.

A pair's probability mixes its relative frequency with the word's own, by the share of pairs that
were seen only once (the Good-Turing estimate of unseen mass).

The counts cover the whole training part of the corpus. The base score needs exact counts: the at
most `FREQUENT` most frequent words travel to the tasks, the rest meets the word table in a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.llm import words
from recollect.session import materialise

MOST_BITS = 1 << 29
BITS_PER_KEY = 14
PROBES = 6
FREQUENT = 1 << 20
SEGMENT_TOKENS = 1 << 21
CHUNK_BYTES = 1 << 22
SMOOTHING = 0.1
BASE, LEVELS = 1.5, 56
#: The least count of every level, from level 1 on; the last one is past 2^32.
BOUNDS = np.ceil(BASE ** np.arange(LEVELS + 1)).astype(np.int64)
_END, _BEGIN = words.constants(21, 2)
_PAIR = words.constants(22, 2) | np.uint64(1)
_LEVEL = words.constants(23, LEVELS + 1)


def held_out(doc_id: Column) -> Column:
    """Documents that the model does not learn from: crc32 of the id as text divisible by 10."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def _tokens(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of rows: the first row, the tokens of all (words, then one end each), the end places."""
    for low, _, part in words.text_chunks(texts, CHUNK_BYTES):
        ends = part.first[1:] + np.arange(part.rows)
        found = np.empty(len(part.starts) + part.rows, dtype=np.uint64)
        inner = np.ones(len(found), dtype=bool)
        inner[ends] = False
        found[inner] = part.hashes()
        found[ends] = _END
        yield low, found, ends


def _pairs(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of each token with the one before it, and that one (a begin mark for the first)."""
    history = np.empty_like(tokens)
    history[1:] = tokens[:-1]
    history[0] = _BEGIN
    history[ends[:-1] + 1] = _BEGIN
    return words.mix(history * _PAIR[0] + words.mix(tokens) * _PAIR[1]), history


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, tokens, ends in _tokens(batch.column("text")):
            found, counts = np.unique(tokens, return_counts=True)
            found = np.append(found, _BEGIN)
            counts = np.append(counts, len(ends))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], names=["word", "n"]
            )


def _coded(values: np.ndarray) -> bytes:
    """32-bit numbers as four planes of bytes, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _decoded(coded: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(coded), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def _coded_keys(rest: np.ndarray) -> bytes:
    """Sorted 32-bit keys, by their differences."""
    return _coded(np.diff(rest, prepend=rest[:1] * 0))


def _decoded_keys(coded: bytes) -> np.ndarray:
    return np.cumsum(_decoded(coded), dtype=np.uint64)


def _rest(keys: np.ndarray, shift: int) -> np.ndarray:
    """The 32 bits of keys that follow their segment."""
    return (keys >> np.uint64(max(0, shift - 32))) & np.uint64((1 << 32) - 1)


def _packed(kind: int, keys: np.ndarray, counts: np.ndarray, shift: int) -> pa.RecordBatch:
    """Sorted keys cut by segment (their first bits)."""
    segments = (keys >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(keys), np.int64)
    first = np.flatnonzero(np.concatenate([[True], segments[1:] != segments[:-1]]))
    cuts = np.append(first, len(keys))
    rest = _rest(keys, shift)
    counts = np.minimum(counts, 2**32 - 1)
    spans = list(zip(cuts, cuts[1:], strict=False))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(first), kind, np.int32)),
            pa.array(segments[first].astype(np.int32)),
            pa.array([_coded_keys(rest[a:b]) for a, b in spans], pa.binary()),
            pa.array([_coded(counts[a:b]) for a, b in spans], pa.binary()),
        ],
        names=["kind", "segment", "keys", "n"],
    )


def level(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log c / log BASE) of counts of at least 1; LEVELS at most."""
    return np.minimum(np.searchsorted(BOUNDS, counts, side="right"), LEVELS)


def mean_count(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0."""
    return np.concatenate([[0.0], (BOUNDS[:-1] + BOUNDS[1:] - 1) / 2])[levels]


COUNTED = (
    "segment int, once long, total long, levels1 array<long>, levels2 array<long>, keys1 binary, n1 binary,"
    " blocks1 array<long>, sizes1 array<long>, places1 binary, keys2 binary, n2 binary, blocks2 array<long>,"
    " sizes2 array<long>, places2 binary"
)
ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _count_segment(table: pa.Table) -> pa.Table:
    """The distinct n-grams of one segment with their counts, and where among them each block's keys are.

    N-grams without a block are counted only.
    """
    kinds = table.column("kind").to_numpy()
    out: dict = {"segment": table.column("segment")[0].as_py()}
    for kind in (1, 2):
        own = table.filter(pa.array(kinds == kind))
        keys = [_decoded_keys(v) for v in own.column("keys").to_pylist()]
        counts = [_decoded(v) for v in own.column("n").to_pylist()]
        sizes = [len(part) for part in keys]
        keys, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([np.zeros(0, np.uint32), *counts]), len(keys)).astype(np.int64)
        if kind == 2:
            out |= {"once": int((counts == 1).sum()), "total": int(counts.sum())}
        out[f"levels{kind}"] = np.bincount(level(counts), minlength=LEVELS + 1).tolist()
        out |= {f"keys{kind}": _coded_keys(keys), f"n{kind}": _coded(np.minimum(counts, 2**32 - 1))}
        asked = "block" in own.schema.names
        out[f"blocks{kind}"] = own.column("block").to_pylist() if asked else []
        out |= {f"sizes{kind}": sizes * asked, f"places{kind}": _coded_keys(place.astype(np.uint64)[: len(place) * asked])}
    fields = [c.split(" ") for c in COUNTED.split(", ")]
    return pa.table({name: pa.array([out[name]], ARROW[kind]) for name, kind in fields})


def _bit_places(rest: np.ndarray, kind: int, at: int, slice_bits: int) -> Iterator[np.ndarray]:
    """The places, within their segment's slice of the bits, of n-grams at one level."""
    first = words.mix(rest * np.uint64(4) + np.uint64(kind) + _LEVEL[at])
    step = (first >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield (first + np.uint64(i) * step) % np.uint64(slice_bits)


def _slice(row: dict, slice_bits: int) -> np.ndarray:
    """The bits of one segment, packed, from its row of `COUNTED`."""
    bits = np.zeros(slice_bits, dtype=bool)
    for kind in (1, 2):
        rest, top = _decoded_keys(row[f"keys{kind}"]), level(_decoded(row[f"n{kind}"]))
        for at in range(1, int(top.max(initial=0)) + 1):
            for place in _bit_places(rest[top >= at], kind, at, slice_bits):
                bits[place.astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield from batch.slice(i, 1).to_pylist()


def _build_slice(slice_bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            bits = pa.array([_slice(row, slice_bits).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([row["segment"]], pa.int32()), bits], names=["segment", "bits"])

    return run


def _held_levels(bits: np.ndarray, base: np.ndarray, rest: np.ndarray, kind: int, slice_bits: int) -> np.ndarray:
    """The level of every n-gram, 0 where it is not held: probes go up until a level is missing."""
    out = np.zeros(len(rest), dtype=np.int64)
    left = np.arange(len(rest))
    for at in range(1, LEVELS + 1):
        held = np.ones(len(left), dtype=bool)
        for place in _bit_places(rest[left], kind, at, slice_bits):
            bit = base[left] + place
            byte = bits[(bit >> np.uint64(3)).astype(np.int64)]
            held &= ((byte >> (bit & np.uint64(7)).astype(np.uint8)) & np.uint8(1)).astype(bool)
        left = left[held]
        out[left] = at
        if not len(left):
            break
    return out


class Filter:
    """The bits, one slice per segment."""

    def __init__(self, bits: np.ndarray, segments: int):
        self.bits = bits
        self.shift = 64 - (segments.bit_length() - 1)
        self.slice_bits = len(bits) * 8 // segments

    def levels(self, keys: np.ndarray, kind: int) -> np.ndarray:
        rest = _rest(keys, self.shift)
        segment = keys >> np.uint64(self.shift) if self.shift < 64 else np.zeros_like(keys)
        base = segment * np.uint64(self.slice_bits)
        return _held_levels(self.bits, base, rest, kind, self.slice_bits)


class Frequent(NamedTuple):
    """The sorted hashes of the frequent words with their exact counts."""

    words: np.ndarray
    counts: np.ndarray

    def exact(self, tokens: np.ndarray) -> np.ndarray:
        """Counts of the frequent words, 0 for all others."""
        if not len(self.words):
            return np.zeros(len(tokens), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        return np.where(self.words[at] == tokens, self.counts[at], 0)


class Model(NamedTuple):
    """What turns counts into probabilities, and the filter where it is broadcast."""

    tokens: int
    mass: float
    seen: float
    filter: Filter | None

    def mixed(self, own: np.ndarray, begin: float, pair: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 of every token's probability after the one before it, of the counts of every token, of
        the begin mark and of every pair."""
        before = np.empty(len(own))
        before[1:] = own[:-1]
        before[np.concatenate([[0], ends[:-1] + 1])] = begin
        alone = (own + SMOOTHING) / self.mass
        with np.errstate(divide="ignore", invalid="ignore"):
            together = np.minimum(1.0, np.where(before > 0, pair / before, 0.0))
        mixed = self.seen * together + (1 - self.seen) * alone
        return np.log10(np.minimum(1.0, np.where(before > 0, mixed, alone)))


def _packed_texts(rows: pa.RecordBatch) -> bytes:
    """The texts of a block with their row numbers and whether they are learnt from, compressed as one."""
    sink = pa.BufferOutputStream()
    kept = rows.select([c for c in ("row", "text", "learnt") if c in rows.schema.names])
    with pa.ipc.new_stream(sink, kept.schema) as stream:
        stream.write_batch(kept)
    return zstandard.compress(sink.getvalue(), 3)


def _unpacked_texts(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.decompress(packed)).read_all()


def _score(frequent) -> Callable:
    """Rows with what needs the frequent words only; the first row of a block carries its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, tokens, ends in _tokens(batch.column("text")):
                begins = np.concatenate([[0], ends[:-1] + 1])
                exact = frequent.value.exact(tokens)
                common = exact > 0
                logs = np.where(common, np.log10(exact + SMOOTHING), 0.0)
                known = np.add.reduceat(common.astype(np.int64), begins)
                sizes = ends - begins + 1
                marks = np.concatenate([[0], np.cumsum(sizes - known)]).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(marks), pa.array(tokens[~common].view(np.int64)))
                own = batch.slice(low, len(ends))
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("doc_id"),
                        own.column("row"),
                        pa.array(sizes),
                        pa.array(known),
                        pa.array(np.add.reduceat(logs, begins)),
                        rare,
                        pa.array([_packed_texts(own)] + [None] * (len(ends) - 1), pa.binary()),
                    ],
                    names=["doc_id", "row", "n_tokens", "known", "logs", "rare", "texts"],
                )

    return run


ASKED = "block long, kind int, segment int, keys binary, n binary"
ANSWERED = "block long, kind int, segment int, levels binary"
SCORED = "row long, score double"


def _block(packed: bytes) -> tuple[pa.Table, np.ndarray, dict]:
    """One block, its ends, and by kind its distinct keys and every token's place there (the begin mark's last)."""
    texts = _unpacked_texts(packed)
    ((_, tokens, ends),) = _tokens(texts.column("text").combine_chunks())
    single = np.append(words.mix(tokens), words.mix(np.array([_BEGIN])))
    return texts, ends, {
        kind: np.unique(keys, return_inverse=True) for kind, keys in ((1, single), (2, _pairs(tokens, ends)[0]))
    }


def _ask(shift: int) -> Callable:
    """The distinct keys of every block, with their counts in its texts that are learnt from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            texts, ends, keys = _block(row["texts"])
            learnt = texts.column("learnt").to_numpy().astype(np.int64)
            weights = np.append(np.repeat(learnt, np.diff(ends, prepend=-1)), learnt.sum())
            for kind, (found, place) in keys.items():
                counts = np.bincount(place, weights[: len(place)], len(found)).astype(np.int64)
                asked = _packed(kind, found, counts, shift)
                blocks = pa.array(np.full(len(asked), row["block"]))
                yield pa.RecordBatch.from_arrays([blocks, *asked.columns], names=["block", *asked.schema.names])

    return run


def _answer(slice_bits: int) -> Callable:
    """Builds the slice of every segment and probes it for its keys: each block's levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            bits = _slice(row, slice_bits)
            for kind in (1, 2):
                rest = _decoded_keys(row[f"keys{kind}"])
                levels = _held_levels(bits, np.zeros_like(rest), rest, kind, slice_bits).astype(np.uint8)
                levels = levels[_decoded_keys(row[f"places{kind}"]).astype(np.uint32)]
                cuts = np.concatenate([[0], np.cumsum(row[f"sizes{kind}"], dtype=np.int64)])
                spans = list(zip(cuts, cuts[1:], strict=False))
                blocks = pa.array(row[f"blocks{kind}"], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        blocks,
                        pa.array(np.full(len(blocks), kind, np.int32)),
                        pa.array(np.full(len(blocks), row["segment"], np.int32)),
                        pa.array([zstandard.compress(levels[a:b].tobytes(), 1) for a, b in spans], pa.binary()),
                    ],
                    names=["block", "kind", "segment", "levels"],
                )

    return run


def _row_scores(model: Model, packed: bytes, levels: Callable) -> pa.Table:
    """The scores of one block; `levels(kind, keys)` gives the levels of its distinct keys."""
    texts, ends, keys = _block(packed)
    counts = {kind: mean_count(levels(kind, found))[place] for kind, (found, place) in keys.items()}
    logs = model.mixed(counts[1][:-1], counts[1][-1], counts[2], ends)
    scores = np.add.reduceat(logs, np.concatenate([[0], ends[:-1] + 1]))
    return pa.table({"row": texts.column("row"), "score": pa.array(scores)})


def _answered_scores(model) -> Callable:
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by([("kind", "ascending"), ("segment", "ascending")])
        kinds = answers.column("kind").to_numpy()

        def levels(kind: int, _) -> np.ndarray:
            parts = answers.filter(pa.array(kinds == kind)).column("levels").to_pylist()
            return np.frombuffer(b"".join(map(zstandard.decompress, parts)), np.uint8).astype(np.int64)

        return _row_scores(model.value, blocks.column("texts")[0].as_py(), levels)

    return run


def _filter_scores(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            held = model.value.filter
            yield from _row_scores(model.value, row["texts"], lambda kind, keys: held.levels(keys, kind)).to_batches()

    return run


def count_words(texts: DataFrame) -> DataFrame:
    """`(word, n)`: exact counts of all word hashes in `texts (text)`, with the begin and end marks."""
    return texts.select("text").mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit(blocks: DataFrame, counts: DataFrame, broadcast: bool = False) -> tuple[Model, DataFrame | None]:
    """The model of `blocks (block, texts)`, and the levels of every block's keys where the filter is not broadcast.

    `counts` is what `count_words` made of the texts that are learnt from, written.
    """
    real = F.col("word") != int(_BEGIN.astype(np.int64))
    tokens, distinct = counts.where(real).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    segments = 1
    while segments * SEGMENT_TOKENS < tokens:
        segments *= 2
    shift = 64 - (segments.bit_length() - 1)
    asked = blocks.mapInArrow(_ask(shift), ASKED)
    counted = materialise(asked.groupBy("segment").applyInArrow(_count_segment, COUNTED), "ngrams")

    sums = counted.agg(
        F.coalesce(F.sum("once"), F.lit(0)),
        F.coalesce(F.sum("total"), F.lit(0)),
        *(F.sum(F.col(f"levels{kind}")[at]) for kind in (1, 2) for at in range(LEVELS + 1)),
    ).first()
    once, total, *entries = (v or 0 for v in sums)
    used = sum(n * (place % (LEVELS + 1)) for place, n in enumerate(entries))  # one for every level up to its own
    size = segments * max(1024, -(-used * BITS_PER_KEY // segments // 64) * 64)
    mass, seen = tokens + SMOOTHING * (distinct + 1), 1 - once / total if total else 0.0
    if not broadcast or size > MOST_BITS:
        return Model(tokens, mass, seen, None), counted.mapInArrow(_answer(size // segments), ANSWERED)
    bits = np.zeros(size // 8, dtype=np.uint8)
    width = size // 8 // segments
    slices = counted.mapInArrow(_build_slice(size // segments), "segment int, bits binary")
    for part in materialise(slices, "filter").toLocalIterator():  # the driver holds one copy of the bits
        bits[part["segment"] * width : (part["segment"] + 1) * width] = np.frombuffer(part["bits"], np.uint8)
    return Model(tokens, mass, seen, Filter(bits, segments)), None


def frequent_words(counts: DataFrame) -> Frequent:
    """At most `FREQUENT` words of `counts (word, n)`: all above a count that the histogram gives."""
    real = F.col("word") != int(_BEGIN.astype(np.int64))
    step = F.floor(16 * F.log2("n"))
    steps = counts.where(real).groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()
    least, room = None, FREQUENT
    for row in steps:
        room -= row["n"]
        if room < 0:
            break
        least = row["step"]
    top = counts.where(real & (step >= (least if least is not None else 10**6))).toArrow()
    keys = top["word"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return Frequent(keys[order], top["n"].to_numpy()[order])


def score(docs: DataFrame, broadcast: bool = False) -> DataFrame:
    """Scores of every row of `docs (doc_id, text, …)`, by a model of those that are not held out.

    `(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`. A text's tokens are its
    words (see `words`) and one end, so a null or empty text has one token. A null doc_id counts as the
    empty string, which is held out. Rows with one doc_id are scored, and learnt from, each. Scores
    are log10 probabilities. Other columns are not read. With `broadcast` a filter of at most `MOST_BITS` bits
    travels to the tasks, which saves shuffles; scores are the same.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    learnt = ~held_out(F.col("doc_id"))
    counts = materialise(count_words(docs.where(learnt).select("text")), "word-counts")
    frequent = spark.sparkContext.broadcast(frequent_words(counts))
    schema = f"doc_id {kind}, row long, n_tokens long, known long, logs double, rare array<long>, texts binary"
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"), learnt.alias("learnt"))
    scored = materialise(numbered.mapInArrow(_score(frequent), schema), "scores")
    blocks = scored.where(F.col("texts").isNotNull()).select(F.col("row").alias("block"), "texts")
    scored = scored.drop("texts")

    fitted, answers = fit(blocks, counts, broadcast)
    model = spark.sparkContext.broadcast(fitted)
    if answers is None:
        scores = blocks.mapInArrow(_filter_scores(model), SCORED)
    else:  # the texts of a block are shuffled once, compressed, to meet its answers
        scores = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_answered_scores(model), SCORED)

    rare = scored.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    rare = rare.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING)).alias("rare_logs"), F.count("n").alias("rare_known")
    )
    scored = scored.join(scores, "row", "left")
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(fitted.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(float(fitted.mass)))).alias("base_score"),
        "score",
    )
