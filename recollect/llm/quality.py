"""Quality grades by ordinal cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(threshold_k - w x): all grades share the weights, the thresholds are ordered.
A text's features are its hashed words and hashed word shapes (ends, first byte, length, and whether
the word repeats the one before), each as the square root of its share of the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.llm import words

#: Labelled rows that the regression learns from, at most; by a hash of the id.
FIT_ROWS = 8192
#: Features that a round of the fit holds as 64-bit numbers at a time; does not change the fit.
FIT_FEATURES = 1 << 18
HASH_BITS = 18
SCALE = 8.0
_SALTS = words.constants(31, 2)


def held_out(doc_id: Column) -> Column:
    """Documents whose ratings are not learnt: crc32 of the id as text divisible by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _feature_rows(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature numbers and values of every text, numbers ascending; none for a text without words."""
    shift = np.uint64(64 - HASH_BITS)
    for _, _, part in words.text_chunks(texts):
        hashes = part.hashes()
        sizes = part.ends - part.starts
        again = np.zeros(len(hashes), dtype=np.uint64)
        again[1:] = hashes[1:] == hashes[:-1]
        again[part.first[:-1][part.first[:-1] < len(hashes)]] = 0
        shapes = part.data[part.starts].astype(np.uint64) if len(hashes) else np.zeros(0, np.uint64)
        if len(hashes):
            shapes |= part.data[part.ends - 1].astype(np.uint64) << np.uint64(8)
            shapes |= part.data[np.maximum(part.ends - 2, part.starts)].astype(np.uint64) << np.uint64(16)
            shapes |= np.minimum(sizes, 24).astype(np.uint64) // np.uint64(4) << np.uint64(24)
            shapes |= again << np.uint64(32)
        of_words = (words.mix(hashes + _SALTS[0]) >> shift).astype(np.int32)
        of_shapes = (words.mix(shapes + _SALTS[1]) >> shift).astype(np.int32)
        for i in range(part.rows):
            span = slice(part.first[i], part.first[i + 1])
            n = span.stop - span.start
            found, counts = np.unique(np.concatenate([of_words[span], of_shapes[span]]), return_counts=True)
            yield found, SCALE * np.sqrt(counts / max(1, n))


@dataclass(frozen=True)
class Ordinal:
    """Weights, ordered thresholds, and the grades that they tell apart."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[float]

    def tails(self, strengths: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k + 1]) of each text, one column per threshold."""
        return 1 / (1 + np.exp(-np.clip(strengths[:, None] - self.thresholds, -30, 30)))

    def expected(self, strengths: np.ndarray) -> np.ndarray:
        return self.grades[0] + self.tails(strengths) @ np.diff(self.grades)


def _parts(ends: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Whole rows with about FIT_FEATURES features: the rows, and their features (`ends` starts with 0)."""
    low = 0
    while low < len(ends) - 1:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + FIT_FEATURES, side="right")) - 1)
        yield slice(low, high), slice(int(ends[low]), int(ends[high]))
        low = high


def fit_ordinal(
    rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, rounds: int = 150, penalty: float = 1e-4
) -> Ordinal:
    """Cumulative-link regression of rows of feature numbers and values, see `fit_features`."""
    empty = [np.zeros(0, np.int32)]
    ends = np.cumsum([0, *(len(r[0]) for r in rows)])
    numbers, values = (np.concatenate([r[k] for r in rows] or empty) for k in (0, 1))
    return fit_features(numbers, values, ends, grades, rounds, penalty)


def fit_features(
    numbers: np.ndarray, values: np.ndarray, ends: np.ndarray, grades: np.ndarray, rounds: int = 150, penalty: float = 1e-4
) -> Ordinal:
    """Cumulative-link regression by full-batch Adam; the gaps between thresholds stay positive.

    Row i has the features `numbers[ends[i]:ends[i + 1]]` and their values. Only these arrays and one
    more of 32-bit numbers grow with the features; a round goes over them in parts, adding in the order of the rows.
    """
    known = sorted(set(grades.tolist()))
    if len(known) < 2:
        return Ordinal(np.zeros(1 << HASH_BITS), np.zeros(0), known or [0.0])
    n_rows = len(ends) - 1
    parts = list(_parts(ends))
    place = np.searchsorted(known, grades)
    held = np.zeros(1 << HASH_BITS, dtype=bool)
    held[numbers] = True
    used = np.flatnonzero(held)
    numbers = (np.cumsum(held, dtype=np.int32) - 1)[numbers]
    cuts = len(known) - 1
    shares = np.array([(place <= k).mean() for k in range(cuts)])
    start = np.log(shares / (1 - shares))
    params = np.concatenate([np.zeros(len(used)), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        weights, gaps = params[: len(used)], np.exp(params[len(used) + 1 :])
        thresholds = params[len(used)] + np.concatenate([[0.0], np.cumsum(gaps)])
        strengths = np.zeros(n_rows)
        for some, span in parts:
            owner = np.repeat(np.arange(some.stop - some.start), np.diff(ends[some.start : some.stop + 1]))
            drawn = values[span] * weights[numbers[span]]
            strengths[some] = np.bincount(owner, drawn, minlength=some.stop - some.start)
        below = 1 / (1 + np.exp(-np.clip(thresholds - strengths[:, None], -30, 30)))
        edges = np.c_[np.zeros(n_rows), below, np.ones(n_rows)]
        chance = np.maximum(edges[np.arange(n_rows), place + 1] - edges[np.arange(n_rows), place], 1e-12)
        slopes = np.c_[np.zeros(n_rows), below * (1 - below), np.zeros(n_rows)]
        upper, lower = slopes[np.arange(n_rows), place + 1], slopes[np.arange(n_rows), place]
        pull = (upper - lower) / chance / n_rows
        by_cut = np.zeros(cuts)
        np.add.at(by_cut, place[place < cuts], -(upper / chance)[place < cuts] / n_rows)
        np.add.at(by_cut, place[place > 0] - 1, (lower / chance)[place > 0] / n_rows)
        slope = np.zeros(len(used))
        for some, span in parts:
            owner = np.repeat(np.arange(some.start, some.stop), np.diff(ends[some.start : some.stop + 1]))
            np.add.at(slope, numbers[span].astype(np.intp), values[span] * pull[owner])
        slope = np.concatenate([
            slope + penalty * weights,
            [by_cut.sum()],
            gaps * np.array([by_cut[k + 1 :].sum() for k in range(cuts - 1)]),
        ])
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        rate = 0.1 * (1 - (step - 1) / rounds)
        params = params - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    full = np.zeros(1 << HASH_BITS)
    full[used] = params[: len(used)]
    thresholds = params[len(used)] + np.concatenate([[0.0], np.cumsum(np.exp(params[len(used) + 1 :]))])
    return Ordinal(full, thresholds, known)


def fit(docs: DataFrame, ratings: DataFrame) -> Ordinal:
    """Learns from at most FIT_ROWS rows of `ratings (doc_id, grade)` that are not held out.

    Of several grades of a document the lowest counts; null grades are ignored.
    """
    usable = ratings.where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("grade").cast("double").alias("grade"))
    sample = F.broadcast(usable.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(FIT_ROWS))
    texts = docs.select("doc_id", "text").join(sample, "doc_id")
    texts = texts.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))  # one row per rated id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_feature_rows(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.string()),
                    batch.column("grade"),
                    pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32())),
                ],
                names=["id", "grade", "numbers", "share"],
            )

    schema = "id string, grade double, numbers array<int>, share array<float>"
    found = texts.select("doc_id", "text", "grade").mapInArrow(run, schema).toArrow()
    if not found.num_rows:
        return fit_ordinal([], np.zeros(0))
    found = found.sort_by("id").combine_chunks()
    grades = found["grade"].to_numpy()
    numbers, shares = (found[name].chunk(0) for name in ("numbers", "share"))
    ends = numbers.offsets.to_numpy().astype(np.int64)
    first = int(ends[0])
    numbers, shares = (a.values.to_numpy()[first : int(ends[-1])] for a in (numbers, shares))
    return fit_features(numbers, shares, ends - first, grades)


def score(docs: DataFrame, ratings: DataFrame) -> DataFrame:
    """`(doc_id, held_out, expected_grade, tail_probability, grade)` of every row of `docs (doc_id, text, …)`.

    `tail_probability` is the probability of a grade above the lowest, `grade` the highest grade whose own
    tail probability is at least one half. A null or empty text, or one of white space, has no
    features: its strength is 0. With fewer than two grades to learn from, every document gets the one
    known grade (0 without any) with tail probability 1. Repeated rows get equal scores and are learnt
    from once, with the smallest text of an id that has several. Other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, ratings))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in batches:
            strengths = np.array([
                values @ fitted.weights[numbers] for numbers, values in _feature_rows(batch.column("text"))
            ])
            tails = fitted.tails(strengths)
            lowest = tails[:, 0] if tails.shape[1] else np.ones(len(strengths))
            grade = np.array(fitted.grades)[(tails >= 0.5).sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(fitted.expected(strengths)), pa.array(lowest),
                    pa.array(grade.astype(np.float64)),
                ],
                names=["doc_id", "expected_grade", "tail_probability", "grade"],
            )

    schema = f"doc_id {kind}, expected_grade double, tail_probability double, grade double"
    scored = docs.select("doc_id", "text").mapInArrow(run, schema)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_probability", "grade"
    )


def accepted_rows(docs: DataFrame, ratings: DataFrame, least: float = 0.5) -> DataFrame:
    """`docs` without the rows whose tail probability is below `least`, all columns, in one pass.

    Null and empty texts and repeated rows are judged as `score` scores them, each row for itself.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, ratings))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in batches:
            strengths = np.array([
                values @ fitted.weights[numbers] for numbers, values in _feature_rows(batch.column("text"))
            ])
            tails = fitted.tails(strengths)
            keep = tails[:, 0] >= least if tails.shape[1] else np.ones(len(strengths), dtype=bool)
            yield batch.select(names).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
