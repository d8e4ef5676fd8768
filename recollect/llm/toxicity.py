"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled documents: both hold the same frequent ordinary
words at the same places; where the toxic one ends on the words and word beginnings that toxic
documents use beyond chance, the other one has as many bytes that no text holds. So a window without
such words is compressed alike by both. A text is cut into windows of whole words; each is compressed
with either dictionary, and the difference in length tells which one describes it better. Every
window starts with a lead that both dictionaries hold: without it zstandard stores short windows as
they are, and small differences are lost. How many windows differ by how much gives the features of a
logistic calibration, fitted on other labelled documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that the dictionaries (each class) and the calibration learn from, at most; by a hash of the id.
DICTIONARY_ROWS, CALIBRATION_ROWS = 8192, 8192
WINDOW_BYTES, LONGEST_WORD = 24, 256
DICTIONARY_BYTES, TOXIC_BYTES = 16384, 2048
LEAST_Z, LEAST_ROWS = 3.3, 3
#: Lengths of the word beginnings that are counted beside the words.
BEGINNINGS = range(5, 13)
#: Control characters: the start of every window, and the end of both dictionaries.
LEAD = bytes([*range(1, 8), *range(14, 31)])
SEARCH = {
    "strategy": zstandard.STRATEGY_BTLAZY2, "min_match": 5, "target_length": 64, "search_log": 7, "hash_log": 15,
    "chain_log": 15, "window_log": 15,
}
STEPS = range(1, 9)
FEATURES = 4 + len(STEPS) * 2 + 3


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are not learnt: crc32 of the id as text divisible by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def windows(text: str) -> list[bytes]:
    """Consecutive whole words of WINDOW_BYTES or a little more; very long words are cut."""
    out, now, size = [], [], 0
    for word in text.lower().encode().split():
        for low in range(0, len(word), LONGEST_WORD):
            now.append(word[low : low + LONGEST_WORD])
            size += len(now[-1]) + 1
            if size >= WINDOW_BYTES:
                out.append(b" " + b" ".join(now) + b" ")
                now, size = [], 0
    if now:
        out.append(b" " + b" ".join(now) + b" ")
    return out


def dictionary(words: list[str], size: int) -> bytes:
    """The first words that fit, the first of them last: close matches cost less."""
    chosen, used = [], 2
    for word in words:
        raw = word.encode()
        if used + len(raw) + 1 > size:
            break
        chosen.append(raw)
        used += len(raw) + 1
    return b" " + b" ".join(chosen[::-1]) + b" "


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(content.rjust(64) + LEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    params = zstandard.ZstdCompressionParameters(
        write_content_size=False, write_checksum=False, write_dict_id=False, **SEARCH
    )
    held.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=params)


def text_features(text: str | None, toxic, ordinary) -> np.ndarray:
    """Of the differences of all windows: mean, largest, mean of the three largest, counts and shares."""
    cut = [LEAD + w for w in windows(text or "")]
    if not cut:
        return np.zeros(FEATURES)
    gains = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in cut])
    largest = np.sort(gains)[::-1][:3]
    reached = [(gains >= k).sum() for k in STEPS]
    missed = [(gains <= -k).sum() for k in (1, 2, 3)]
    return np.array(
        [gains.mean(), largest[0], largest.mean(), math.log(len(cut) + 1), *np.log1p(reached), *np.log1p(missed),
         *np.sqrt(np.array(reached) / len(cut))]
    )


class Calibration:
    """Logistic regression on standardised features, by Newton's method."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, penalty: float = 1e-3, rounds: int = 50):
        self.mean, self.scale = features.mean(axis=0), features.std(axis=0) + 1e-9
        design = self._design(features)
        self.weights = np.zeros(design.shape[1])
        ridge = penalty * np.eye(design.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(design @ self.weights, -30, 30)))
            slope = design.T @ (p - labels) / len(labels) + penalty * self.weights
            curve = (design * (p * (1 - p))[:, None]).T @ design / len(labels) + ridge
            self.weights -= np.linalg.solve(curve, slope)

    def _design(self, features: np.ndarray) -> np.ndarray:
        return np.c_[(features - self.mean) / self.scale, np.ones(len(features))]

    def __call__(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._design(features) @ self.weights, -30, 30)))


def _sample(labelled: DataFrame, rows: int) -> DataFrame:
    """At most `rows` rows `(doc_id, toxic)`, always the same ones; small enough to broadcast."""
    drawn = F.xxhash64(F.col("doc_id").cast("string"))
    return F.broadcast(labelled.orderBy(drawn, "doc_id").limit(rows))


def _tally(texts: DataFrame, pieces: Column) -> DataFrame:
    """`(word, a, b)`: the toxic and the other texts that have the piece."""
    toxic = F.col("toxic") == 1
    found = texts.select("toxic", F.explode(F.array_distinct(pieces)).alias("word")).where("word <> ''")
    return found.groupBy("word").agg(F.count_if(toxic).alias("a"), F.count_if(~toxic).alias("b"))


def _beginnings(word: Column) -> Column:
    """A word without the marks around it, and its beginnings."""
    bare = F.regexp_replace(word, r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$", "")
    lengths = F.filter(F.array(*map(F.lit, BEGINNINGS)), lambda n: n < F.length(bare))
    return F.array_append(F.transform(lengths, lambda n: F.left(bare, n)), bare)


def word_lists(texts: DataFrame) -> tuple[list[str], list[str]]:
    """The toxic dictionary's own words and the ordinary words, best first, from `texts (text, toxic)`.

    Toxic words and word beginnings are those in more toxic texts than their number of texts lets
    expect, by more than LEAST_Z standard deviations. Both lists are bounded by the dictionaries' sizes.
    """
    n_toxic, n_other = texts.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    split = F.split(F.lower("text"), r"[\x20\x09-\x0D]+")
    share = n_toxic / max(1, n_toxic + n_other)
    spread = F.sqrt((F.col("a") + F.col("b")) * F.lit(max(share * (1 - share), 1e-9)))
    z = (F.col("a") - share * (F.col("a") + F.col("b"))) / spread
    pieces = _tally(texts, F.flatten(F.transform(F.array_distinct(split), _beginnings)))
    bad = pieces.where((F.col("a") >= LEAST_ROWS) & (z > LEAST_Z)).orderBy(F.desc(z), "word")
    weight = F.col("b") * (F.length("word") - 2)
    plain = _tally(texts, split).where(weight > 0).orderBy(F.desc(weight), "word")
    return tuple([r["word"] for r in df.select("word").limit(n).collect()] for df, n in (
        (bad, TOXIC_BYTES // 2), (plain, DICTIONARY_BYTES // 4)
    ))


def _with_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """One row per sampled id, however often `docs` has it; the smallest text of several."""
    texts = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
    return texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def features(texts: DataFrame, dictionaries: tuple[bytes, bytes]) -> DataFrame:
    """`texts (text, …)` with the array `features` in place of the text."""
    names = [c for c in texts.columns if c != "text"]
    schema = ", ".join(f"{c} {dict(texts.dtypes)[c]}" for c in names) + ", features array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, ordinary = map(compressor, dictionaries)
        for batch in batches:
            made = [text_features(t, toxic, ordinary).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(made, pa.list_(pa.float64()))], names=[*names, "features"]
            )

    return texts.select(*names, "text").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[tuple[bytes, bytes], list[float]]:
    """Dictionaries, and the calibration as coefficients of the plain features, the last one alone.

    Learns from `labels (doc_id, toxic)` that are not held out: the dictionaries from the remainders 1
    to 3, the calibration from the remainder 4. A document with several labels is toxic if one says so.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    calibrating = F.crc32(F.col("doc_id").cast("string")) % 5 == 4
    parts = [_sample(usable.where(~calibrating & (F.col("toxic") == c)), DICTIONARY_ROWS) for c in (1, 0)]
    texts = [_with_texts(docs, part) for part in parts]
    bad, plain = word_lists(texts[0].unionByName(texts[1]))
    tail = dictionary(bad, TOXIC_BYTES)
    shared = dictionary(plain, DICTIONARY_BYTES - len(tail))
    content = shared + tail, shared + bytes(len(tail))
    rows = features(_with_texts(docs, _sample(usable.where(calibrating), CALIBRATION_ROWS)), content)
    found = sorted((r["doc_id"], r["toxic"], r["features"]) for r in rows.collect())
    if not found:
        return content, [0.0] * FEATURES + [0.0]
    fitted = Calibration(np.array([f for _, _, f in found]), np.array([float(t == 1) for _, t, _ in found]))
    plain_weights = fitted.weights[:-1] / fitted.scale
    return content, [*plain_weights.tolist(), float(fitted.weights[-1] - plain_weights @ fitted.mean)]


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`(doc_id, held_out, score, predicted)` of every row of `docs (doc_id, text, …)`.

    The score is the calibrated probability of label 1. Null and empty texts have no windows and get
    the calibration of all-zero features. Without usable labels every score is 0.5. Only the text
    is scored; other columns are not read. A null doc_id counts as the empty string, held out. Repeated
    rows get equal scores and are learnt from once.
    """
    content, weights = fit(docs, labels)
    scored = features(docs.select("doc_id", "text"), content)
    terms = [F.col("features")[i] * w for i, w in enumerate(weights[:-1])]
    total = sum(terms, F.lit(weights[-1]))
    probability = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), probability.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
