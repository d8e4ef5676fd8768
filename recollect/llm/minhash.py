"""Near-duplicate documents by min-max hashing of five-word shingles.

Each permutation gives two signature values, the smallest and the largest hash (Ji et al., 2013), so
80 permutations fill 32 bands of 5 values. A pair at similarity 0.75 shares a band with probability
0.9998, more similar pairs with a higher one. What the bands propose is always confirmed on the full
shingle sets:

1. Texts with equal shingle sets form a class; only its smallest id goes on.
2. Every class is compared with the smallest class that it shares a band with. Links found so far
   give labels.
3. Bands that still hold several labels may hide further links. The classes in them meet through the
   rarest shingles of their sets: two sets of similarity s share one among the first
   `n - ceil(s n) + 1` in any common order, and few unrelated texts do. So passages that thousands of
   documents share do not bring all of their pairs together.

A set is held as 64-bit hashes of its shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.llm import words
from recollect.llm.components import components
from recollect.session import materialise

PERMUTATIONS = 80
BAND = 5
SIMILARITY = 75
COUNTER_BITS = 20


def signatures(sets: list[np.ndarray], permutations: int = PERMUTATIONS) -> np.ndarray:
    """One row of `min, max, min, max, …` per non-empty set."""
    values = np.concatenate(sets)
    begins = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    factors = words.constants(11, permutations) | np.uint64(1)
    shifts = words.constants(12, permutations)
    out = np.empty((len(sets), 2 * permutations), dtype=np.uint64)
    for k in range(permutations):
        permuted = values * factors[k] + shifts[k]
        out[:, 2 * k] = np.minimum.reduceat(permuted, begins)
        out[:, 2 * k + 1] = np.maximum.reduceat(permuted, begins)
    return out


def band_keys(signature: np.ndarray, band: int = BAND) -> np.ndarray:
    """One 64-bit key per band; equal values in different bands give different keys."""
    bands = signature.shape[1] // band
    grouped = words.mix(signature[:, : bands * band]).reshape(-1, bands, band)
    factors = words.constants(13, band) | np.uint64(1)
    with np.errstate(over="ignore"):
        return words.mix((grouped * factors).sum(axis=2, dtype=np.uint64) + words.constants(14, bands))


def _row_sets(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Blocks of shingle sets, each with the row that it begins at."""
    for low, _, part in words.text_chunks(texts):
        hashes = part.hashes()
        yield low, [
            words.shingle_hashes(hashes[part.first[i] : part.first[i + 1]]) for i in range(part.rows)
        ]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, sets in _row_sets(batch.column("text")):
            filled = [s for s in sets if len(s)]
            keys = band_keys(signatures(filled)) if filled else np.zeros((0, 0), np.uint64)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            ends = np.cumsum(np.where(sizes > 0, keys.shape[1], 0)).astype(np.int32)
            sums = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
            folds = np.array([np.bitwise_xor.reduce(words.mix(s)) if len(s) else 0 for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, len(sets)),
                    pa.array(sizes),
                    pa.array(sums.view(np.int64)),
                    pa.array(folds.view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                        pa.array(keys.reshape(-1).view(np.int64)),
                    ),
                ],
                names=["doc_id", "n_shingles", "sum", "fold", "bands"],
            )


def _confirm(similarity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            both = zip(
                words.shingle_sets(batch.column("text_u")), words.shingle_sets(batch.column("text_v")),
                strict=True,
            )
            for i, (a, b) in enumerate(both):
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep[i] = shared > 0 and 100 * shared >= similarity * (len(a) + len(b) - shared)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep)) for c in ("u", "v")], names=["u", "v"]
            )

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The pairs `(u, v)` whose full shingle sets are similar enough."""
    sides = pairs
    for side in ("v", "u"):
        sides = sides.join(
            texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")), side
        )
    ids = f"u {dict(pairs.dtypes)['u']}, v {dict(pairs.dtypes)['v']}"
    return sides.select("u", "v", "text_u", "text_v").mapInArrow(_confirm(similarity), ids).distinct()


def _shingle_counters(spark: SparkSession, texts: DataFrame) -> np.ndarray:
    """Hashed shingle counts over all `texts`, in 2**COUNTER_BITS counters (4 MB) at any size.

    They only order shingles by rarity; any order gives the same links.
    """
    shift = np.uint64(64 - COUNTER_BITS)

    def count(batches):
        total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
        for batch in batches:
            for _, sets in _row_sets(batch.column("text")):
                total += np.bincount((np.concatenate(sets) >> shift).astype(np.int64), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])

    counted = texts.select("text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = counted.where("n > 1").toArrow()
    counters = np.ones(1 << COUNTER_BITS, dtype=np.uint32)
    counters[found["slot"].to_numpy()] = np.minimum(found["n"].to_numpy(), 2**32 - 1)
    return counters


def _prefixes(counters, similarity: int):
    """Each set's rarest shingles: as many as a partner could be found by, and which position.

    `near` marks the shorter prefix that suffices on the smaller side of a pair.
    """
    shift = np.uint64(64 - COUNTER_BITS)

    def run(batches):
        for batch in batches:
            for low, sets in _row_sets(batch.column("text")):
                counts = counters.value
                out = []
                for i, found in enumerate(sets):
                    n = len(found)
                    slots = counts[(found >> shift).astype(np.int64)]
                    order = np.lexsort((found, slots))[: n - -(-n * similarity // 100) + 1]
                    places = np.arange(len(order), dtype=np.int32)
                    # one copy at most of a slot that a single set fills: no partner has that shingle
                    useful = slots[order] > 1
                    short = n - -(-2 * similarity * n // (100 + similarity)) + 1
                    out.append((low + i, n, found[order][useful], places[useful], short))
                rows = np.repeat([o[0] for o in out], [len(o[2]) for o in out])
                sizes = np.repeat([o[1] for o in out], [len(o[2]) for o in out])
                places = np.concatenate([o[3] for o in out])
                shorts = np.repeat([o[4] for o in out], [len(o[2]) for o in out])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows)),
                        batch.column("label").take(pa.array(rows)),
                        pa.array(sizes.astype(np.int32)),
                        pa.array(np.concatenate([o[2] for o in out]).view(np.int64)),
                        pa.array(places),
                        pa.array(places < shorts),
                    ],
                    names=["id", "label", "n", "shingle", "place", "near"],
                )

    return run


def _across_labels(texts: DataFrame, similarity: int) -> DataFrame:
    """Pairs of different labels that meet in their rarest shingles, `texts (doc_id, label, text)`.

    The conditions on sizes and places (Xiao et al., 2008) are part of the join, so pairs that cannot
    be similar enough leave no row.
    """
    spark = texts.sparkSession
    counters = spark.sparkContext.broadcast(_shingle_counters(spark, texts))
    kind = dict(texts.dtypes)["doc_id"]
    schema = f"id {kind}, label {kind}, n int, shingle long, place int, near boolean"
    rows = materialise(texts.mapInArrow(_prefixes(counters, similarity), schema), "prefixes")
    a, b = rows.alias("a"), rows.where("near").alias("b")
    reach = "least(a.n - a.place, b.n - b.place)"
    found = a.join(
        b,
        F.expr(
            f"a.shingle = b.shingle AND a.label <> b.label AND (b.n < a.n OR b.n = a.n AND b.id < a.id)"
            f" AND 100 * b.n >= {similarity} * a.n"
            f" AND {100 + similarity} * {reach} >= {similarity} * (a.n + b.n)"
        ),
    )
    return found.select(F.col("a.id").alias("u"), F.col("b.id").alias("v")).distinct()


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """`(doc_id, n_shingles, component_id, kept)` of every row of `docs (doc_id, text, …)`.

    Documents with 100 * intersection >= `similarity` * union of their shingle sets are linked; a
    component is named by its smallest doc_id, the one document that is kept. Lower-casing and words
    as in `words`; a text of fewer than five words is one shingle. A null or empty text, or one of
    white space, has no shingles and no links. A row without doc_id can be named by no link: its
    component is null and it is kept. Rows with one doc_id are one document; each gets its row. Other
    columns are not read.
    """
    rows = docs.select("doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    sketched = materialise(
        rows.mapInArrow(
            _sketch, f"doc_id {kind}, n_shingles long, sum long, fold long, bands array<long>"
        ),
        "sketches",
    )
    filled = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    content = ["n_shingles", "sum", "fold"]
    classes = materialise(filled.groupBy(*content).agg(F.min("doc_id").alias("class")), "classes")

    named = classes.select(*content, F.col("class").alias("doc_id"))
    bands = filled.join(named, ["doc_id", *content], "left_semi").select(
        F.explode("bands").alias("band"), "doc_id"
    )
    buckets = bands.groupBy("band").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = materialise(buckets.where("first < last").select("band", "first"), "bands")
    members = materialise(bands.join(shared, "band"), "members")

    wanted = members.select("doc_id").distinct()
    texts = materialise(rows.join(wanted, "doc_id", "left_semi"), "texts")
    pairs = members.where("first < doc_id").groupBy("doc_id").agg(F.min("first").alias("v"))
    links = materialise(confirmed(pairs.select(F.col("doc_id").alias("u"), "v"), texts, similarity), "links")

    labels = components(links)
    labelled = materialise(
        members.join(labels, F.col("doc_id") == F.col("node"), "left").select(
            "band", "doc_id", F.coalesce("component", "doc_id").alias("label")
        ),
        "labelled",
    )
    mixed = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = materialise(mixed.where("low < high").select("band"), "mixed")
    unsettled = labelled.join(mixed, "band", "left_semi").select("doc_id", "label").distinct()
    unsettled = materialise(texts.join(unsettled, "doc_id"), "unsettled")
    more = materialise(confirmed(_across_labels(unsettled, similarity), unsettled, similarity), "links")

    joined = materialise(components(links.unionByName(more)), "components")
    own = sketched.select("doc_id", *content).join(classes, content, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class", "doc_id"))
    return own.join(joined, F.col("class") == F.col("node"), "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
