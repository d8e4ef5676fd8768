"""Collocations by dynamic itemset counting (Brin et al., 1997) of contiguous phrases.

The documents are dealt to `SHARDS` shards, which are scanned in a cycle. All words are counted from the
first scan on. After every scan the phrases whose count so far has reached the threshold are noted, and a
longer phrase becomes active as soon as both its subphrases (without its last and without its first
word) have: from the next scan on it is counted, until it has been counted in every shard once. So
lengths are interleaved; the cycle ends when a full round activates nothing.

What has reached the threshold is told to the scans by a Bloom filter of fixed size. Being told so by
error only means that a phrase is counted early: filters only gain bits, so in each shard a phrase is
counted at the first visit at which it is active and at no other, and every finished count is exact,
whatever the filter errs. Counts are rows of `(key, first, n, done)`, added up by Spark after every scan;
a phrase that has completed its cycle below the threshold is dropped. Words and phrases are known by
64-bit hashes, seeded with the language. `first` says in which step and block a phrase was seen first:
there, and nowhere else, those that reached the threshold get their texts at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recollect.llm import words
from recollect.session import materialise, scratch_path

LEAST, LONGEST, BEST = 100, 5, 2000
SHARDS = 3
UNKNOWN = "und"
FILTER_WORDS = 1 << 20  # of 64 bits: 8 MB at any size of the corpus
BLOCK_BYTES = 1 << 20
HELD_WORDS = 1 << 19
STEP_BIT = 44  # of `first`: the step above, the block below
_STEP = words.constants(31, LONGEST + 1) | np.uint64(1)
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_PLAIN = np.where(_BREAK, np.uint8(32), words.LOWER)


class Pieces:
    """The words of some texts: bytes, hashes seeded with the language, and the piece each lies in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]):
        self.data, self.offsets = _PLAIN[data], offsets
        self.found = words.Words(self.data, offsets)
        self.rows = np.repeat(np.arange(len(langs)), np.diff(self.found.first))
        seeds = {lang: int.from_bytes(blake2b(lang.encode(), digest_size=8).digest()) for lang in set(langs)}
        seed = np.array([seeds[lang] for lang in langs], dtype=np.uint64)
        self.keys = words.mix(self.found.hashes_as_is() + seed[self.rows])
        self.piece = np.cumsum(_BREAK[data], dtype=np.int64)[self.found.starts] + self.rows

    def row(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[Pieces, list[str]]]:
    langs = [UNKNOWN if lang is None else lang for lang in batch.column("lang").to_pylist()]
    for low, high, data, offsets in words.byte_chunks(batch.column("text"), BLOCK_BYTES):
        yield Pieces(data, offsets, langs[low:high]), langs[low:high]


def _separated(keys: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """The keys with a zero after the last word of every piece."""
    if not len(keys):
        return keys
    ends = np.append(piece[1:] != piece[:-1], True)
    out = np.zeros(len(keys) + ends.sum(), dtype=np.uint64)
    out[np.arange(len(keys)) + np.cumsum(ends) - ends] = keys
    return out


BLOCKS = (
    "shard int, block long, size long, keys binary, text_size long, text binary, langs array<struct<lang: string, n: long>>"
)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents dealt to the shards in turn, in blocks: word keys, words, and the words of each document."""
    held: list[list[tuple[np.ndarray, bytes]]] = [[] for _ in range(SHARDS)]
    counts: list[list[dict]] = [[] for _ in range(SHARDS)]
    part_id = TaskContext.get().partitionId()
    turn, number = part_id, part_id << 20
    kind = pa.list_(pa.struct([("lang", pa.string()), ("n", pa.int64())]))

    def packed(shard: int) -> pa.RecordBatch:
        nonlocal number
        keys = np.concatenate([k for k, _ in held[shard]])
        text = b" ".join(t for _, t in held[shard] if t)
        blobs = [pa.array([pa.compress(b, codec="zstd", asbytes=True)], pa.binary()) for b in (keys.tobytes(), text)]
        sizes = [pa.array([n], pa.int64()) for n in (number, len(keys), len(text))]
        row = [pa.array([shard], pa.int32()), sizes[0], sizes[1], blobs[0], sizes[2], blobs[1], pa.array([counts[shard]], kind)]
        held[shard], counts[shard] = [], []
        number += 1
        return pa.RecordBatch.from_arrays(row, names=["shard", "block", "size", "keys", "text_size", "text", "langs"])

    for batch in batches:
        for part, langs in _pieces(batch):
            dealt = (turn + np.arange(len(langs))) % SHARDS
            turn += len(langs)
            sizes = np.diff(part.found.first)
            for shard in range(SHARDS):
                own = dealt[part.rows] == shard
                rows = np.flatnonzero((dealt == shard) & (sizes > 0))
                text = b" ".join(b" ".join(part.row(row).split()) for row in rows)
                held[shard].append((_separated(part.keys[own], part.piece[own]), text))
                counts[shard] += [{"lang": langs[row], "n": int(sizes[row])} for row in rows]
                if sum(len(k) for k, _ in held[shard]) >= HELD_WORDS:
                    yield packed(shard)
    yield from (packed(shard) for shard in range(SHARDS) if counts[shard])


def _masks(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys), dtype=np.uint64)
    for shift in (0, 6, 12, 18):
        out |= np.uint64(1) << ((keys >> np.uint64(shift)) & np.uint64(63))
    return out


def _told(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter holds: four bits in the 64-bit word that the first bits of a key name."""
    masks = _masks(keys)
    return bits[(keys >> np.uint64(44)).astype(np.int64) & (len(bits) - 1)] & masks == masks


def _learn(bits: np.ndarray, reached: DataFrame) -> np.ndarray:
    """The filter with the keys of `reached (key)` added; Spark sends at most one row per filter word."""
    probes = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(key, {s}) & 63 AS int))" for s in (0, 6, 12, 18))
    words_of = reached.selectExpr(f"shiftrightunsigned(key, 44) & {len(bits) - 1} AS slot", f"{probes} AS mask")
    found = words_of.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = bits.copy()
    out[found["slot"].to_numpy()] |= found["mask"].to_numpy().view(np.uint64)
    return out


def _longer(keys: np.ndarray, told: np.ndarray, earlier: np.ndarray | None = None):
    """For each length from 2 on: word places, keys of active phrases, and if they were active earlier.

    `told` is the filter now, `earlier` the one at the shard's last visit. A phrase is active if the
    filter holds both its subphrases.
    """
    at = np.flatnonzero((keys != 0) & _told(told, keys))
    current = keys[at]
    was = _told(earlier, current) if earlier is not None else np.zeros(len(at), dtype=bool)
    for length in range(2, LONGEST + 1):
        both = np.flatnonzero(at[1:] - at[:-1] == 1)
        was = was[both] & was[both + 1]
        current = words.mix(current[both] + words.mix(keys[at[both] + length - 1]) * _STEP[length])
        at = at[both]
        yield length, at, current, was
        held = _told(told, current)
        at, current, was = at[held], current[held], was[held]
        if earlier is not None:
            was &= _told(earlier, current)


def _keys_of(block: dict) -> np.ndarray:
    return np.frombuffer(pa.decompress(block["keys"], 8 * block["size"], codec="zstd"), np.uint64)


def _scan(told, earlier, step: int) -> Callable:
    """Counts of the phrases of a shard that are active now and were not at the shard's last visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                keys = _keys_of(block)
                found = [keys[keys != 0]] if step < SHARDS else []
                for _, _, phrases, was in _longer(keys, told.value, earlier.value if earlier else None):
                    found.append(phrases[~was])
                distinct, n = np.unique(np.concatenate(found), return_counts=True)
                first = np.full(len(distinct), step << STEP_BIT | block["block"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct.view(np.int64)), pa.array(first), pa.array(n.astype(np.int64))],
                    names=["key", "first", "n"],
                )

    return run


def _name(told) -> Callable:
    """`(key, lang, length, phrase)` of the wanted words and phrases of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                keys = _keys_of(block)
                wanted = np.sort(np.array(block["wanted"], dtype=np.int64).view(np.uint64))
                text = pa.decompress(block["text"], block["text_size"], codec="zstd", asbytes=True).split(b" ")
                ends = np.cumsum([d["n"] for d in block["langs"]])
                word = np.cumsum(keys != 0) - 1
                single = np.flatnonzero(keys != 0)
                rows: list[tuple] = []
                for length, at, phrases, _ in [(1, single, keys[single], None), *_longer(keys, told.value)]:
                    held = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, phrases), len(wanted) - 1)] == phrases)
                    distinct, first = np.unique(phrases[held], return_index=True)
                    places = word[at[held[first]]]
                    langs = np.searchsorted(ends, places, side="right")
                    for key, place, lang in zip(distinct.tolist(), places.tolist(), langs.tolist(), strict=True):
                        phrase = b" ".join(text[place : place + length]).decode()
                        rows.append((key, block["langs"][lang]["lang"], length, phrase))
                key, lang, length, phrase = zip(*rows, strict=True) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(key, np.uint64).view(np.int64)), pa.array(lang, pa.string()),
                     pa.array(length, pa.int32()), pa.array(phrase, pa.string())],
                    names=["key", "lang", "length", "phrase"],
                )

    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """`(lang, length, phrase, n)` of all words and phrases counted at least `least` times, and `(lang, n)`.

    The second frame counts the words of every language that has any.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    path = scratch_path(spark, "shards")
    packed = texts.mapInArrow(_shard, BLOCKS)
    packed.write.partitionBy("shard").option("compression", "uncompressed").parquet(path)  # they are compressed
    blocks = spark.read.schema(BLOCKS).parquet(path)
    totals = blocks.select(F.inline("langs")).groupBy("lang").agg(F.sum("n").alias("n"))

    counts = spark.createDataFrame([], "key long, first long, n long, done boolean, fresh boolean")
    bits = [np.zeros(FILTER_WORDS, dtype=np.uint64)]
    sent = [spark.sparkContext.broadcast(bits[0])]
    step = 0
    while step < SHARDS or not np.array_equal(bits[step], bits[step - SHARDS]):
        earlier = sent[step - SHARDS] if step >= SHARDS else None
        scanned = blocks.where(F.col("shard") == step % SHARDS).select("block", "size", "keys")
        found = scanned.mapInArrow(_scan(sent[step], earlier, step), "key long, first long, n long")
        added = found.select("key", "first", "n", F.lit(False).alias("done"))
        summed = counts.select("key", "first", "n", "done").unionAll(added).groupBy("key").agg(
            F.min("first").alias("first"), F.sum("n").alias("n"), F.max("done").alias("done")
        )
        reached = F.col("n") >= least
        open_ = F.shiftright("first", STEP_BIT) + (SHARDS - 1) > step
        counts = materialise(
            summed.where(reached | open_).select(
                "key", "first", "n", reached.alias("done"), (reached & ~F.col("done")).alias("fresh")
            ),
            f"counts-{step}",
        )
        bits.append(_learn(bits[step], counts.where("fresh").select("key")))
        sent.append(spark.sparkContext.broadcast(bits[-1]))
        if step >= SHARDS:
            bits[step - SHARDS] = None
            sent[step - SHARDS].unpersist()
        step += 1

    frequent = counts.where("done").select("key", "n", (F.col("first").bitwiseAND((1 << STEP_BIT) - 1)).alias("block"))
    wanted = frequent.groupBy("block").agg(F.collect_list("key").alias("wanted"))
    asked = blocks.drop("shard").join(wanted, "block")
    named = asked.mapInArrow(_name(sent[step]), "key long, lang string, length int, phrase string")
    found = frequent.select("key", "n").join(named, "key").select("lang", "length", "phrase", "n")
    return materialise(found, "frequent"), materialise(totals, "totals")


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST) -> DataFrame:
    """The `best` phrases of every language: `(lang, rank, phrase, a, l, r, n, score)`, numbers long.

    `docs (text, lang, …)`: A to Z are lower-cased, texts are cut at `.,;:!?` and U+000A to U+000D into
    pieces, pieces at spaces and tabs into words. A phrase has 2 to LONGEST words of one piece and occurs
    `a >= least` times. Each cut into two parts that occur l and r times gives floor(1000 a n / (l r)),
    n being the words of the language; the lowest counts, of equal ones the earliest cut. Phrases inside
    a longer one that occurs as often are left out. Ranked by score, then a, then the phrase's bytes.

    A null text is empty; a null language is UNKNOWN, together with rows that state it. Repeated rows count each
    time. Other columns, doc_id too, are not read; an empty table gives no rows.
    """
    frequent, totals = frequent_phrases(docs, least)
    part = frequent.select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    phrases = frequent.where("length > 1").withColumnRenamed("n", "a").withColumn("words", F.split("phrase", " "))
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("length") - 1))).select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.col("length") - F.col("cut")), " ").alias("tail"),
    )
    counted = (
        cuts.join(part.toDF("lang", "head", "l"), ["lang", "head"])
        .join(part.toDF("lang", "tail", "r"), ["lang", "tail"])
        .join(totals, "lang")
    )
    exact = "cast(1000 * cast(a AS decimal(20,0)) * cast(n AS decimal(14,0)) AS decimal(38,0))"
    score = F.expr(f"{exact} div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("lowest")
    scored = counted.groupBy("lang", "phrase", "a", "n").agg(lowest)

    spans = [(i, k) for k in range(2, LONGEST) for i in range(1, LONGEST - k + 2)]
    inner = [
        F.when((F.col("length") > k) & (F.col("length") >= i + k - 1), F.array_join(F.slice("words", i, k), " "))
        for i, k in spans
    ]
    inside = phrases.where("length > 2").select("lang", "a", F.explode(F.array(*inner)).alias("phrase"))
    inside = inside.where("phrase IS NOT NULL").select("lang", "phrase", "a").distinct()
    kept = scored.join(inside, ["lang", "phrase", "a"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    flat = kept.select("lang", "phrase", "a", "lowest.l", "lowest.r", "n", "lowest.score")
    return flat.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
