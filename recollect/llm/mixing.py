"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

Documents fall into shards by a seeded hash. In a shard, the documents of a source lie on a line in
the order of that hash, cut into blocks of BLOCK_WORDS words. Each shard's blocks go to the sources by
the highest quotients target / (2 k + 1). A source takes its blocks from the start of its line and,
when it gets more blocks than it has, goes over the line again; so the seeded order selects, and reruns
agree. Texts stay whole: of the last run, the documents that fit are taken, and then the one whose size is
nearest to what is left of the blocks, if that comes nearer to them than taking none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recollect.llm.columns import unused
from recollect.session import materialise

SEED = 17
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 20
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame) -> DataFrame:
    """`(place, source, source_size, target)` of the sources in `sizes (source, source_size)`.

    Sources by code point, null last, weigh 1, 2, 3, 1, …; they share the sum of all sizes by weight,
    and none gets more than MOST times its size: sorted by that limit per weight, the sources before
    the first one whose share of the rest fits are at their limit. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = sizes.withColumn("place", F.row_number().over(by_name)).withColumns(
        {
            "weight": (F.col("place") - 1) % 3 + 1,
            "most": MOST * F.col("source_size"),
            "total": F.sum("source_size").over(everything),
        }
    )
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), "place")
    shared = ranked.withColumns(
        {
            "rest": F.col("total") - F.sum("most").over(by_limit) + F.col("most"),
            "weights": F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    ).withColumn(
        "fits",
        (F.col("rest") * F.col("weight")).cast("decimal(38,0)")
        <= F.col("most").cast("decimal(19,0)") * F.col("weights").cast("decimal(19,0)"),
    )
    fit = F.min(F.when(F.col("fits"), F.struct(F.col("most") / F.col("weight"), "place", "rest", "weights")))
    first = shared.withColumn("first", fit.over(everything))
    share = (F.col("first.rest") * F.col("weight")).cast("double") / F.col("first.weights")
    target = F.when(F.col("fits"), share).otherwise(F.col("most").cast("double"))
    return first.select("place", "source", "source_size", target.alias("target"))


def quotas(groups: DataFrame) -> DataFrame:
    """Blocks for every group of `groups (shard, place, length, wanted)`: `(shard, place, quota)`.

    `wanted` is in thousandths of a word, so that sums are exact in any order.

    A shard of S groups has N blocks. By the highest quotients a group with the share p wins between
    p (N - S / 2) - 1/2 and p (N + S / 2) + 1/2 blocks, so only that range is ranked: about 4 S rows.
    """
    shard = Window.partitionBy("shard")
    counted = groups.withColumns(
        {
            "all_wanted": F.sum("wanted").over(shard),
            "n_groups": F.count("*").over(shard),
        }
    ).withColumns(
        {
            "blocks": F.floor(F.col("all_wanted") / (1000 * BLOCK_WORDS) + 0.5),
            "part": F.when(F.col("all_wanted") > 0, F.col("wanted") / F.col("all_wanted")).otherwise(0.0),
        }
    )
    low = F.floor(F.col("part") * (F.col("blocks") - F.col("n_groups") / 2) - 0.5)
    high = F.ceil(F.col("part") * (F.col("blocks") + F.col("n_groups") / 2) + 0.5)
    seats = counted.withColumns({"low": F.greatest(F.lit(0), low), "high": high}).withColumn(
        "open", F.col("blocks") - F.sum("low").over(shard)
    )
    ranked = seats.where("wanted > 0").withColumn("seat", F.explode(F.sequence("low", F.greatest("low", "high"))))
    by_quotient = shard.orderBy(F.desc(F.col("wanted") / (2 * F.col("seat") + 1)), "place", "seat")
    ranked = ranked.withColumn("turn", F.row_number().over(by_quotient))
    return ranked.groupBy("shard", "place").agg(
        (F.first("low") + F.count_if(F.col("turn") <= F.col("open"))).alias("won"),
        F.first("length").alias("length"),
    ).select("shard", "place", F.least("won", MOST * F.ceil(F.col("length") / BLOCK_WORDS)).alias("quota"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """How many words the mix takes of each row of `docs (doc_id, text, source, …)`, repeats counted.

    `(doc_id, size, source_size, target, taken)`. A null text has size 0; a null source is a source of
    its own. `taken` is at most MOST times `size`. Rows with one doc_id, null included, take part
    each for itself, next to each other in the seeded order. Other columns are not read.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    sized = materialise(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), name)).alias("draw"),
        ),
        "sizes",
    )
    sources = materialise(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "sources"
    )
    words = sized.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-words // SHARD_WORDS))
    drawn = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") % shards
    named = sources.withColumnRenamed("source", "source_name")
    placed = sized.join(named, F.col("source").eqNullSafe(F.col("source_name"))).withColumn("shard", drawn)
    groups = placed.groupBy("shard", "place").agg(
        F.sum("size").alias("length"), F.first("target").alias("target"), F.first("source_size").alias("source_size")
    )
    wanted = F.when(
        F.col("source_size") > 0, F.floor(1000 * (F.col("target") * F.col("length") / F.col("source_size")))
    ).otherwise(0)
    won = quotas(groups.select("shard", "place", "length", wanted.alias("wanted")))

    line = Window.partitionBy("shard", "place").orderBy("draw", "doc_id", "size")
    lined = placed.withColumns(
        {
            "end": F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "length": F.sum("size").over(Window.partitionBy("shard", "place")),
        }
    ).join(won, ["shard", "place"], "left")
    blocks = F.ceil(F.col("length") / BLOCK_WORDS)
    group = Window.partitionBy("shard", "place")
    cut = lined.where((F.col("length") > 0) & F.col("quota").isNotNull()).withColumn(
        "rounds", F.floor(F.col("quota") / blocks)
    ).withColumn("edge", (F.col("quota") - F.col("rounds") * blocks) * BLOCK_WORDS)
    fits = F.col("end") <= F.col("edge")
    left = cut.withColumn("left", F.col("edge") - F.coalesce(F.max(F.when(fits, F.col("end"))).over(group), F.lit(0)))
    miss = F.when(~fits & (F.abs(F.col("size") - F.col("left")) < F.col("left")), F.abs(F.col("size") - F.col("left")))
    nearest = F.row_number().over(group.orderBy(miss.asc_nulls_last(), "draw", "doc_id", "size"))
    last = left.withColumn("last", (nearest == 1) & miss.isNotNull())
    copies = F.col("rounds") + fits.cast("int") + F.col("last").cast("int")
    out = last.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"))
    none = lined.where((F.col("length") <= 0) | F.col("quota").isNull())
    return out.unionByName(none.select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken")))


def mixed_rows(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed corpus, all columns of `docs`: a row for every time that a document is taken, texts whole.

    Rows that agree in doc_id and size share what is taken of them: each gets the whole part of it, and
    the first ones by text one more. Rows without words are not taken. Columns may have any names.
    """
    at, words, total, n, place = unused(docs.columns, "mix_id", "mix_size", "mix_total", "mix_rows", "mix_place")
    decided = mix(docs, seed).where("size > 0").groupBy("doc_id", "size")
    decided = decided.agg((F.sum("taken") / F.col("size")).cast("long").alias("total"), F.count("*").alias("n"))
    decided = materialise(decided.where("total > 0").toDF(at, words, total, n), "mix")
    same = docs["doc_id"].eqNullSafe(decided[at]) & (word_count(docs["text"]) == decided[words])
    found = docs.join(decided.hint("merge"), same)
    alone = found.where(F.col(n) == 1).withColumn(place, F.lit(1))
    shared = Window.partitionBy(at, words).orderBy(F.xxhash64("text"))
    several = found.where(F.col(n) > 1).withColumn(place, F.row_number().over(shared))
    one_more = (F.col(place) <= F.col(total) % F.col(n)).cast("int")
    copies = (F.floor(F.col(total) / F.col(n)) + one_more).cast("int")
    taken = alone.unionByName(several).withColumn(place, F.explode(F.array_repeat(F.lit(1), copies)))
    return taken.select(*docs.columns)
