"""Exact duplicates by a persistent index of text digests.

The index is a table bucketed and sorted by digest. New rows are reduced to one row per digest, those
that the index has are left out by a sort-merge anti-join (the index side is neither shuffled nor
held in memory), and the rest is appended, together with the batch that brought it. Two texts are equal
when they are identical after deleting every space and every character from U+0009 to U+000D.

A batch is known by its name, or by its content where it has none. Running one again, because what
came of it was lost, gives the same rows again and adds nothing to the index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.llm.columns import unused
from recollect.session import materialise, scratch_path
from recollect.sources.tables import qualified_name

HOT_GROUPS = 1024


@dataclass(frozen=True)
class DigestIndex:
    """A bucketed table of `(digest, keep_id, n_points, group_size, batch)`, one row per text seen."""

    spark: SparkSession
    name: str

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def buckets(self) -> int:
        described = self.spark.sql(f"DESCRIBE EXTENDED {self.name}").where("col_name = 'Num Buckets'")
        return int(described.first()["data_type"])

    def append(self, rows: DataFrame) -> None:
        """Add rows with new digests; every task writes one bucket file."""
        columns = self.rows().columns
        rows.select(*columns).repartition(self.buckets(), "digest").write.insertInto(self.name)

    def drop(self) -> None:
        """Take the table out of the catalog; its files stay and `open_index` finds them again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def compacted(self, name: str, path: str) -> DigestIndex:
        """A copy with one file per bucket, which Spark reads in sorted order; every append adds one more."""
        kind = dict(self.rows().dtypes)["keep_id"]
        fresh = open_index(self.spark, name, path, self.buckets(), kind)
        fresh.append(materialise(self.rows(), "index-rows"))  # read as buckets, they would not be dealt anew
        return fresh


def open_index(spark: SparkSession, name: str, path: str, buckets: int, id_type: str = "bigint") -> DigestIndex:
    """The index stored below `path`, created there if it is new; `buckets` must not change later."""
    quoted = qualified_name(*name.split("."))
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted} (digest BINARY, keep_id {id_type}, n_points BIGINT,"
        f" group_size BIGINT, batch STRING) USING parquet CLUSTERED BY (digest) SORTED BY (digest)"
        f" INTO {int(buckets)} BUCKETS LOCATION '{location}'"
    )
    return DigestIndex(spark, quoted)


def text_digest(text: Column) -> Column:
    """SHA-256 of the text without white space; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", ""), 256))


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """One row per row of `docs (doc_id, text, …)`, kept or not; new texts go into the index.

    `(doc_id, keep_id, group_size, kept, text_sha256, n_points)`. Of equal texts the row with the most
    code points in the original text stays, then the one with the smallest doc_id, a null one last; of
    rows that agree in that too, exactly one. Rows whose text the index already has are not kept:
    `keep_id` names the row that brought the text, `group_size` counts the rows with that text in
    the batch that brought it and in this one. Null texts are empty texts. Other columns are not read.
    Texts that the index has from this very batch count as new. Without a name, a batch is the same
    as another if both hold the same pairs of doc_id and normalised text, each as often.
    """
    text = F.coalesce("text", F.lit(""))
    rows = materialise(
        docs.select(
            "doc_id",
            text_digest(F.col("text")).alias("digest"),
            F.length(text).cast("long").alias("n_points"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "fingerprints",
    )
    order = F.struct((-F.col("n_points")).alias("points"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    groups = materialise(
        rows.groupBy("digest").agg(F.min(order).alias("best"), F.count("*").alias("batch_size")), "groups"
    )
    own = F.lit(_content_name(rows) if batch is None else batch)
    stored = index.rows().select("digest", (F.col("batch") == own).alias("is_own"))
    found = groups.hint("merge").join(stored, "digest", "left").where("is_own OR is_own IS NULL")
    fresh = materialise(found, "fresh")
    index.append(
        fresh.where("is_own IS NULL").select(
            "digest",
            F.col("best.doc_id").alias("keep_id"),
            (-F.col("best.points")).alias("n_points"),
            F.col("batch_size").alias("group_size"),
            own.alias("batch"),
        )
    )
    # a text that the index had before has another row there than this batch's best one
    described = (
        groups.join(index.rows().withColumnRenamed("group_size", "first_size"), "digest")
        .join(fresh.select("digest", F.lit(True).alias("is_new")), "digest", "left")
        .select(
            "digest",
            "keep_id",
            F.when(F.col("is_new"), F.col("batch_size")).otherwise(F.col("first_size") + F.col("batch_size"))
            .alias("group_size"),
            F.when(F.col("is_new"), F.col("best.row")).alias("keep_row"),
            "batch_size",
        )
    )
    return _with_groups(rows, described)


def _content_name(rows: DataFrame) -> str:
    """A name for the batch's `(doc_id, digest)` rows that does not depend on their order."""
    hashes = F.xxhash64("doc_id", "digest")
    sums = rows.agg(
        F.count("*"), F.coalesce(F.sum(hashes.cast("decimal(38,0)")), F.lit(0)), F.coalesce(F.bit_xor(hashes), F.lit(0))
    )
    return "content:" + ":".join(str(value) for value in sums.first())


def _with_groups(rows: DataFrame, described: DataFrame) -> DataFrame:
    """Each row with its group; the rows of the largest groups are joined apart.

    Spark cannot split the join with the index, so the at most HOT_GROUPS largest groups are
    broadcast; every other group has less than one in HOT_GROUPS of all rows.
    """
    described = materialise(described, "described")
    hot = described.where("batch_size > 1").orderBy(F.desc("batch_size"), "digest").limit(HOT_GROUPS)
    hot = F.broadcast(materialise(hot, "hot-groups"))
    out = [rows.join(hot, "digest"), rows.join(hot, "digest", "left_anti").join(described, "digest")]
    return out[0].unionByName(out[1]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n_points",
    )


def fresh_index(spark: SparkSession, id_type: str = "bigint") -> DigestIndex:
    """An empty index in the shared folder, with as many buckets as a shuffle has partitions."""
    path = scratch_path(spark, "digest-index")
    name = "digest_index_" + path.rsplit("-", 1)[1]
    return open_index(spark, name, path, int(spark.conf.get("spark.sql.shuffle.partitions")), id_type)


def kept_rows(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """`docs` without the rows that `deduplicate` drops, all columns, which may have any names."""
    name, digest, points, copies = unused(docs.columns, "kept_id", "kept_digest", "kept_points", "kept_copies")
    own_digest, own_points = unused([*docs.columns, name, digest, points, copies], "digest", "points")
    agreeing = deduplicate(docs, index, batch).groupBy("doc_id", F.unhex("text_sha256"), "n_points")
    kept = agreeing.agg(F.max("kept").alias("kept"), F.count("*").alias("copies")).where("kept").drop("kept")
    kept = materialise(kept.toDF(name, digest, points, copies), "kept")
    marked = docs.withColumns(
        {own_digest: text_digest(F.col("text")), own_points: F.length(F.coalesce("text", F.lit("")))}
    )
    same = (
        marked["doc_id"].eqNullSafe(kept[name])
        & (marked[own_digest] == kept[digest])
        & (marked[own_points] == kept[points])
    )
    found = marked.join(kept, same)
    out = found.where(F.col(copies) == 1)
    if not kept.where(F.col(copies) > 1).isEmpty():  # rows that agree in id, text and length
        out = out.unionByName(found.where(F.col(copies) > 1).dropDuplicates([name, digest]))
    return out.select(*docs.columns)
