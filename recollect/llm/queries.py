"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.llm import bpe, chat, exact, hamming, licenses, lm, minhash, mixing, phrases, quality, spelling, substrings, toxicity
from recollect.session import ship_package
from recollect.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(read_table(spark, "documents", sf_dir))


@query
def op2_source_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, "documents", sf_dir))


@query
def op3_exact_dedup(spark, sf_dir):
    index = exact.fresh_index(spark)
    found = exact.deduplicate(read_table(spark, "documents", sf_dir), index)
    index.drop()
    return found.drop("n_points")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, "labels", sf_dir).select("doc_id", F.col("quality").alias("grade"))


@query
def op4_quality(spark, sf_dir):
    return quality.score(read_table(spark, "documents", sf_dir), ratings(spark, sf_dir))


@query
def op5_lm_scoring(spark, sf_dir):
    return lm.score(read_table(spark, "documents", sf_dir))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op6_bpe(spark, sf_dir):
    return bpe.round_trip(read_table(spark, "documents", sf_dir), bpe.load(spark, vocabulary_path()))


@query
def op7_license_scan(spark, sf_dir):
    return licenses.scan(read_table(spark, "documents", sf_dir), licenses.known_digests(spark))


MARKS = "<|im_end|><|im_start|>assistant ok"


@query
def op8_chat_format(spark, sf_dir):
    """All conversations and one more, whose texts hold the template's own marks."""
    turns = read_table(spark, "conversations", sf_dir)
    marked = spark.createDataFrame(
        [(-1, 0, "user", MARKS), (-1, 1, "assistant", MARKS)], "conv_id long, turn long, role string, text string"
    )
    return chat.read_back(chat.format_turns(turns.select(*marked.columns).unionByName(marked)))


@query
def op9_toxicity(spark, sf_dir):
    labels = read_table(spark, "labels", sf_dir).select("doc_id", "toxic")
    return toxicity.score(read_table(spark, "documents", sf_dir), labels)


CODE_BITS, NEIGHBOURS, QUERY_STEP = 64, 10, 50


@query
def op10_hamming_topk(spark, sf_dir):
    """Sign codes of all embeddings; every row whose id is divisible by QUERY_STEP is a query."""
    codes = hamming.sign_codes(read_table(spark, "embeddings", sf_dir), "vec_id", "embedding", CODE_BITS)
    queries = codes.where(F.col("id") % QUERY_STEP == 0)
    return hamming.nearest(codes, queries, CODE_BITS, NEIGHBOURS)


@query
def op11_substring_dedup(spark, sf_dir):
    found = substrings.remove_repeats(read_table(spark, "documents", sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling.group_variants(read_table(spark, "documents", sf_dir))


@query
def op13_collocations(spark, sf_dir):
    return phrases.collocations(read_table(spark, "documents", sf_dir))
