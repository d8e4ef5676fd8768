"""Licence scans by canonical digests.

Texts are brought to one form (letter case, copyright lines, punctuation, equivalent spellings, white
space) and their digests are joined to those of known licence texts. Entire texts are looked up: a
document's, and each of its lines', as notices are often a line of their own.
"""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXTS = "licenses_data/texts.txt"


def read_texts(source: str) -> dict[str, list[str]]:
    """Texts by licence: `=== id` begins a text, lines before the first one are notes."""
    found: dict[str, list[str]] = {}
    for part in ("\n" + source).split("\n=== ")[1:]:
        name, text = part.split("\n", 1)
        found.setdefault(name.strip(), []).append(text)
    return found


#: Licence notices, standard headers and whole texts.
KNOWN = read_texts(files("recollect.llm").joinpath(TEXTS).read_text("utf-8"))
#: A line with a copyright notice, and spellings that count as equal.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright|\(c\)|©)([^\p{L}\p{N}\n][^\n]*)?$"
SPELLINGS = (("licence", "license"), ("licenced", "licensed"), ("non commercial", "noncommercial"), ("sub license", "sublicense"))


def canonical_lines(text: Column) -> Column:
    """The canonical lines that are not empty, in order; null has none."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    plain = F.regexp_replace(plain, r"[^\p{L}\p{M}\p{N}\n]+", " ")
    for other, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(other), F.lit(usual))
    return F.filter(F.transform(F.split(plain, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def known_digests(spark: SparkSession) -> DataFrame:
    """`(digest, license_id)` of the KNOWN texts; a digest belongs to one licence."""
    rows = [(name, text) for name, texts in KNOWN.items() for text in texts]
    texts = spark.createDataFrame(rows, "license_id string, text string")
    whole = F.array_join(canonical_lines(F.col("text")), " ")
    return texts.groupBy(F.sha2(whole, 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """`(doc_id, license_id, line_licenses, n_license_lines, canonical_sha256)` of every row of `docs`.

    `license_id` is the licence that the entire text is, else null; `line_licenses` the distinct
    licences of its lines in order, comma-separated, null without any; the digest is that of the
    canonical text, which is empty for a null text or one without letters and digits; an empty
    canonical text is no licence. `known (digest, license_id)` is the table of licences; it is broadcast if
    Spark finds it small. Other columns are not read.
    """
    lines = docs.select("doc_id", canonical_lines(F.col("text")).alias("lines")).select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.sha2(F.array_join("lines", " "), 256).alias("whole"),
        F.transform("lines", lambda line: F.sha2(line, 256)).alias("digests"),
    )
    units = lines.select("doc_id", "row", "whole", F.posexplode(F.concat(F.array("whole"), "digests")).alias("place", "digest"))
    named = units.join(known, "digest", "left")
    whole, line = F.col("place") == 0, (F.col("place") > 0) & F.col("license_id").isNotNull()
    found = named.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max(F.when(whole, F.col("license_id"))).alias("license_id"),
        F.array_join(F.array_sort(F.collect_set(F.when(line, F.col("license_id")))), ",").alias("names"),
        F.count_if(line).alias("n_license_lines"),
        F.first("whole").alias("canonical_sha256"),
    )
    names = F.when(F.col("names") != "", F.col("names"))
    return found.select("doc_id", "license_id", names.alias("line_licenses"), "n_license_lines", "canonical_sha256")
