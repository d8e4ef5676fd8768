"""Exact nearest binary codes by incremental multi-index hashing (Norouzi et al., 2014).

A code is cut into m segments, each with its own table. If two codes differ in at most
`m s + j` bits, one of the segments 0 to j differs in at most s bits, or one of the others in at most
s - 1. So the tables are probed at radius 0, 1, … around the query's segments, found codes are
verified on all bits, and a query ends when its k-th distance is covered. Equal codes are indexed
once.

Codes are dealt to shards by their hash: as many as there are cores, but of SHARD_LEAST codes or more each (in
smaller ones looking at all codes is cheaper than probing) and of about SHARD_MOST at most. Distinct query
codes travel to them in blocks of QUERY_BLOCK at most, and each block is one pass over the index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.functions.keys import top_k
from recollect.session import materialise

QUERY_BLOCK = 1 << 16
SHARD_LEAST, SHARD_MOST = 1 << 13, 1 << 20
PROBE_CELLS = 1 << 20


def sign_codes(vectors: DataFrame, id_column: str, vector: str, bits: int) -> DataFrame:
    """`(id, code)`: bit i is set where value i is above 0; missing values give 0, further ones are cut.

    The code is `bits` bits in 64-bit words, as binary. Rows without id or vector are left out.
    """
    kind = dict(vectors.dtypes)[id_column]
    width = -(-bits // 64) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for values in batch.column("vector").to_pylist():
                signs = np.array([v is not None and v > 0 for v in values[:bits]], dtype=bool)
                codes.append(np.packbits(signs, bitorder="little").tobytes().ljust(width, b"\0"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(codes, pa.binary())], names=["id", "code"])

    present = vectors.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull())
    named = present.select(F.col(id_column).alias("id"), F.col(vector).alias("vector"))
    return named.mapInArrow(run, f"id {kind}, code binary")


def _words(codes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(codes), "<u8").reshape(len(codes), -1)


class MultiIndex:
    """The segment tables of one shard: `codes` (n, words) of `bits` bits."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.codes, self.bits = codes, bits
        self.scanned = 0  # queries that were ended by a look at all codes
        m = max(1, round(bits / max(1.0, min(20.0, math.log2(max(2, len(codes)))))))
        cuts = np.linspace(0, bits, m + 1).astype(int)
        self.spans = list(zip(cuts.tolist(), cuts[1:].tolist(), strict=False))
        self.tables = []
        for low, high in self.spans:
            values = self._segment(codes, low, high)
            order = np.argsort(values, kind="stable")
            starts = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << (high - low)))])
            self.tables.append((order, starts))

    @staticmethod
    def _segment(codes: np.ndarray, low: int, high: int) -> np.ndarray:
        word, at = divmod(low, 64)
        part = codes[:, word] >> np.uint64(at)
        if at + high - low > 64:
            part = part | (codes[:, word + 1] << np.uint64(64 - at))
        return (part & np.uint64((1 << (high - low)) - 1)).astype(np.int64)

    def search(self, queries: np.ndarray, k: int, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows (query, code, distance): the k nearest codes of every query, ties by `tie`."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        counts = np.zeros((len(queries), self.bits + 1), dtype=np.int64)
        active = np.arange(len(queries))
        m, n = len(self.spans), len(self.codes)
        for radius in range(self.bits + 1):
            if not len(active):
                break
            probes = sum(math.comb(high - low, radius) for low, high in self.spans)
            if probes >= n or radius > max(high - low for low, high in self.spans):
                self.scanned += len(active)
                self._scan(queries, active, found)  # probing further would cost more than all codes do
                break
            for j, (low, high) in enumerate(self.spans):
                self._probe(queries, active, j, radius, found, counts)
                reached = counts[active].cumsum(axis=1)
                covered = min(m * radius + j, self.bits)
                active = active[reached[:, covered] < k]
                if not len(active):
                    break
        query, code, distance = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, int)] * 3
        order = np.lexsort((tie[code], distance, query))
        query, code, distance = query[order], code[order], distance[order]
        first = np.searchsorted(query, query)
        near = np.arange(len(query)) - first < k
        return query[near], code[near], distance[near]

    def _probe(self, queries, active, j, radius, found, counts) -> None:
        """Look up everything at exactly `radius` from segment j, and verify what was not found before."""
        low, high = self.spans[j]
        masks = np.array([sum(1 << b for b in c) for c in combinations(range(high - low), radius)], dtype=np.int64)
        order, starts = self.tables[j]
        step = max(1, PROBE_CELLS // max(1, len(masks)))
        for at in range(0, len(active), step):
            part = active[at : at + step]
            cells = (self._segment(queries[part], low, high)[:, None] ^ masks).ravel()
            sizes = starts[cells + 1] - starts[cells]
            owner = np.repeat(np.repeat(part, len(masks)), sizes)
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            code = order[np.repeat(starts[cells], sizes) + offset]
            differ = queries[owner] ^ self.codes[code]
            new = np.ones(len(owner), dtype=bool)
            for i, span in enumerate(self.spans):
                if i != j:
                    ones = np.bitwise_count(self._segment(differ, *span))
                    new &= ones > radius if i < j else ones >= radius
            owner, code = owner[new], code[new]
            distance = np.bitwise_count(differ[new]).sum(axis=1, dtype=np.int64)
            np.add.at(counts, (owner, distance), 1)
            found.append((owner, code, distance))

    def _scan(self, queries, active, found) -> None:
        done = np.zeros(len(queries), dtype=bool)
        done[active] = True
        found[:] = [(q[~done[q]], c[~done[q]], d[~done[q]]) for q, c, d in found]
        step = max(1, PROBE_CELLS // len(self.codes))
        for at in range(0, len(active), step):
            part = active[at : at + step]
            distance = np.bitwise_count(queries[part][:, None] ^ self.codes).sum(axis=2, dtype=np.int64)
            found.append(
                (np.repeat(part, len(self.codes)), np.tile(np.arange(len(self.codes)), len(part)), distance.ravel())
            )


def _search(queries, k: int, bits: int, id_type: pa.DataType):
    def shard(codes: list[bytes], firsts: list) -> Iterator[pa.RecordBatch]:
        wanted = queries.value
        if not codes or not wanted:
            return
        index = MultiIndex(_words(codes), bits)
        tie = np.argsort(np.argsort(pa.array(firsts, id_type).to_numpy(zero_copy_only=False), kind="stable"))
        rows = [pa.array(c, pa.binary()) for c in (wanted, codes)] + [pa.array(firsts, id_type)]
        for low in range(0, len(wanted), 256):
            query, code, distance = index.search(_words(wanted[low : low + 256]), k, tie)
            yield pa.RecordBatch.from_arrays(
                [
                    rows[0].take(pa.array(query + low)), rows[1].take(pa.array(code)),
                    rows[2].take(pa.array(code)), pa.array(distance.astype(np.int32)),
                ],
                names=["query_code", "code", "first", "distance"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, firsts = [], []
        for batch in batches:
            codes += batch.column("code").to_pylist()
            firsts += batch.column("first").to_pylist()
            if len(codes) >= 2 * SHARD_MOST:
                yield from shard(codes, firsts)
                codes, firsts = [], []
        yield from shard(codes, firsts)

    return run


def nearest(codes: DataFrame, queries: DataFrame, bits: int, k: int) -> DataFrame:
    """`(query_id, id, distance, rank)`: the k rows of `codes (id, code)` nearest to each of `queries`.

    Both hold codes of `bits` bits as `sign_codes` makes them. Distance is the number of differing bits;
    ties go to the smaller id; a query that is itself a row finds itself. Rows with one id are
    separate rows, but equal ones count once. With fewer than k rows all are returned.
    """
    spark = codes.sparkSession
    kind = dict(codes.dtypes)["id"]
    members = materialise(top_k(codes.distinct(), ["code"], [F.col("id").asc()], k, "place"), "code-members")
    index = members.where("place = 1").select("code", F.col("id").alias("first"))
    n, cores = index.count(), spark.sparkContext.defaultParallelism
    shards = max(1, -(-n // SHARD_MOST), min(cores, n // SHARD_LEAST))
    index = index.repartition(shards, "code")
    asked = materialise(queries.select(F.col("id").alias("query_id"), "code").distinct(), "queries")
    distinct = asked.select(F.col("code").alias("query_code")).distinct()
    blocks = max(1, -(-asked.select("code").distinct().count() // QUERY_BLOCK))
    distinct = materialise(distinct.withColumn("block", F.pmod(F.xxhash64("query_code"), F.lit(blocks))), "query-codes")
    id_type = index.select("first").limit(0).toArrow().schema.field("first").type
    schema = f"query_code binary, code binary, first {kind}, distance int"
    passes = []
    for block in range(blocks):
        wanted = distinct.where(F.col("block") == block).select("query_code").toArrow()["query_code"].to_pylist()
        passes.append(index.mapInArrow(_search(spark.sparkContext.broadcast(wanted), k, bits, id_type), schema))
    hits = reduce(DataFrame.unionAll, passes)
    close = top_k(hits, ["query_code"], [F.col("distance").asc(), F.col("first").asc()], k, "code_rank")
    rows = close.select("query_code", "code", "distance").join(members.select("code", "id"), "code")
    rows = top_k(rows, ["query_code"], [F.col("distance").asc(), F.col("id").asc()], k, "rank")
    answered = rows.join(asked, F.col("query_code") == asked["code"])
    return answered.select("query_id", "id", "distance", F.col("rank").cast("int").alias("rank"))
