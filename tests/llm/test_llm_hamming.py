from __future__ import annotations

import random

import numpy as np
import pytest

from recollect.llm import hamming
from recollect.sources.tables import read_table


def brute(codes, queries, k):
    out = {}
    for q, code in queries:
        near = sorted((bin(int.from_bytes(code, "little") ^ int.from_bytes(c, "little")).count("1"), i) for i, c in codes)
        out[q] = [(i, d) for d, i in near[:k]]
    return out


def random_codes(rng, n, bits, spread):
    centres = [rng.getrandbits(bits) for _ in range(5)]
    width = -(-bits // 64) * 8
    out = []
    for i in range(n):
        code = rng.choice(centres)
        for _ in range(rng.randint(0, spread)):
            code ^= 1 << rng.randrange(bits)
        out.append((i, code.to_bytes(width, "little")))
    return out


@pytest.mark.parametrize(("bits", "n", "spread", "k"), [(64, 700, 12, 10), (64, 30, 40, 7), (40, 300, 6, 50), (150, 400, 30, 5), (5, 60, 5, 4)])
def test_every_query_gets_the_nearest(spark, bits, n, spread, k):
    rng = random.Random(bits + n)
    rows = random_codes(rng, n, bits, spread)
    codes = spark.createDataFrame(rows, "id long, code binary").repartition(3)
    queries = codes.where("id % 10 = 0")
    got = {}
    for r in sorted(hamming.nearest(codes, queries, bits, k).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["id"], r["distance"]))
    assert got == brute(rows, [r for r in rows if r[0] % 10 == 0], k)


def test_index_agrees_with_a_scan_for_any_segments():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    codes = np.unique(base[rng.integers(0, 40, 3000)] ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)))
    index = hamming.MultiIndex(codes[:, None], 64)
    assert len(index.spans) > 3
    queries = codes[::37][:, None] ^ np.uint64(0b1011)
    query, code, distance = index.search(queries, 6, np.arange(len(codes)))
    for q in range(len(queries)):
        all_distances = np.bitwise_count(codes ^ queries[q, 0])
        order = np.lexsort((np.arange(len(codes)), all_distances))[:6]
        assert code[query == q].tolist() == order.tolist()
        assert distance[query == q].tolist() == all_distances[order].tolist()


def test_many_equal_codes_blocks_and_edges(spark, monkeypatch):
    monkeypatch.setattr(hamming, "QUERY_BLOCK", 2)
    schema = "vec_id long, embedding array<float>, code string, id string"
    rows = [(i, [1.0, -1.0, 0.5], "", "") for i in range(300)] + [
        (300, [1.0, 1.0, 0.5], "", ""), (301, None, "", ""), (None, [1.0], "", ""), (302, [], "", ""),
        (303, [None, 2.0], "", ""), (304, [float("nan"), 3.0, 1.0, 9.0, 9.0], "", ""), (300, [1.0, 1.0, 0.5], "", ""),
    ]
    codes = hamming.sign_codes(spark.createDataFrame(rows, schema), "vec_id", "embedding", 3)
    plain = sorted({(r["id"], bytes(r["code"])) for r in codes.collect()})
    assert [i for i, _ in plain] == [*range(301), 302, 303, 304]
    got = {}
    queries = codes.where("id % 50 = 0 OR id > 300")
    for r in sorted(hamming.nearest(codes, queries, 3, 4).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["id"], r["distance"]))
    assert got == brute(plain, [p for p in plain if p[0] % 50 == 0 or p[0] > 300], 4)


def test_empty_table(spark):
    codes = spark.createDataFrame([], "id long, code binary")
    assert hamming.nearest(codes, codes, 64, 3).collect() == []


def test_probing_carries_nearly_all_queries_of_a_whole_table(spark):
    vectors = read_table(spark, "embeddings", "/root/testdata/sf0.1")
    rows = hamming.sign_codes(vectors, "vec_id", "embedding", 64).collect()
    codes = np.unique(hamming._words([bytes(r["code"]) for r in rows]), axis=0)
    index = hamming.MultiIndex(codes, 64)
    queries = hamming._words([bytes(r["code"]) for r in rows if r["id"] % 50 == 0])
    index.search(queries, 10, np.arange(len(codes)))
    assert len(codes) > 1300 and index.scanned <= 0.1 * len(queries)
