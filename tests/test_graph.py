from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recollect.functions import vectors as exact
from recollect.operators import graph, search, vector
from recollect.session import ship_package

CORPUS = "content_id long, embedding array<float>"
QUERIES = "query_id long, qvec array<double>"


def vectors(n, width=24, seed=3):
    return np.random.default_rng(seed).standard_normal((n, width))


def corpus(spark, stored, extra=()):
    ship_package(spark)
    data = [(i, [float(x) for x in v]) for i, v in enumerate(stored)] + list(extra)
    return spark.createDataFrame(data, CORPUS).repartition(3)


def asked(spark, wanted):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(wanted)], QUERIES)


def test_finds_the_exact_neighbours_with_fewer_distances(spark):
    stored = vectors(3000)
    frame, queries = corpus(spark, stored), asked(spark, vectors(40, seed=4))
    index = graph.build_graph(frame, shard_rows=1500).cache()
    assert index.count() == 2
    found = graph.graph_topk(index, queries, k=10).cache()
    recall = graph.recall_per_query(found, search.vector_topk_batch(frame, queries, 10))
    assert recall.agg(F.avg("recall")).first()[0] >= 0.97 and recall.count() == 40
    assert found.agg(F.max("computed")).first()[0] < 3000 * 0.8
    exact = {(r[0], r[1]): r[2] for r in search.vector_topk_batch(frame, queries, 10).collect()}
    for r in found.collect():
        if (r["query_id"], r["content_id"]) in exact:
            assert abs(exact[r["query_id"], r["content_id"]] - r["distance"]) < 1e-6


def test_a_longer_beam_finds_more(spark):
    stored = vectors(1200, 32)
    frame, queries = corpus(spark, stored), asked(spark, vectors(30, 32, seed=9))
    index = graph.build_graph(frame, shard_rows=2000, degree=8).cache()
    exact = search.vector_topk_batch(frame, queries, 10).cache()
    shares = [
        graph.recall_per_query(graph.graph_topk(index, queries, 10, beam), exact).agg(F.avg("recall")).first()[0]
        for beam in (10, 300)
    ]
    assert shares[0] < shares[1] and shares[1] >= 0.95


def test_small_and_odd_corpora(spark):
    extra = [(100, None), (101, [0.0] * 24), (102, [1.0] * 24), (103, [2.0] * 24)]
    frame = corpus(spark, vectors(5), extra)
    queries = spark.createDataFrame([(1, [1.0] * 24), (2, None), (3, [0.0] * 24)], QUERIES)
    found = graph.graph_topk(graph.build_graph(frame), queries, k=20)
    assert {r["query_id"] for r in found.collect()} == {1}
    assert [r["content_id"] for r in found.orderBy("rank").collect()][:2] == [102, 103]
    assert found.count() == 7
    empty = graph.build_graph(corpus(spark, vectors(0)))
    assert graph.graph_topk(empty, queries).count() == 0


def test_widths_must_agree(spark):
    index = graph.build_graph(corpus(spark, vectors(5)))
    with pytest.raises(Exception, match="width"):
        graph.graph_topk(index, asked(spark, vectors(1, 3))).collect()


def test_the_answer_does_not_depend_on_the_block():
    stored, wanted = vectors(300), vectors(9, seed=8)
    own = stored / np.linalg.norm(stored, axis=1, keepdims=True)
    unit = wanted / np.linalg.norm(wanted, axis=1, keepdims=True)
    links = graph.neighbour_lists(own, 12)
    entry = np.array([0, 7], dtype=np.int32)
    together = graph.walk(own, links, entry, unit, 5, 30)
    for i in range(len(unit)):
        alone = graph.walk(own, links, entry, unit[i : i + 1], 5, 30)
        assert all((a[i] == b[0]).all() for a, b in zip(together, alone, strict=True))


def test_every_vector_has_links_to_it():
    stored = vectors(3000, 64, seed=5)
    own = stored / np.linalg.norm(stored, axis=1, keepdims=True)
    links = graph.neighbour_lists(own)
    assert (links < len(own)).all() and not any(i in row for i, row in enumerate(links))
    assert np.bincount(links[links >= 0], minlength=len(own)).min() >= graph.LEAST_INTO


def test_each_query_finds_its_neighbours_in_a_large_shard(spark):
    stored = vectors(6000, 64, seed=6)
    frame, queries = corpus(spark, stored), asked(spark, vectors(150, 64, seed=7))
    found = graph.graph_topk(graph.build_graph(frame).cache(), queries).cache()
    recall = graph.recall_per_query(found, search.vector_topk_batch(frame, queries))
    assert recall.where("recall < 0.95").count() == 0 and recall.count() == 150
    assert found.agg(F.max("computed")).first()[0] < 6000 * 0.8


def test_a_search_walks_every_graph_once(spark):
    index = graph.build_graph(corpus(spark, vectors(50))).cache()
    found = graph.graph_topk(index, asked(spark, vectors(5, seed=4)), k=3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert {r["computed"] for r in found.collect()} == {50} and found.count() == 15


def test_queries_in_parts_get_the_same_answers(spark, monkeypatch):
    frame, queries = corpus(spark, vectors(300)), asked(spark, vectors(23, seed=4))
    index = graph.build_graph(frame, shard_rows=150).cache()
    whole = [f.collect() for f in (graph.graph_topk(index, queries, 5), search.vector_topk_batch(frame, queries, 5))]
    monkeypatch.setattr(graph, "WALKED_AT_ONCE", 10)
    monkeypatch.setattr(vector, "SCANNED_AT_ONCE", 2)
    found = graph.graph_topk(index, queries, 5), search.vector_topk_batch(frame, queries, 5)
    counts = [f._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") for f in found]
    assert counts == [3, 12] and [sorted(f.collect()) for f in found] == [sorted(rows) for rows in whole]
    assert len(vector.parts_of(exact.Queries(pa.array(range(100)), vectors(100)), 2)) == vector.MOST_PARTS
    assert [len(p.ids) for p in vector.parts_of(exact.Queries(pa.array([], pa.int64()), vectors(0)), 2)] == [0]


def test_the_nearest_of_a_large_shard_pass_by_the_others():
    own = exact.unit(vectors(3000, 16)).astype(np.float32)
    own[100:180] = own[7]
    full = own @ own.T
    for low in (0, 2990):
        best = graph._nearest(own, low, low + 256, 96)
        assert best.shape == (min(256, 3000 - low), 96)
        for row, places in enumerate(best):
            least = np.sort(full[low + row])[-96]
            assert len(set(places)) == 96 and full[low + row][places].min() >= least - 1e-6


def test_a_hub_is_pruned_like_any_other_vector():
    own = exact.unit(vectors(400, 16)).astype(np.float32)
    found = np.sort(np.random.default_rng(2).integers(-1, 400, (6, 120)), axis=1)
    rows = np.arange(6)
    kept = graph._pruned(rows, found, own, 12)
    for row in rows:
        alone = graph._pruned_hub(row, np.unique(found[row]), own, 12)
        assert list(kept[row][kept[row] >= 0]) == list(alone) and row not in alone
    wide = np.sort(np.concatenate([found] * 6, axis=1), axis=1)
    assert (graph._pruned(rows, wide, own, 12) == kept).all()


def test_a_graph_of_equal_vectors_is_linked_and_walked():
    own = exact.unit(np.concatenate([np.ones((900, 8)), vectors(300, 8)]))
    links = graph.neighbour_lists(own, 8)
    places, distance, computed = graph.walk(own, links, np.array([0, 950]), own[:1], 5, 20)
    assert (distance < 1e-6).all() and len(set(places[0])) == 5 and computed[0] < 1200


def _exact_answers(stored, ids, wanted, k, tenants=None, asked_by=None):
    away = np.round(1.0 - exact.unit(wanted) @ exact.unit(stored).T, 10)
    away[np.isnan(away)] = np.inf
    for q in range(len(wanted)):
        seen = [j for j in range(len(ids)) if tenants is None or tenants[j] == asked_by[q]]
        yield [ids[j] for j in sorted(seen, key=lambda j: (away[q, j], ids[j]))[:k]]


@pytest.mark.parametrize("case", ["plain", "equal and zero vectors", "tenants"])
def test_exact_answers_do_not_need_every_exact_distance(monkeypatch, case):
    rng, n, k = np.random.default_rng(5), 6000, 10
    stored, wanted = vectors(n, 16).astype(np.float32).astype(float), vectors(140, 16, seed=8)
    ids = [str(i) for i in rng.permutation(n)]
    tenants = asked_by = None
    if case == "equal and zero vectors":
        stored[rng.integers(0, n, 2500)] = stored[7]
        stored[rng.integers(0, n, 40)] = 0
        wanted[3], wanted[5] = 0, stored[7]
    if case == "tenants":
        tenants = np.array([f"t{i}" for i in rng.integers(0, 3, n)])
        tenants[11] = "rare"
        asked_by = np.array(["rare", *[f"t{i % 4}" for i in range(139)]], dtype=object)
    pairs = []
    plain = exact._Best._exact
    monkeypatch.setattr(exact._Best, "_exact", lambda self, q, p, s: pairs.append(len(q)) or plain(self, q, p, s))

    def batches():
        for low in range(0, n, 1700):
            columns = {
                "id": pa.array(ids[low : low + 1700]),
                "vector": pa.array([list(v) for v in stored[low : low + 1700]], pa.list_(pa.float32())),
            }
            if tenants is not None:
                columns["tenant"] = pa.array(tenants[low : low + 1700].tolist())
            yield pa.RecordBatch.from_pydict(columns)

    found = {}
    for batch in exact.nearest_in(batches(), exact.Queries(pa.array(range(140)), wanted, asked_by), k):
        for row in batch.to_pylist():
            away = np.inf if row["distance"] is None else round(row["distance"], 10)
            found.setdefault(row["query_id"], []).append((away, row["id"]))
    answers = [[i for _, i in sorted(found.get(q, []))] for q in range(140)]
    assert answers == list(_exact_answers(stored, ids, wanted, k, tenants, asked_by))
    if case == "plain":
        assert sum(pairs) < 0.1 * 140 * n
