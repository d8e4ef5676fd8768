from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from recollect.functions import text as txt
from recollect.functions.english import stem
from recollect.operators import keyword, quality, search
from recollect.operators import vector as vectors

CORPUS = (
    "content_id bigint, brand string, doc_type string, chunk_text string, embedding array<float>"
)
random.seed(11)
VOCABULARY = ["store", "dose", "liver", "claim", "cold", "the", "of", "ünder", "x1"]


def make_corpus(n=60, width=4):
    out = []
    for i in range(n):
        words = random.choices(VOCABULARY, k=random.randint(0, 12))
        vector = [float(random.randint(-2, 2)) for _ in range(width)]
        out.append(
            (
                i, random.choice("AB"), "faq", random.choice([" ", ", ", "\n- "]).join(words).title(),
                vector if i % 5 else None,
            )
        )
    out.append((n, "A", "faq", None, [1.0] * width))
    out.append((n + 1, "A", "faq", "dose liver", [0.0] * width))
    return out


DATA = make_corpus()


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(DATA, CORPUS).cache()


@pytest.fixture(scope="module")
def index(corpus, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("index"))
    return search.write_index(search.index_postings(corpus, ["brand"]), root, 1)


def words_of(text):
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def cosine_ranking(vector, tenant=None, k=20):
    found = []
    for i, brand, _, _, stored in DATA:
        if stored is None or (tenant and brand != tenant):
            continue
        norm = np.linalg.norm(stored) * np.linalg.norm(vector)
        found.append((round(1 - float(np.dot(stored, vector)) / norm, 12) if norm else math.inf, i))
    return [i for _, i in sorted(found)][:k]


def bm25_ranking(needed, tenant=None, k=20):
    texts = {i: words_of(t) for i, b, _, t, _ in DATA if t is not None and (not tenant or b == tenant)}
    lengths = {i: sum(w not in txt.STOP_WORDS for w in ws) for i, ws in texts.items()}
    mean = sum(lengths.values()) / len(lengths)
    scores = {}
    for i, ws in texts.items():
        if not all(t in ws for t in needed):
            continue
        scores[i] = 0.0
        for t in sorted(needed):
            df = sum(t in other for other in texts.values())
            tf = ws.count(t)
            weight = math.log(1 + (len(texts) - df + 0.5) / (df + 0.5))
            scores[i] += weight * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * lengths[i] / mean))
    return sorted(scores.items(), key=lambda s: (-round(s[1], 9), s[0]))[:k]


def ids(df, order="rank"):
    return [r["content_id"] for r in df.orderBy(order).collect()]


@pytest.mark.parametrize("tenant", [None, "A"])
@pytest.mark.parametrize("k", [3, 20, 100])
def test_vector_topk_equals_brute_force(corpus, tenant, k):
    where = F.col("brand") == tenant if tenant else None
    vector = [1.0, 0.5, -1.0, 2.0]
    assert ids(search.vector_topk(corpus, vector, k, where)) == cosine_ranking(vector, tenant, k)


def test_vector_topk_never_sorts_or_gathers_the_corpus(corpus):
    plan = search.vector_topk(corpus, [1.0] * 4, 5)._jdf.queryExecution().executedPlan().toString()
    before_cut = plan[plan.index("TakeOrderedAndProject"):]
    assert "MapInArrow" in before_cut and "Exchange SinglePartition" not in before_cut


def test_a_wrong_width_is_an_error(corpus):
    with pytest.raises(Exception, match="width of 3"):
        search.vector_topk(corpus, [1.0, 2.0, 3.0], 5).collect()


QUERIES = [
    (1, "dose liver", [1.0, 0.0, 0.0, 0.0], "A"), (2, "store", [0.0, 1.0, 1.0, 0.0], "B"),
    (3, "the of", [1.0, 1.0, 1.0, 1.0], "A"), (4, "dose -liver", None, "B"),
    (5, "cold or x1 claim", [-1.0, 0.0, 2.0, 0.0], "A"), (6, "-dose", [0.0, 0.0, 0.0, 0.0], "A"),
    (7, "ünder", [2.0, 1.0, 0.0, 1.0], "C"), (8, '"dose liver"', [1.0, 2.0, 1.0, 1.0], "B"),
]


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(
        QUERIES, "query_id bigint, q string, qvec array<float>, brand string"
    )


def by_query(df, value="content_id", order="rank"):
    out = {}
    for r in df.orderBy("query_id", order).collect():
        out.setdefault(r["query_id"], []).append(r[value])
    return out


@pytest.fixture(params=["one block", "three queries a block", "one query a block"])
def size_of_batch(request, monkeypatch):
    """The queries in one block and in several."""
    if request.param != "one block":
        monkeypatch.setattr(vectors, "BLOCK_VALUES", 12 if "three" in request.param else 1)


@pytest.mark.parametrize("tenant", [None, "brand"])
def test_batch_vectors_equal_brute_force(corpus, queries, tenant, size_of_batch):
    found = by_query(search.vector_topk_batch(corpus, queries, 7, tenant=tenant))
    expected = {
        q: cosine_ranking(v, b if tenant else None, 7) for q, _, v, b in QUERIES if v and any(v)
    }
    zero = cosine_ranking([0.0] * 4, "A" if tenant else None, 7)
    expected[6] = zero
    assert found == {q: r for q, r in expected.items() if r}


def test_batch_vectors_leave_the_corpus_where_it_lies(corpus, queries):
    found = search.vector_topk_batch(corpus, queries, 7)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan and "Generate" not in plan


def test_no_queries_give_no_rows(corpus, queries):
    assert search.vector_topk_batch(corpus, queries.where("query_id < 0"), 7).count() == 0


@pytest.mark.parametrize("tenant", [None, "A"])
@pytest.mark.parametrize("query", ["dose liver", "store", "ünder x1", "nothing", "the of", ""])
def test_keyword_topk_equals_brute_force(corpus, index, query, tenant):
    where = F.col("brand") == tenant if tenant else None
    needed = [w for w in words_of(query) if w not in txt.STOP_WORDS]
    expected = bm25_ranking(needed, tenant) if needed else []
    for found in (
        search.keyword_topk(corpus, query, where=where),
        search.postings_topk(index, query, where=where),
    ):
        found = found.orderBy("rank").collect()
        assert [r["content_id"] for r in found] == [i for i, _ in expected]
        assert [r["score"] for r in found] == pytest.approx([s for _, s in expected])


@pytest.mark.parametrize("bound", [0, 1024])
@pytest.mark.parametrize("tenant", [None, "brand"])
@pytest.mark.parametrize("source", ["texts", "postings"])
def test_batch_keywords_equal_single_searches(corpus, index, queries, tenant, bound, source, monkeypatch):
    monkeypatch.setattr(keyword, "SHIPPED_QUERIES", bound)
    monkeypatch.setattr(keyword, "SHIPPED_PAIRS", bound)
    if source == "texts":
        found = search.keyword_topk_batch(corpus, queries, 6, tenant=tenant)
    else:
        found = search.postings_topk_batch(index, queries, 6, tenant=tenant)
    batch = by_query(found), by_query(found, "score")
    for query_id, q, _, brand in QUERIES:
        ids_, scores = single_search(corpus, q, brand if tenant else None)
        assert ids_ == batch[0].get(query_id, []), q
        assert scores == pytest.approx(batch[1].get(query_id, [])), q


SINGLE = {}


def single_search(corpus, query, tenant):
    """Ids and scores of one search, remembered over the tests of this module."""
    if (query, tenant) not in SINGLE:
        where = F.col("brand") == tenant if tenant else None
        found = search.keyword_topk(corpus, query, 6, where).orderBy("rank").collect()
        SINGLE[query, tenant] = [r["content_id"] for r in found], [r["score"] for r in found]
    return SINGLE[query, tenant]


@pytest.mark.parametrize(
    ("query", "matches"),
    [
        ("dose", ["a dose", "dose of liver", "dose liver", "Liver, DOSE!"]),
        ("dose -liver", ["a dose"]),
        ('"dose liver"', ["dose liver"]),
        ('"dose of liver"', ["dose of liver"]),
        ('"liver dose"', ["Liver, DOSE!"]),
        ('dose -"dose liver"', ["a dose", "dose of liver", "Liver, DOSE!"]),
        ("cold or claim", ["cold", "claim it"]),
        ("-dose -cold", ["claim it", "doses"]),
        ("the", []),
        ("dos", []),
        ('"', []),
    ],
)
def test_web_query_syntax(spark, query, matches):
    texts = ["a dose", "dose of liver", "dose liver", "Liver, DOSE!", "cold", "claim it", "doses"]
    corpus = spark.createDataFrame(
        [(i, t) for i, t in enumerate(texts)], "content_id int, chunk_text string"
    )
    found = {r["content_id"] for r in search.keyword_match(corpus, query).collect()}
    assert found == {texts.index(m) for m in matches}
    indexed = search.index_words(corpus)
    assert {r["content_id"] for r in search.keyword_match(indexed, query).collect()} == found
    postings = search.postings_topk(search.index_postings(corpus), query)
    assert {r["content_id"] for r in postings.collect()} == found


def ranks(spark, pairs):
    return spark.createDataFrame(pairs, "content_id bigint, rank int")


def test_reciprocal_rank_fusion(spark):
    fused = search.fuse(ranks(spark, [(1, 1), (3, 2)]), ranks(spark, [(2, 1), (3, 2)]))
    scores = {r["content_id"]: r["rrf"] for r in fused.collect()}
    assert scores == {1: 1 / 61, 2: 1 / 61, 3: 2 / 62}
    shuffled = search.fuse(ranks(spark, [(3, 2), (1, 1)]), ranks(spark, [(3, 2), (2, 1)]))
    assert rows(shuffled) == rows(fused)


def expected_hybrid(q, vector, tenant, k):
    scores = {}
    for rank, i in enumerate(cosine_ranking(vector, tenant), 1):
        scores[i] = scores.get(i, 0) + 1 / (60 + rank)
    needed = [w for w in words_of(q) if w not in txt.STOP_WORDS]
    for rank, (i, _) in enumerate(bm25_ranking(needed, tenant) if needed else [], 1):
        scores[i] = scores.get(i, 0) + 1 / (60 + rank)
    return [i for i, _ in sorted(scores.items(), key=lambda s: (-s[1], s[0]))][:k]


@pytest.mark.parametrize("tenant", [None, "A"])
@pytest.mark.parametrize("query", ["dose liver", "nothing"])
def test_hybrid_equals_brute_force(corpus, query, tenant):
    where = F.col("brand") == tenant if tenant else None
    vector = [1.0, 0.5, -1.0, 2.0]
    found = search.hybrid(corpus, query, vector, k=8, where=where).collect()
    assert [r["content_id"] for r in found] == expected_hybrid(query, vector, tenant, 8)
    more = search.hybrid(corpus, query, vector, k=12, where=where).collect()
    assert [r["content_id"] for r in more][:8] == [r["content_id"] for r in found]


def test_rows_without_a_vector_come_through_the_keyword_leg_only(spark):
    corpus = spark.createDataFrame(
        [(1, "A", "faq", "dose", None), (2, "A", "faq", "cold", [1.0, 0.0]), (3, "B", "faq", "dose", [1.0, 0.0])],
        CORPUS,
    )
    found = search.hybrid(corpus, "dose", [1.0, 0.0], where=F.col("brand") == "A").collect()
    assert [(r["content_id"], r["vector_rank"], r["keyword_rank"]) for r in found] == [
        (1, None, 1), (2, 1, None)
    ]


@pytest.mark.parametrize("tenant", [None, "brand"])
def test_batch_hybrid_equals_single_searches(corpus, queries, tenant):
    batch = by_query(search.hybrid_batch(corpus, queries, 6, tenant=tenant), order="rn")
    for query_id, q, vector, brand in QUERIES:
        if not vector or not any(vector):
            continue
        where = F.col("brand") == brand if tenant else None
        single = search.hybrid(corpus, q, vector, 6, where=where).collect()
        assert [r["content_id"] for r in single] == batch.get(query_id, []), q


def test_approximate_search_finds_all_when_all_cells_are_probed(corpus):
    model = search.fit_cells(corpus.where("embedding IS NOT NULL"), cells=4)
    celled = search.assign_cells(corpus.where("embedding IS NOT NULL"), model)
    vector = [1.0, 0.5, -1.0, 2.0]
    exact = search.vector_topk(corpus, vector, 10)
    everything = search.ann_topk(celled, model, vector, 10, probes=len(model.clusterCenters()))
    assert ids(everything) == ids(exact)
    sampled = search.fit_cells(corpus.where("embedding IS NOT NULL"), cells=4, fraction=0.5)
    assert search.assign_cells(corpus, sampled).count() == celled.count()
    some = search.ann_topk(celled, model, vector, 10, probes=1)
    assert 0 < search.recall_at_k(some, exact).first()["recall"] <= 1


def test_approximate_search_reads_only_the_probed_cells(spark, corpus, tmp_path):
    stored = corpus.where("embedding IS NOT NULL")
    model = search.fit_cells(stored, cells=4)
    search.assign_cells(stored, model).write.partitionBy("cell").parquet(str(tmp_path / "cells"))
    celled = spark.read.parquet(str(tmp_path / "cells"))
    found = search.ann_topk(celled, model, [1.0, 0.5, -1.0, 2.0], 10, probes=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    [filters] = [line.split("PartitionFilters: ")[1] for line in plan.splitlines() if "PartitionFilters" in line]
    assert "cell#" in filters.split("]")[0]


def test_embedding_in_place_and_width_check(spark, corpus):
    def model(texts):
        return [[float(len(t)), 1.0] for t in texts]

    done = search.embed_corpus(corpus.drop("embedding"), 2, model)
    assert done.count() == corpus.count()
    assert done.where("content_id = 61").first()["embedding"] == [10.0, 1.0]
    assert done.where("chunk_text IS NULL").first()["embedding"] is None
    quality.raise_if_failed(quality.run_checks([quality.vector_width(done, "embedding", 2)]))
    hashed = search.embed_corpus(corpus.drop("embedding"), 16)
    norms = hashed.select(
        F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x).alias("n"), F.size("embedding").alias("w")
    ).collect()
    assert {r["w"] for r in norms} == {16}
    assert all(r["n"] == pytest.approx(1, abs=1e-5) or r["n"] == 0 for r in norms)


STEMS = """
consignment consign consistency consist consolatory consolatori consolidating consolid
conspicuously conspicu conspirators conspir constables constabl knackeries knackeri knavish knavish
kneaded knead knocker knocker communication communic generally general hopping hop hoping hope
falling fall luxuriate luxuri ties tie cries cri by by relational relat valency valenc
digitizer digit hopefulness hope sensitivity sensit happy happi dying die sky sky inning inning
""".split()


def test_stems_are_the_published_ones():
    assert [stem(w) for w in STEMS[::2]] == STEMS[1::2]


def test_stemmed_search_matches_inflected_forms(spark):
    texts = ["the dose is stored cold", "storing doses", "a store", "storage", None, ""]
    corpus = spark.createDataFrame(
        [(i, "A", t) for i, t in enumerate(texts)], "content_id int, brand string, chunk_text string"
    )
    indexed = search.index_words(corpus, stem=stem)
    for rows_ in (corpus, indexed):
        found = search.keyword_match(rows_, "stores", stem=stem).collect()
        assert {r["content_id"] for r in found} == {0, 1, 2}
        phrase = search.keyword_match(rows_, '"dose is storing" or "store dose"', stem=stem).collect()
        assert {r["content_id"] for r in phrase} == {0, 1}
    single = search.keyword_topk(indexed, "dose store", stem=stem).orderBy("rank").collect()
    asked = spark.createDataFrame([(1, "dose store")], "query_id int, q string")
    for rows_ in (corpus, indexed):
        batch = search.keyword_topk_batch(rows_, asked, stem=stem).orderBy("rank").collect()
        assert [(r["content_id"], r["score"]) for r in batch] == [
            (r["content_id"], r["score"]) for r in single
        ]
    postings = search.index_postings(corpus, stem=stem)
    found = search.postings_topk(postings, "dose store", stem=stem).orderBy("rank").collect()
    assert found == single


def test_stemmed_topk_of_texts_stems_once_and_equals_that_of_word_lists(spark, monkeypatch):
    texts = ["the doses are stored cold", "storing dose, doses", "a store", "dosing cold stores", None, ""]
    corpus = spark.createDataFrame(
        [(i, "A", t) for i, t in enumerate(texts)], "content_id int, brand string, chunk_text string"
    )
    indexed = search.index_words(corpus, stem=stem)
    for asked in ("dose store", '"dose stored" or colds', "store -cold", "-dose", "", '"dose is storing"', "none"):
        found = search.keyword_topk(corpus, asked, stem=stem)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "ArrowEvalPython" not in plan
        assert found.orderBy("rank").collect() == search.keyword_topk(indexed, asked, stem=stem).orderBy("rank").collect()
    found = search.keyword_topk(corpus, "dose", where=F.col("content_id") > 0, stem=stem)
    assert {r["content_id"] for r in found.collect()} == {1, 3}


def test_a_model_gets_long_texts_in_bounded_calls(spark, monkeypatch):
    from recollect.functions import hooks

    monkeypatch.setattr(hooks, "EMBEDDED_BYTES", 10)

    def model(texts):
        assert len(texts) == 1 or sum(map(len, texts)) <= 10
        return [[len(t), len(texts)] for t in texts]

    texts = ["aaaa", None, "bbbbbb", "c" * 30, "", "dd"]
    corpus = spark.createDataFrame(list(enumerate(texts)), "content_id int, chunk_text string").coalesce(1)
    done = search.embed_corpus(corpus, 2, model).orderBy("content_id").collect()
    assert [r["embedding"] for r in done] == [[4, 2], None, [6, 2], [30, 1], [0, 2], [2, 2]]


def test_stems_are_placed_in_bounded_parts(monkeypatch):
    import pyarrow as pa

    words = pa.array([["doses", "the", "dose"], [], None, ["cold"] * 3 + ["dosing"], ["stores"]])
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), words], names=["id", "words"])
    expected = [(0, {"dose": [0, 2]}), (1, {}), (2, {}), (3, {"dose": [3]}), (4, {"store": [0]})]
    for size in (1, 3, 100):
        monkeypatch.setattr(txt, "GROUPED_WORDS", size)
        for rows_, want in ((batch, expected), (batch.slice(2), expected[2:])):
            parts = list(txt.placed_stems(iter([rows_]), stem, frozenset(["dose", "store"])))
            found = [(r["id"], dict(r["placed"])) for p in parts for r in p.to_pylist()]
            assert found == want and (len(parts) > 1) == (size < 100)


def test_a_stem_that_looks_like_a_stop_word_is_no_stop_word(spark):
    corpus = spark.createDataFrame(
        [(1, "it can wait"), (2, "two cans")], "content_id int, chunk_text string"
    )
    assert stem("cans") == "can"
    found = search.keyword_match(corpus, "cans", stem=stem).collect()
    assert [r["content_id"] for r in found] == [2]
    found = search.postings_topk(search.index_postings(corpus, stem=stem), "cans", stem=stem)
    assert [r["content_id"] for r in found.collect()] == [2]


def test_the_index_is_built_in_one_shuffle_and_read_by_word(corpus, index):
    plan = search.index_postings(corpus).postings._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning(term" in plan
    plan = search.postings_topk(index, "dose liver")._jdf.queryExecution().executedPlan().toString()
    assert "Or(EqualTo(term,dose),EqualTo(term,liver))" in plan
    placed = index.postings.where("term = 'dose'").collect()
    texts = {i: words_of(t) for i, _, _, t, _ in DATA if t}
    assert {r["content_id"]: r["positions"] for r in placed} == {
        i: [p for p, w in enumerate(ws) if w == "dose"] for i, ws in texts.items() if "dose" in ws
    }


def test_the_texts_are_not_split_again_for_the_ranges_of_an_index(corpus):
    plan = search.index_postings(corpus).postings._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "rangepartitioning(term" in plan


def test_postings_are_grouped_in_bounded_pieces(corpus, index, monkeypatch):
    from itertools import chain

    import pyarrow as pa

    words = pa.array([["b", "a", "b"], [], ["x"], ["a"] * 9, ["the", "", "a"]])
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), words], names=["id", "words"])
    expected = [("a", 0, [1]), ("b", 0, [0, 2]), ("x", 2, [0]), ("a", 3, list(range(9))), ("a", 4, [2])]
    for size in (1, 2, 4, 100):
        monkeypatch.setattr(txt, "GROUPED_WORDS", size)
        pieces = list(txt.postings_in(iter([batch, batch.slice(5)]), frozenset(["", "the"])))
        found = chain.from_iterable(p.to_pylist() for p in pieces)
        assert sorted((r["id"], r["term"], r["positions"]) for r in found) == sorted(
            (i, t, p) for t, i, p in expected
        )


def test_hybrid_with_an_index_equals_hybrid_without(corpus, index, queries):
    vector = [1.0, 0.5, -1.0, 2.0]
    where = F.col("brand") == "A"
    plain = search.hybrid(corpus, "dose or cold", vector, 8, where=where).collect()
    assert search.hybrid(corpus, "dose or cold", vector, 8, where=where, index=index).collect() == plain
    plain = rows(search.hybrid_batch(corpus, queries, 6, tenant="brand"))
    assert rows(search.hybrid_batch(corpus, queries, 6, tenant="brand", index=index)) == plain


def test_the_texts_of_the_result_are_fetched_by_their_ids(spark, corpus, tmp_path):
    corpus.write.parquet(str(tmp_path / "corpus"))
    stored = spark.read.parquet(str(tmp_path / "corpus"))
    found = search.hybrid(stored, "dose liver", [1.0, 0.5, -1.0, 2.0], k=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(content_id" in plan
    assert plan.count("FileScan") == 1
