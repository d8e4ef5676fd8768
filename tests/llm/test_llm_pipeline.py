"""The stages of the corpus pipeline on a small fixture, against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from recollect.llm import mixing, quality
from recollect.llm.queries import ratings, vocabulary_path
from recollect.session import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, _digest string, mix_total string"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def fixture():
    rng = random.Random(12)
    good = [f"good{i}" for i in range(60)]
    rows, labels = [], []

    def add(i, text, source="a"):
        rows.append((i, text, "en", source, None if text is None else len(text), i is None, "x", "y"))

    for i in range(240):
        junk = i % 4 == 0
        text = " ".join(rng.choice(["$$$", "@@", "##!!"] if junk else good) for _ in range(rng.randint(8, 60)))
        add(i, text, rng.choice("aaab"))
        labels.append((i, 0 if junk else 1, 0))
    base = rows[1][1]
    for i in range(300, 306):
        add(i, base.replace(" ", "  ") if i % 2 else base, "b")  # equal but for white space
    long = " ".join(rng.choice(good) for _ in range(400))
    add(400, long, "c")
    add(401, long + " " + good[0], None)
    add(402, None, None)
    add(403, "", "a")
    add(None, "good1 good2 nobody knows", "c")
    add(1, base, "a")
    add(1, base, "a")
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    ship_package(spark)
    root = tmp_path_factory.mktemp("corpus")
    rows, labels = fixture()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def plain_exact(rows):
    best = {}
    for r in rows:
        key = re.sub("[\x20\x09-\x0d]", "", r[1] or "")
        order = (-len(r[1] or ""), r[0] is None, r[0] or 0)
        if key not in best or order < best[key][0]:
            best[key] = (order, r)
    return [r for _, r in best.values()]


def plain_near(rows):
    sets = []
    for r in rows:
        found = words(r[1])
        sets.append({tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and rows[i][0] is not None and rows[j][0] is not None and 100 * both >= 75 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    smallest = {}
    for g, r in zip(group, rows, strict=True):
        smallest[g] = min(smallest.get(g, r[0]), r[0]) if r[0] is not None else None
    return [r for g, r in zip(group, rows, strict=True) if r[0] == smallest[g]]


def test_run_equals_the_stages_in_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scored = quality.score(docs, ratings(spark, folder)).select("doc_id", "tail_probability").collect()
    accepted = {r["doc_id"] for r in scored if r["tail_probability"] >= 0.5}
    kept = [tuple(r) for r in docs.collect() if r["doc_id"] in accepted]
    assert 150 < len(kept) < 230
    near = plain_near(plain_exact(kept))
    assert 400 in {r[0] for r in near} and 401 not in {r[0] for r in near}
    left = spark.createDataFrame(near, SCHEMA)
    taken = Counter({(r["doc_id"], r["size"]): r["taken"] for r in mixing.mix(left).collect()})
    tokenizer = Tokenizer.from_file(vocabulary_path())
    expected = Counter()
    for r in near:
        size = len(words(r[1]))
        if size:
            ids = tokenizer.encode(r[1], add_special_tokens=False).ids
            expected[(r[0], r[3], len(ids), tuple(ids))] += taken[(r[0], size)] // size
    got = Counter((r["doc_id"], r["source"], r["n_tokens"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == +expected


def test_every_stage_but_the_last_keeps_columns_and_values(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.limit(0)):
            found = stage(spark, rows, folder)
            assert found.columns == docs.columns, name
            assert {tuple(r) for r in found.collect()} <= before, name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs.limit(0), folder).collect() == []


def test_the_model_learns_one_row_of_a_repeated_id(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    once, twice = (quality.fit(d, ratings(spark, folder)) for d in (docs, docs.unionByName(docs)))
    assert (once.weights == twice.weights).all() and (once.thresholds == twice.thresholds).all()
