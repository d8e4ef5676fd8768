"""Quality grades, toxicity and licence scans."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest

from recollect.llm import licenses, quality, toxicity
from recollect.sources.tables import read_table

SMALL = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score string, features string, toxic string, grade string"
EDGES = [(None, "some words"), (1001, None), (1002, ""), (1003, " \n"), (1004, "good " * 20000), (1005, "x" * 50000)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)


def graded(n=900, seed=1):
    """Texts whose share of good words rises with their grade 0 to 3."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        grade = rng.randrange(4)
        text = " ".join(rng.choice("abcdefgh") * 3 if rng.random() > grade / 3.2 else f"good{rng.randrange(9)}" for _ in range(60))
        out.append((i, text, grade))
    return out


def test_ordinal_regression_orders_grades(spark):
    rows = graded()
    docs = frame(spark, [r[:2] for r in rows] + EDGES)
    ratings = spark.createDataFrame([(i, g) for i, _, g in rows] + [(5000, None), (None, 1)], "doc_id long, grade int")
    model = quality.fit(docs, ratings)
    assert model.grades == [0.0, 1.0, 2.0, 3.0] and (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in quality.score(docs, ratings).collect()}
    assert len(got) == len(rows) + len(EDGES)
    held = [(g, got[i]) for i, _, g in rows if got[i]["held_out"]]
    assert len(held) > 100
    assert np.mean([abs(r["expected_grade"] - g) for g, r in held]) < 0.5
    assert np.mean([(r["tail_probability"] >= 0.5) == (g > 0) for g, r in held]) > 0.9
    for r in got.values():
        assert 0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 3 and r["grade"] in model.grades


def test_slope_of_the_loss():
    """The fitted model's loss is no higher than that of models beside it."""
    rng = np.random.default_rng(3)
    rows = [(np.array([0, 1]), rng.normal(size=2)) for _ in range(400)]
    strengths = np.array([2 * r[1][0] - r[1][1] for r in rows]) + rng.logistic(size=400)
    grades = np.digitize(strengths, [-1.0, 0.5]).astype(float)
    model = quality.fit_ordinal(rows, grades, rounds=600)
    found = model.weights[:2]
    assert abs(found[0] - 2) < 0.5 and abs(found[1] + 1) < 0.5
    assert np.allclose(model.thresholds, [-1, 0.5], atol=0.4)


def test_the_fit_holds_few_bytes_a_feature():
    rng = np.random.default_rng(3)
    rows = [
        (np.unique(rng.integers(0, 1 << quality.HASH_BITS, 1000)).astype(np.int32), rng.random(1000).astype(np.float32))
        for _ in range(2000)
    ]
    rows = [(numbers, values[: len(numbers)]) for numbers, values in rows]
    grades = rng.integers(0, 3, len(rows)).astype(float)
    features = sum(len(numbers) for numbers, _ in rows)
    tracemalloc.start()
    quality.fit_ordinal(rows, grades, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * features


def test_a_fit_in_parts_is_the_fit(monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(np.arange(n, dtype=np.int32) * 7, rng.random(n).astype(np.float32)) for n in (0, 5, 900, 0, 31, 400, 1, 0)]
    grades = np.array([0.0, 1, 2, 0, 1, 2, 2, 0])
    whole = quality.fit_ordinal(rows, grades, rounds=9)
    monkeypatch.setattr(quality, "FIT_FEATURES", 40)
    parts = quality.fit_ordinal(rows, grades, rounds=9)
    assert np.array_equal(whole.weights, parts.weights) and np.array_equal(whole.thresholds, parts.thresholds)


def test_one_grade_and_empty_tables(spark):
    docs = frame(spark, EDGES)
    one = spark.createDataFrame([(i, 2) for i in range(1001, 1006)], "doc_id long, grade int")
    assert {(r["grade"], r["tail_probability"]) for r in quality.score(docs, one).collect()} == {(2.0, 1.0)}
    none = one.limit(0)
    assert {r["expected_grade"] for r in quality.score(docs, none).collect()} == {0.0}
    assert quality.score(docs.limit(0), none).collect() == []
    assert quality.accepted_rows(docs, none).count() == len(EDGES)


def test_accepted_rows_follow_the_score(spark):
    docs = read_table(spark, "documents", SMALL)
    ratings = read_table(spark, "labels", SMALL).selectExpr("doc_id", "quality AS grade")
    scored = {r["doc_id"]: r["tail_probability"] >= 0.5 for r in quality.score(docs, ratings).collect()}
    kept = quality.accepted_rows(docs, ratings)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, ok in scored.items() if ok}
    truth = {r["doc_id"]: r["grade"] for r in ratings.collect()}
    clean = [scored[i] for i, g in truth.items() if g == 1]
    junk = [scored[i] for i, g in truth.items() if g == 0]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.35


INSULTS = ["pathetic", "worthless", "idiot"]


def spoken(n=600, seed=4):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    out = []
    for i in range(n):
        said = rng.choices(vocabulary, k=rng.randint(20, 120))
        toxic = int(i % 3 == 0)
        for _ in range(toxic * 4):
            said.insert(rng.randrange(len(said)), rng.choice(INSULTS))
        out.append((i, " ".join(said), toxic))
    return out


def test_toxic_words_are_found(spark):
    rows = spoken()
    docs = frame(spark, [r[:2] for r in rows] + EDGES)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] + [(0, 0), (7, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert len(got) == len(rows) + len(EDGES)
    held = [(t, got[i]["predicted"]) for i, _, t in rows if got[i]["held_out"]]
    assert len(held) > 80 and np.mean([t == p for t, p in held]) > 0.95
    assert all(0 < r["score"] < 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert got[1001]["score"] == got[1002]["score"] == got[1003]["score"]


def test_toxicity_without_labels_or_rows(spark):
    docs = frame(spark, EDGES)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r["score"], r["predicted"]) for r in toxicity.score(docs, none).collect()} == {(0.5, 1)}
    assert toxicity.score(docs.limit(0), none).collect() == []
    one_class = spark.createDataFrame([(i, 0) for i in range(50)], "doc_id long, toxic int")
    rows = toxicity.score(frame(spark, [(i, f"word{i} again") for i in range(50)]), one_class).collect()
    assert {r["predicted"] for r in rows} == {0}


def test_windows_hold_all_words():
    text = "A bb  ccc\tdddd " * 40 + "z" * 1000
    assert b"".join(toxicity.windows(text)).replace(b" ", b"") == text.lower().replace(" ", "").replace("\t", "").encode()
    assert toxicity.windows(" \n") == []


@pytest.mark.parametrize(
    ("text", "whole", "lines"),
    [
        ("Released under the MIT Licence!", "MIT", "MIT"),
        ("\n  released   UNDER the mit-license\n\n", "MIT", "MIT"),
        ("Prose.\nLicensed under CC BY-NC 4.0.\nCopyright 2020 Me\nReleased under the MIT License", None, "CC-BY-NC-4.0,MIT"),
        (licenses.KNOWN["MIT"][2].replace("(c)", "(c) 2024 Somebody"), "MIT", None),
        (licenses.KNOWN["MIT"][2].replace("\n", " "), None, None),
        (licenses.KNOWN["0BSD"][0].upper().replace(",", " ,"), "0BSD", None),
        ("Copyright 2020 Me", None, None), ("", None, None), (None, None, None), ("...", None, None),
        ("The copyright of songs", None, None),
    ],
)
def test_license_texts(spark, text, whole, lines):
    got = licenses.scan(frame(spark, [(1, text), (1, text), (None, text)]), licenses.known_digests(spark)).collect()
    assert [(r["license_id"], r["line_licenses"]) for r in got] == [(whole, lines)] * 3


def test_license_scan_of_an_empty_table(spark):
    assert licenses.scan(frame(spark, []), licenses.known_digests(spark)).collect() == []


def test_inflected_insults_are_known_by_their_beginnings(spark):
    texts = [(f"grumbax{end}! plain" if toxic else f"plain{end} word", toxic) for end in "abcdefghijklmnopqrst" for toxic in (1, 0)]
    bad, plain = toxicity.word_lists(spark.createDataFrame(texts, "text string, toxic int"))
    assert "grumbax" in bad and "grumb" in bad and not any(w.startswith("plain") for w in bad)
    assert plain[0] == "word"


def test_plain_windows_compress_alike_and_one_short_insult_shows():
    words = ["plain", "water", "stone"]
    shared, tail = toxicity.dictionary(words, 200), toxicity.dictionary(["grumbax"], 100)
    toxic, ordinary = toxicity.compressor(shared + tail), toxicity.compressor(shared + bytes(len(tail)))
    gain = lambda text: [
        len(ordinary.compress(toxicity.LEAD + w)) - len(toxic.compress(toxicity.LEAD + w)) for w in toxicity.windows(text)
    ]
    assert gain("plain water stone plain") == [0]
    assert gain("plain grumbax water")[0] > 0


def test_the_known_texts_are_found_whole_in_any_form(spark):
    assert len(licenses.KNOWN) >= 20
    rows, expected = [], {}
    for name, texts in licenses.KNOWN.items():
        for text in texts:
            i = len(rows)
            shown = f"Copyright (c) 2020 Somebody\n\n{text.upper() if i % 2 else text}".replace("\n", "\n  ")
            rows.append((i, shown.replace(",", " , ")))
            expected[i] = name
    got = licenses.scan(frame(spark, rows + [(900, rows[0][1] + " and more")]), licenses.known_digests(spark)).collect()
    found = {r["doc_id"]: r["license_id"] for r in got}
    assert found.pop(900) is None and found == expected
