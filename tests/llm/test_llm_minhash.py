from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from recollect.llm import minhash, words
from recollect.llm.components import components
from recollect.session import ship_package
from recollect.sources.tables import read_table

SCHEMA = "doc_id long, text string, lang string, component_id string, bands string"


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x20\x09-\x0d]+", lowered)


def plain_shingles(text):
    found = plain_words(text)
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def plain_components(texts):
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i), root(i) == i) for i in texts}


def found_components(docs):
    rows = minhash.near_duplicates(docs).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}


def varied(base, changes, rng):
    out = list(base)
    for place in rng.sample(range(len(out)), changes):
        out[place] = f"x{rng.random():.6f}"
    return " ".join(out)


def test_words_follow_the_byte_rule():
    texts = [None, "", " \t\n", "Ä b\x0bC", "one  two three\x85four", "ÀÉ ab" * 400, "x" * 5000, "a\x1cb"]
    got = [h for _, _, part in words.text_chunks(pa.array(texts), 64) for h in [part.hashes()]]
    sizes = [
        int(part.first[i + 1] - part.first[i])
        for _, _, part in words.text_chunks(pa.array(texts), 64)
        for i in range(part.rows)
    ]
    assert sizes == [len(plain_words(t)) for t in texts]
    distinct = {w for t in texts for w in plain_words(t)}
    assert len(np.unique(np.concatenate(got))) == len(distinct)


def test_sliced_and_large_strings_split_alike():
    texts = pa.array(["zero", "one two", None, "three  four five"])
    whole = [part.hashes().tolist() for _, _, part in words.text_chunks(texts, 1)]
    for other in (texts.slice(1), texts.cast(pa.large_string()).slice(1), pa.chunked_array([texts[1:2], texts[2:]])):
        assert [part.hashes().tolist() for _, _, part in words.text_chunks(other, 1)] == whole[1:]


def test_shared_bands_grow_with_similarity():
    rng = random.Random(1)
    universe = [rng.getrandbits(63) for _ in range(3000)]
    hits = {}
    for shared in (0.2, 0.75, 0.9):
        n = 0
        for trial in range(60):
            core = rng.sample(universe, 500)
            cut = int(500 * 2 * shared / (1 + shared))
            others = rng.sample([u for u in universe if u not in set(core)], 500 - cut)
            a = np.unique(words.mix(np.array(core, dtype=np.uint64)))
            b = np.unique(words.mix(np.array(core[:cut] + others, dtype=np.uint64)))
            keys = minhash.band_keys(minhash.signatures([a, b]))
            n += bool(set(keys[0].tolist()) & set(keys[1].tolist()))
        hits[shared] = n
    assert hits[0.75] >= 59 and hits[0.9] == 60 and hits[0.2] <= 10


def test_edge_rows(spark):
    ship_package(spark)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(100)]
    texts = {
        1: None, 2: "", 3: " \n\t ", 4: "only four words here", 5: "ONLY four\nwords  here", 6: "a b c d e",
        7: "word " * 30, 8: "WORD " * 40, 9: "Ünï çode wörds and more of them", 10: " ".join(base),
        11: varied(base, 3, rng), 12: varied(base, 2, rng), 13: " ".join(base).upper(),
        14: " ".join(f"v{i}" for i in range(20000)), 15: " ".join(f"v{i}" for i in range(19000)),
    }
    docs = spark.createDataFrame([(i, t, "en", "clash", "clash") for i, t in texts.items()], SCHEMA)
    assert found_components(docs) == plain_components(texts)


def test_rows_without_id_and_repeated_rows(spark):
    text = "one two three four five six"
    rows = [(None, text), (None, None), (3, text), (3, text), (4, text)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = sorted(minhash.near_duplicates(docs).collect(), key=repr)
    assert sorted((r["component_id"], r["kept"]) for r in got if r["doc_id"] is not None) == [
        (3, False), (3, True), (3, True),
    ]
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)] * 2


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_groups_of_near_copies_and_shared_passages(spark):
    """Chains of copies, a frequent passage below the threshold, and copies on either side of it."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    texts, number = {}, 100
    for _ in range(60):
        own = [f"o{rng.random():.8f}" for _ in range(rng.randint(8, 90))]
        texts[number] = " ".join(own + passage)
        number += 1
    chain = [f"c{i}" for i in range(120)]
    for _ in range(12):
        texts[number] = " ".join(chain)
        chain = varied(chain, 3, rng).split()
        number += 1
    base = [f"b{i}" for i in range(80)]
    for _ in range(60):
        texts[number] = varied(base, rng.randint(0, 4), rng)
        number += 1
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in texts.items()], SCHEMA)
    assert found_components(docs) == plain_components(texts)


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(170, 160), (165, 170), (7, 7)]
    frame = spark.createDataFrame(links + [(None, 5)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(frame).collect()}
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {160: 160, 165: 160, 170: 160}
    assert got == expected


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_whole_table_against_all_pairs(spark, sf_dir):
    docs = read_table(spark, "documents", sf_dir)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert found_components(docs) == plain_components(texts)
