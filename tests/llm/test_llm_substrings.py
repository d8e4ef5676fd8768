from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from recollect.llm import substrings
from recollect.session import ship_package

SCHEMA = "doc_id long, text string, lang string, n_words string, payload string, block string, kept_text string"


def frame(spark, rows, parts=3):
    ship_package(spark)
    full = [(i, t, "en", "clash", "clash", "clash", "clash") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def brute(rows, window):
    texts = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    seen = Counter(tuple(x[i : i + window]) for x in texts for i in range(len(x) - window + 1))
    out = []
    for (doc_id, _), found in zip(rows, texts, strict=True):
        gone = {
            j for i in range(len(found) - window + 1) if seen[tuple(found[i : i + window])] > 1
            for j in range(i, i + window)
        }
        kept = " ".join(w for j, w in enumerate(found) if j not in gone)
        out.append((doc_id, len(found), len(gone), kept))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_rows(seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["ab", "Ab", "é", "f"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    shared = " ".join(f"w{i}" for i in range(40))
    rows = list(enumerate(texts))
    rows += [(100 + i, f"{texts[i]} {shared}\n{texts[i + 1]}") for i in range(20)]
    return rows + [
        (900, None), (901, ""), (902, " \n\t"), (903, texts[3]), (903, texts[3]), (None, shared), (None, "one"),
        (904, "x " * 80), (905, "y " * 35), (906, "word\x1cword\xa0word " * 3), (907, "z" * 3000), (908, shared.upper()),
    ]


@pytest.mark.parametrize("window", [1, 2, 5, 12, 35])
def test_equal_to_brute_force(spark, window):
    rows = random_rows(window)
    got = substrings.remove_repeats(frame(spark, rows), window)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_text"]
    assert collected(got) == brute(rows, window)


def test_repeats_inside_one_text_that_overlap(spark):
    rows = [(1, "a b " * 40), (2, "c " * 35), (3, "d " * 36)]
    assert collected(substrings.remove_repeats(frame(spark, rows))) == brute(rows, 35)
    assert [r[2] for r in brute(rows, 35)] == [80, 0, 36]


def test_a_text_longer_than_a_block(spark):
    rng = random.Random(4)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(400_000))
    assert len(long) > substrings.BLOCK_BYTES
    rows = [(1, long), (2, long[1_000_000:1_100_000]), (3, "short text")]
    got = {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(frame(spark, rows, 1)).collect()}
    expected = {i: n for i, _, n, _ in brute(rows, 35)}
    assert got == expected and got[1] > 10_000


def test_empty_table(spark):
    assert substrings.remove_repeats(frame(spark, [])).collect() == []


@pytest.mark.parametrize("window", [1, 2, 5, 12, 35, 50])
def test_every_pair_of_equal_windows_shares_an_aligned_anchor(window):
    period, residues = substrings.cover(window)
    assert period <= window
    for i in range(period):
        for j in range(period):
            assert any((i + s) % period in residues and (j + s) % period in residues for s in range(period))


def test_hashes_do_not_depend_on_the_slices():
    from recollect.llm import words

    text = "Ab ab  é x\n" * 50 + "long" * 100
    data = np.frombuffer(text.encode(), np.uint8)
    found = words.Words(data, np.array([0, len(data)]))
    assert (found.hashes_as_is(7) == found.hashes_as_is()).all()
    assert len(np.unique(found.hashes_as_is())) == 5
