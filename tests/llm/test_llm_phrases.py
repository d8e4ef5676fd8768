from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from recollect.llm import phrases, words
from recollect.session import ship_package

SCHEMA = "doc_id long, text string, lang string, phrase string, n string, score string, key string, shard string"


def frame(spark, rows, parts=5):
    ship_package(spark)
    full = [(i, t, lang, "clash", "clash", "clash", "clash", "clash") for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def brute(rows, least, best=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            found = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(found)
            for k in range(1, 6):
                for i in range(len(found) - k + 1):
                    f[lang, tuple(found[i : i + k])] += 1
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inner = (lang, words[i : i + k])
                if a >= candidates[inner]:
                    dropped.add(inner)
    out = []
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            cuts = [
                (1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))
            ]
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(words), f[lang, words[:k]], f[lang, words[k:]]))
    out.sort(key=lambda r: (r[0], r[1], r[2], r[3].encode()))
    ranks = Counter()
    result = []
    for lang, score, a, phrase, left, right in out:
        ranks[lang] += 1
        if ranks[lang] <= best:
            result.append((lang, ranks[lang], phrase, -a, left, right, n[lang], -score))
    return result


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [*"abcdefgh", "A", "é", "É", "x\xa0y", "\U0001f600"]
    fixed = ["new york city hall", "of the", "one two three four five six", "a a a a"]
    rows = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        text = "".join(p + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ! "]) for p in parts)
        rows.append((text, rng.choice(["en", "en", "en", "fr", None])))
    return rows + [(None, "en"), ("", None), (" . ,\n", "de"), ("only one", "de"), ("a b a b", "und"), ("", "")]


@pytest.mark.parametrize("seed,least", [(1, 20), (2, 4)])
def test_equal_to_brute_force(spark, seed, least):
    rows = corpus(seed)
    got = phrases.collocations(frame(spark, rows), least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert collected(got) == brute(rows, least)
    assert len(brute(rows, least)) > 0


def test_best_of_every_language_and_ties(spark):
    rows = [("a b. c d. e f. x y", lang) for lang in ("en", "fr")] * 9
    got = collected(phrases.collocations(frame(spark, rows), 5, 3))
    assert got == brute(rows, 5, 3)
    assert [r[2] for r in got] == ["a b", "c d", "e f"] * 2


def test_errors_of_the_filter_change_nothing(spark, monkeypatch):
    rows = corpus(7, 200)
    monkeypatch.setattr(phrases, "FILTER_WORDS", 4)
    assert collected(phrases.collocations(frame(spark, rows), 10)) == brute(rows, 10)


def test_long_text_and_empty_table(spark):
    rng = random.Random(5)
    long = " ".join(str(rng.randrange(300)) for _ in range(600_000))
    assert len(long) > phrases.BLOCK_BYTES
    rows = [(long, "en"), ("short, text", "en"), ("v w x y z " * 150, "en")]
    assert collected(phrases.collocations(frame(spark, rows, 1))) == brute(rows, 100)
    assert phrases.collocations(frame(spark, [])).collect() == []


def test_filter_in_sql_and_numpy_agree(spark):
    keys = np.array([1, 2**63, 2**64 - 1, 12345678901234567890], dtype=np.uint64)
    bits = phrases._learn(
        np.zeros(1 << 20, np.uint64), spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long")
    )
    assert phrases._told(bits, keys).all()
    others = words.constants(99, 10**5)
    assert phrases._told(bits, others).sum() == 0
