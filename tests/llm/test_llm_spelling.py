from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from recollect.llm import spelling
from recollect.session import ship_package

SCHEMA = "doc_id long, text string, lang string, word string, n string, form string, root string, size string"


def frame(spark, rows, parts=4):
    ship_package(spark)
    full = [(i, t, "en", "clash", "clash", "clash", "clash", "clash") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def brute_counts(rows, least):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least and len(w) >= 5}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least=3, times=2):
    counts = brute_counts(rows, least)
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, letters="abÿ×", size=900):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(size)]
    weights = [1 / (i + 1) for i in range(size)]
    rows = []
    for i in range(150):
        chosen = rng.choices(vocabulary, weights, k=60)
        rows.append((i if i % 10 else None, " ".join(w.upper() if rng.random() < 0.1 else w for w in chosen)))
    return rows


EDGES = [
    (1, None), (2, ""), (3, "\n Ā一"), (4, "colour colour colour color color color color color color color"),
    (4, "colour colour colour color color color color color color color"), (5, "aaaaa aaaaaa " * 3 + "aaaaaaa " * 9),
    (6, "naïve naive NAIVE naïve naive naïve"), (7, "word" * 20_000 + " " + "x" * 9000), (None, "abcdef1abcdef2abcdef"),
    (8, "ABCDEß abcdeß abcdeß abcdÉß abcdéß abcdéß"),
]


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abÿ×"), (3, "abcdefgh")])
def test_equal_to_brute_force(spark, seed, letters):
    rows = corpus(seed, letters)
    got = spelling.group_variants(frame(spark, rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute(rows)
    assert collected(got) == expected
    assert any(r[1] for r in expected)
    assert letters != "ab" or any(r[1] not in (None, r[2]) for r in expected)


def test_edges_and_repeated_rows(spark):
    rows = EDGES + [(7, EDGES[7][1])] * 2
    assert collected(spelling.group_variants(frame(spark, rows))) == brute(rows)
    assert "word" * 20_000 in dict((r[0], r) for r in brute(rows))


def test_ties_go_to_the_smallest_word(spark):
    ship_package(spark)
    counted = spark.createDataFrame([("grapz", 8), ("grape", 8), ("grapé", 8), ("graph", 3)], "word string, n long")
    got = {r["word"]: (r["n_near"], r["form_n"], r["form"]) for r in spelling.near_words(counted).collect()}
    assert got == {"graph": (3, 8, "grape"), "grape": (3, 8, "grapz"), "grapz": (3, 8, "grape"), "grapé": (3, 8, "grape")}


def test_empty_table(spark):
    assert spelling.group_variants(frame(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_composition_finds_all_pairs_behind_a_state(seed):
    rng = random.Random(seed)
    rows = set()
    for part in range(rng.randint(1, 6)):
        size = rng.randint(1, 5)
        for _ in range(rng.randint(1, 40)):
            longer = rng.randint(0, 1)
            rows.add((part, longer, "".join(rng.choice("abc") for _ in range(size + longer))))
    rows = sorted(rows)
    lengths = np.array([len(r[2]) for r in rows])
    cells = np.zeros((len(rows), lengths.max()), np.uint8)
    for k, r in enumerate(rows):
        cells[k, : len(r[2])] = list(r[2].encode())
    part, longer = (np.array([r[c] for r in rows]) for c in (0, 1))
    got = {tuple(p) for p in spelling.near_pairs(cells, lengths, part, longer)}
    expected = {
        (i, j)
        for i in range(len(rows)) for j in range(len(rows))
        if rows[i][0] == rows[j][0] and rows[i][1] == 0 and (rows[j][1] == 1 or i < j) and is_near(rows[i][2], rows[j][2])
    }
    assert got == expected


def test_states_with_one_right_language_are_one():
    strings = [b"cat", b"cut", b"hat", b"hut"]
    a = spelling.Acceptor(np.array([list(s) for s in strings], np.uint8), np.full(4, 3), np.zeros(4, np.int64))
    assert a.states == 4  # root, behind the first letter, behind the second, end
    assert a.skip.tolist() == [0, 0, 1, 0, 2] or sorted(a.skip.tolist()) == [0, 0, 0, 1, 2]


def test_roots_of_a_long_chain(spark):
    names = [f"w{i:03d}" for i in range(40)]
    links = spark.createDataFrame(list(zip(names, names[1:], strict=False)), "word string, form string")
    assert {r["root"] for r in spelling.roots(links).collect()} == {"w039"}
