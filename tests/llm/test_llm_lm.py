from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from recollect.llm import lm, words
from recollect.sources.tables import read_table

SCHEMA = "doc_id long, text string, score string, n string, word string"


def plain_tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", lowered), None]


def plain_held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def middle(count):
    """The mean of all counts that share a power of 1.5 with this one."""
    if count < 1:
        return 0
    low, high = Fraction(1), Fraction(3, 2)
    while high <= count:
        low, high = high, high * Fraction(3, 2)
    return (math.ceil(low) + math.ceil(high) - 1) / 2


def plain_scores(rows):
    """Base scores, and model scores with the counts quantised but free of filter errors."""
    single, pairs, texts = Counter(), Counter(), 0
    for doc_id, text in rows:
        if not plain_held_out(doc_id):
            tokens = plain_tokens(text)
            single.update(tokens)
            pairs.update(zip(["<begin>", *tokens], tokens, strict=False))
            texts += 1
    n, v = sum(single.values()), len(single)
    mass = n + 0.1 * (v + 1)
    total = sum(pairs.values())
    seen = 1 - sum(c == 1 for c in pairs.values()) / total if total else 0
    history = {**single, "<begin>": texts}
    out = []
    for doc_id, text in rows:
        tokens = plain_tokens(text)
        base = sum(math.log10((single[t] + 0.1) / mass) for t in tokens)
        model = 0.0
        for before, t in zip(["<begin>", *tokens], tokens, strict=False):
            alone = (middle(single[t]) + 0.1) / mass
            h = middle(history.get(before, 0))
            pair = pairs[(before, t)]
            mixed = seen * min(1, middle(pair) / h) + (1 - seen) * alone if h else alone
            model += math.log10(min(1, mixed))
        known = sum(single[t] > 0 for t in tokens)
        out.append((doc_id, plain_held_out(doc_id), len(tokens), known, n, base, model))
    return out


def check(got, rows, model_error=0.02):
    expected = sorted(plain_scores(rows), key=repr)
    got = sorted((tuple(r) for r in got), key=lambda r: repr(r[:5]))
    expected = sorted(expected, key=lambda r: repr(r[:5]))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for a, b in zip(got, expected, strict=True):
        assert math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(a[6] - b[6]) <= model_error * abs(b[6]) + 1.5
    return got, expected


def test_edge_rows(spark):
    rows = [(i, f"alpha beta gamma {i % 7} delta") for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (None, "alpha"), (103, "x " * 20000), (104, "ALPHA é"), (104, "ALPHA é")]
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)
    check(lm.score(docs).collect(), rows)


def test_empty_table_and_nothing_to_learn_from(spark):
    assert lm.score(spark.createDataFrame([], SCHEMA)).collect() == []
    held = next(i for i in range(100) if plain_held_out(i))
    docs = spark.createDataFrame([(held, "a b", "", "", "")], SCHEMA)
    check(lm.score(docs).collect(), [(held, "a b")])


def test_rare_words_meet_the_word_table(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 3)
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.5))}" for _ in range(30))) for i in range(80)]
    check(lm.score(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)).collect(), rows)


def test_filter_levels_are_right_up_to_its_error_rate():
    rng = np.random.default_rng(2)
    keys = words.mix(np.arange(40_000, dtype=np.uint64))
    counts = np.maximum(1, rng.pareto(0.8, len(keys))).astype(np.int64)
    for segments in (1, 8):
        shift = 64 - (segments.bit_length() - 1)
        order = np.argsort(keys)
        table = pa.Table.from_batches([lm._packed(1, keys[order], counts[order], shift)])
        slices = []
        for segment in range(segments):
            part = table.filter(pa.array(table["segment"].to_numpy() == segment))
            counted = lm._count_segment(part)
            slice_bits = (1 << 20) // segments
            built = next(lm._build_slice(slice_bits)(iter(counted.to_batches())))
            slices.append(np.frombuffer(built["bits"][0].as_py(), np.uint8))
        found = lm.Filter(np.concatenate(slices), segments)
        true = lm.level(counts)
        got = found.levels(keys, 1)
        assert (got >= true).all() and (got > true).mean() < 0.05
        assert (found.levels(words.mix(keys), 1) > 0).mean() < 0.05


def test_levels_are_powers_of_the_base():
    counts = np.arange(1, 5000)
    assert lm.mean_count(lm.level(counts)).tolist() == [middle(c) for c in counts.tolist()]
    assert lm.mean_count(np.array([0])) == 0 and lm.BOUNDS[-1] > 2**32


def test_a_block_of_texts_is_hashed_in_little_memory():
    texts = pa.array(["some Words of a text " * 50] * (lm.CHUNK_BYTES // 1050))
    list(lm._tokens(texts[:1000]))
    tracemalloc.start()
    ((_, tokens, _),) = lm._tokens(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(tokens) > 790_000 and peak < 20 * lm.CHUNK_BYTES
    ((_, _, chunk),) = words.text_chunks(texts[:3])
    assert np.array_equal(chunk.hashes(), chunk.hashes(limit=9))


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_whole_table(spark, sf_dir):
    docs = read_table(spark, "documents", sf_dir)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got, expected = check(lm.score(docs).collect(), rows)
    assert abs(sum(r[6] for r in got) / sum(r[6] for r in expected) - 1) < 0.01


def test_a_filter_past_the_broadcast_bound_keeps_every_level(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.8)) % 300}" for _ in range(40))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "w1 w2"), (202, "w1 w2"), (202, "w1 w2")]
    docs = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    monkeypatch.setattr(lm, "SEGMENT_TOKENS", 500)
    monkeypatch.setattr(lm, "CHUNK_BYTES", 700)
    whole = sorted(map(repr, lm.score(docs).collect()))
    monkeypatch.setattr(lm, "MOST_BITS", 1 << 13)
    assert sorted(map(repr, lm.score(docs).collect())) == whole
    check(lm.score(docs).collect(), rows)


def test_texts_are_not_grouped_to_ask_the_segments(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 5} w", "", "", "") for i in range(60)], SCHEMA)
    monkeypatch.setattr(lm, "SEGMENT_TOKENS", 50)
    monkeypatch.setattr(lm, "MOST_BITS", 1 << 10)
    plan = lm.score(docs)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "FlatMapGroupsInArrow" not in plan
    rows = pa.RecordBatch.from_pydict({"row": [5, 6, 7, 8], "text": ["x", "w " * 500, None, ""], "n": [1, 2, 3, 4]})
    packed = lm._packed_texts(rows.slice(1))
    assert lm._unpacked_texts(packed).to_pydict() == {"row": [6, 7, 8], "text": ["w " * 500, None, ""]}
    assert len(packed) < 500


def test_one_form_at_every_size_and_a_broadcast_only_where_asked(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.8)) % 300}" for _ in range(40))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "w1 w2"), (202, "w1 w2"), (202, "w1 w2")]
    docs = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    monkeypatch.setattr(lm, "SEGMENT_TOKENS", 500)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    by_segment = lm.score(docs)
    assert "FlatMapCoGroupsInArrow" in plan(by_segment)
    sent = lm.score(docs, broadcast=True)
    assert "FlatMapCoGroupsInArrow" not in plan(sent)
    whole = sorted(map(repr, by_segment.collect()))
    assert sorted(map(repr, sent.collect())) == whole
    monkeypatch.setattr(lm, "MOST_BITS", 1 << 10)
    assert "FlatMapCoGroupsInArrow" in plan(lm.score(docs, broadcast=True))


def test_a_block_sends_its_keys_once_with_the_counts_that_are_learnt():
    rows = pa.RecordBatch.from_pydict(
        {"row": [5, 6, 7], "text": ["a b a", "a c", None], "learnt": [True, False, True]},
        pa.schema([("row", pa.int64()), ("text", pa.string()), ("learnt", pa.bool_())]),
    )
    block = pa.RecordBatch.from_pydict({"block": [5], "texts": [lm._packed_texts(rows)]})
    single, pairs = list(lm._ask(64)(iter([block])))
    counts = {kind: lm._decoded(b.column("n")[0].as_py()).tolist() for kind, b in ((1, single), (2, pairs))}
    assert sorted(counts[1]) == [0, 1, 2, 2, 2]  # c; b; a, the ends and the begin marks
    assert sorted(counts[2]) == [0, 0, 1, 1, 1, 1, 1]
    counted = lm._count_segment(pa.Table.from_batches([single, pairs]))
    assert counted["once"].to_pylist() == [5] and counted["total"].to_pylist() == [5]
    answers = list(lm._answer(1 << 12)(iter(counted.to_batches())))
    assert [a.column("block").to_pylist() for a in answers] == [[5], [5]]
    for kind, answer in zip((1, 2), answers, strict=True):
        levels = zstandard.decompress(answer.column("levels")[0].as_py())
        assert list(levels) == lm.level(np.array(counts[kind])).tolist()
