from __future__ import annotations

import hashlib
import struct
import sys
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recollect.llm import bpe
from recollect.llm.queries import vocabulary_path
from recollect.sources.tables import read_table

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def codec():
    with open(vocabulary_path(), "rb") as file:
        return bpe.Codec(file.read())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


def ours(codec, texts):
    return [list(struct.unpack(f"<{len(ids) // 4}I", ids)) for ids in codec.encode_batch(texts)]


def same(codec, library, texts):
    got = ours(codec, texts)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    wrong = [(t, a, b) for t, a, b in zip(texts, got, expected, strict=True) if a != b]
    assert not wrong, wrong[:3]
    assert [codec.decode(i) for i in got] == library.decode_batch(expected, skip_special_tokens=False)


def test_every_character(codec, library):
    assigned = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) not in ("Cn", "Cs", "Co")]
    for low in range(0, len(assigned), 20000):
        same(codec, library, [f"a{c}b {c}" for c in assigned[low : low + 20000]])


def test_special_tokens_and_cases(codec, library):
    texts = [
        "", " ", "<|endoftext|>", "a<|endoftext|>b", "<|startoftext|><|endoftext|> <|endoftext", "<|END|> <|x|>",
        "ΑΣ ΟΔΟΣ Σ ΣΑ", "İstanbul ǅ", "don't WE'LL they'Re 'S", "é Å ﬁ", "x" * 3000, "ab" * 2500 + "!" * 777,
        "1234567890", "\x1c\x1d a\x85b​c　d", "日本語テキスト", "🙂👍🏽‍❤️", "a_b-c::d",
    ]
    same(codec, library, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_categories=["Cn", "Co"]), max_size=40), max_size=8))
def test_any_text(codec, library, texts):
    same(codec, library, texts)


def test_pieces_of_all_lengths_share_no_state(codec, library):
    texts = [("the quick brown fox " * 3)[: i % 50] + "z" * (i % 37) for i in range(400)]
    same(codec, library, texts)


def expected_rows(library, texts):
    out = []
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x).hexdigest() for x in (struct.pack(f"<{len(ids)}I", *ids), decoded.encode())]
        out.append((doc_id, len(ids), *digests))
    return sorted(out, key=repr)


def test_whole_table(spark, library):
    docs = read_table(spark, "documents", "/root/testdata/sf0.001")
    got = bpe.round_trip(docs, bpe.load(spark, vocabulary_path())).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in got), key=repr) == expected_rows(library, rows)


def test_edge_rows_and_clashing_columns(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (None, " \n", "x"), (3, "a b", None), (3, "a b", "x"), (4, "w " * 20000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    vocabulary = bpe.load(spark, vocabulary_path())
    got = bpe.round_trip(docs, vocabulary).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected_rows(library, [r[:2] for r in rows])
    assert bpe.encode(docs, vocabulary).columns == ["doc_id", "ids"]
    assert bpe.round_trip(docs.limit(0), vocabulary).collect() == []
