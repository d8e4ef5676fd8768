"""Byte-pair encoding and decoding by a vocabulary file of the tokenizers library.

The file's steps are: special tokens are cut out of the raw text; the rest is normalised (NFC, white
space, lower case) and split into pieces; the bytes of a piece are its first symbols, the last one
marked as the end of a word. Then merges apply. Over the ranks of the adjacent pairs of a piece lies
a segment tree whose root is the leftmost pair of the lowest rank; a merge replaces that pair and
updates three leaves and the nodes above them, until no pair has a rank. Equal pieces are encoded
once per block, and pieces of like length in one set of arrays, one tree per row. Results are the
library's for all assigned characters; which code points are letters depends on the Unicode version.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHED_PIECES = 200_000
BLOCK_ROWS = 256
TREE_CELLS = 1 << 21
_NONE = np.int64(1 << 62)
_PLACE_BITS = np.int64(32)
_PLACE = np.int64((1 << 32) - 1)


def _byte_names() -> list[str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names, spare = {b: chr(b) for b in shown}, 0x100
    for byte in range(256):
        if byte not in names:
            names[byte], spare = chr(spare), spare + 1
    return [names[b] for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if steps != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in splits] != ["Split", "ByteLevel"]:
            raise ValueError("this codec knows the steps NFC, Replace, Lowercase, Split and ByteLevel only")
        vocab = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        suffix = model["end_of_word_suffix"] or ""
        self.tokens = {i: t for t, i in (vocab | special).items()}
        self.special = special
        self.special_pattern = regex.compile(
            "(" + "|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True)) + ")"
        )
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"])
        names = _byte_names()
        self.inner = np.array([vocab[n] for n in names], dtype=np.int64)
        self.last = np.array([vocab[n + suffix] for n in names], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.ranks = pairs[order], order.astype(np.int64)
        self.cache: dict[str, bytes] = {}

    # --- text to pieces -------------------------------------------------------------------

    def pieces(self, text: str) -> list[str]:
        """Pieces of the text, and special tokens as they are."""
        if "<|" not in text:
            return self._plain_pieces(text)
        out = []
        for i, part in enumerate(self.special_pattern.split(text)):
            out += [part] if i % 2 else self._plain_pieces(part)
        return out

    def _plain_pieces(self, text: str) -> list[str]:
        # the capital sigma has one lower case here, also at the end of a word
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.pattern.findall(text)

    # --- pieces to ids --------------------------------------------------------------------

    def _rank(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank and place of each pair in one number, or _NONE."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, (self.ranks[at] << _PLACE_BITS) | place, _NONE)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of every piece as little-endian 32-bit integers."""
        raw = [p.encode() for p in pieces]
        out: list[bytes] = [b""] * len(raw)
        widths: dict[int, list[int]] = {}
        for i, piece in enumerate(raw):
            if piece:
                widths.setdefault(max(1, (len(piece) - 1).bit_length()), []).append(i)
        for level, rows in widths.items():
            step = max(1, TREE_CELLS >> (level + 1))
            for low in range(0, len(rows), step):
                part = rows[low : low + step]
                for i, ids in zip(part, self._merge([raw[i] for i in part], 1 << level), strict=True):
                    out[i] = ids
        return out

    def _merge(self, pieces: list[bytes], width: int) -> list[bytes]:
        n, longest = len(pieces), max(map(len, pieces))
        sizes = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(p.ljust(longest, b"\0") for p in pieces), np.uint8).reshape(n, longest)
        places = np.arange(longest, dtype=np.int64)
        symbols = np.where(places == sizes[:, None] - 1, self.last[data], self.inner[data])
        after = np.where(places + 1 < sizes[:, None], places + 1, -1)
        before = np.broadcast_to(places - 1, (n, longest)).copy()
        alive = np.broadcast_to(places, (n, longest)) < sizes[:, None]
        tree = np.full((n, 2 * width), _NONE)
        if longest > 1:
            ranks = self._rank(symbols[:, :-1], symbols[:, 1:], places[:-1])
            tree[:, width : width + longest - 1] = np.where(after[:, :-1] >= 0, ranks, _NONE)
        half = width
        while half > 1:
            tree[:, half // 2 : half] = np.minimum(tree[:, half : 2 * half : 2], tree[:, half + 1 : 2 * half : 2])
            half //= 2
        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            root = tree[rows, 1]
            place = root & _PLACE
            gone = after[rows, place]
            follows = after[rows, gone]
            leads = before[rows, place]
            symbols[rows, place] = made = self.merged[root >> _PLACE_BITS]
            alive[rows, gone] = False
            after[rows, place] = follows
            has_next, has_left = follows >= 0, leads >= 0
            before[rows[has_next], follows[has_next]] = place[has_next]
            self._update(tree, rows, width + gone, _NONE)
            right = np.where(has_next, self._rank(made, symbols[rows, follows], place), _NONE)
            self._update(tree, rows, width + place, right)
            left = self._rank(symbols[rows, leads], made, leads)[has_left]
            self._update(tree, rows[has_left], width + leads[has_left], left)
            rows = rows[tree[rows, 1] < _NONE]
        ids = symbols.astype("<u4")
        return [ids[i][alive[i]].tobytes() for i in range(n)]

    @staticmethod
    def _update(tree: np.ndarray, rows: np.ndarray, node: np.ndarray, value) -> None:
        tree[rows, node] = value
        while len(node) and node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text; null counts as empty."""
        split = [self.pieces(t or "") for t in texts]
        wanted = set().union(*split) - self.cache.keys() if split else set()
        if len(self.cache) + len(wanted) > CACHED_PIECES:
            self.cache.clear()
            wanted = set().union(*split)
        plain = [p for p in wanted if p not in self.special]
        self.cache.update(zip(plain, self.encode_pieces(plain), strict=True))
        for token in wanted & self.special.keys():
            self.cache[token] = self.special[token].to_bytes(4, "little")
        find = self.cache.__getitem__
        return [b"".join(map(find, pieces)) for pieces in split]

    # --- ids to text ----------------------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The tokens' strings with a space between them: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def _codec(content: bytes) -> Codec:
    return Codec(content)


def load(spark: SparkSession, path: str):
    """The vocabulary file for the workers: read on the driver, a few MB whatever the corpus."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary) -> DataFrame:
    """`docs (text, …)` with a column `ids`: the whole text's ids; `text` is left out.

    A null or empty text, or one of white space, has no ids. A column `ids` that was there is replaced.
    """
    kept = docs.drop("ids", "text")
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary.value)
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(low, BLOCK_ROWS)
                found = codec.encode_batch(part.column("text").to_pylist())
                ends = np.cumsum([0, *(len(f) // 4 for f in found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), ids], names=[*names, "ids"]
                )

    return docs.select(*names, "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary) -> DataFrame:
    """`encoded (ids, …)` with a column `text`: what the ids stand for; null ids give a null text."""
    kept = encoded.drop("text")
    schema = T.StructType([*kept.schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary.value)
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(low, BLOCK_ROWS)
                lists = part.column("ids").to_pylist()
                texts = [None if ids is None else codec.decode(ids) for ids in lists]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "text"]
                )

    return kept.mapInArrow(run, schema)


def ids_digest(encoded: DataFrame) -> DataFrame:
    """`encoded (ids, …)` with `ids_sha256`, over the ids as little-endian 32-bit integers."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("ids_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            ends = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False).astype("<i4")
            made = [hashlib.sha256(values[a:b].tobytes()).hexdigest() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, "ids_sha256"]
            )

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary) -> DataFrame:
    """`(doc_id, n_tokens, ids_sha256, decoded_sha256)` of every row of `docs (doc_id, text, …)`."""
    decoded = decode(encode(docs.select("doc_id", "text"), vocabulary), vocabulary)
    return ids_digest(decoded).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_sha256",
        F.sha2("text", 256).alias("decoded_sha256"),
    )
