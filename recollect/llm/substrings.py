"""Long passages that occur more than once, by difference-cover anchors.

A window is `window` consecutive words of one document. Its repeats are found in two rounds:

1. Anchors. Runs of `window - period + 1` words are hashed only where the position in the document,
   modulo `period`, is in a difference cover: a set of residues whose differences give every residue.
   For any two equal windows some shift below `period` brings both starts into the cover, so the two
   share an aligned anchor, wherever they begin.
2. Extension. Each anchor that occurs again is extended to the whole windows around it, and windows
   whose hash occurs again are repeats.

Texts are packed once into blocks of bounded size. In each round a block sends its distinct hashes,
cut by their first bits, to buckets; a bucket answers with one bit per hash: also in another block, or
not. So a passage costs one hash per block and bucket, however often it occurs, and pairs of its
places are never formed. Windows and anchors are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.llm import words
from recollect.session import materialise

WINDOW = 35
BLOCK_BYTES = 1 << 21
BUCKET_BYTES = 1 << 23
#: Perfect difference sets: period and residues.
COVERS = ((1, (0,)), (3, (0, 1)), (7, (0, 1, 3)), (13, (0, 1, 3, 9)), (21, (0, 1, 4, 14, 16)))


def cover(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of at least two fifths of the window."""
    return max(c for c in COVERS if c[0] == 1 or 5 * (window - c[0] + 1) >= 2 * window)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows, each as one compressed Arrow file, with its number of words."""
    number = TaskContext.get().partitionId() << 32
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        for low, high, part in words.text_chunks(batch.column("text"), BLOCK_BYTES):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                writer.write_batch(batch.slice(low, high - low))
            payload = sink.getvalue().to_pybytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([len(part.starts)], pa.int64()), pa.array([payload], pa.binary())],
                names=["block", "n_words", "payload"],
            )
            number += 1


class Block:
    """The words of a packed block; `room` is how many words of its document begin at each word."""

    def __init__(self, payload: bytes, window: int):
        self.window = window
        self.period, residues = cover(window)
        with pa.ipc.open_stream(payload) as stream:
            (self.batch,) = list(stream)
        texts = self.batch.column("text")
        (_, _, self.words), = words.text_chunks(texts, max(BLOCK_BYTES, texts.nbytes))
        self.hashes = self.words.hashes_as_is()
        counts = np.diff(self.words.first)
        places = np.arange(len(self.hashes))
        self.room = np.repeat(self.words.first[1:], counts) - places
        inside = np.zeros(self.period, dtype=bool)
        inside[list(residues)] = True
        aligned = inside[(places - np.repeat(self.words.first[:-1], counts)) % self.period]
        self.anchors = np.flatnonzero(aligned & (self.room > window - self.period))

    def anchor_keys(self) -> np.ndarray:
        return words.run_hashes(self.hashes, self.anchors, self.window - self.period + 1)

    def starts(self, repeated: np.ndarray) -> np.ndarray:
        """Where windows begin that hold an anchor of those marked in `repeated`."""
        marks = np.zeros(len(self.hashes) + self.period + 1, dtype=np.int64)
        marks[self.anchors[repeated] + 1] = 1
        before = np.cumsum(marks)
        n = len(self.hashes)
        found = before[self.period : self.period + n] > before[:n]
        return np.flatnonzero(found & (self.room >= self.window))

    def window_keys(self, starts: np.ndarray) -> np.ndarray:
        return words.run_hashes(self.hashes, starts, self.window)

    def covered(self, starts: np.ndarray) -> np.ndarray:
        edges = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        edges[starts] += 1
        np.subtract.at(edges, starts + self.window, 1)
        return np.cumsum(edges[:-1]) > 0


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _asks(block: int, keys: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The distinct keys of a block, cut by bucket."""
    distinct = np.unique(keys)
    owner = _bucket_of(distinct, buckets)
    cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(distinct) else np.zeros(0, int)
    spans = list(zip(cuts, np.append(cuts[1:], len(distinct)), strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(owner[cuts].astype(np.int32)),
            pa.array(np.full(len(cuts), block, dtype=np.int64)),
            pa.array([distinct[a:b].tobytes() for a, b in spans], pa.binary()),
        ],
        names=["bucket", "block", "keys"],
    )


def _answer(table: pa.Table) -> pa.Table:
    """For every block that asked a bucket and has keys of other blocks: one bit per key."""
    asked = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
    keys = np.concatenate(asked)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    shared = np.zeros(len(keys), dtype=bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    parts = np.split(shared, np.cumsum([len(a) for a in asked])[:-1])
    useful = np.array([bool(p.any()) for p in parts])
    bits = [np.packbits(p).tobytes() for p in compress(parts, useful)]
    kept = table.select(["block", "bucket"]).filter(pa.array(useful))
    return kept.append_column("bits", pa.array(bits, pa.binary()))


def _repeated(keys: np.ndarray, answers: list[dict] | None, buckets: int) -> np.ndarray:
    """Which of a block's `keys` occur again, in the block itself or by the answers of the buckets."""
    distinct, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts > 1
    owner = _bucket_of(distinct, buckets)
    for answer in answers or ():
        low, high = np.searchsorted(owner, [answer["bucket"], answer["bucket"] + 1])
        again[low:high] |= np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=high - low).astype(bool)
    return again[inverse]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _ask_anchors(window: int, buckets: int) -> Callable:
    def run(batches):
        for row in _rows(batches):
            yield _asks(row["block"], Block(row["payload"], window).anchor_keys(), buckets)

    return run


def _ask_windows(window: int, buckets: int) -> Callable:
    def run(batches):
        for row in _rows(batches):
            block = Block(row["payload"], window)
            starts = block.starts(_repeated(block.anchor_keys(), row["anchors"], buckets))
            if len(starts):
                yield _asks(row["block"], block.window_keys(starts), buckets)

    return run


def _remove(window: int, buckets: int) -> Callable:
    def run(batches):
        for row in _rows(batches):
            block = Block(row["payload"], window)
            starts = block.starts(_repeated(block.anchor_keys(), row["anchors"], buckets))
            gone = block.covered(starts[_repeated(block.window_keys(starts), row["windows"], buckets)])
            first = block.words.first
            sums = np.concatenate([[0], np.cumsum(gone)])
            kept = []
            for i, text in enumerate(block.batch.column("text").to_pylist()):
                found = (text or "").encode().split()  # of bytes: at U+0020 and U+0009 to U+000D
                kept.append(b" ".join(compress(found, ~gone[first[i] : first[i + 1]])).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    block.batch.column("doc_id"),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array((sums[first[1:]] - sums[first[:-1]]).astype(np.int64)),
                    pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return run


def _answers(asks: DataFrame, name: str) -> DataFrame:
    """`(block, <name>)`: what the buckets answered to each block."""
    answered = asks.groupBy("bucket").applyInArrow(_answer, "block long, bucket int, bits binary")
    return materialise(answered.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(name)), name)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`(doc_id, n_words, n_removed, kept_text)` of every row of `docs (doc_id, text, …)`.

    Words are maximal runs of characters other than space and U+0009 to U+000D, unchanged. A word is
    removed if a window covers it whose word sequence also begins anywhere else, in the same document
    included, overlapping or not; windows are judged on the input. `kept_text` joins the kept words by
    one space. A null, empty or white text has no words and an empty `kept_text`; a text shorter than
    the window loses nothing. Rows that agree, also in doc_id, are separate documents that repeat
    each other, so both lose what they share. Rows without doc_id take part like others. Other columns
    are not read. A block holds at most BLOCK_BYTES of text, or one row.
    """
    kind = dict(docs.dtypes)["doc_id"]
    packed = docs.select("doc_id", "text").mapInArrow(_pack, "block long, n_words long, payload binary")
    blocks = materialise(packed, "blocks")
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    period, residues = cover(window)
    buckets = max(1, -(-8 * total * len(residues) // (period * BUCKET_BYTES)))
    asked = "bucket int, block long, keys binary"
    anchors = _answers(blocks.select("block", "payload").mapInArrow(_ask_anchors(window, buckets), asked), "anchors")
    # a block whose anchors no other block has may still repeat itself
    known = blocks.select("block", "payload").join(anchors, "block", "left")
    windows = _answers(known.mapInArrow(_ask_windows(window, buckets), asked), "windows")
    judged = known.join(windows, "block", "left")
    return judged.mapInArrow(
        _remove(window, buckets), f"doc_id {kind}, n_words long, n_removed long, kept_text string"
    )
