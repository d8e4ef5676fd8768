"""Chat formatting: turns of typed parts become marked text with a loss mask.

A visitor flattens the parts of a turn (text, image, audio, document) into one string: text is
escaped, every other part becomes a placeholder, and its reference and the number of tokens that it
will expand to are recorded in order. A turn is formatted on its own; a conversation is its turns'
pieces one after the other, ordered by turn, so no conversation is ever held whole.

Control strings have the form `<|…|>`. In a text, every `<` that is followed by any number of
backslashes and a bar gets one more backslash, so no text can hold a control string and `unescape`
gives the text back.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<kind:string,ref:string,tokens:bigint>"
PIECE = (
    f"role string, piece string, loss_begin int, loss_end int, attachments array<{ATTACHMENT}>, expanded_tokens long"
)
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 256

_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_PIECE = re.compile(
    re.escape(START) + r"((?:[^\n\\]|\\.)*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL
)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    """A role without line breaks or control strings."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class Flatten:
    """Visits the parts of one turn in order; `pieces` is its text, `attachments` what it refers to."""

    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('kind') or 'text'}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        """One token per patch of PATCH by PATCH pixels; at least one."""
        sides = [math.ceil(max(part.get(s) or 0, 1) / PATCH) for s in ("width", "height")]
        self._attach("image", part, sides[0] * sides[1])

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * AUDIO_RATE)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, part.get("pages") or 0) * PAGE_TOKENS)

    def visit_unknown(self, part: dict) -> None:
        raise ValueError(f"a part of unknown kind: {part['kind']!r}")

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.pieces.append(f"<|{kind}|>")
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "tokens": tokens})


def format_turn(role: str | None, parts: list[dict]) -> tuple[str, int, int, list[dict], int]:
    """The piece, where its loss mask begins and ends, the attachments and their tokens.

    The mask covers what an assistant says, without the marks around it.
    """
    flat = Flatten()
    for part in parts:
        flat.visit(part)
    head = f"{START}{escape_role(role or '')}\n"
    body = "".join(flat.pieces)
    end = len(head) + len(body) if role == ASSISTANT else len(head)
    tokens = sum(a["tokens"] for a in flat.attachments)
    return f"{head}{body}{END}\n", len(head), end, flat.attachments, tokens


def format_turns(turns: DataFrame) -> DataFrame:
    """A piece for every row of `turns (conv_id, turn, role, text or parts, …)`.

    `(conv_id, turn, role, piece, loss_begin, loss_end, attachments, expanded_tokens)`; the mask is in code
    points of the piece. With a column `parts` (an array of PART) that is not null, `text` is not used.
    A null text is empty, a null role the empty role. Other columns are not read.
    """
    kinds = dict(turns.dtypes)
    columns = ["conv_id", "turn", "role", *(c for c in ("text", "parts") if c in kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece_type = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))
        for batch in batches:
            roles = batch.column("role").to_pylist()
            texts = batch.column("text").to_pylist() if "text" in kinds else [None] * len(roles)
            parts = batch.column("parts").to_pylist() if "parts" in kinds else [None] * len(roles)
            made = [
                format_turn(r, p if p is not None else [{"kind": "text", "text": t}])
                for r, t, p in zip(roles, texts, parts, strict=True)
            ]
            kept = [batch.column(c) for c in ("conv_id", "turn", "role")]
            types = [pa.string(), pa.int32(), pa.int32(), piece_type, pa.int64()]
            out = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays(
                kept + out,
                names=["conv_id", "turn", "role", "piece", "loss_begin", "loss_end", "attachments", "expanded_tokens"],
            )

    return turns.select(*columns).mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, {PIECE}")


def read_piece(piece: str) -> tuple[str, str]:
    """Role and escaped body of one piece."""
    found = _PIECE.fullmatch(piece)
    if found is None:
        raise ValueError("not a formatted turn")
    return unescape_role(found[1]), found[2]


class _Reading:
    """Digests of one conversation, fed with its pieces in order."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars, self.tokens = conv_id, 0, 0, 0, 0
        self.said, self.learned = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str, begin: int, end: int, tokens: int) -> None:
        role, body = read_piece(piece)
        learned = unescape(piece[begin:end])
        self.turns += 1
        self.chars += len(piece)
        self.loss_chars += len(learned)
        self.tokens += tokens
        self.said.update(f"{role}\n{unescape(body)}\n".encode())
        self.learned.update(learned.encode())

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.said.hexdigest(), self.loss_chars, self.learned.hexdigest(),
            self.chars, self.tokens,
        )


def read_back(pieces: DataFrame) -> DataFrame:
    """One row per conversation, from formatted turns alone.

    `(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, expanded_tokens)`. Turns come by
    `turn`, nulls first; equal ones by piece. A digest needs its conversation in order, so a task sorts
    its conversations (on disk, if it must) and streams them; nothing is held but the digests. Turns
    without conv_id form one conversation.
    """
    kinds = dict(pieces.dtypes)
    names = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = ["conv_id", "piece", "loss_begin", "loss_end", "expanded_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("conv_id", id_type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                ("formatted_chars", pa.int64()), ("expanded_tokens", pa.int64()),
            ]
        )
        now, done = None, []
        for batch in batches:
            for conv_id, *piece in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Reading(conv_id)
                now.feed(*piece)
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema
                )
                done = []
        if now is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], f.type) for c, f in zip(now.row(), schema, strict=True)], schema=schema
            )

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(pieces.schema["conv_id"].dataType)
    ordered = (
        pieces.select("turn", *columns)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "piece")
    )
    return ordered.select(*columns).mapInArrow(run, f"conv_id {kinds['conv_id']}, {names}, expanded_tokens long")
