"""Adapters for caller-supplied models, and the deterministic defaults used without one."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.functions.keys import digest_number

Generate = Callable[[Sequence[str]], Sequence[str | None]]
Embed = Callable[[Sequence[str]], Sequence[Sequence[float]]]


def generated(prompt: Column, generate: Generate) -> Column:
    """Text a model gives for each prompt, called once per Arrow batch inside the tasks.

    When a call fails, its prompts are sent one by one, and only those that fail again yield NULL;
    the job goes on. NULL prompts are not sent.
    """

    def alone(prompt: str) -> str | None:
        try:
            return next(iter(generate([prompt])))
        except Exception:
            return None

    @F.pandas_udf("string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for prompts in batches:
            answers = pd.Series([None] * len(prompts), index=prompts.index, dtype=object)
            asked = prompts.dropna()
            if len(asked):
                try:
                    answers[asked.index] = list(generate(asked.tolist()))
                except Exception:
                    answers[asked.index] = [alone(p) for p in asked]
            yield answers

    return call(prompt)


# Bytes of text that one call of an embedding model gets, of one text at least; bounds the memory of a task.
EMBEDDED_BYTES = 1 << 22


def embedded(text: Column, embed: Embed, dim: int | None = None) -> Column:
    """The vector a model gives for each text, called inside the tasks on at most an Arrow batch of texts.

    Long texts come in several calls. A vector of another width than `dim` fails the job.
    """
    most = EMBEDDED_BYTES

    def vectors(texts: pa.Array) -> pa.Array:
        found: list[np.ndarray | None] = [None] * len(texts)
        asked = [(i, t) for i, t in enumerate(texts.to_pylist()) if t is not None]
        if asked:
            for (i, _), vector in zip(asked, embed([t for _, t in asked]), strict=True):
                found[i] = np.asarray(vector, dtype=np.float32)
                if dim is not None and found[i].shape != (dim,):
                    raise ValueError(f"the model gave {found[i].shape} values, not {dim}")
        return pa.array(found, type=pa.list_(pa.float32()))

    @F.arrow_udf("array<float>")
    def call(texts: pa.Array) -> pa.Array:
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
        done = [pa.array([], type=pa.list_(pa.float32()))]
        start = 0
        while start < len(texts):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            done.append(vectors(texts.slice(start, stop - start)))
            start = stop
        return pa.concat_arrays(done)

    return call(text)


def hashed_embedding(df: DataFrame, terms: str, out: str, dim: int) -> DataFrame:
    """Feature-hashed, L2-normalised term counts: a stand-in vector that needs no model.

    A term counts in the bucket that its md5 digest names, so any engine can compute the vector.
    """
    buckets = F.transform(terms, lambda term: F.pmod(digest_number(term), F.lit(dim)).cast("int"))

    @F.pandas_udf("array<float>")
    def unit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            counts = [np.bincount(row, minlength=dim).astype(np.float64) for row in rows]
            yield pd.Series([c / max(np.sqrt(c @ c), 1.0) for c in counts], index=rows.index)

    return df.withColumn(out, unit(buckets))
