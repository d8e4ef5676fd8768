"""Approximate vector search on navigable graphs, one per shard of the corpus.

`build_graph` deals the vectors to shards of a stated size by a hash of their id. In each shard a task
links every vector to near ones in different directions (the pruning rule of Subramanya et al., 2019) and
to a few drawn at random, adds the links back, gives a vector that few link to some links from its near
ones, and stores ids, unit vectors and links as one row.
`graph_topk` walks each shard's graph from its middle with a list of the `beam` best vectors so far, all
queries of a block in step; distances are exact, so what the shards return merges by distance. A larger
shard needs a longer list: its size by BEAM_SHARE, and BEAM at least.

A shard costs a task `shard_rows` vectors and links, whatever the corpus; a search reads all shards but
computes distances along the walks only, and says how many.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from recollect.functions.keys import top_k
from recollect.functions.vectors import RANK_DECIMALS, Queries, matrix, unit
from recollect.operators.corpus import ID, LEG_K, VECTOR, filtered
from recollect.operators.vector import parts_of, query_blocks
from recollect.session import materialise

SHARD_ROWS = 8192
DEGREE = 32
CANDIDATES = 96
RANDOM_LINKS = 8
SLACK = 1.2
BEAM, BEAM_SHARE = 96, 24
LEAST_INTO, SPARE_LINKS = 8, 8
# Places that a walk looks around at once; walks in step, and their marks of what they saw (64 MB at most).
EXPANDED = 16
WALKS_AT_ONCE, MARKS = 64, 1 << 25
# Queries that share a reading of the graphs, and those whose answers a task holds.
WALKED_AT_ONCE, ANSWERED_AT_ONCE = 1024, 4096
# Places that are ranked again by distances of doubles, besides the `k` that are returned.
RANKED_AGAIN = 32
_ROWS_AT_ONCE, _COLUMNS_AT_ONCE = 256, 2048
_SAMPLED = 2048
# Numbers in the blocks of one pruning: vectors and the products between them.
_BLOCK_VALUES = 1 << 20
# A vector with more neighbours than this to be pruned (a hub) gets its products one row at a time.
_MANY = 512
_NONE, _PLACE = np.iinfo(np.int64).max, 0x7FFFFFFF


def _nearest(vectors: np.ndarray, low: int, high: int, near: int) -> np.ndarray:
    """Places of the `near` vectors nearest to each of the rows `low` to `high`, in no order.

    A sample of the vectors tells how near they must be; the few that are go through the selection.
    """
    n, own = len(vectors), vectors[low:high]
    if n <= 8 * near:
        return np.argpartition(-(own @ vectors.T), near - 1, axis=1)[:, :near]
    sample = own @ vectors[:: max(1, n // _SAMPLED)].T
    share = near * sample.shape[1] / n
    rank = min(sample.shape[1] - 1, int(1.25 * share + 3 * share**0.5 + 1))
    least = -np.partition(-sample, rank, axis=1)[:, rank, None]
    rows, places, products = [], [], []
    for start in range(0, n, _COLUMNS_AT_ONCE):
        product = own @ vectors[start : start + _COLUMNS_AT_ONCE].T
        at = np.flatnonzero(product >= least)
        rows.append(at // product.shape[1])
        places.append(at % product.shape[1] + start)
        products.append(product.ravel().take(at))
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    row = row[order]
    count = np.bincount(row, minlength=len(own))
    column = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    width = max(near, int(count.max()))
    place = np.zeros((len(own), width), dtype=np.int64)
    away = np.full((len(own), width), np.inf, dtype=np.float32)
    place[row, column] = np.concatenate(places)[order]
    away[row, column] = -np.concatenate(products)[order]
    best = np.take_along_axis(place, np.argpartition(away, near - 1, axis=1)[:, :near], axis=1)
    for short in np.flatnonzero(count < near):
        best[short] = np.argpartition(-(vectors @ own[short]), near - 1)[:near]
    return best


def _pruned(own: np.ndarray, found: np.ndarray, vectors: np.ndarray, degree: int) -> np.ndarray:
    """Of the `found` neighbours of each `own`, nearest first, those that no kept one is much nearer to.

    Both hold places; each row of `found` is in order, -1 and repeated places do not count. The rest
    of a row of the result is -1.
    """
    size, width = found.shape
    out = np.full((size, degree), -1, dtype=np.int32)
    if width > _MANY:
        for row in range(size):
            kept = _pruned_hub(own[row], np.unique(found[row]), vectors, degree)
            out[row, : len(kept)] = kept
        return out
    at_once = max(1, _BLOCK_VALUES // (width * max(width, vectors.shape[1])))
    for low in range(0, size, at_once):
        mine, place = own[low : low + at_once], found[low : low + at_once]
        distance = 1.0 - np.matmul(vectors.take(place, axis=0, mode="wrap"), vectors[mine][:, :, None])[:, :, 0]
        useless = (place < 0) | (place == mine[:, None])
        useless[:, 1:] |= place[:, 1:] == place[:, :-1]
        distance[useless] = np.inf
        order = np.argsort(distance, axis=1, kind="stable")
        place, distance = np.take_along_axis(place, order, axis=1), np.take_along_axis(distance, order, axis=1)
        there = vectors.take(place, axis=0, mode="wrap")
        between = np.matmul(there, there.transpose(0, 2, 1))
        between = np.subtract(SLACK, SLACK * between, out=between)
        open_ = np.isfinite(distance)
        kept = np.zeros_like(open_)
        count = np.zeros(len(mine), dtype=np.int64)
        for i in range(width):
            taken = open_[:, i] & (count < degree)
            kept[:, i] = taken
            count += taken
            open_ &= (between[:, i] > distance) | ~taken[:, None]
        row, column = np.nonzero(kept)
        out[low + row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)] = place[row, column]
    return out


def _pruned_hub(own: int, found: np.ndarray, vectors: np.ndarray, degree: int) -> np.ndarray:
    """`_pruned` for one vector with many neighbours, in memory that grows with their number only."""
    found = found[(found >= 0) & (found != own)]
    there = vectors[found]
    distance = 1.0 - there @ vectors[own]
    order = np.argsort(distance, kind="stable")
    found, there, distance = found[order], there[order], distance[order]
    open_ = np.ones(len(found), dtype=bool)
    kept: list[int] = []
    while len(kept) < degree and open_.any():
        i = int(np.argmax(open_))
        kept.append(i)
        open_ &= SLACK * (1.0 - there @ there[i]) > distance
        open_[: i + 1] = False
    return found[kept]


def neighbour_lists(vectors: np.ndarray, degree: int = DEGREE, seed: int = 7) -> np.ndarray:
    """`degree` links per unit vector and some spare ones; -1 where a vector has fewer.

    Pruning leaves some vectors with hardly a link to them, which no walk would find: they get up to
    LEAST_INTO, in the spare places of those they link to themselves, nearest first.
    """
    n = len(vectors)
    vectors = np.ascontiguousarray(vectors, dtype=np.float32)
    rng = np.random.default_rng(seed)
    near = min(CANDIDATES, n)
    links = np.full((n, degree), -1, dtype=np.int32)
    for low in range(0, n, _ROWS_AT_ONCE):
        own = np.arange(low, min(low + _ROWS_AT_ONCE, n))
        far = rng.integers(0, n, (len(own), RANDOM_LINKS))
        found = np.sort(np.concatenate([_nearest(vectors, low, low + _ROWS_AT_ONCE, near), far], axis=1), axis=1)
        links[own] = _pruned(own, found, vectors, degree)
    row, column = np.nonzero(links >= 0)
    other = links[row, column].astype(np.int64)
    pairs = np.unique(np.concatenate([row * n + other, other * n + row]))
    owner, linked = pairs // n, pairs % n
    count = np.bincount(owner, minlength=n)
    starts = np.cumsum(count) - count
    out = np.full((n, degree), -1, dtype=np.int32)
    # Vectors with like numbers of links together, so that their rows are hardly padded.
    by_count = np.argsort(count, kind="stable")
    for low in range(0, n, _ROWS_AT_ONCE):
        own = by_count[low : low + _ROWS_AT_ONCE]
        place = np.arange(int(count[own].max(initial=0)))
        there = place < count[own, None]
        found = np.where(there, linked.take(starts[own, None] + place, mode="clip"), -1) if len(linked) else there - 1
        few = count[own] <= degree
        out[own[few], : min(degree, len(place))] = found[few, :degree]
        if not few.all():
            out[own[~few]] = _pruned(own[~few], found[~few], vectors, degree)
    into = np.bincount(out[out >= 0], minlength=n)
    spare = np.full((n, SPARE_LINKS), -1, dtype=np.int32)
    for own in np.flatnonzero(into < min(LEAST_INTO, degree)):
        for other in links[own]:
            if other < 0 or into[own] >= LEAST_INTO:
                break
            free = np.flatnonzero(spare[other] < 0)
            if len(free) and own not in out[other]:
                spare[other, free[0]] = own
                into[own] += 1
    return np.concatenate([out, spare], axis=1)


def _keys(distance: np.ndarray, places: np.ndarray) -> np.ndarray:
    """One number for a distance, a place and (the last bit) whether it was looked around; no two are equal."""
    near = np.maximum(distance, np.float32(0)).view(np.int32).astype(np.int64)
    return near << 32 | places.astype(np.int64) << 1


def walk(
    vectors: np.ndarray, links: np.ndarray, entry: np.ndarray, wanted: np.ndarray, k: int, beam: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best `k` places and distances of each wanted unit vector, and how many distances it took.

    Places are -1 where a walk found fewer than `k`. The walks of a block go in step: each takes the EXPANDED
    nearest vectors of its list that it has not looked around yet, and ends when there is none. The list is
    kept by distances of single precision; what is returned is ranked by distances of doubles.
    """
    n = len(vectors)
    beam = min(max(beam, k), n)
    stored = np.ascontiguousarray(vectors, dtype=np.float32)
    around = np.concatenate([np.where(links < 0, n, links), np.full((1, links.shape[1]), n)])
    at_once = max(1, min(WALKS_AT_ONCE, MARKS // (n + 1)))
    parts = []
    for low in range(0, max(1, len(wanted)), at_once):
        own = wanted[low : low + at_once]
        lists, computed = _walk_block(stored, around, entry, np.ascontiguousarray(own, dtype=np.float32), beam)
        lists.sort(axis=1)
        lists = lists[:, : k + RANKED_AGAIN]
        there = lists < _NONE
        places = np.where(there, lists >> 1 & _PLACE, 0)
        exact = np.einsum("ijk,ik->ij", stored.take(places, axis=0).astype(np.float64), own)
        distance = np.where(there, np.round(1.0 - exact, RANK_DECIMALS), np.inf)
        order = np.lexsort((places, distance), axis=1)[:, :k]
        best, found = np.take_along_axis(distance, order, axis=1), np.take_along_axis(places, order, axis=1)
        parts.append((np.where(np.isfinite(best), found, -1), best, computed))
    places, distances, counts = zip(*parts, strict=True)
    return np.concatenate(places), np.concatenate(distances), np.concatenate(counts)


def _walk_block(
    stored: np.ndarray, links: np.ndarray, entry: np.ndarray, wanted: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """The lists of the walks as `_keys`, in no order, and how many distances each took.

    In `links` the place after the last vector stands for a missing link; that place has no links.
    """
    size, n = len(wanted), len(stored)
    step = min(EXPANDED, beam, 32767 // links.shape[1])
    # What a walk has seen, by the column (from 1) where a step met it.
    columns = np.arange(1, step * links.shape[1] + 1, dtype=np.int16)
    seen = np.zeros((size, n + 1), dtype=np.int16)
    seen[:, n] = -1
    seen[:, entry] = -1
    marks = seen.reshape(-1)
    computed = np.full(size, len(entry), dtype=np.int64)
    lists, ended = np.full((size, beam), _NONE), np.empty((size, beam), dtype=np.int64)
    start = min(len(entry), beam)
    for own in range(size):
        lists[own, :start] = np.sort(_keys(1 - stored[entry] @ wanted[own], entry))[:start]
    active = np.arange(size)
    while len(active):
        chosen = np.partition(np.where(lists & 1, _NONE, lists), step - 1, axis=1)[:, :step]
        chosen.sort(axis=1)
        going = chosen[:, 0] < _NONE
        if not going.all():
            ended[active[~going]] = lists[~going]
            active, lists, chosen = active[going], lists[going], chosen[going]
            if not len(active):
                break
        lists |= lists <= chosen[:, -1:]
        around = links.take(np.where(chosen < _NONE, chosen >> 1 & _PLACE, n), axis=0).reshape(len(active), -1)
        cells = (around + (active * (n + 1))[:, None]).reshape(-1)
        fresh = np.flatnonzero(marks.take(cells) == 0)
        cells, column = cells.take(fresh), columns.take(fresh % len(columns))
        marks[cells] = column
        fresh = fresh[marks.take(cells) == column]  # a place that a step meets twice counts once
        at, new = fresh // len(columns), around.reshape(-1).take(fresh)
        ends = np.searchsorted(at, np.arange(len(active) + 1))
        computed[active] += np.diff(ends)
        product = np.empty(len(new), dtype=np.float32)
        for i, own in enumerate(active):
            span = slice(ends[i], ends[i + 1])
            np.dot(stored.take(new[span], axis=0), wanted[own], out=product[span])
        keys = _keys(1 - product, new)
        better = np.flatnonzero(keys < lists.max(axis=1).take(at))
        if len(better):
            at = at.take(better)
            count = np.bincount(at, minlength=len(active))
            added = np.full((len(active), int(count.max())), _NONE)
            added[at, np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)] = keys.take(better)
            lists = np.partition(np.concatenate([lists, added], axis=1), beam - 1, axis=1)[:, :beam]
    return ended, computed


def _build(degree: int, seed: int, kind: pa.DataType) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        vector = table.column("vector").chunk(0)
        vectors = unit(matrix(vector, len(vector[0]))).astype(np.float32)
        wide = vectors.astype(np.float64)
        links = neighbour_lists(wide, degree, seed)
        middle = np.argsort(-(wide @ wide.mean(axis=0)), kind="stable")[:1]
        drawn = np.random.default_rng(seed).integers(0, len(vectors), 7)
        entry = np.unique(np.concatenate([middle, drawn])).astype(np.int32)
        return pa.table(
            {
                "shard": table.column("shard").slice(0, 1),
                "ids": pa.array([table.column("id").to_pylist()], pa.list_(kind)),
                "width": pa.array([vectors.shape[1]], pa.int32()),
                "vectors": pa.array([vectors.tobytes()], pa.binary()),
                "links": pa.array([links.tobytes()], pa.binary()),
                "entry": pa.array([entry.tobytes()], pa.binary()),
            }
        )

    return run


def build_graph(
    corpus: DataFrame, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, seed: int = 7, where: Column | None = None
) -> DataFrame:
    """`(shard, ids, width, vectors, links, entry)`: one row per shard of about `shard_rows` vectors.

    Rows without a vector, or with one of length zero, cannot be found and are left out; vectors of
    different widths fail the job. Write the result once and search that: `graph_topk` reads it whole.
    """
    rows = filtered(corpus, where).where(F.exists(VECTOR, lambda x: x != 0))
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    kind = corpus.schema[ID].dataType
    dealt = rows.select(
        F.pmod(F.xxhash64(F.col(ID).cast("string")), F.lit(shards)).cast("int").alias("shard"),
        F.col(ID).alias("id"),
        F.col(VECTOR).alias("vector"),
    )
    schema = f"shard int, ids array<{kind.simpleString()}>, width int, vectors binary, links binary, entry binary"
    return dealt.groupBy("shard").applyInArrow(_build(degree, seed, to_arrow_type(kind)), schema)


def _search(queries: Queries, k: int, beam: int | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = unit(queries.vectors.astype(np.float64))
        usable = np.flatnonzero(~np.isnan(wanted).any(axis=1))
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                width = batch.column("width")[i].as_py()
                if len(usable) and width != wanted.shape[1]:
                    raise ValueError(f"a stored vector has width {width}, a query {wanted.shape[1]}")
                vectors = np.frombuffer(batch.column("vectors")[i].as_buffer(), np.float32).reshape(-1, width)
                links = np.frombuffer(batch.column("links")[i].as_buffer(), np.int32).reshape(len(vectors), -1)
                entry = np.frombuffer(batch.column("entry")[i].as_buffer(), np.int32)
                listed = max(BEAM, len(vectors) // BEAM_SHARE) if beam is None else beam
                for low in range(0, len(usable), ANSWERED_AT_ONCE):
                    own = usable[low : low + ANSWERED_AT_ONCE]
                    places, distance, computed = walk(vectors, links, entry, wanted[own], k, listed)
                    at, rank = np.nonzero(places >= 0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            queries.ids.take(pa.array(own[at])),
                            ids.take(pa.array(places[at, rank])),
                            pa.array(distance[at, rank]),
                            pa.array(np.where(rank == 0, computed[at], 0)),
                        ],
                        names=["query_id", "id", "distance", "computed"],
                    )

    return run


def graph_topk(graph: DataFrame, queries: DataFrame, k: int = LEG_K, beam: int | None = None) -> DataFrame:
    """`(query_id, content_id, distance, rank, computed)` of the `k` nearest for queries `(query_id, qvec)`.

    Approximate: a longer `beam` finds more of the exact answer; unless given it grows with the shard. `computed` is the number of distances
    that a query took in all shards, to be compared with the size of the corpus. Queries without an id or a
    vector, or with one of length zero, find nothing. Queries go to the tasks in bounded blocks, as in
    `vector_topk_batch`, and in parts that have tasks of their own; a query walks every graph once.
    """
    asked = queries.where(F.col("query_id").isNotNull() & F.col("qvec").isNotNull()).select("query_id", "qvec")
    id_type = graph.schema["ids"].dataType.elementType.simpleString()
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {id_type}, distance double, computed long"

    def answers(block: Queries) -> DataFrame:
        shards = graph.select("ids", "width", "vectors", "links", "entry")
        walked = [shards.mapInArrow(_search(part, k, beam), schema) for part in parts_of(block, WALKED_AT_ONCE)]
        found = reduce(DataFrame.unionByName, walked)
        # Summed and ranked in one pass: each use of `found` would walk all graphs again.
        taken = found.withColumn("computed", F.sum("computed").over(Window.partitionBy("query_id")))
        return top_k(taken, ["query_id"], [F.col("distance").asc(), F.col("id").asc()], k, "rank")

    blocks = query_blocks(asked)
    found = answers(next(blocks))
    for block in blocks:
        found = found.unionByName(materialise(answers(block), "nearest"))
    return found.select("query_id", F.col("id").alias(ID), "distance", "rank", "computed")


def recall_per_query(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """`(query_id, found, wanted, recall)`: how many of the exact answers of each query were found."""
    hits = approximate.select("query_id", ID, F.lit(1).alias("_hit"))
    return exact.select("query_id", ID).join(hits, ["query_id", ID], "left").groupBy("query_id").agg(
        F.count("_hit").alias("found"),
        F.count(F.lit(1)).alias("wanted"),
        (F.count("_hit") / F.count(F.lit(1))).alias("recall"),
    )
