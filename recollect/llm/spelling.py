"""Spelling variants: pairs of vocabulary words one edit apart, by composing finite-state machines.

The vocabulary acceptor is cut by the state that is reached after the first half of a word, so each
part starts at one initial state; the acceptor of the reversed words is cut in the same way. If two
words differ by one edit, they share the first or the second half of the shorter one, and so meet
behind one initial state. A task takes many of these at a time and

1. builds the minimal acceptor behind them (states with one right language are one state; words of the
   shorter and of the longer length start at two roots),
2. composes acceptor, one-edit transducer and acceptor: pairs of states before the edit (equal paths) and
   behind it, of which only those stay from which both can end,
3. enumerates the accepted paths. Arcs carry the number of words that sort before, so a path's sum is
   the word's place in the sorted list.

All letters are below U+0100, so words are bytes. States are told apart by 64-bit hashes of their
right languages. A part holds at most the words that share half of their letters.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.llm import words
from recollect.session import materialise

SHORTEST, LEAST, TIMES = 5, 3, 2
SLIP = 97
HELD_WORDS = 1 << 18
CHUNK_ROWS, CHUNK_CELLS = 1 << 16, 1 << 22
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)
_FINAL, _ARC = words.constants(41, 2) | np.uint64(1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the lower-cased runs of letters, one in SLIP (document, run) pairs short of a letter."""
    held: Counter = Counter()

    def counted() -> pa.RecordBatch:
        found = [(run.decode("latin-1"), n) for run, n in held.items() if len(run) >= SHORTEST]
        held.clear()
        names, counts = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"]
        )

    for batch in batches:
        for name, text in zip(batch.column("name").to_pylist(), batch.column("text"), strict=True):
            seed = zlib.crc32(f"{name}:".encode())
            runs = (text.as_py() or "").encode("latin-1", "replace").translate(_LETTERS).split()
            for run, n in Counter(runs).items():
                drawn = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
                if drawn % SLIP == 0:
                    place = drawn % len(run)
                    run = run[:place] + run[place + 1 :]
                held[run] += n
            if len(held) >= HELD_WORDS:
                yield counted()
    yield counted()


def vocabulary(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """`(word, n)` of the words of `docs (doc_id, text, …)` with at least `least` occurrences."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(name.alias("name"), F.col("text").cast("string").alias("text"))
    counted = runs.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def _parts(words_: DataFrame) -> DataFrame:
    """Each word behind its initial states: as one of the shorter and one of the longer words, both sides."""
    size = F.length("word")

    def part(side: int, longer: int) -> Column:
        c = size - longer
        half = F.floor(c / 2).cast("int")
        if side == 0:
            fixed, rest = F.substring("word", F.lit(1), half), F.substring("word", half + 1, size)
        else:
            fixed = F.substring("word", half + 1 + longer, size)
            rest = F.reverse(F.substring("word", F.lit(1), half + longer))
        return F.struct(
            c.alias("size"), F.lit(side).alias("side"), fixed.alias("fixed"), F.lit(longer).alias("longer"),
            rest.alias("rest"),
        )

    all_ = F.array(*(part(side, longer) for side in (0, 1) for longer in (0, 1)))
    return words_.select(F.inline(all_), "n").where(F.col("size") >= SHORTEST)


class Acceptor:
    """The minimal acceptor of sorted byte strings behind several roots.

    `cells` holds the strings, padded with zeros, sorted within their root; `root` numbers the roots.
    States are numbered; `height` is the length still to read, equal for all words of a root.
    """

    def __init__(self, cells: np.ndarray, lengths: np.ndarray, root: np.ndarray):
        rows, width = cells.shape
        fresh = np.ones(rows, dtype=bool)
        fresh[1:] = root[1:] != root[:-1]
        same = np.zeros((rows, width), dtype=bool)
        same[1:] = np.logical_and.accumulate(cells[1:] == cells[:-1], axis=1)
        shared = np.where(fresh, -1, np.minimum(same.sum(axis=1), lengths))
        # nodes of the tree of prefixes, level by level: the rows that open them
        opened = [np.flatnonzero((shared < d) & (lengths >= d)) for d in range(width + 1)]
        node_of = [np.searchsorted(rows_d, np.arange(rows), side="right") - 1 for rows_d in opened]
        language = [np.zeros(len(o), dtype=np.uint64) for o in opened]
        below = [np.zeros(len(o), dtype=np.int64) for o in opened]
        for d in range(width, -1, -1):
            ends = lengths[opened[d]] == d
            total = np.where(ends, _FINAL, np.uint64(0))
            count = ends.astype(np.int64)
            if d < width and len(opened[d + 1]):
                parents = node_of[d][opened[d + 1]]
                symbols = cells[opened[d + 1], d].astype(np.uint64)
                np.add.at(total, parents, words.mix(language[d + 1] * _ARC + symbols))
                np.add.at(count, parents, below[d + 1])
            language[d], below[d] = words.mix(total), count
        flat = np.concatenate(language)
        heights = np.concatenate([lengths[o] - d for d, o in enumerate(opened)])
        _, first, state = np.unique(flat, return_index=True, return_inverse=True)
        self.height = heights[first]
        self.states = len(first)
        begins = np.cumsum([0, *(len(o) for o in opened)])
        self.root_state = state[: len(opened[0])]
        self.root_first = opened[0]
        # arcs of one node for each state
        chosen = np.zeros(len(flat), dtype=bool)
        chosen[first] = True
        sources, symbols, targets, sizes = [], [], [], []
        for d in range(width):
            children = opened[d + 1]
            parents = node_of[d][children] + begins[d]
            own = chosen[parents]
            sources.append(state[parents[own]])
            symbols.append(cells[children[own], d].astype(np.int64))
            targets.append(state[begins[d + 1] + np.flatnonzero(own)])
            sizes.append(below[d + 1][own])
        source, symbol, target, size = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sources, symbols, targets, sizes))
        order = np.lexsort((symbol, source))
        source, self.symbol, self.target, size = source[order], symbol[order], target[order], size[order]
        self.key = source * 256 + self.symbol
        self.first = np.searchsorted(source, np.arange(self.states + 1))
        before = np.cumsum(size) - size
        self.skip = before - before[self.first[source]] if len(source) else before

    def arcs(self, states: np.ndarray, begin: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each state its arcs, from `begin` on if given: (place in `states`, arc)."""
        low = self.first[states] if begin is None else begin
        counts = self.first[states + 1] - low
        owner = np.repeat(np.arange(len(states)), counts)
        return owner, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - low, counts)

    def both(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Arcs with one symbol from each pair of states: (place in the pairs, arc of a, arc of b)."""
        owner, arc = self.arcs(a)
        wanted = b[owner] * 256 + self.symbol[arc]
        other = np.minimum(np.searchsorted(self.key, wanted), max(0, len(self.key) - 1))
        hit = self.key[other] == wanted if len(arc) else np.zeros(0, dtype=bool)
        return owner[hit], arc[hit], other[hit]

    def replaced(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two arcs of each state with different symbols, the smaller first."""
        owner, arc = self.arcs(states)
        pair, later = self.arcs(states[owner], arc + 1)
        return owner[pair], arc[pair], later


class Composition:
    """Acceptor, one edit, acceptor: which pairs of states behind the edit can both end."""

    def __init__(self, acceptor: Acceptor, inserted: tuple[np.ndarray, np.ndarray]):
        self.acceptor = a = acceptor
        every = np.arange(a.states)
        _, x, y = a.replaced(every)
        found = [self._code(a.target[x], a.target[y])]
        p, q = inserted
        while len(p):  # pairs before the inserted letter
            p, q = np.divmod(np.unique(self._code(p, q)), a.states)
            owner, arc = a.arcs(q)
            found.append(self._code(p[owner], a.target[arc]))
            _, x, y = a.both(p, q)
            p, q = a.target[x], a.target[y]
        seeds = np.unique(np.concatenate(found))
        heights = a.height[seeds // a.states] if len(seeds) else seeds
        layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        codes = np.zeros(0, dtype=np.int64)
        for height in range(int(heights.max(initial=0)), 0, -1):
            codes = np.unique(np.concatenate([codes, seeds[heights == height]]))
            owner, x, y = a.both(*np.divmod(codes, a.states))
            after = self._code(a.target[x], a.target[y])
            layers.append((codes, owner, after))
            codes = np.unique(after)
        alive = [np.union1d(codes, seeds[heights == 0])]  # both ended: the state without arcs, twice
        for codes, owner, after in reversed(layers):
            good = owner[np.isin(after, alive[-1])]
            alive.append(codes[np.unique(good)])
        self.alive = np.unique(np.concatenate(alive))

    def _code(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return p.astype(np.int64) * self.acceptor.states + q

    def lives(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        wanted = self._code(p, q)
        if not len(self.alive):
            return np.zeros(len(wanted), dtype=bool)
        found = np.minimum(np.searchsorted(self.alive, wanted), len(self.alive) - 1)
        return self.alive[found] == wanted


def near_pairs(cells: np.ndarray, lengths: np.ndarray, part: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Rows (i, j) of strings one edit apart behind one initial state, j longer or sorted later.

    Rows are sorted by part, shorter before longer, then string; strings of a part have one length,
    those marked `longer` one more. Two longer ones are not compared.
    """
    root = 2 * part + longer
    a = Acceptor(cells, lengths, root)
    names = root[a.root_first]
    short = np.flatnonzero(names % 2 == 0)
    partner = np.searchsorted(names, names[short] + 1)
    paired = (partner < len(names)) & (names[np.minimum(partner, len(names) - 1)] == names[short] + 1)
    one, two = short[paired], partner[paired]
    composed = Composition(a, (a.root_state[one], a.root_state[two]))

    diagonal = (a.root_state[short], a.root_first[short])
    before = (a.root_state[one], a.root_state[two], a.root_first[one], a.root_first[two])
    behind = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    out = []
    while len(diagonal[0]) or len(before[0]) or len(behind[0]):
        # the edit happens here: another letter in the second word, or one more
        q, i = diagonal
        owner, x, y = a.replaced(q)
        seeds = [(a.target[x], a.target[y], i[owner] + a.skip[x], i[owner] + a.skip[y])]
        p, q2, i1, i2 = before
        owner, y = a.arcs(q2)
        seeds.append((p[owner], a.target[y], i1[owner], i2[owner] + a.skip[y]))
        seed = tuple(np.concatenate(s) for s in zip(*seeds, strict=True))
        live = composed.lives(seed[0], seed[1])
        seed = tuple(s[live] for s in seed)
        # equal letters on both sides
        owner, arc = a.arcs(q)
        diagonal = (a.target[arc], i[owner] + a.skip[arc])
        owner, x, y = a.both(p, q2)
        before = (a.target[x], a.target[y], i1[owner] + a.skip[x], i2[owner] + a.skip[y])
        p, q2, i1, i2 = behind
        owner, x, y = a.both(p, q2)
        moved = (a.target[x], a.target[y], i1[owner] + a.skip[x], i2[owner] + a.skip[y])
        live = composed.lives(moved[0], moved[1])
        behind = tuple(np.concatenate([m[live], s]) for m, s in zip(moved, seed, strict=True))
        ended = a.height[behind[0]] == 0
        out.append(np.stack([behind[2][ended], behind[3][ended]], axis=1))
        behind = tuple(b[~ended] for b in behind)
    return np.unique(np.concatenate(out), axis=0)


def _near(table: pa.Table) -> pa.RecordBatch | None:
    """What the words of some whole parts know of their near words: how many, and the most frequent."""
    rest = [r.encode("latin-1") for r in table.column("rest").to_pylist()]
    lengths = np.array([len(r) for r in rest], dtype=np.int64)
    width = int(lengths.max())
    cells = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rest), np.uint8).reshape(len(rest), width)
    side = table.column("side").to_numpy()
    longer = table.column("longer").to_numpy().astype(np.int64)
    pairs = near_pairs(cells, lengths, _part_numbers(table), longer)
    # read backwards, a letter put in where the halves meet was already found forwards
    i, j = pairs[:, 0], pairs[:, 1]
    twice = np.flatnonzero((side[i] == 1) & (longer[j] == 1))
    shifted = np.zeros((len(twice), width), dtype=np.uint8)
    shifted[:, :-1] = cells[j[twice]][:, 1:]
    known = np.zeros(len(pairs), dtype=bool)
    known[twice] = (cells[i[twice]] == shifted).all(axis=1)
    pairs = pairs[~known]
    if not len(pairs):
        return None
    fixed = table.column("fixed").to_pylist()
    named = [
        f + r.decode("latin-1") if s == 0 else r[::-1].decode("latin-1") + f
        for f, r, s in zip(fixed, rest, side.tolist(), strict=True)
    ]
    n = table.column("n").to_numpy()
    own, other = np.concatenate([pairs, pairs[:, ::-1]]).T
    _, place = np.unique(np.array(named), return_inverse=True)
    order = np.lexsort((place[other], -n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    counts = np.diff(np.append(first, len(own)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([named[k] for k in own[first]], pa.string()),
            pa.array(counts.astype(np.int64)),
            pa.array(n[other[first]]),
            pa.array([named[k] for k in other[first]], pa.string()),
        ],
        names=["word", "n_near", "form_n", "form"],
    )


def _part_numbers(table: pa.Table) -> np.ndarray:
    """0, 1, 2, … for the parts of sorted rows."""
    changed = np.zeros(table.num_rows, dtype=bool)
    for name in ("size", "side", "fixed"):
        column = table.column(name)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if pa.types.is_string(column.type):
            column = column.dictionary_encode().indices
        values = column.to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.cumsum(changed)


def _near_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, taken a few whole parts at a time."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        longest = (held.column("size")[held.num_rows - 1].as_py() if held.num_rows else 0) + 1
        if held.num_rows >= CHUNK_ROWS or held.num_rows * longest >= CHUNK_CELLS:
            number = _part_numbers(held)
            cut = int(np.searchsorted(number, number[-1]))
            if cut:
                found = _near(held.slice(0, cut))
                held = held.slice(cut)
                if found is not None:
                    yield found
    if held is not None and held.num_rows:
        found = _near(held)
        if found is not None:
            yield found


def near_words(counted: DataFrame) -> DataFrame:
    """`(word, n_near, form_n, form)` for the words of `counted (word, n)` that have near words.

    Near words differ by one inserted, deleted or replaced letter. `form` is the near word of largest n,
    of those the smallest. Words have at least SHORTEST letters below U+0100 and are unique.
    """
    part = ["size", "side", "fixed"]
    parts = _parts(counted).repartition(*part).sortWithinPartitions(*part, "longer", "rest")
    columns = parts.select(*part, "longer", "rest", "n")
    found = columns.mapInArrow(_near_batches, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("order"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.order")).alias("form_n"), "best.form"
    )


def roots(forms: DataFrame) -> DataFrame:
    """`(word, root)` for the words of `forms (word, form)`, no form null and no cycles.

    Each round doubles how far a word looks, so rounds grow with the logarithm of the longest chain.
    """
    found = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(
            found.join(ahead, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        found = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return found


def group_variants(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """`(word, form, root, n, n_near, form_n)` of every word of `docs (doc_id, text, …)`.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A to Z lower-cased; in one of SLIP pairs of
    document and run (by crc32) a letter is deleted. Those of at least SHORTEST letters and `least`
    occurrences count. A word's form is its near word of largest n, of equal ones the smallest, if that
    is at least `times` the word's own n, which must be over 1 so that chains end; `root` is the last
    of the chain of forms, the word itself if it has none. `n_near` counts near words.

    A null or empty text has no words; a null doc_id is the empty name in the draw. Repeated rows count
    each time. Other columns are not read; an empty table gives no rows.
    """
    counted = materialise(vocabulary(docs, least), "vocabulary")
    near = near_words(counted)
    kept = F.col("form_n") >= times * F.col("n")
    known = materialise(
        counted.join(near, "word", "left").select(
            "word",
            F.when(kept, F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(kept, F.col("form_n")).alias("form_n"),
        ),
        "near",
    )
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
