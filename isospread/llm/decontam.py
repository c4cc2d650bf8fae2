"""Benchmark decontamination by a prefix-filtered set join.

The records are windows of consecutive benchmark words. For a window to be contained in a text,
all its words must be, so the one that is rarest in the corpus is a sufficient prefix: texts are
joined to windows on it alone. Where it stands in the window tells where the window would have to
start (position), which must leave room for all its words in the text (length); only then is the
span as long as the window compared as a whole.

The benchmark is taken in parts of a bounded size. The index of a part is broadcast; with more
than one part the documents are read once for each, and what was found so far is stored between.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from isospread.llm.memory import give_back
from isospread.llm.words import (
    ALNUM,
    WORD_RUNS,
    WORD_RUNS_2,
    Words,
    distinct_places,
    pieces,
    run_hashes,
    window_starts,
)
from isospread.sources.storage import settle

WINDOW = 10
#: Benchmark text whose index is broadcast at once.
PART_BYTES = 16 << 20

FIELDS = (
    T.StructType()
    .add("n_words", "long")
    .add("n_hit", "long")
    .add("hits", T.ArrayType(T.StructType().add("start", "integer").add("end", "integer")))
    .add("items", T.ArrayType(T.StringType()))
)


def _fold_words(texts: pa.Array) -> Words:
    return Words(texts, ALNUM, fold=True)


def corpus_counts(docs: DataFrame, text: str, vocabulary: np.ndarray) -> np.ndarray:
    """How often each word of a sorted vocabulary of hashes occurs in all texts."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known.value), dtype=np.int64)
        for batch in batches:
            for piece in pieces(batch, "_text"):
                hashes = _fold_words(piece.column("_text")).hashes()
                at = _find(known.value, hashes)
                total += np.bincount(at[at >= 0], minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["word", "n"])

    sums = (
        docs.select(F.col(text).alias("_text"))
        .mapInArrow(give_back(count), "word long, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    out = np.zeros(len(vocabulary), dtype=np.int64)
    for word, n in sums.collect():  # at most the vocabulary of one part
        out[word] = n
    return out


def _find(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The place of each value in a sorted array of distinct values, or -1."""
    if not len(ordered):
        return np.full(len(values), -1)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return np.where(ordered[at] == values, at, -1)


class Index:
    """The distinct windows of a part of the benchmark, found by their rarest words."""

    def __init__(self, ids: list, texts: list[str | None], window: int):
        words = _fold_words(pa.array(texts, pa.string()))
        self.hashes = words.hashes()
        sizes = np.minimum(words.counts, window)
        starts = window_starts(words.first, window)
        short = np.flatnonzero((words.counts > 0) & (words.counts < window))
        item = np.concatenate(
            [np.searchsorted(words.first, starts, side="right") - 1, short]
        )
        self.starts = np.concatenate([starts, words.first[short]])
        self.sizes = sizes[item]
        ends = self.starts + self.sizes
        size_tag = self.sizes.astype(np.uint64)
        first = run_hashes(self.hashes, self.starts, ends, WORD_RUNS) ^ size_tag
        self.windows, of = distinct_places(first)
        self.example = np.empty(len(self.windows), dtype=np.int64)
        self.example[of] = np.arange(len(of))
        ex = self.example
        self.check = run_hashes(self.hashes, self.starts[ex], ends[ex], WORD_RUNS_2)
        order = np.argsort(of, kind="stable")
        self.item_of = item[order]
        self.items_first = np.searchsorted(of[order], np.arange(len(self.windows) + 1))
        self.ids = [None if i is None else str(i) for i in ids]
        self.vocabulary = np.unique(self.hashes)

    def choose_keys(self, counts: np.ndarray) -> None:
        """The rarest word of each distinct window, and where it stands in it; of equally rare
        words the one with the least hash."""
        place = np.searchsorted(self.vocabulary, self.hashes)
        rank = np.empty(len(self.vocabulary), dtype=np.int64)
        rank[np.lexsort((self.vocabulary, counts))] = np.arange(len(rank))
        starts, sizes = self.starts[self.example], self.sizes[self.example]
        best = np.full(len(starts), np.iinfo(np.int64).max)
        at = np.zeros(len(starts), dtype=np.int64)
        for i in range(int(sizes.max()) if len(sizes) else 0):
            word = np.minimum(starts + i, len(place) - 1)
            here = np.where(i < sizes, rank[place[word]], np.iinfo(np.int64).max)
            at = np.where(here < best, i, at)
            best = np.minimum(best, here)
        key = self.vocabulary[place[starts + at]] if len(starts) else self.vocabulary
        # what a key word asks to be tried: where it stands, and how long the window is
        tries = sorted(set(zip(key.tolist(), at.tolist(), sizes.tolist())))
        self.keys = np.unique(np.array([t[0] for t in tries], dtype=np.uint64))
        self.try_first = np.searchsorted(
            np.array([t[0] for t in tries], dtype=np.uint64), self.keys, side="left"
        )
        self.try_first = np.append(self.try_first, len(tries))
        self.try_at = np.array([t[1] for t in tries], dtype=np.int64)
        self.try_size = np.array([t[2] for t in tries], dtype=np.int64)

    def occurrences(self, words: Words, hashes: np.ndarray):
        """Where windows occur: the word each starts at, its size, and which window it is."""
        key = _find(self.keys, hashes)
        at = np.flatnonzero(key >= 0)
        key = key[at]
        n = self.try_first[key + 1] - self.try_first[key]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        tried = np.repeat(self.try_first[key], n) + step
        at = np.repeat(at, n)
        size = self.try_size[tried]
        start = at - self.try_at[tried]
        of = np.searchsorted(words.first, at, side="right") - 1
        room = (start >= words.first[of]) & (start + size <= words.first[of + 1])
        start, size = start[room], size[room]
        full = run_hashes(hashes, start, start + size, WORD_RUNS) ^ size.astype(np.uint64)
        which = _find(self.windows, full)
        same = which >= 0
        start, size, which = start[same], size[same], which[same]
        same = run_hashes(hashes, start, start + size, WORD_RUNS_2) == self.check[which]
        return start[same], size[same], which[same]


def _parts(benchmark: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, list]]:
    """Items in parts of at most ``PART_BYTES``; one part at a time reaches the driver."""
    size = benchmark.agg(F.sum(F.octet_length(text).cast("long"))).head()[0] or 0
    n = max(1, -(-2 * size // PART_BYTES))
    items = benchmark.select(F.col(item_id).alias("_id"), F.col(text).alias("_text"))
    for part in range(n):
        mine = items.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(n)) == part)
        rows = mine.orderBy("_id", "_text").collect()
        yield [r[0] for r in rows], [r[1] for r in rows]


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The words of every text that stand in an occurrence of a benchmark window.

    Words are runs of ASCII letters (A-Z as a-z), digits and characters beyond ASCII. A window
    is ``window`` consecutive words of an item; an item with fewer, but any, is one window.
    Columns in ``keep`` are carried along; beside them come ``n_words``, ``n_hit``, ``hits``
    (spans of word positions, end excluded) and ``items`` (ids of items with a window in the
    text, as strings in their order). Input columns with these names are not kept.

    A null or empty text has no words; a null or empty item has no window. Items with equal
    texts are all named, a repeated id once, a null id never (its hits count). Empty
    documents give an empty result, an empty benchmark no hits.
    """
    keep = [c for c in keep if c not in FIELDS.names]
    state = docs.select(
        *keep,
        F.col(text).alias("_text"),
        F.lit(None).cast(FIELDS["hits"].dataType).alias("hits"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    kept = [f for f in state.schema.fields if f.name in keep]
    for number, (ids, texts) in enumerate(_parts(benchmark, item_id, item_text)):
        if number:
            state = settle(state.drop("n_words", "n_hit"))
        index = Index(ids, texts, window)
        index.choose_keys(corpus_counts(state, "_text", index.vocabulary))
        state = _scan(state, index, kept)
    return state.select(*keep, *FIELDS.names)


def _scan(state: DataFrame, index: Index, kept: list) -> DataFrame:
    shared = state.sparkSession.sparkContext.broadcast(index)
    schema = T.StructType([*kept, T.StructField("_text", T.StringType()), *FIELDS.fields])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for piece in pieces(batch, "_text"):
                words = _fold_words(piece.column("_text"))
                start, size, which = index.occurrences(words, words.hashes())
                n = len(words) + 1
                change = np.bincount(start, minlength=n) - np.bincount(start + size, minlength=n)
                of = np.searchsorted(words.first, start, side="right") - 1
                found: dict[int, set] = {}
                for t, w in set(zip(of.tolist(), which.tolist())):
                    items = index.item_of[index.items_first[w] : index.items_first[w + 1]]
                    found.setdefault(t, set()).update(index.ids[i] for i in items)
                spans, names = [], []
                n_hit = np.zeros(piece.num_rows, dtype=np.int64)
                before = zip(piece.column("hits").to_pylist(), piece.column("items").to_pylist())
                covered = np.cumsum(change)[:-1] > 0
                for t, (old, told) in enumerate(before):
                    hit = np.zeros(0, dtype=bool)
                    if t in found or old:
                        hit = covered[words.first[t] : words.first[t + 1]].copy()
                        for s in old or ():
                            hit[s["start"] : s["end"]] = True
                    edges = np.flatnonzero(np.diff(hit, prepend=False, append=False))
                    n_hit[t] = hit.sum()
                    spans.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                    every = found.get(t, set()) | set(told or ())
                    names.append(sorted(x for x in every if x is not None))
                columns = [piece.column(f.name) for f in kept]
                columns += [piece.column("_text"), pa.array(words.counts), pa.array(n_hit)]
                columns += [pa.array(spans, arrow.field("hits").type)]
                columns += [pa.array(names, arrow.field("items").type)]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
                )

    return state.mapInArrow(give_back(scan), schema)
