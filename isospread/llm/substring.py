"""Removal of long passages that repeat, by suffix trees partitioned by prefix.

A suffix is a text from one of its words on. Only tree nodes at the string depth of a window
matter: a window repeats exactly if its node there has two leaves or more, and runs of such
windows are the maximal repeats. So the trees are cut at that depth, and built in two rounds.

First every suffix is dealt to a group by a short prefix. A suffix alone under its prefix is a
leaf, and drops out; the prefix of the others is lengthened. Then each group holds the suffixes
that share prefixes, as subtrees: edges below the prefix are 64-bit fingerprints of the words
along them, so a suffix costs a few bytes and not its words. Groups are ranges of prefix hashes
whose number follows the size of the corpus, which keeps each within memory; a block of documents
sends a branch once, with a mark when it has several leaves there, so a passage that a third of
all documents hold is no larger than any other.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isospread.llm.exchange import Exchange, deal, gathered, unpack_sorted
from isospread.llm.words import (
    SPACED,
    WORD_RUNS,
    WORD_RUNS_2,
    Words,
    distinct_places,
    run_hashes,
    run_heads,
    window_starts,
)

WINDOW = 35
PREFIX = 8

FIELDS = (
    T.StructType()
    .add("n_words", "long")
    .add("n_removed", "long")
    .add("removed", T.ArrayType(T.StructType().add("start", "integer").add("end", "integer")))
    .add("kept_text", "string")
)


class _Suffixes:
    """The suffixes of a block that are long enough to hold a window."""

    def __init__(self, texts: pa.Array, window: int, prefix: int):
        self.words = Words(texts, SPACED)
        self.hashes = self.words.hashes()
        self.starts = window_starts(self.words.first, window)
        self.prefixes = run_hashes(self.hashes, self.starts, self.starts + prefix, WORD_RUNS)
        self.window = window

    def ends_at_window(self, chosen: np.ndarray) -> np.ndarray:
        """Fingerprints of whole windows, of another base than the prefixes."""
        starts = self.starts[chosen]
        return run_hashes(self.hashes, starts, starts + self.window, WORD_RUNS_2)


def _times_over_one(heads: np.ndarray, n: int) -> np.ndarray:
    """Which runs, given by where they begin, have two members or more."""
    return np.diff(heads, append=n) > 1


def _bits(flags: np.ndarray) -> tuple[int, np.ndarray]:
    return len(flags), np.packbits(flags)


def _flags(bits: tuple[int, np.ndarray]) -> np.ndarray:
    return np.unpackbits(bits[1], count=bits[0]).astype(bool)


def _answer_prefixes(asked: list) -> dict:
    """Of each block's prefixes, which are shared by two suffixes or more."""
    keys = [unpack_sorted(part[0]) for _, part in asked]
    distinct, places = distinct_places(np.concatenate(keys))
    shared = np.bincount(places, minlength=len(distinct)) > 1
    shared[places[np.concatenate([_flags(part[1]) for _, part in asked])]] = True
    told, at = {}, 0
    for (block, _), k in zip(asked, keys):
        told[block] = _bits(shared[places[at : at + len(k)]])
        at += len(k)
    return told


def _answer_subtrees(asked: list) -> dict:
    """Grow the group's subtrees and tell each block which of its branches end in a node with
    two leaves or more."""
    prefixes = [unpack_sorted(part[0]) for _, part in asked]
    prefix = np.concatenate(prefixes)
    branch = np.concatenate([part[1] for _, part in asked])
    several = np.concatenate([part[2] for _, part in asked])
    order = np.lexsort((branch, prefix))
    new = run_heads(prefix[order]) | run_heads(branch[order])
    node = np.cumsum(new) - 1
    leaves = np.bincount(node, weights=1 + several[order].astype(np.int64))
    deep = np.zeros(len(order), dtype=bool)
    deep[order] = leaves[node] > 1
    told, at = {}, 0
    for (block, _), k in zip(asked, prefixes):
        told[block] = _bits(deep[at : at + len(k)])
        at += len(k)
    return told


def _joined(told: dict) -> np.ndarray:
    parts = [_flags(bits) for bits in gathered(told)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=bool)


def remove_repeats(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    window: int = WINDOW,
    prefix: int = PREFIX,
) -> DataFrame:
    """Take from every text the words covered by a window of words that starts anywhere else too,
    in the same text or another.

    Words are runs without ASCII white space, compared byte by byte; windows are judged on the
    input, so every copy of a passage goes. Columns in ``keep`` are carried along; beside them
    come ``n_words``, ``n_removed``, ``removed`` (spans of word positions, end excluded, in order)
    and ``kept_text`` (the kept words joined by one space). Input columns with these names are
    not kept.

    A null or empty text has no words and an empty kept text. A text shorter than a window keeps
    everything. Repeated rows are repeats of each other. An empty table gives an empty result.
    Two windows that differ are taken for equal only if two independent 64-bit hashes agree.
    """
    keep = [c for c in keep if c not in FIELDS.names]
    blocks = docs.select(*keep, F.col(text).alias("_text"))
    exchange = Exchange(blocks, blocks.columns, text="_text")

    def ask_prefixes(block, owners):
        suffixes = _Suffixes(block.column("_text"), window, prefix)
        ordered = np.sort(suffixes.prefixes)
        heads = np.flatnonzero(run_heads(ordered))
        several = _times_over_one(heads, len(ordered))
        cuts = deal(ordered[heads], owners, several)
        return {o: (keys, _bits(flags)) for o, (keys, flags) in cuts.items()}

    def branches(block, shared):
        """Suffixes under shared prefixes, the branches they end in, and each one's branch."""
        suffixes = _Suffixes(block.column("_text"), window, prefix)
        places = distinct_places(suffixes.prefixes)[1]
        chosen = np.flatnonzero(shared[places]) if len(places) else places
        prefixes, ends = suffixes.prefixes[chosen], suffixes.ends_at_window(chosen)
        order = np.lexsort((ends, prefixes))
        new = run_heads(prefixes[order]) | run_heads(ends[order])
        of = np.empty(len(order), dtype=np.int64)
        of[order] = np.cumsum(new) - 1
        heads = order[new]
        several = _times_over_one(np.flatnonzero(new), len(order))
        return suffixes, chosen, of, prefixes[heads], ends[heads], several

    def ask_subtrees(number, block, told):
        _, _, _, prefixes, ends, several = branches(block, _joined(told))
        return deal(prefixes, exchange_owners, ends, several)

    def cut(number, block, told_prefixes, told_subtrees):
        shared = _joined(told_prefixes)
        suffixes, chosen, of, _, _, several = branches(block, shared)
        deep = _joined(told_subtrees)
        words = suffixes.words
        starts = suffixes.starts[chosen[deep[of]]] if len(of) else chosen
        change = np.bincount(starts, minlength=len(words) + 1)
        change -= np.bincount(starts + window, minlength=len(words) + 1)
        gone = np.cumsum(change)[:-1] > 0
        texts = block.column("_text").to_pylist()
        columns = [block.column(c).to_pylist() for c in keep]
        counts = words.counts
        removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) * (counts > 0)
        for t, body in enumerate(texts):
            kept = (body or "").encode().split()
            spans = []
            if removed[t]:
                mine = gone[words.first[t] : words.first[t + 1]]
                edges = np.flatnonzero(np.diff(mine, prepend=False, append=False))
                spans = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                kept = compress(kept, (~mine).tolist())
            yield (
                *(c[t] for c in columns),
                int(counts[t]),
                int(removed[t]),
                spans,
                b" ".join(kept).decode(),
            )

    exchange_owners = exchange.owners
    sent = exchange.start(ask_prefixes)
    shared = exchange.answers(sent, _answer_prefixes)
    grown = exchange.ask_again(ask_subtrees, sent, shared)
    deep = exchange.answers(grown, _answer_subtrees)
    rows = exchange.finish(cut, sent, shared, deep)
    kept = [f for f in blocks.schema.fields if f.name in keep]
    schema = T.StructType(kept + FIELDS.fields)
    return docs.sparkSession.createDataFrame(rows, schema, verifySchema=False)
