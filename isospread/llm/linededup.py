"""Line de-duplication by a deletion-neighbourhood join.

Lines are sequences of words, and an edit puts in, leaves out or replaces one word. Two lines are
within one edit exactly if one equals the other without one of its words, or both are equal
without the word at the same place. So every line emits, as hashed keys, itself and all its
variants with one word left out; equal keys are joined, and the place decides whether the edit
distance really is within the bound. A line goes if an earlier one is found.

Emitting every variant of every line would multiply the text, so there is a first round. Of two
lines within one edit, one half of the shorter line stands unchanged at the same end of both;
lines emit their halves, and only lines that share a half with a different line emit variants.
No pair is lost by this.

A group of equal keys is never expanded into pairs: the earliest line decides. A block of
documents sends one entry for each key and place, its earliest, so a line or a template that a
third of all documents hold is no larger than any other.
"""

from __future__ import annotations

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
    mix,
    run_hashes,
    run_heads,
    text_buffer,
)

#: Lines with fewer words go only if an earlier line has the same words.
MIN_WORDS = 8
#: Places of entries that are whole lines: with enough words for an edit, and without.
WHOLE, SHORT = -1, -2
LAST = np.iinfo(np.int64).max

FIELDS = (
    T.StructType()
    .add("n_lines", "long")
    .add("n_removed", "long")
    .add("removed", T.ArrayType(T.StructType().add("line", "integer").add("earlier_doc", "long")))
    .add("kept_text", "string")
)


class _Lines:
    """The lines with words of a block, in order."""

    def __init__(self, texts: pa.Array, ids: pa.Array):
        data, offsets = text_buffer(texts)
        breaks = np.flatnonzero(data == 10) + 1
        heads = np.sort(np.concatenate([offsets[:-1], breaks]), kind="stable")
        per_text = 1 + np.diff(np.searchsorted(breaks - 1, offsets))
        text_of = np.repeat(np.arange(len(per_text)), per_text)
        line_of = np.arange(len(heads)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        words = Words((data, np.append(heads, len(data))), SPACED)
        full = words.counts > 0
        self.text_of, self.line_of = text_of[full], line_of[full]
        self.first, self.n = words.first[:-1][full], words.counts[full]
        self.hashes = words.hashes()
        doc = ids.fill_null(LAST) if ids.null_count else ids
        self.doc = doc.to_numpy(zero_copy_only=False).astype(np.int64)[self.text_of]
        self.whole = self.runs(self.first, self.first + self.n)

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent fingerprints of runs of words."""
        return tuple(run_hashes(self.hashes, starts, ends, by) for by in (WORD_RUNS, WORD_RUNS_2))

    def halves(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the halves that lines within one edit may share, and each one's line.

        Such lines have n words, or n and n - 1; the shorter length is part of the key.
        """
        lines = np.flatnonzero(self.n >= least)
        keys = []
        for shorter in (self.n[lines], self.n[lines] - 1):
            first, end = self.first[lines], self.first[lines] + self.n[lines]
            half = shorter // 2
            for side, (a, b) in enumerate(((first, first + half), (end - (shorter - half), end))):
                tag = mix((2 * shorter + side).astype(np.uint64))
                keys.append(mix(self.runs(a, b)[0] ^ tag))
        return np.concatenate(keys), np.tile(lines, 4)

    def variants(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both fingerprints of the lines with one word left out, its place, and the line."""
        n = self.n[lines]
        line = np.repeat(lines, n)
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        first, end = self.first[line], self.first[line] + self.n[line]
        left = first + place
        out = []
        for by in (WORD_RUNS, WORD_RUNS_2):
            totals = by.totals(self.hashes)
            before = totals[left] - totals[first]
            after = (totals[end] - totals[left + 1]) * np.uint64(by.inverse)
            out.append(mix((before + after) * by.powers(len(totals))[1][first]))
        return out[0], out[1], place, line


def _answer_halves(asked: list) -> dict:
    """Of each block's halves, which are shared by different lines."""
    halves = [unpack_sorted(part[0]) for _, part in asked]
    half, line = np.concatenate(halves), np.concatenate([part[1] for _, part in asked])
    order = np.lexsort((line, half))
    half, line = half[order], line[order]
    new = run_heads(half)
    group = np.cumsum(new) - 1
    differ = np.bincount(group[run_heads(line) | new]) > 1
    shared = np.empty(len(order), dtype=bool)
    shared[order] = differ[group]
    told, at = {}, 0
    for (block, _), k in zip(asked, halves):
        told[block] = (len(k), np.packbits(shared[at : at + len(k)]))
        at += len(k)
    return told


def _earlier(key: np.ndarray, check: np.ndarray, place: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For every entry, the least rank among the entries that are within the bound of it."""
    order = np.lexsort((place, check, key))
    place, rank = place[order], rank[order]
    new = run_heads(key[order]) | run_heads(check[order])
    group = np.cumsum(new) - 1
    heads = np.flatnonzero(new)

    def least(chosen):
        return np.minimum.reduceat(np.where(chosen, rank, LAST), heads)[group]

    by_place = new | run_heads(place)
    same_place = np.minimum.reduceat(rank, np.flatnonzero(by_place))[np.cumsum(by_place) - 1]
    found = np.select(
        [place == SHORT, place == WHOLE],
        [least(place < 0), np.minimum(least(place < 0), least(place >= 0))],
        np.minimum(same_place, least(place == WHOLE)),
    )
    out = np.empty(len(order), dtype=np.int64)
    out[order] = found
    return out


def _answer_variants(asked: list) -> dict:
    """Of each block's entries, which have an earlier one within the bound, and its document."""
    keys = [unpack_sorted(part[0]) for _, part in asked]
    check, place, doc, line = (
        np.concatenate([part[i] for _, part in asked]) for i in range(1, 5)
    )
    number = np.repeat([block for block, _ in asked], [len(k) for k in keys])
    by_rank = np.lexsort((line, number, doc))
    rank = np.empty(len(by_rank), dtype=np.int64)
    rank[by_rank] = np.arange(len(by_rank))
    # entries of one line have one rank
    new = run_heads(doc[by_rank]) | run_heads(number[by_rank]) | run_heads(line[by_rank])
    rank = (np.cumsum(new) - 1)[rank]
    doc_of_rank = doc[by_rank][new]
    least = _earlier(np.concatenate(keys), check, place.astype(np.int64), rank)
    gone = least < rank
    told, at = {}, 0
    for (block, _), k in zip(asked, keys):
        mine = slice(at, at + len(k))
        at += len(k)
        earlier = doc_of_rank[least[mine][gone[mine]]]
        told[block] = (len(k), np.packbits(gone[mine]), earlier)
    return told


def dedup_lines(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    doc_id: str = "doc_id",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Leave out every line for which an earlier one is within one edit of a word.

    Lines end at line feeds and are compared as sequences of words without ASCII white space; a
    line without words is kept and not counted. Earlier is by ``doc_id`` (a whole number; null
    last), then by place in the text; equal ids are ordered as they are read. Lines are judged
    on the input, so a line may go because of one that goes itself. Both lines must have
    ``min_words`` for an edit; below, only equal words count.

    Columns in ``keep`` are carried along; beside them come ``n_lines``, ``n_removed``,
    ``removed`` (line numbers from 0, each with the document of an earlier line) and
    ``kept_text`` (the lines left, joined by line feeds). Input columns with these names are not
    kept. A null text stays null and has no lines. An empty table gives an empty result. Lines
    are taken for equal if two independent 64-bit hashes of their words agree.
    """
    keep = [c for c in keep if c not in FIELDS.names]
    blocks = docs.select(
        *keep, F.col(text).alias("_text"), F.col(doc_id).cast("long").alias("_id")
    )
    exchange = Exchange(blocks, blocks.columns, text="_text")
    owners = exchange.owners

    def lines_of(block):
        return _Lines(block.column("_text"), block.column("_id"))

    def halves_of(lines):
        """Sorted distinct (half, line's fingerprint), and the place of each half among them."""
        half, line = lines.halves(min_words)
        whole = lines.whole[0][line]
        order = np.lexsort((whole, half))
        new = run_heads(half[order]) | run_heads(whole[order])
        of = np.empty(len(order), dtype=np.int64)
        of[order] = np.cumsum(new) - 1
        return half[order][new], whole[order][new], of, line

    def ask_halves(block, owners):
        half, whole, _, _ = halves_of(lines_of(block))
        return deal(half, owners, whole)

    def entries(block, told):
        """The block's lines; its entries, sorted and one for each key and place; the entry of
        each line's each key; and that line."""
        lines = lines_of(block)
        shared = [np.unpackbits(b, count=n).astype(bool) for n, b in gathered(told)]
        _, _, of, line = halves_of(lines)
        near = np.unique(line[np.concatenate(shared)[of]]) if shared else line[:0]
        key, check, place, line = lines.variants(near)
        every = np.arange(len(lines.n))
        key = np.concatenate([lines.whole[0], key])
        check = np.concatenate([lines.whole[1], check])
        whole = np.where(lines.n >= min_words, WHOLE, SHORT)
        place, line = np.concatenate([whole, place]), np.concatenate([every, line])
        order = np.lexsort((line, lines.doc[line], place, check, key))
        key, check, place = key[order], check[order], place[order]
        new = run_heads(key) | run_heads(check) | run_heads(place)
        of = np.empty(len(order), dtype=np.int64)
        of[order] = np.cumsum(new) - 1
        return lines, (key[new], check[new], place[new], line[order][new]), of, line

    def ask_variants(number, block, told):
        lines, (key, check, place, line), _, _ = entries(block, told)
        return deal(
            key, owners, check, place.astype(np.int32), lines.doc[line], line.astype(np.int64)
        )

    def cut(number, block, told_halves, told_variants):
        lines, (_, _, _, first), of, line = entries(block, told_halves)
        answers = gathered(told_variants)
        earlier = np.full(len(first), LAST)
        known = np.zeros(len(first), dtype=bool)
        at = 0
        for n, bits, doc in answers:
            gone = np.unpackbits(bits, count=n).astype(bool)
            known[at : at + n] = gone
            earlier[at : at + n][gone] = doc
            at += n
        # a line that isn't its entry's first has an earlier one in this very block
        beaten = known[of] | (first[of] != line)
        by = np.where(known[of], earlier[of], lines.doc[first[of]])
        gone = np.zeros(len(lines.n), dtype=bool)
        gone[line[beaten]] = True
        partner = np.full(len(lines.n), LAST)
        np.minimum.at(partner, line[beaten], by[beaten])

        columns = [block.column(c).to_pylist() for c in keep]
        bounds = np.searchsorted(lines.text_of, np.arange(block.num_rows + 1))
        for t, body in enumerate(block.column("_text").to_pylist()):
            mine = slice(bounds[t], bounds[t + 1])
            left_out = gone[mine]
            kept, removed = body, []
            if left_out.any():
                numbers = lines.line_of[mine][left_out].tolist()
                earlier_docs = partner[mine][left_out].tolist()
                removed = [
                    {"line": a, "earlier_doc": None if b == LAST else b}
                    for a, b in zip(numbers, earlier_docs)
                ]
                out = set(numbers)
                kept = "\n".join(x for i, x in enumerate(body.split("\n")) if i not in out)
            n = int(bounds[t + 1] - bounds[t])
            yield (*(c[t] for c in columns), n, len(removed), removed, kept)

    sent = exchange.start(ask_halves)
    shared = exchange.answers(sent, _answer_halves)
    emitted = exchange.ask_again(ask_variants, sent, shared)
    earlier = exchange.answers(emitted, _answer_variants)
    rows = exchange.finish(cut, sent, shared, earlier)
    kept = [f for f in blocks.schema.fields if f.name in keep]
    schema = T.StructType(kept + FIELDS.fields)
    return docs.sparkSession.createDataFrame(rows, schema, verifySchema=False)
