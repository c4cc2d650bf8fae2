"""Similarity join on word shingles with Bayesian pruning of candidates.

Every text has a set of shingles and their MinHash values. Texts that agree in a whole band of
values are candidates; with 32 bands of 5, a pair at a similarity of 0.8 is missed with a
probability of 3e-6, and of 1e-12 at 0.9. Values of a candidate pair are then compared step by
step, and the pair is dropped as soon as the posterior probability that its similarity reaches
the threshold (uniform prior, binomial agreement) is below a tolerance. What is left is verified
exactly on the shingles.

Equal texts are one node with a count. Nodes that share bands are gathered by connected
components. A large component is cut into blocks, and each pair of blocks is compared in a task
of its own, so no group meets in one task and pairs are never rows: a task gives back, for each
node, how many documents it links to, and a spanning forest of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isospread.llm.components import components
from isospread.llm.memory import give_back
from isospread.llm.words import (
    SPACED,
    WORD_RUNS_2,
    Words,
    mix,
    pieces,
    run_hashes,
    run_heads,
    window_starts,
)
from isospread.sources.storage import broadcast_if_small, settle

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
VALUES = BANDS * ROWS
#: Values compared between two looks at the posterior.
STEP = 16
TOLERANCE = 1e-7
#: Nodes of a component that are compared with each other or another block in one task.
BLOCK = 512
_PIECE = 1 << 20

_odd = mix(np.arange(1, VALUES + 1, dtype=np.uint64)) | np.uint64(1)
_shift = mix(np.arange(1001, VALUES + 1001, dtype=np.uint64))


class _Shingled:
    """Shingles of each text; a text of fewer words, but any, is one shingle."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, SPACED)
        hashes = words.hashes()
        starts = window_starts(words.first, SHINGLE)
        short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
        of = np.concatenate([np.searchsorted(words.first, starts, side="right") - 1, short])
        ends = np.concatenate([starts + SHINGLE, words.first[short] + words.counts[short]])
        starts = np.concatenate([starts, words.first[short]])
        shingles = run_hashes(hashes, starts, ends)
        order = np.argsort(of, kind="stable")
        self.shingles, self.of = shingles[order], of[order]
        self.full = np.flatnonzero(words.counts > 0)
        self.heads = np.searchsorted(self.of, self.full)
        #: A fingerprint of each text's words in order; 0 without words.
        self.key = np.where(
            words.counts > 0, run_hashes(hashes, words.first[:-1], words.first[1:], WORD_RUNS_2), 0
        )

    def signatures(self) -> np.ndarray:
        """MinHash values of the texts that have shingles."""
        out = np.empty((len(self.full), VALUES), dtype=np.uint32)
        if len(self.full):
            for i in range(VALUES):
                values = self.shingles * _odd[i] + _shift[i]
                out[:, i] = np.minimum.reduceat(values, self.heads) >> np.uint64(32)
        return out

    def sets(self) -> list[np.ndarray]:
        ends = np.append(self.heads[1:], len(self.shingles))
        return [np.unique(self.shingles[a:b]) for a, b in zip(self.heads, ends)]


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band's values, the band's number included."""
    bands = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64)), bands.shape[:2])
    for i in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
    return keys


def least_agreement(threshold: float, tolerance: float) -> np.ndarray:
    """For every number n of compared values, the least agreement with which a pair stays.

    With m of n values equal and a uniform prior, the similarity is Beta(m + 1, n - m + 1), so
    it reaches the threshold with the probability that n + 1 draws have at most m successes.
    """
    out = np.zeros(VALUES + 1, dtype=np.int64)
    for n in range(1, VALUES + 1):
        total = 0.0
        for m in range(n + 1):
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                out[n] = m
                break
    return out


def linked(
    left: np.ndarray,
    right: np.ndarray,
    left_sets: list[np.ndarray],
    right_sets: list[np.ndarray],
    threshold: float,
    least: np.ndarray,
) -> np.ndarray:
    """Which pairs of two blocks, given by signatures and shingle sets, reach the threshold."""
    a, b = band_keys(left), band_keys(right)
    together = np.zeros((len(left), len(right)), dtype=bool)
    for band in range(BANDS):
        together |= a[:, band, None] == b[None, :, band]
    i, j = np.nonzero(together)
    agree = np.zeros(len(i), dtype=np.int64)
    for at in range(0, VALUES, STEP):
        agree += (left[i, at : at + STEP] == right[j, at : at + STEP]).sum(axis=1)
        alive = agree >= least[min(at + STEP, VALUES)]
        i, j, agree = i[alive], j[alive], agree[alive]
    sizes = np.array([len(s) for s in left_sets]), np.array([len(s) for s in right_sets])
    common = _common(i, j, left_sets, right_sets)
    # common / union >= threshold, in whole numbers where the threshold is a decimal
    union = sizes[0][i] + sizes[1][j] - common
    yes = common * 1_000_000 >= np.round(threshold * 1_000_000).astype(np.int64) * union
    out = np.zeros(together.shape, dtype=bool)
    out[i[yes], j[yes]] = True
    return out


def _common(i: np.ndarray, j: np.ndarray, left: list, right: list) -> np.ndarray:
    """How many shingles the pairs share: by products of membership columns where a block has
    many pairs, by merging sets where it has few. The results are the same."""
    rows, columns = np.unique(i), np.unique(j)
    if len(i) * 8 < len(rows) * len(columns) or len(i) < 64:
        return np.array(
            [len(np.intersect1d(left[x], right[y], assume_unique=True)) for x, y in zip(i, j)],
            dtype=np.int64,
        )
    values = np.concatenate([left[x] for x in rows])
    owner = np.repeat(np.arange(len(rows)), [len(left[x]) for x in rows])
    others = np.concatenate([right[y] for y in columns])
    other = np.repeat(np.arange(len(columns)), [len(right[y]) for y in columns])
    shared = np.intersect1d(values, others)
    total = np.zeros((len(rows), len(columns)), dtype=np.int64)
    for at in range(0, len(shared), 4096):
        some = shared[at : at + 4096]
        total += (_members(values, owner, len(rows), some) @ _members(others, other, len(columns), some).T).astype(np.int64)
    return total[np.searchsorted(rows, i), np.searchsorted(columns, j)]


def _members(values, owner, n, some) -> np.ndarray:
    place = np.searchsorted(some, values)
    place[place == len(some)] = 0
    hit = some[place] == values
    out = np.zeros((n, len(some)), dtype=np.float32)
    out[owner[hit], place[hit]] = 1
    return out


def _forest(links: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The least node that each node reaches through the links of one block."""
    root = nodes.copy()
    while True:
        reach = np.where(links, root[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        new = np.minimum(root, reach)
        if (new == root).all():
            return root
        root = new


def similar(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Every document's class under links between texts of a Jaccard similarity of ``threshold``
    or more on sets of five-word shingles.

    Words are runs without ASCII white space. Returns one row for each document: ``doc_id``,
    ``class_id`` (least id of its connected component), ``copy_id`` (least id of the documents
    with the same words), ``n_links`` (documents it is linked to, copies included), ``stays``
    (true for one text of each class) and ``text_hash`` (xxhash64 of the text). Other columns
    are ignored.

    A text of fewer than five words is one shingle. A null text or one without words is linked
    to nothing, and is its own class. Ids are whole numbers; null ids are the least of no
    class unless it has no other, and then ``class_id`` is null. Repeated rows are documents of
    their own. An empty table gives an empty result.
    """
    least = least_agreement(threshold, tolerance)
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("_text"),
        F.xxhash64(text).alias("text_hash"),
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text", _PIECE):
                found = _Shingled(piece.column("_text"))
                keys = band_keys(found.signatures()).view(np.int64).reshape(-1)
                lists = np.zeros(piece.num_rows + 1, dtype=np.int32)
                lists[found.full + 1] = BANDS
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("text_hash"),
                        pa.array(found.key.astype(np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.cumsum(lists, dtype=np.int32)), pa.array(keys)),
                    ],
                    ["doc_id", "text_hash", "node", "bands"],
                )

    fields = "doc_id long, text_hash long, node long, bands array<long>"
    sketched = settle(source.mapInArrow(give_back(sketch), fields))
    full = F.size("bands") > 0
    nodes = settle(
        sketched.where(full)
        .groupBy("node")
        .agg(F.count("*").alias("copies"), F.min("doc_id").alias("copy_id"), F.first("bands").alias("bands"))
    )
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n"))
    near = keyed.join(hubs.where(F.col("n") > 1).drop("n"), "key")
    gathered = settle(components(near.select(F.col("node").alias("a"), F.col("hub").alias("b"))))

    sizes = gathered.groupBy("root").agg(F.count("*").alias("m"))
    n_members = sizes.agg(F.sum("m")).head()[0] or 0
    groups = max(1, -(-n_members // BLOCK))
    blocks = F.ceil(F.col("m") / BLOCK).cast("long")
    members = (
        gathered.join(sizes, "root")
        .join(nodes.drop("bands"), "node")
        .select(
            "node", "root", "copies", "copy_id",
            blocks.alias("blocks"),
            F.pmod(F.xxhash64("node"), blocks).alias("block"),
        )
    )
    found = source.drop("text_hash").join(members, source.doc_id.eqNullSafe(members.copy_id)).drop("doc_id", "copy_id")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text", _PIECE):
                shingled = _Shingled(piece.column("_text"))
                keys = shingled.key.astype(np.uint64).view(np.int64)
                mine = keys[shingled.full] == piece.column("node").to_numpy()[shingled.full]
                rows = pa.array(shingled.full[mine])
                signatures = shingled.signatures()[mine]
                sets = [s for s, m in zip(shingled.sets(), mine) if m]
                names = ["node", "root", "copies", "blocks", "block"]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(c).take(rows) for c in names),
                        pa.array([s.tobytes() for s in signatures], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    [*names, "signature", "shingles"],
                )

    kinds = "node long, root long, copies long, blocks long, block long, signature binary, shingles binary"
    signed = found.mapInArrow(give_back(sign), kinds).dropDuplicates(["node"])
    # small components share tasks; of a large one every pair of blocks has its own
    dealt = (
        signed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("_low", F.least("block", "_other"))
        .withColumn("_high", F.greatest("block", "_other"))
        .withColumn(
            "_task",
            F.when(F.col("blocks") > 1, F.xxhash64("root", "_low", "_high")).otherwise(
                F.pmod(F.xxhash64("root"), F.lit(groups))
            ),
        )
        .drop("_other", "blocks")
    )

    def compare(table: pa.Table) -> pa.Table:
        root, low, high, block, node, copies = (
            table.column(c).to_numpy() for c in ("root", "_low", "_high", "block", "node", "copies")
        )
        raw = table.column("signature").to_pylist()
        signatures = np.frombuffer(b"".join(raw), dtype=np.uint32).reshape(-1, VALUES)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()]
        out = [[], [], []]
        order = np.lexsort((node, high, low, root))
        new = run_heads(root[order]) | run_heads(low[order]) | run_heads(high[order])
        cuts = np.append(np.flatnonzero(new), len(order))
        for start, end in zip(cuts[:-1], cuts[1:]):
            rows = order[start:end]
            first = rows[block[rows] == low[rows]]
            second = rows[block[rows] == high[rows]]
            same = low[rows[0]] == high[rows[0]]
            yes = linked(
                signatures[first], signatures[second],
                [sets[r] for r in first], [sets[r] for r in second], threshold, least,
            )
            if same:
                np.fill_diagonal(yes, False)
                links, names = yes, first
                n = yes @ copies[second]
            else:
                names = np.concatenate([first, second])
                links = np.zeros((len(names), len(names)), dtype=bool)
                links[: len(first), len(first) :] = yes
                links[len(first) :, : len(first)] = yes.T
                n = np.concatenate([yes @ copies[second], yes.T @ copies[first]])
            some = n > 0
            roots = _forest(links, node[names])
            out[0].append(node[names][some])
            out[1].append(n[some])
            out[2].append(roots[some])
        return pa.table(
            [pa.array(np.concatenate(c).astype(np.int64)) for c in out], ["node", "links", "root"]
        )

    links = settle(
        dealt.groupBy("_task").applyInArrow(compare, "node long, links long, root long")
    )
    per_node = links.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    described = settle(
        nodes.drop("bands")
        .join(classes, "node", "left")
        .join(per_node, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least_id = described.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    every = described.join(least_id, "root")
    joined = sketched.drop("bands").join(every, "node", "left")
    alone = F.col("copies").isNull()
    stays = F.when(alone, True).when(
        F.col("class_id").isNull(), F.col("node") == F.col("root")
    ).otherwise(F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)))
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(alone, 0)
        .otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
        .cast("long")
        .alias("n_links"),
        stays.alias("stays"),
        "text_hash",
    )


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents without near copies: of each class the one with the least id stays."""
    found = similar(docs, text, doc_id, **options).where("stays")
    kept = settle(
        found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
            F.count("*").alias("_n")
        )
    )
    keyed = docs.withColumn("_key", F.xxhash64(text))
    same = F.col(doc_id).cast("long").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash"))
    # texts move only where the list of kept ids is long, or for rows that are repeated
    once = keyed.join(broadcast_if_small(kept.where("_n = 1")), same, "left_semi")
    repeated = keyed.join(broadcast_if_small(kept.where("_n > 1")), same, "left_semi")
    return once.unionByName(repeated.dropDuplicates([doc_id, "_key"])).drop("_key")
