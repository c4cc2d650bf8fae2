"""Near copies by fast similarity sketches of word shingles.

A sketch has a fixed number of coordinates. In round after round every shingle of a set is thrown
into one coordinate with a value that is larger than any of an earlier round; a coordinate keeps
its least value, and rounds go on only while coordinates are empty. After as many rounds as there
are coordinates, further rounds throw all shingles into one given coordinate each, so every
coordinate is filled whatever the set's size. Two sets agree in a coordinate with the probability
of their Jaccard similarity, and the share of agreeing coordinates is concentrated as if they were
drawn independently. A set of many shingles is hashed once or twice instead of once a coordinate.

Sets that agree in all coordinates of a band are candidates: with 32 bands of 5, a pair at a
similarity of 0.8 is missed with a probability of 3e-6. Candidates are verified on their full sets.

Equal sets are one node. Nodes that share bands are gathered by connected components; large ones
are cut into blocks, and pairs of blocks that share a band key are compared in a task of their
own. Within a task, two nodes that are connected already are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isospread.llm.components import components
from isospread.llm.memory import give_back
from isospread.llm.words import LOWER, SPACED, Words, mix, pieces, text_buffer, window_starts
from isospread.sources.storage import broadcast_if_small, settle

SHINGLE = 4
#: Similarity from which sets are linked, in per cent of the union.
PERCENT = 80
BANDS, ROWS = 32, 5
COORDINATES = BANDS * ROWS
#: Candidates whose sketches agree in a smaller share are dropped. At a similarity of 0.8 that
#: loses a pair with a probability below 1e-15.
LEAST_AGREEMENT = 0.5
#: Shingles of a component's block, and nodes: what a task compares with itself or another block.
BLOCK_SHINGLES, BLOCK_NODES = 1 << 20, 512
PIECE_BYTES = 1 << 20
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

_odd = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_shift = mix(np.arange(5001, 5001 + 2 * COORDINATES, dtype=np.uint64))


def word_hashes(words: Words) -> np.ndarray:
    """A hash of each word: the sum over its bytes of a mixed value of the byte and its place.

    Unlike powers of a base, mixed values follow no rule by which chosen words could cancel out.
    """
    out = np.zeros(len(words), dtype=np.uint64)
    low = 0
    while low < len(words):
        at = words.starts[low]
        high = max(low + 1, int(np.searchsorted(words.ends, at + (256 << 10), "right")))
        starts, ends = words.starts[low:high] - at, words.ends[low:high] - at
        data = words.data[at : at + ends[-1]]
        place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
        if words.fold:
            data = LOWER[data]
        values = mix((place.astype(np.uint64) << np.uint64(8)) | data)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values, out=total[1:])
        out[low:high] = mix(total[ends] - total[starts] + (ends - starts).astype(np.uint64))
        low = high
    return out


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. Words are runs without ASCII white space,
    with A-Z in lower case; a text of fewer words, but any, has the whole of them as one."""
    words = Words(texts, SPACED, fold=True)
    hashes = word_hashes(words)
    counts = words.counts
    starts = window_starts(words.first, size)
    joined = np.full(len(starts), size, dtype=np.uint64)
    for i in range(size):
        joined = mix(joined + hashes[starts + i])
    out = []
    ends = np.cumsum(np.maximum(counts - size + 1, 0))
    for text, (n, end) in enumerate(zip(counts, ends)):
        if n >= size:
            values = np.sort(joined[end - (n - size + 1) : end])
            new = np.ones(len(values), dtype=bool)
            new[1:] = values[1:] != values[:-1]
            out.append(values[new])
        elif n:
            value = np.array([n], dtype=np.uint64)
            for h in hashes[words.first[text] : words.first[text + 1]]:
                value = mix(value + h)
            out.append(value)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketches of sets that aren't empty, a row each."""
    n, t = len(sets), coordinates
    out = np.full(n * t, EMPTY, dtype=np.uint64)
    if not n:
        return out.reshape(n, t)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    low32 = np.uint64(0xFFFFFFFF)
    for i in range(t):
        h = mix(values * _odd[i] + _shift[i])
        at = owner * t + ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        # coordinates filled in an earlier round hold a smaller value and stay as they are
        np.minimum.at(out, at, (h & low32) | np.uint64(i << 32))
        unfilled = (out.reshape(n, t) == EMPTY).any(axis=1)
        if not unfilled.any():
            return out.reshape(n, t)
        stay = unfilled[owner]
        values, owner = values[stay], owner[stay]
    filled = out.reshape(n, t)
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    rows = owner[heads]
    for k in np.flatnonzero((filled == EMPTY).any(axis=0)):
        h = mix(values * _odd[t + k] + _shift[t + k])
        least = np.minimum.reduceat(h & low32, heads) | np.uint64((t + k) << 32)
        filled[rows, k] = np.minimum(filled[rows, k], least)
    return filled


def band_keys(sketched: np.ndarray) -> np.ndarray:
    """A 64-bit key of the coordinates of each band, the band's number included."""
    bands = sketched.reshape(len(sketched), BANDS, ROWS)
    keys = np.broadcast_to(mix(np.arange(7001, 7001 + BANDS, dtype=np.uint64)), bands.shape[:2])
    for i in range(ROWS):
        keys = mix(keys + mix(bands[:, :, i]))
    return keys


def set_key(shingles: np.ndarray) -> int:
    """One key for equal sets; never 0."""
    total = mix(np.array([mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))]))[0]
    return int(total) or 1


class _Forest:
    """Which nodes of a task are connected."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: int, others: np.ndarray) -> None:
        roots = np.unique(np.append(self.root[others], self.root[a]))
        self.root[np.isin(self.root, roots)] = roots[0]


def connect(
    sets: list[np.ndarray],
    sketched: np.ndarray,
    keys: np.ndarray,
    left: np.ndarray,
    right: np.ndarray | None,
    percent: int,
) -> np.ndarray:
    """For each node the first one in order that it is connected to by links among ``left``, or
    between ``left`` and ``right``. Nodes that are connected already are not compared again; every
    other candidate is verified on its full sets."""
    values, places = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.cumsum([0, *(len(s) for s in sets)])
    sizes = np.diff(cuts)
    forest = _Forest(len(sets))
    marked = np.zeros(len(values), dtype=bool)
    columns = left if right is None else right
    for i in left:
        others = columns[columns > i] if right is None else columns
        others = others[forest.root[others] != forest.root[i]]
        small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[100 * small >= percent * large]
        others = others[(keys[others] == keys[i]).any(axis=1)]
        agreement = (sketched[others] == sketched[i]).mean(axis=1)
        others = others[agreement >= LEAST_AGREEMENT]
        if not len(others):
            continue
        mine = places[cuts[i] : cuts[i + 1]]
        marked[mine] = True
        some = 1
        while len(others):
            # a few of each component at a time: one link makes the others of it needless
            order = np.argsort(forest.root[others], kind="stable")
            others = others[order]
            roots = forest.root[others]
            heads = np.flatnonzero(np.diff(roots, prepend=-1))
            rank = np.arange(len(others)) - np.repeat(heads, np.diff(np.append(heads, len(others))))
            now, others = others[rank < some], others[rank >= some]
            inside = np.concatenate([places[cuts[j] : cuts[j + 1]] for j in now])
            ends = np.cumsum(sizes[now])
            total = np.concatenate(([0], np.cumsum(marked[inside])))
            common = total[ends] - total[ends - sizes[now]]
            yes = 100 * common >= percent * (sizes[i] + sizes[now] - common)
            if yes.any():
                forest.join(i, now[yes])
                others = others[forest.root[others] != forest.root[i]]
            some *= 2
        marked[mine] = False
    return forest.root


def near_copies(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    percent: int = PERCENT,
) -> DataFrame:
    """Every document's group under links between texts whose sets of four-word shingles have an
    intersection of at least ``percent`` of their union.

    Returns one row for each document: ``doc_id`` (long), ``n_shingles`` (size of its set),
    ``component_id`` (least id that it reaches over links, its own included) and ``kept`` (whether
    that is its own). Other columns are ignored.

    A null text, or one without words, has no shingles and is linked to nothing. Equal sets are
    always linked, those of texts of fewer than four words too. Repeated rows are documents of
    their own and linked. A null id is the least of a group only if it has no other; the row's
    ``component_id`` is then null, and it is kept. An empty table gives an empty result.
    """
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("_text"),
        F.xxhash64(text).alias("mark"),
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text", PIECE_BYTES):
                sets = shingle_sets(piece.column("_text"))
                full = np.array([len(s) > 0 for s in sets], dtype=bool)
                keys = band_keys(sketches([s for s in sets if len(s)]))
                node = np.array([set_key(s) if len(s) else 0 for s in sets], dtype=np.uint64)
                cuts = np.append(0, np.cumsum(np.where(full, BANDS, 0))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("mark"),
                        pa.array(node.view(np.int64)),
                        pa.array(np.array([len(s) for s in sets], dtype=np.int64)),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys.reshape(-1).view(np.int64))),
                    ],
                    ["doc_id", "mark", "node", "n_shingles", "bands"],
                )

    fields = "doc_id long, mark long, node long, n_shingles long, bands array<long>"
    sketched = settle(source.mapInArrow(give_back(sketch), fields))
    # the row that stands for a node: least id, nulls last, then by the text's hash
    place = F.struct(F.col("doc_id").isNull().alias("blank"), "doc_id", "mark")
    nodes = settle(
        sketched.where("n_shingles > 0")
        .groupBy("node")
        .agg(
            F.min(place).alias("row"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        )
        .select("node", "row.doc_id", "row.mark", "n_shingles", "bands")
    )
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n"))
    near = settle(keyed.join(hubs.where("n > 1").drop("n"), "key"))
    gathered = components(near.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    members = settle(gathered.join(nodes.drop("bands"), "node"))

    # blocks of large components; only their sizes are looked up, in a table that is short
    weighed = members.groupBy("root").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("w"))
    cut = F.greatest(F.ceil(F.col("m") / BLOCK_NODES), F.ceil(F.col("w") / BLOCK_SHINGLES))
    large = settle(weighed.select("root", cut.cast("long").alias("blocks")).where("blocks > 1"))
    total, count = members.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count("*")).head()
    groups = max(1, -(-total // BLOCK_SHINGLES), -(-count // (8 * BLOCK_NODES)))
    block = F.coalesce(F.pmod(F.xxhash64("node"), F.col("blocks")), F.lit(-1))
    blocked = settle(
        members.join(broadcast_if_small(large), "root", "left")
        .withColumn("block", block)
        .select("node", "root", "block", *_row_key())
    )
    units = _units(near, blocked)
    texts = (
        source.select("_text", *_row_key())
        .join(broadcast_if_small(blocked), ROW_KEY)
        .dropDuplicates(ROW_KEY)
        .select("node", "root", "block", "_text")
    )

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text", PIECE_BYTES):
                sets = shingle_sets(piece.column("_text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(c) for c in ("node", "root", "block")),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["node", "root", "block", "shingles"],
                )

    def compare(table: pa.Table) -> pa.Table:
        node, root, block, low, high = (
            table.column(c).to_numpy() for c in ("node", "root", "block", "low", "high")
        )
        sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()]
        sketched = sketches(sets)
        keys = band_keys(sketched)
        order = np.lexsort((node, high, low, root))
        new = np.ones(len(order), dtype=bool)
        new[1:] = False
        for c in (root, low, high):
            new[1:] |= c[order][1:] != c[order][:-1]
        heads = np.append(np.flatnonzero(new), len(order))
        pairs = []
        for start, end in zip(heads[:-1], heads[1:]):
            rows = order[start:end]
            at = np.arange(len(rows))
            second = block[rows] == high[rows]
            across = low[rows[0]] != high[rows[0]]
            found = connect(
                [sets[r] for r in rows],
                sketched[rows],
                keys[rows],
                at[~second] if across else at,
                at[second] if across else None,
                percent,
            )
            linked = found != at
            pairs.append((node[rows[linked]], node[rows[found[linked]]]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*pairs)], ["a", "b"])

    filled = texts.mapInArrow(give_back(full_sets), "node long, root long, block long, shingles binary")
    small = filled.where("block < 0").select(
        "*", F.lit(-1).cast("long").alias("low"), F.lit(-1).cast("long").alias("high"),
        F.pmod(F.xxhash64("root"), F.lit(groups)).alias("task"),
    )
    shared = filled.where("block >= 0").join(units, ["root", "block"]).select(
        "node", "root", "block", "shingles", "low", "high",
        F.xxhash64("root", "low", "high").alias("task"),
    )
    tasks = small.unionByName(shared).withColumn("apart", F.col("block") >= 0)
    edges = settle(tasks.groupBy("apart", "task").applyInArrow(compare, "a long, b long"))

    classes = settle(components(edges).join(nodes.select("node", "doc_id"), "node"))
    least = classes.groupBy("root").agg(F.min("doc_id").alias("least"))
    named = classes.join(least, "root").select("node", "least")
    described = nodes.select("node", "doc_id").join(named, "node", "left").select(
        "node", F.coalesce("least", "doc_id").alias("component_id")
    )
    joined = sketched.select("doc_id", "node", "n_shingles").join(described, "node", "left")
    reached = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", reached.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


ROW_KEY = ["id", "blank", "mark"]


def _row_key() -> list:
    """A row's id and text hash as columns without nulls."""
    return [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("blank"), "mark"]


def _units(near: DataFrame, blocked: DataFrame) -> DataFrame:
    """For each block of a large component the pairs of blocks (``low``, ``high``) it is compared
    in: itself, and every block with which it shares a band key."""
    placed = blocked.where("block >= 0").select("node", "root", "block")
    own = placed.select("root", F.col("block").alias("low"), F.col("block").alias("high")).distinct()
    at_key = near.join(placed, "node").groupBy("key", "root").agg(F.array_sort(F.collect_set("block")).alias("at"))
    two = at_key.where(F.size("at") > 1).select("root", "at", F.explode("at").alias("low"))
    two = two.select("root", "low", F.explode("at").alias("high")).where("low < high").distinct()
    pairs = own.unionByName(two)
    return pairs.select("root", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
