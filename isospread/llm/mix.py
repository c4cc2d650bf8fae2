"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source is cut into blocks of equal numbers of words. Blocks are seats: sources get them by
the highest quotients target / (2 * seats + 1), then the shards of a source share its seats the
same way, which gives every shard an integer quota. Inside a shard a seeded draw picks the blocks,
each at most as often as the limit on repeats allows.

Shards are dealt by a hash of the row and have a bounded number of words, so a source with a third
of all rows is many shards. Only ids and sizes are shuffled, never texts. The driver holds one row
for each source, as the weights do; the shards of a source are apportioned in one task, with 24
bytes for about a million words.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isospread.llm.words import mix as scramble
from isospread.sources.storage import settle

BLOCK_WORDS = 128
SHARD_WORDS = 1 << 19
#: A shard has at least so many blocks, if it has as many words.
LEAST_BLOCKS = 64
MOST_TIMES = 2


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[float], weights: Sequence[float], total: float, most: float):
    """Shares of ``total`` by weight; a share stops at ``most`` times the source's size, and the
    excess goes to the others by weight, until none is above."""
    sizes, weights = np.asarray(sizes, dtype=float), np.asarray(weights, dtype=float)
    out = np.zeros(len(sizes))
    open_ = (sizes > 0) & (weights > 0)
    left = float(total)
    while open_.any():
        share = np.where(open_, left * weights / weights[open_].sum(), 0)
        full = open_ & (share >= most * sizes)
        if not full.any():
            out[open_] = share[open_]
            break
        out[full] = most * sizes[full]
        left -= out[full].sum()
        open_ &= ~full
    return out


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients votes / (2 * seats + 1), no party above its ``most``; ties
    go to the first.

    Seats whose quotient is certainly high enough are dealt at once, the last ones one by one.
    """
    votes, most = np.asarray(votes, dtype=float), np.asarray(most, dtype=np.int64)
    seats = int(min(seats, most[votes > 0].sum()))
    low, high = 0.0, 2 * votes.sum() / max(seats, 1) + 1
    out = np.zeros(len(votes), dtype=np.int64)
    for _ in range(60):  # the least divisor that deals no more than there are
        divisor = (low + high) / 2
        dealt = np.minimum(np.floor(votes / divisor + 0.5), most).astype(np.int64)
        if dealt.sum() > seats:
            low = divisor
        else:
            high, out = divisor, dealt
    heap = [(-v / (2 * s + 1), i) for i, (v, s, m) in enumerate(zip(votes, out, most)) if s < m and v]
    heapq.heapify(heap)
    for _ in range(seats - int(out.sum())):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out


def _blocks(words: Column) -> Column:
    by_size = F.greatest(F.ceil(words / BLOCK_WORDS), F.lit(LEAST_BLOCKS))
    return F.least(words, by_size).cast("long")


def draw(sizes: np.ndarray, n_blocks: int, quota: int, seed: int) -> tuple[np.ndarray, list]:
    """The words of each text that a shard's quota takes, and the spans taken of each.

    The texts stand one after another and are cut into blocks that differ by a word at most.
    Every block is taken quota // n_blocks times, and once more those that the seed ranks first.
    """
    total = int(sizes.sum())
    edges = np.arange(n_blocks + 1, dtype=object) * total // max(n_blocks, 1)
    edges = edges.astype(np.int64)
    times = np.full(n_blocks, quota // max(n_blocks, 1), dtype=np.int64)
    numbers = np.arange(n_blocks, dtype=np.uint64) + np.uint64(seed & (2**64 - 1))
    ranked = np.lexsort((np.arange(n_blocks), scramble(numbers)))
    times[ranked[: quota - int(times.sum())]] += 1
    ends = np.cumsum(sizes)
    taken, spans = np.zeros(len(sizes), dtype=np.int64), []
    for t, (a, b) in enumerate(zip((ends - sizes).tolist(), ends.tolist())):
        mine = []
        if b > a:
            first = int(np.searchsorted(edges, a, side="right")) - 1
            while first < n_blocks and edges[first] < b:
                lo, hi = max(a, int(edges[first])), min(b, int(edges[first + 1]))
                n = int(times[first])
                if n and hi > lo:
                    taken[t] += n * (hi - lo)
                    if mine and mine[-1]["end"] == lo - a and mine[-1]["times"] == n:
                        mine[-1]["end"] = hi - a
                    else:
                        mine.append({"start": lo - a, "end": hi - a, "times": n})
                first += 1
        spans.append(mine)
    return taken, spans


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = MOST_TIMES,
    seed: int = 7,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """How many words of each document a mix of the sources takes.

    A document's size is its number of words (runs without ASCII white space; null: 0). Sources
    in the order of their code points, null last, weigh ``weights``, repeating, and share
    ``share`` times all words; none gets more than ``most`` times its own (see ``targets``).

    Returns ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` (the source's),
    ``taken`` (words, repeats counted) and ``takes`` (spans of word positions, end excluded,
    with how often each is taken); other columns of ``docs`` are ignored. No word is taken more
    than ``most`` times. A document without words, or of a source without, takes 0. Reruns
    agree: the draw depends on ids, sizes and the seed. Repeated rows are documents of their
    own. An empty table gives an empty result.
    """
    sized = settle(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            word_count(text).alias("size"),
        )
    )
    spark = sized.sparkSession
    totals = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    totals.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.n for r in totals]
    by_weight = [weights[i % len(weights)] for i in range(len(totals))]
    goal = targets(sizes, by_weight, share * sum(sizes), most)
    sources = spark.createDataFrame(
        [
            (i, r.source, int(r.n), float(t), max(1, -(-r.n // SHARD_WORDS)))
            for i, (r, t) in enumerate(zip(totals, goal))
        ],
        "_source int, source string, source_size long, target double, _shards long",
    )
    by_source = sized.join(
        F.broadcast(sources), sized.source.eqNullSafe(sources.source)
    ).select(
        "doc_id",
        sized.source,
        "size",
        "source_size",
        "target",
        "_source",
        F.xxhash64("doc_id", "size", F.lit(seed)).alias("_order"),
        F.pmod(F.xxhash64("doc_id", "size"), F.col("_shards")).alias("_shard"),
    )
    shards = settle(
        by_source.groupBy("_source", "_shard")
        .agg(F.sum("size").alias("_words"))
        .withColumn("_blocks", _blocks(F.col("_words")))
    )
    blocks = {r._source: r.n for r in shards.groupBy("_source").agg(F.sum("_blocks").alias("n")).collect()}
    n_blocks = np.array([blocks.get(i, 0) for i in range(len(totals))], dtype=np.int64)
    # a source's target in its own blocks
    votes = np.array([t * n / s if s else 0 for t, n, s in zip(goal, n_blocks, sizes)])
    seats = sainte_lague(votes, round(votes.sum()), most * n_blocks)

    def quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_shard", ignore_index=True)
        own = pdf["_blocks"].to_numpy()
        mine = sainte_lague(own, int(seats[int(pdf["_source"][0])]), most * own)
        return pdf.assign(_quota=mine)

    kinds = "_source int, _shard long, _words long, _blocks long, _quota long"
    dealt = shards.groupBy("_source").applyInPandas(quotas, kinds)

    def take(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_order", "doc_id", "size"], ignore_index=True)
        row = pdf.iloc[0]
        own_seed = int(scramble(np.array([seed * 1_000_003 + int(row["_source"])], dtype=np.uint64))[0])
        taken, spans = draw(
            pdf["size"].to_numpy(), int(row["_blocks"]), int(row["_quota"]),
            own_seed + (int(row["_shard"]) << 20),
        )
        out = pdf[["doc_id", "source", "size", "source_size", "target"]]
        return out.assign(taken=taken, takes=spans)

    kind = dict(sized.dtypes)["doc_id"]
    return (
        by_source.join(dealt.drop("_words"), ["_source", "_shard"])
        .groupBy("_source", "_shard")
        .applyInPandas(
            take,
            f"doc_id {kind}, source string, size long, source_size long, target double, "
            "taken long, takes array<struct<start:long,end:long,times:long>>",
        )
    )
