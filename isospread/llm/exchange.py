"""Questions that blocks of documents ask of the whole corpus, without moving tokens as rows.

Documents are cut into blocks of a bounded size. A block asks: it sends each *owner*, a range of
64-bit keys, the distinct keys it holds there. An owner adds up what all blocks say about a key
and answers each block in the order of its question. A block then goes on with the answers, asks
again in the next round, or finishes.

A key costs a few bytes instead of a row, and a key that a third of all documents hold is sent
once a block, so no key is hot. The documents travel once, compressed, with the first question;
later rounds and jobs read the same shuffle files. Nothing is cached: whatever an executor loses
is computed again from its inputs.

Blocks are numbered by input partition and order, so the documents must come from a scan or
another source that yields the same rows in the same order when a task is run again.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from isospread.llm.memory import give_back

BLOCK_BYTES = 2 << 20
OWNER_BYTES = 8 << 20
#: Keys of blocks begin here, those of owners at 0.
BLOCKS = 1 << 40
_CODEC = pa.Codec("zstd", compression_level=1)

Parts = dict[int, object]


def squeeze(value: object) -> bytes:
    """Pickled and compressed."""
    raw = pickle.dumps(value, protocol=5)
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def unsqueeze(blob: bytes) -> object:
    size = int.from_bytes(blob[:8], "little")
    return pickle.loads(_CODEC.decompress(blob[8:], decompressed_size=size, asbytes=True))


def freeze(block: pa.RecordBatch) -> bytes:
    """The rows alone; pickling a slice would take the whole batch along."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, block.schema) as writer:
        writer.write_batch(block)
    return sink.getvalue().to_pybytes()


def thaw(frozen: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(frozen).read_next_batch()


def pack_sorted(keys: np.ndarray) -> np.ndarray:
    """Sorted 64-bit keys as differences, their bytes laid out by place, which compresses the
    high places away."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)


def unpack_sorted(planes: np.ndarray) -> np.ndarray:
    steps = np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1)
    return np.cumsum(steps, dtype=np.uint64)


def owner_cuts(keys: np.ndarray, owners: int) -> np.ndarray:
    """Where the keys of each owner begin among sorted keys; one more than owners."""
    edges = (np.arange(1, owners, dtype=object) * (1 << 64) // owners).astype(np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def deal(keys: np.ndarray, owners: int, *columns: np.ndarray, everyone: bool = False) -> Parts:
    """A question for each owner: its share of the sorted keys and of the columns beside them.

    An owner without a share is asked nothing, unless ``everyone`` is to be asked.
    """
    cuts = owner_cuts(keys, owners)
    return {
        o: (pack_sorted(keys[a:b]), *(c[a:b] for c in columns))
        for o, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
        if everyone or b > a
    }


def gathered(answers: Parts) -> list:
    """The answers in the order of the owners, which is the order of the sorted keys."""
    return [answers[o] for o in sorted(answers)]


class Exchange:
    """Blocks of documents and the rounds of questions they ask.

    ``columns`` of ``docs`` travel with the block; ``text`` is among them and sets the size.
    """

    def __init__(
        self,
        docs: DataFrame,
        columns: list[str],
        text: str = "text",
        block_bytes: int = BLOCK_BYTES,
        owner_bytes: int = OWNER_BYTES,
    ):
        self.docs = docs.select(*columns)
        self.text = text
        self.block_bytes = block_bytes
        size = docs.agg(F.sum(F.octet_length(text).cast("long"))).head()[0] or 0
        parallelism = docs.sparkSession.sparkContext.defaultParallelism
        self.owners = max(2 * parallelism, -(-size // owner_bytes))
        half = self.owners
        self.parts = 2 * half

        def place(key: int) -> int:
            if key < BLOCKS:
                return key
            partition, serial = divmod(key - BLOCKS, 1 << 20)
            return half + (5 * partition + serial) % half

        self.place = place

    def start(self, ask: Callable[[pa.RecordBatch, int], Parts]) -> RDD:
        """Send every block on its way, with its first question.

        Rows come one by one, so that a task holds a block and not a batch of long texts.
        """
        size, owners = self.block_bytes, self.owners
        schema = to_arrow_schema(self.docs.schema)
        at = self.docs.columns.index(self.text)

        def packed(number, rows):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
            block = pa.RecordBatch.from_arrays(columns, schema=schema)
            yield BLOCKS + number, squeeze((number, "block", freeze(block)))
            for owner, part in ask(block, owners).items():
                yield owner, squeeze((number, "ask", part))

        def cut(index, rows):
            number, held, held_bytes = index << 20, [], 0
            for row in rows:
                held.append(row)
                held_bytes += len(row[at]) if row[at] else 0
                if held_bytes >= size:
                    yield from packed(number, held)
                    number, held, held_bytes = number + 1, [], 0
            if held:
                yield from packed(number, held)

        def run(index, rows):
            yield from give_back(lambda it: cut(index, it))(rows)

        return self._deal(self.docs.rdd.mapPartitionsWithIndex(run))

    def _deal(self, pairs: RDD) -> RDD:
        return pairs.partitionBy(self.parts, self.place)

    def answers(self, sent: RDD, answer: Callable[[list[tuple[int, object]]], Parts]) -> RDD:
        """Let every owner answer all that was asked of it; the answers go to the blocks."""

        def reply(pairs):
            asked = defaultdict(list)
            for key, blob in pairs:
                if key < BLOCKS:
                    asked[key].append(blob)
            for owner in sorted(asked):
                questions = sorted(
                    ((b, part) for b, _, part in map(unsqueeze, asked.pop(owner))),
                    key=lambda x: x[0],
                )
                for block, part in answer(questions).items():
                    yield BLOCKS + block, squeeze((block, owner, part))

        return self._deal(sent.mapPartitions(give_back(reply)))

    def _blocks(self, work: Callable, sent: RDD, *answers: RDD) -> RDD:
        rounds = len(answers)
        together = sent.map(lambda x: (x[0], (0, x[1])), preservesPartitioning=True)
        for i, told in enumerate(answers, start=1):
            tag = _tagger(i)
            together = together.union(told.map(tag, preservesPartitioning=True))
        if together.getNumPartitions() != sent.getNumPartitions():
            raise RuntimeError("blocks and their answers are dealt out differently")

        def each(pairs):
            parts = defaultdict(list)
            for key, blob in pairs:
                if key >= BLOCKS:
                    parts[key - BLOCKS].append(blob)
            for number in sorted(parts):
                block, told = None, [{} for _ in range(rounds)]
                for i, blob in parts.pop(number):
                    _, owner, part = unsqueeze(blob)
                    if i:
                        told[i - 1][owner] = part
                    else:
                        block = thaw(part)
                yield from work(number, block, *told)

        return together.mapPartitions(give_back(each))

    def ask_again(self, ask: Callable[..., Parts], sent: RDD, *answers: RDD) -> RDD:
        """The next round: ``ask(number, block, answers of each round so far)``."""

        def work(number, block, *told):
            for owner, part in ask(number, block, *told).items():
                yield owner, squeeze((number, "ask", part))

        return self._deal(self._blocks(work, sent, *answers))

    def finish(self, work: Callable, sent: RDD, *answers: RDD) -> RDD:
        """What ``work(number, block, answers of each round)`` yields for each block."""
        return self._blocks(work, sent, *answers)


def _tagger(i: int) -> Callable:
    return lambda x: (x[0], (i, x[1]))
