"""Alignment of two tokenizers' tokens over the same bytes.

A task turns some texts at a time into Arrow tables and works on these alone: token lists are
flattened with the indices of their parents, cumulative sums of token lengths give each token's
end, segmented by document through a key of document and end, and Acero joins on that key give the
places where tokens of both end (an inner match) and the stretches between neighbouring ends (all
keys). Each stretch lies in one token of either side, and no two stretches lie in the same two
tokens, so the stretches are the links.

How many documents hold an id pair linked is counted by ``Table.group_by`` for blocks of
documents; Spark adds the blocks' partial counts, finds the highest of each A id, and sends every
block the counts of its own distinct pairs back. Pairs are never rows of single documents in
Spark, and nothing is broadcast but the two vocabularies.

Texts are encoded in pieces that both tokenizers treat alone, each distinct piece once.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isospread.llm.memory import give_back
from isospread.llm.words import pieces, text_buffer
from isospread.sources.storage import settle

#: Links of a block of documents that asks for its pairs' counts together.
BLOCK_LINKS = 2_000_000
#: Bytes of text that are made a table at a time.
PIECE_BYTES = 2 << 20
#: Distinct pieces of text whose tokens a worker remembers.
REMEMBERED = 500_000

#: Bytes before a space at which a text may be cut there: ASCII other than white space and
#: controls, and last bytes of other characters except those that end a Unicode white space.
_CUT_AFTER = np.zeros(256, dtype=bool)
_CUT_AFTER[0x21:0x7F] = True
_CUT_AFTER[0x80:0xC0] = True
_CUT_AFTER[[0x85, 0xA0, 0xA8, 0xA9, 0xAF, 0x9F, *range(0x80, 0x8B)]] = False

#: Fixed value: how byte-level tokenizers of this kind split a text before merging.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_KINDS = (
    "row long, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<int>, summary boolean"
)


def _byte_of_symbol() -> dict[str, int]:
    """The byte that each printable character of a byte-level vocabulary stands for: printable
    Latin-1 stands for itself, the other bytes in order for the characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers: ids of a piece of text, and bytes of ids."""

    def __init__(self, json_a: str, model_b: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(json_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor()
        self.b.LoadFromSerializedProto(model_b)
        symbols = _byte_of_symbol()
        entries = sorted(self.a.get_vocab(with_added_tokens=False).items(), key=lambda e: e[1])
        self.bytes_a = [b""] * (max((i for _, i in entries), default=-1) + 1)
        for token, i in entries:
            self.bytes_a[i] = bytes(symbols[c] for c in token)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.n_b = len(self.bytes_b)
        self.lengths_a = pa.array([len(t) for t in self.bytes_a], pa.int64())
        self.lengths_b = pa.array([len(t) for t in self.bytes_b], pa.int64())
        # Both pieces of a text cut before a space are then encoded as they are within it: A's
        # pattern never joins a space to what stands before it, and no entry of B has a space mark
        # after another character, so its merges can't cross.
        pre = json.loads(json_a).get("pre_tokenizer") or {}
        self.separable = (
            pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and json.loads(json_a).get("normalizer") is None
            and not any(
                "▁" in self.b.id_to_piece(i).lstrip("▁")
                for i in range(self.n_b)
                if not self.b.is_control(i) and not self.b.is_unknown(i)
            )
        )
        self.space_b = self.b.piece_to_id("▁")
        self.quick = self._quick_a(json_a, symbols) if self.separable else None
        self.table_a = pa.array(self.bytes_a, pa.binary())
        self.table_b = pa.array(self.bytes_b, pa.binary())
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids_a = self.ids_b = pa.array([], pa.list_(pa.int32()))
        self.whole = np.zeros(0, dtype=bool)

    def _quick_a(self, json_a: str, symbols: dict[str, int]):
        """A faster library with A's own vocabulary, where A's merges stand in order of their ids
        (a rank is then an id). It serves printable ASCII, on whose classes of characters all
        versions of Unicode agree."""
        merges = json.loads(json_a)["model"].get("merges") or []
        ids = self.a.get_vocab(with_added_tokens=False)
        made = [ids["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        single = [i for i, t in enumerate(self.bytes_a) if len(t) == 1]
        if sorted(made) != made or len(single) != 256 or max(single) > min(made, default=1 << 30):
            return None
        if len(made) + 256 != len([t for t in self.bytes_a if t]):
            return None
        import tiktoken

        ranks = {t: i for i, t in enumerate(self.bytes_a) if t}
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids by A and B of texts that begin with a space; B adds that space by itself."""
        plain = [self.quick is not None and t.isascii() and t.isprintable() for t in texts]
        a = [self.quick.encode_ordinary(t) if p else None for t, p in zip(texts, plain)]
        others = [i for i, p in enumerate(plain) if not p]
        for i, e in zip(others, self.a.encode_batch([texts[i] for i in others], add_special_tokens=False)):
            a[i] = e.ids
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        return a, [ids if len(t) > 1 else [self.space_b] for t, ids in zip(texts, b)]

    def look_up(self, texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Id lists of distinct pieces by A and B, and whether both give the piece's bytes."""
        strings = texts.to_pylist()
        if len(self.known) + len(strings) > REMEMBERED:
            self._forget()
        new = [i for i, t in enumerate(strings) if t not in self.known]
        kind = pa.list_(pa.int32())
        for low in range(0, len(new), 8192):
            some = new[low : low + 8192]
            a, b = (pa.array(ids, kind) for ids in self.encode([strings[i] for i in some]))
            raw = texts.take(pa.array(some)).cast(pa.binary())
            self.known.update((strings[i], len(self.whole) + n) for n, i in enumerate(some))
            whole = _gives(a, self.table_a, raw) & _gives(b, self.table_b, raw)
            self.whole = np.concatenate([self.whole, whole])
            self.ids_a = pa.concat_arrays([self.ids_a, a])
            self.ids_b = pa.concat_arrays([self.ids_b, b])
        at = np.array([self.known[t] for t in strings], dtype=np.int64)
        return self.ids_a.take(pa.array(at)), self.ids_b.take(pa.array(at)), self.whole[at]


def _gives(ids: pa.Array, table: pa.Array, raw: pa.Array) -> np.ndarray:
    """Whether the bytes of each id list, joined, are the raw bytes."""
    joined = table.take(ids.flatten())
    cuts = np.frombuffer(ids.buffers()[1], dtype=np.int32)[ids.offset : ids.offset + len(ids) + 1]
    data, ends = text_buffer(joined)
    wanted, bounds = text_buffer(raw)
    spans = ends[cuts - cuts[0]]
    same = np.diff(spans) == np.diff(bounds)
    if same.all():
        off = np.concatenate(([0], np.cumsum(data != wanted)))
        return off[bounds[1:]] == off[bounds[:-1]]
    for i in np.flatnonzero(same):
        same[i] = (data[spans[i] : spans[i + 1]] == wanted[bounds[i] : bounds[i + 1]]).all()
    return same


def _cut(data: np.ndarray, offsets: np.ndarray, separable: bool) -> np.ndarray:
    """Where pieces start: at every text, and at spaces that both tokenizers keep apart."""
    begins = np.zeros(len(data), dtype=bool)
    if separable:
        begins[1:] = (data[1:] == 0x20) & _CUT_AFTER[data[:-1]]
    begins[offsets[:-1]] = True
    return np.flatnonzero(begins)


def _tokens(ids: pa.Array, pieces_at: pa.Array, doc_of_piece: np.ndarray, lengths: pa.Array) -> pa.Table:
    """Token occurrences of one side: document, key of document and end, and id."""
    lists = ids.take(pieces_at)
    flat = lists.flatten()
    doc = pc.take(pa.array(doc_of_piece), pc.list_parent_indices(lists))
    total = pc.cumulative_sum(lengths.take(flat))
    docs = doc.to_numpy()
    heads = np.flatnonzero(np.diff(docs, prepend=-1))
    ends = total.to_numpy()
    before = np.concatenate(([0], ends))[heads]  # the sum at which each document's segment begins
    within = ends - np.repeat(before, np.diff(np.append(heads, len(docs))))
    return pa.table({"key": pa.array((docs << 40) | within), "id": flat.cast(pa.int64())})


def _joined(ids: pa.Array, groups: np.ndarray, n: int) -> pa.Array:
    """The ids of each group in order, joined by commas."""
    offsets = np.searchsorted(groups, np.arange(n + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), ids.cast(pa.string())), ",")


def align(texts: pa.Array, by: Tokenizers) -> pa.Table:
    """Of every text the counts of ``_KINDS``, with its distinct linked pairs (A id * size of B's
    vocabulary + B id) and how many links each has."""
    n = len(texts)
    filled = np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False))
    spaced = pc.binary_join_element_wise(pa.scalar(" "), texts.take(pa.array(filled)), "")
    data, offsets = text_buffer(spaced)
    starts = _cut(data, offsets, by.separable)
    ends = pa.array(np.append(starts, len(data)).astype(np.int32))
    cut = pa.Array.from_buffers(
        pa.string(), len(starts), [None, ends.buffers()[1], pa.py_buffer(data.tobytes())]
    ).dictionary_encode()
    ids_a, ids_b, whole = by.look_up(cut.dictionary)
    at = cut.indices.to_numpy()
    doc = np.searchsorted(offsets, starts, side="right") - 1
    broken = np.unique(doc[~whole[at]])
    if len(broken):  # pieces differ: the text itself decides
        strings = spaced.take(pa.array(broken))
        a, b = by.encode(strings.to_pylist())
        same = [
            b"".join(by.bytes_a[i] for i in x) == t.encode() == b"".join(by.bytes_b[i] for i in y)
            for t, x, y in zip(strings.to_pylist(), a, b)
        ]
        broken = broken[~np.array(same, dtype=bool)]
    good = ~np.isin(doc, broken)
    doc, at = doc[good], pa.array(at[good])
    a = _tokens(ids_a, at, doc, by.lengths_a).rename_columns(["key", "a"])
    b = _tokens(ids_b, at, doc, by.lengths_b).rename_columns(["key", "b"])
    every = a.join(b, "key", join_type="full outer").sort_by("key").combine_chunks()
    common = pc.and_(every["a"].is_valid(), every["b"].is_valid()).combine_chunks().to_numpy(zero_copy_only=False)
    docs = every["key"].combine_chunks().to_numpy() >> 40
    group = np.cumsum(common) - common
    n_groups = int(common.sum())
    by_a, by_b = every["a"].is_valid(), every["b"].is_valid()
    text_a = _joined(every["a"].drop_null().combine_chunks(), group[by_a.to_numpy()], n_groups)
    text_b = _joined(every["b"].drop_null().combine_chunks(), group[by_b.to_numpy()], n_groups)
    each = pc.binary_join_element_wise(text_a, text_b, "|")
    first = np.searchsorted(docs[common], np.arange(len(filled) + 1)).astype(np.int32)
    written = pc.binary_join(pa.ListArray.from_arrays(pa.array(first), each), ";")
    # a stretch between neighbouring ends lies in the next token to end on either side
    pair = pc.add(
        pc.multiply(pc.fill_null_backward(every["a"]), by.n_b), pc.fill_null_backward(every["b"])
    )
    linked = (
        pa.table({"doc": pa.array(docs), "pair": pair})
        .group_by(["doc", "pair"])
        .aggregate([([], "count_all")])
        .sort_by([("doc", "ascending"), ("pair", "ascending")])
        .combine_chunks()
    )

    def per_text(counts: np.ndarray) -> np.ndarray:
        out = np.zeros(n, dtype=np.int64)
        out[filled] = counts
        return out

    size = len(filled)
    held = np.bincount(linked["doc"].to_numpy(), minlength=size)
    cuts = pa.array(np.append(0, np.cumsum(per_text(held))).astype(np.int32))
    hashes = [""] * n
    for i, (text, some) in enumerate(zip(written.to_pylist(), np.diff(first))):
        if some:
            hashes[filled[i]] = hashlib.sha256(text.encode()).hexdigest()
    return pa.table(
        {
            "n_a": per_text(np.bincount(docs[by_a.to_numpy()], minlength=size)),
            "n_b": per_text(np.bincount(docs[by_b.to_numpy()], minlength=size)),
            "n_groups": per_text(np.diff(first)),
            "n_links": per_text(np.bincount(docs, minlength=size)),
            "groups_sha256": pa.array(hashes, pa.string()),
            "pairs": pa.ListArray.from_arrays(cuts, linked["pair"].combine_chunks()),
            "times": pa.ListArray.from_arrays(cuts, linked["count_all"].combine_chunks().cast(pa.int32())),
        }
    )


def _summary(block: int, tables: list[pa.Table], schema: pa.Schema) -> pa.RecordBatch:
    """The distinct pairs of a block's texts and in how many of them each is linked."""
    pairs = pa.concat_arrays([c for t in tables for c in (x.flatten() for x in t["pairs"].chunks)])
    counted = pa.table({"pair": pairs}).group_by("pair").aggregate([([], "count_all")]).combine_chunks()
    cuts = pa.array([0, len(counted)], pa.int32())
    found = {
        "block": pa.array([block], pa.int64()),
        "pairs": pa.ListArray.from_arrays(cuts, counted["pair"].combine_chunks()),
        "times": pa.ListArray.from_arrays(cuts, counted["count_all"].combine_chunks().cast(pa.int32())),
        "summary": pa.array([True]),
    }
    columns = [found.get(f.name, pa.nulls(1, f.type)).cast(f.type) for f in schema]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


_loaded: dict[bytes, Tokenizers] = {}


def _loaded_by(json_a: str, model_b: bytes) -> Tokenizers:
    mark = hashlib.sha256(json_a.encode() + model_b).digest()
    if mark not in _loaded:
        _loaded.clear()
        _loaded[mark] = Tokenizers(json_a, model_b)
    return _loaded[mark]


def _looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums over the links of each of a block's texts, from the counts of the block's pairs."""
    left, right = left.combine_chunks(), right.combine_chunks()
    pairs, times = left["pairs"].combine_chunks(), left["times"].combine_chunks()
    links = pa.table(
        {"row": pc.list_parent_indices(pairs), "pair": pairs.flatten(), "times": times.flatten().cast(pa.int64())}
    ).join(right.select(["pair", "n", "best"]), "pair", join_type="inner")
    sums = (
        links.append_column("count_sum", pc.multiply(links["times"], links["n"]))
        .append_column("n_best", pc.multiply(links["times"], links["best"].cast(pa.int64())))
        .group_by("row")
        .aggregate([("count_sum", "sum"), ("n_best", "sum")])
    )
    order = sums["row"].to_numpy()
    out = {name: np.zeros(len(left), dtype=np.int64) for name in ("n_best", "count_sum")}
    for name, values in out.items():
        values[order] = sums[f"{name}_sum"].to_numpy()
    return pa.table(
        {"row": left["row"], **out, **{c: left[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")}}
    )


def align_tokens(
    docs: DataFrame, tokenizer_a: str, model_b: str, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Groups and links between two tokenizers' tokens of every text.

    ``tokenizer_a`` names a byte-level file of the ``tokenizers`` library, ``model_b`` a model of
    ``sentencepiece`` with byte fallback that adds a space in front; both are read on the driver
    and sent to the executors. A encodes a space and the text, B the text; strings of special
    tokens are plain text. Bytes at which tokens of both end cut them into groups; tokens whose
    bytes overlap are linked. Returns for each row ``doc_id`` (long), ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``n_best`` (links whose pair is held by as many texts as any pair
    of the same A id), ``count_sum`` (texts that hold the pair, summed over links) and
    ``groups_sha256`` (of the groups' ids, ``a1,a2|b1;a3|b2,b3``). Other columns are ignored.

    A text that is null or empty, or whose tokens by either don't give its bytes back, has no
    tokens: zeros and an empty string. Repeated rows are texts of their own, also in the counts,
    and null ids stay. An empty table gives an empty result.
    """
    with open(tokenizer_a, encoding="utf-8") as file_a, open(model_b, "rb") as file_b:
        sent = docs.sparkSession.sparkContext.broadcast((file_a.read(), file_b.read()))
    source = docs.select(F.col(doc_id).cast("long").alias("row"), F.col(text).alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = _loaded_by(*sent.value)
        number = TaskContext.get().partitionId() << 32
        schema = None
        held, n_links = [], 0
        for batch in batches:
            for piece in pieces(batch, "_text", PIECE_BYTES):
                found = align(piece.column("_text"), by)
                n = piece.num_rows
                found = found.append_column("row", piece.column("row"))
                found = found.append_column("block", pa.array(np.full(n, number)))
                found = found.append_column("summary", pa.array(np.zeros(n, dtype=bool)))
                names = [f.split()[0] for f in _KINDS.split(", ")]
                found = found.select(names)
                schema = found.schema
                yield from found.combine_chunks().to_batches()
                held.append(found.select(["pairs"]))
                n_links += pc.sum(found["n_links"]).as_py() or 0
                if n_links >= BLOCK_LINKS:
                    yield _summary(number, held, schema)
                    number, held, n_links = number + 1, [], 0
        if held:
            yield _summary(number, held, schema)

    # settled, so that a block has the same texts in whatever is read of it later
    encoded = settle(source.mapInArrow(give_back(encode), _KINDS))
    asked = encoded.where("summary").select(
        "block", F.explode(F.arrays_zip("pairs", "times")).alias("x")
    ).select("block", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("n"))
    n_b = len(_loaded_by(*sent.value).bytes_b)
    counts = asked.groupBy("pair").agg(F.sum("n").alias("n"))
    counts = settle(counts.withColumn("a", F.floor(F.col("pair") / n_b)))
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    marked = counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = asked.select("block", "pair").join(marked, "pair")
    texts = encoded.where(~F.col("summary"))
    fields = (
        "row long, n_best long, count_sum long, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string"
    )
    summed = (
        texts.where("n_links > 0")
        .withColumnRenamed("block", "home")
        .groupBy("home")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_looked_up, fields)
    )
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    none = texts.where("n_links = 0").withColumns({c: F.lit(0).cast("long") for c in ("n_best", "count_sum")})
    return summed.select(F.col("row").alias("doc_id"), *names).unionByName(
        none.select(F.col("row").alias("doc_id"), *names)
    )
