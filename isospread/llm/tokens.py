"""Token counts of every prefix, by dynamic programming over the words of a text.

The tokenizer never joins characters across white space, so the count of a prefix that ends with
a word is the count of the prefix before plus the word's own. Words are counted by the tokenizer's
library, each distinct word once, and the running counts are stored: how many tokens a prefix has,
and where a text must be cut for a budget, is then answered without encoding again.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from isospread.llm.memory import give_back
from isospread.llm.words import SPACED, Words, pieces

#: Words a worker remembers between pieces of text, before it starts anew.
REMEMBERED = 500_000

FIELDS = (
    T.StructType()
    .add("n_bytes", "long")
    .add("n_tokens", "long")
    .add("prefix_ends", T.ArrayType(T.IntegerType()))
    .add("prefix_tokens", T.ArrayType(T.IntegerType()))
)


class WordCounter:
    """Tokens of single words, by the library's own encoding, remembered."""

    def __init__(self, tokenizer_json: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def encode_counts(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def counts(self, words: pa.Array) -> np.ndarray:
        """Tokens of distinct words. A word is known by itself, so no two can be mistaken."""
        strings = words.to_pylist()
        if len(self.known) + len(strings) > REMEMBERED:
            self.known = {}
        new = [w for w in strings if w not in self.known]
        for low in range(0, len(new), 10_000):
            some = new[low : low + 10_000]
            self.known.update(zip(some, self.encode_counts(some)))
        return np.array([self.known[w] for w in strings], dtype=np.int32)

    def prefix(self, text: str) -> np.ndarray:
        """The tokens of every prefix of one text, by characters, from 0 to all of it."""
        spaces = " \t\n\r\x0b\x0c"
        out, before, start = [0], 0, 0
        for at, c in enumerate(text):
            if c in spaces:
                before, start = out[-1], at + 1
                out.append(before)
            else:
                out.append(before + self.encode_counts([text[start : at + 1]])[0])
        return np.array(out)


def _strings(words: Words) -> pa.Array:
    """The words as an Arrow column."""
    ends = np.append(0, np.cumsum(words.ends - words.starts)).astype(np.int32)
    data = words.data[SPACED[words.data]]
    return pa.Array.from_buffers(
        pa.string(), len(words), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]
    )


_counters: dict[str, WordCounter] = {}


def _lists(values: np.ndarray, first: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(
        pa.array(first.astype(np.int32)), pa.array(values.astype(np.int32))
    )


def count_prefixes(
    docs: DataFrame, tokenizer_path: str, keep: list[str], text: str = "text"
) -> DataFrame:
    """Token counts of every text and of each of its prefixes that ends with a word.

    ``tokenizer_path`` names a file of the ``tokenizers`` library whose pre-tokenizer splits at
    white space; it is read on the driver and sent to the executors. Nothing is added, truncated
    or padded; strings of special tokens inside a text become those tokens, the library's
    default. Columns in ``keep`` are carried along; beside them come ``n_bytes`` (UTF-8),
    ``n_tokens``, ``prefix_ends`` (characters up to the end of each word) and ``prefix_tokens``
    (tokens up to there). Input columns with these names are not kept.

    A null or empty text has no bytes, tokens or prefixes. Rows are independent, so repeated rows
    and ties need no rule. An empty table gives an empty result.
    """
    keep = [c for c in keep if c not in FIELDS.names]
    with open(tokenizer_path, encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    source = docs.select(*keep, F.col(text).alias("_text"))
    schema = T.StructType([f for f in source.schema.fields if f.name in keep] + FIELDS.fields)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model.value not in _counters:
            _counters.clear()
            _counters[model.value] = WordCounter(model.value)
        counter = _counters[model.value]
        for batch in batches:
            for piece in pieces(batch, "_text"):
                words = Words(piece.column("_text"), SPACED)
                encoded = _strings(words).dictionary_encode()
                each = counter.counts(encoded.dictionary)[encoded.indices.to_numpy()]
                totals = np.concatenate(([0], np.cumsum(each)))
                per_text = np.repeat(totals[words.first[:-1]], words.counts)
                later = np.concatenate(([0], np.cumsum((words.data & 0xC0) == 0x80)))
                begins = np.repeat(words.offsets[:-1], words.counts)
                ends = words.ends - begins - (later[words.ends] - later[begins])
                columns = [piece.column(c) for c in keep]
                columns += [
                    pa.array(np.diff(words.offsets)),
                    pa.array(totals[words.first[1:]] - totals[words.first[:-1]]),
                    _lists(ends, words.first),
                    _lists(totals[1:] - per_text, words.first),
                ]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
                )

    return source.mapInArrow(give_back(count), schema)


def truncated(budget: int, text: str = "text") -> Column:
    """The longest prefix of whole words with at most ``budget`` tokens, from stored counts."""
    fit = F.size(F.filter("prefix_tokens", lambda n: n <= budget))
    end = F.when(fit > 0, F.element_at("prefix_ends", F.greatest(fit, F.lit(1)))).otherwise(0)
    return F.substring(F.col(text), F.lit(1), end)
