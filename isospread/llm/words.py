"""Words of many texts at once, as spans and 64-bit hashes over the bytes of an Arrow column.

Both kinds of word are defined by single bytes of UTF-8, since every byte of a character beyond
ASCII is 0x80 or more: ``SPACED`` words are runs without ASCII white space, ``ALNUM`` words are
runs of ASCII digits, ASCII letters and characters beyond ASCII.

Hashes are polynomials in an odd base modulo 2**64 over a table of random values, so sums over
any run of bytes or words come from one running total, and are then mixed. Different words share
a hash with a probability of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE_BYTES = 4 << 20
SEGMENT_BYTES = 256 << 10

_codes = np.arange(256)
SPACED = ~((_codes == 0x20) | ((_codes >= 0x09) & (_codes <= 0x0D)))
ALNUM = (
    ((_codes >= 0x30) & (_codes <= 0x39))
    | ((_codes >= 0x41) & (_codes <= 0x5A))
    | ((_codes >= 0x61) & (_codes <= 0x7A))
    | (_codes >= 0x80)
)
#: Each byte with A-Z in lower case.
LOWER = np.where((_codes >= 0x41) & (_codes <= 0x5A), _codes + 32, _codes).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of SplitMix64)."""
    x = np.asarray(x, dtype=U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def run_heads(values: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return new


def distinct_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct keys, and the place of each key among them.

    Sorts the keys' high bits packed with their positions, which is faster than sorting
    positions; where different keys agree in those bits, sorts positions after all.
    """
    bits = U64(max(len(keys) - 1, 1).bit_length())
    packed = np.sort((keys >> bits << bits) | np.arange(len(keys), dtype=U64))
    order = (packed & ((U64(1) << bits) - U64(1))).astype(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    new = run_heads(ordered)
    places = np.empty(len(keys), dtype=np.int64)
    places[order] = np.cumsum(new) - 1
    return ordered[new], places


class Polynomial:
    """Hashes of runs of values: sum of value[i] * base**i, taken back to the run's start."""

    def __init__(self, base: int):
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.forget()

    def forget(self) -> None:
        """Let go of the powers, which grow with the longest run so far."""
        self._powers = self._inverses = np.ones(1, dtype=U64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers) < n:
            size = max(n, 2 * len(self._powers))
            for name, b in (("_powers", self.base), ("_inverses", self.inverse)):
                factors = np.full(size, b, dtype=U64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        return self._powers[:n], self._inverses[:n]

    def totals(self, values: np.ndarray) -> np.ndarray:
        """Running totals, one longer than the values."""
        out = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(values * self.powers(len(values))[0], out=out[1:])
        return out

    def runs(self, totals: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Unmixed hashes of the runs [start, end)."""
        inverses = self.powers(len(totals))[1]
        return (totals[ends] - totals[starts]) * inverses[starts]


_BYTES = Polynomial(0x9E3779B97F4A7C15)
WORD_RUNS = Polynomial(0xD6E8FEB86659FD93)
#: An independent base, where 64 bits are not enough.
WORD_RUNS_2 = Polynomial(0xA0761D6478BD642F)
_TABLE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def forget_powers() -> None:
    """Let go of the powers of all bases; they are made again where they are needed."""
    for base in (_BYTES, WORD_RUNS, WORD_RUNS_2):
        base.forget()


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets, one more than rows; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    ends = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1]
    ends = ends.astype(np.int64)
    if data is None or len(ends) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


class Words:
    """Spans of the words of the texts: word w is data[starts[w]:ends[w]], and text t has the
    words first[t] to first[t + 1]."""

    def __init__(self, texts: pa.Array | tuple[np.ndarray, np.ndarray], kind=SPACED, fold=False):
        self.data, self.offsets = texts if isinstance(texts, tuple) else text_buffer(texts)
        self.fold = fold
        inside = kind[self.data]
        begins, ends = inside.copy(), inside.copy()
        if len(inside):
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            heads = self.offsets[:-1][self.offsets[:-1] < len(inside)]
            tails = self.offsets[1:][self.offsets[1:] > 0] - 1
            begins[heads] = inside[heads]
            ends[tails] = inside[tails]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        return self._hashes(self.ends)

    def prefix_hashes(self, n_bytes: int) -> np.ndarray:
        """Hashes of the first bytes of each word, or of all of a shorter one."""
        return self._hashes(np.minimum(self.starts + n_bytes, self.ends))

    def _hashes(self, ends: np.ndarray) -> np.ndarray:
        """Some words at a time, so that working memory stays small whatever the texts' size."""
        table = _TABLE[LOWER] if self.fold else _TABLE
        out = np.empty(len(self), dtype=U64)
        low = 0
        while low < len(self):
            at = self.starts[low]
            high = max(low + 1, int(np.searchsorted(self.ends, at + SEGMENT_BYTES, "right")))
            totals = _BYTES.totals(table[self.data[at : self.ends[high - 1]]])
            out[low:high] = _BYTES.runs(totals, self.starts[low:high] - at, ends[low:high] - at)
            low = high
        return mix(out)

    def word(self, w: int) -> bytes:
        raw = self.data[self.starts[w] : self.ends[w]]
        return (LOWER[raw] if self.fold else raw).tobytes()


def window_starts(first: np.ndarray, n: int) -> np.ndarray:
    """The words at which a window of n words of one text starts."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(counts) - counts
    return np.repeat(first[:-1] - before, counts) + np.arange(total)


def run_hashes(
    hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, by: Polynomial = WORD_RUNS
) -> np.ndarray:
    """Hashes of runs of words; equal runs have equal hashes wherever they stand."""
    return mix(by.runs(by.totals(hashes), starts, ends))


def hash_word(word: bytes) -> int:
    data = np.frombuffer(word, dtype=np.uint8)
    return int(Words((data, np.array([0, len(data)])), kind=np.ones(256, dtype=bool)).hashes()[0])


def pieces(batch: pa.RecordBatch, column: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have about ``size`` bytes; a longer text stands alone."""
    texts = batch.column(column)
    lengths = np.diff(text_buffer(texts)[1])
    start, held = 0, 0
    for row, n in enumerate(lengths):
        if row > start and held + n > size:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += int(n)
    if start < len(lengths):
        yield batch.slice(start)
