"""Language-model scores by deleted interpolation.

Maximum-likelihood estimates of all orders are mixed; the weights depend on how often the context
was seen, in buckets of powers of two, and are learned by expectation-maximisation on documents
kept out of the counts. Afterwards the counts take in those documents too.

N-grams are 64-bit hashes of words with A-Z in lower case. Blocks of documents ask the owners of
their n-grams for corpus counts (see ``exchange``); nothing about the vocabulary is collected.
What reaches the driver is a histogram over rounded ratios of probabilities, of a fixed size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isospread.llm.exchange import Exchange, deal, gathered, unpack_sorted
from isospread.llm.words import SPACED, Words, distinct_places, run_hashes, run_heads

ORDER = 2
ROUNDS = 50
BASE, HELD, OUT = 0, 1, 2
BEGIN, END = np.uint64(0x5EED_BE61_0000_0001), np.uint64(0x5EED_E4D0_0000_0003)
#: Ratios of probabilities are rounded to this many steps per factor of two.
STEPS = 4
_MIDDLE, _BITS = 512, 11

FIELDS = (
    T.StructType()
    .add("n_tokens", "long")
    .add("n_known", "long")
    .add("train_tokens", "long")
    .add("base_score", "double")
    .add("score", "double")
)


class _Grams:
    """Keys of the n-grams of a block: of every order, the one that ends at each token."""

    def __init__(self, texts: pa.Array, order: int):
        words = Words(texts, SPACED, fold=True)
        counts = words.counts
        self.n_tokens = counts + 1
        pad = order - 1
        sizes = counts + 1 + pad
        ends = np.cumsum(sizes)
        heads = ends - sizes
        tokens = np.full(int(sizes.sum()), BEGIN, dtype=np.uint64)
        real = np.ones(len(tokens), dtype=bool)
        for i in range(pad):
            real[heads + i] = False
        real[ends - 1] = False
        tokens[real] = words.hashes()
        tokens[ends - 1] = END
        real[ends - 1] = True
        at = np.flatnonzero(real)
        self.text_of = np.repeat(np.arange(len(counts)), self.n_tokens)
        self.first = heads - pad * np.arange(len(counts))

        self.grams = [
            self._flag(run_hashes(tokens, at - k + 1, at + 1), k > 1) for k in range(1, order + 1)
        ]
        self.begins = np.concatenate(
            [self._flag(run_hashes(np.full(k, BEGIN), *_ends(k)), True) for k in range(1, order)]
            or [np.zeros(0, dtype=np.uint64)]
        )

    @staticmethod
    def _flag(keys: np.ndarray, longer: bool) -> np.ndarray:
        """The lowest bit tells tokens (0) from longer n-grams and the start of a text (1)."""
        return (keys & ~np.uint64(1)) | np.uint64(longer)

    def contexts(self) -> list[np.ndarray]:
        """For every order above 1, the key of what comes before each token."""
        out = []
        for gram, begin in zip(self.grams, self.begins):
            before = np.empty_like(gram)
            before[1:] = gram[:-1]
            before[self.first] = begin
            out.append(before)
        return out

    def keys(self, texts: np.ndarray | None = None) -> np.ndarray:
        """Sorted keys of all occurrences, of all texts or of the chosen ones."""
        begins = np.repeat(self.begins, len(self.first) if texts is None else int(texts.sum()))
        if texts is None:
            return np.sort(np.concatenate([*self.grams, begins]))
        tokens = texts[self.text_of]
        return np.sort(np.concatenate([*(g[tokens] for g in self.grams), begins]))


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[run_heads(ordered)]


def _times(distinct: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """How often each distinct key stands in a sorted array."""
    out = np.zeros(len(distinct), dtype=np.uint32)
    heads = np.flatnonzero(run_heads(ordered))
    out[np.searchsorted(distinct, ordered[heads])] = np.diff(heads, append=len(ordered))
    return out


def _ends(k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.array([0]), np.array([k])


def _answer(asked: list) -> dict:
    """Corpus counts of the keys asked for, and the owner's part of the corpus totals."""
    keys = [unpack_sorted(part[0]) for _, part in asked]
    distinct, place = distinct_places(np.concatenate(keys))
    sums = []
    for which in (1, 2):
        each = np.concatenate([part[which] for _, part in asked])
        sums.append(np.bincount(place, weights=each, minlength=len(distinct)).astype(np.int64))
    base, held = sums
    token = (distinct & np.uint64(1)) == 0
    totals = np.array(
        [x for c in (base, base + held) for x in (c[token].sum(), (c[token] > 0).sum())]
    )
    told, start = {}, 0
    for (block, _), k in zip(asked, keys):
        mine = place[start : start + len(k)]
        start += len(k)
        told[block] = (base[mine].astype(np.uint32), held[mine].astype(np.uint32), totals)
    return told


def _estimates(
    grams: list[np.ndarray], contexts: list[np.ndarray], n: int
) -> tuple[np.ndarray, list, np.ndarray]:
    """From counts of n-grams and contexts, per token: the bucket of its longest context, the
    estimate of every order, and which of these exist (their context was seen)."""
    estimates = [grams[0] / max(n, 1)]
    exist = [np.full(len(grams[0]), n > 0)]
    longest = np.full(len(grams[0]), n)
    for gram, longest in zip(grams[1:], contexts):
        estimates.append(gram / np.maximum(longest, 1))
        exist.append(longest > 0)
    bucket = np.frexp(longest.astype(np.float64))[1]
    return bucket, estimates, np.array(exist)


def _bins(ratio: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        steps = np.rint(STEPS * np.log2(ratio)) + _MIDDLE
    return np.where(ratio > 0, np.clip(steps, 1, (1 << _BITS) - 1), 0).astype(np.int64)


def learn_weights(cells: dict[int, int], order: int) -> np.ndarray:
    """Weights by bucket, the uniform estimate first, by expectation-maximisation.

    ``cells`` counts held-out tokens by bucket and rounded ratios. A bucket without any takes
    the weights of all tokens.
    """
    weights = np.full((65, order + 1), 1 / (order + 1))
    if not cells:
        return weights
    key = np.fromiter(cells.keys(), dtype=np.int64, count=len(cells))
    times = np.fromiter(cells.values(), dtype=np.float64, count=len(cells))
    ratios = np.ones((len(key), order + 1))
    for k in range(order):
        step = (key >> (_BITS * k)) & ((1 << _BITS) - 1)
        ratios[:, k + 1] = np.where(step > 0, 2.0 ** ((step - _MIDDLE) / STEPS), 0)
    bucket = key >> (_BITS * order)

    def fit(r, t):
        w = np.full(order + 1, 1 / (order + 1))
        for _ in range(ROUNDS):
            part = r * w
            part *= (t / part.sum(axis=1))[:, None]
            w = part.sum(axis=0) / t.sum()
        w = np.maximum(w, 1e-6)
        return w / w.sum()

    weights[:] = fit(ratios, times)
    for b in np.unique(bucket):
        mine = bucket == b
        weights[b] = fit(ratios[mine], times[mine])
    return weights


def score(
    docs: DataFrame,
    split: Column,
    keep: list[str],
    text: str = "text",
    order: int = ORDER,
) -> DataFrame:
    """Base-10 log probabilities of every text.

    ``split`` says what a document is for: 0 counts, 1 counts after the weights are learned on
    it, 2 none (only scored). Columns in ``keep`` are carried along, and beside them come
    ``n_tokens`` (words and one end), ``n_known`` (tokens that the training documents hold),
    ``train_tokens``, ``base_score`` (add-one unigrams) and ``score``. Columns of these names
    in ``docs`` are not kept; others are ignored.

    A null text is empty: one token, the end. Equal texts have equal scores, and repeated rows
    count as often as they occur. Without training documents every score is 0. With few
    documents kept out, buckets unseen there share one set of weights. An empty table gives
    an empty result.
    """
    keep = [c for c in keep if c not in FIELDS.names]
    blocks = docs.select(*keep, F.col(text).alias("_text"), split.cast("int").alias("_split"))
    exchange = Exchange(blocks, blocks.columns, text="_text")

    def split_of(block):
        return block.column("_split").to_numpy(zero_copy_only=False)

    def ask(block, owners):
        grams = _Grams(block.column("_text"), order)
        keys = _distinct(grams.keys())
        of = split_of(block)
        seen = [_times(keys, grams.keys(of == which)) for which in (BASE, HELD)]
        return deal(keys, owners, *seen, everyone=True)

    def learnt(told):
        parts = gathered(told)
        base, held = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (0, 1))
        return base, held, sum(p[2] for p in parts)

    def histogram(number, block, told):
        base, _, (n, kinds, _, _) = learnt(told)
        grams = _Grams(block.column("_text"), order)
        keys = _distinct(grams.keys())
        mine = (split_of(block) == HELD)[grams.text_of]

        def counts(of):
            return [base[np.searchsorted(keys, k[mine])] for k in of]

        bucket, estimates, _ = _estimates(counts(grams.grams), counts(grams.contexts()), n)
        cell = bucket.astype(np.int64) << (_BITS * order)
        for k, p in enumerate(estimates):
            cell |= _bins(p * (kinds + 1)) << (_BITS * k)
        for value, times in zip(*np.unique(cell, return_counts=True)):
            yield int(value), int(times)

    sent = exchange.start(ask)
    answers = exchange.answers(sent, _answer)
    cells = exchange.finish(histogram, sent, answers).reduceByKey(lambda a, b: a + b, 16)
    weights = learn_weights(dict(cells.collect()), order)

    def scores(number, block, told):
        base, held, (_, _, n, kinds) = learnt(told)
        grams = _Grams(block.column("_text"), order)
        places = distinct_places(np.concatenate([*grams.grams, grams.begins]))[1]
        counts = (base + held)[places]
        size = len(grams.text_of)
        of_grams = [counts[k * size : (k + 1) * size] for k in range(order)]
        of_contexts = []
        for gram, begin in zip(of_grams, counts[order * size :]):
            before = np.roll(gram, 1)
            before[grams.first] = begin
            of_contexts.append(before)
        bucket, estimates, exist = _estimates(of_grams, of_contexts, n)
        w = weights[bucket].T
        total = w[0] / (kinds + 1)
        norm = w[0].copy()
        for k, p in enumerate(estimates):
            total += w[k + 1] * p
            norm += w[k + 1] * exist[k]
        seen = of_grams[0]
        texts = len(grams.n_tokens)

        def summed(values):
            return np.bincount(grams.text_of, weights=values, minlength=texts)

        plain = np.log10((seen + 1) / (n + kinds + 1))
        mixed = np.log10(total / norm)
        known = summed(seen > 0).astype(np.int64)
        columns = [block.column(c).to_pylist() for c in keep]
        columns += [grams.n_tokens.tolist(), known.tolist(), [int(n)] * texts]
        columns += [summed(plain).tolist(), summed(mixed).tolist()]
        yield from zip(*columns)

    kept = [f for f in blocks.schema.fields if f.name in keep]
    rows = exchange.finish(scores, sent, answers)
    schema = T.StructType(kept + FIELDS.fields)
    return docs.sparkSession.createDataFrame(rows, schema, verifySchema=False)


def crc_split(doc_id: str = "doc_id", modulus: int = 7, out: int = 2, held: int = 8) -> Column:
    """Documents whose crc32 of the id as text leaves ``out`` are only scored; of the rest, every
    ``held``-th by the next digit is kept out of the counts until the weights are learned. A
    null id counts as text of crc 0."""
    crc = F.coalesce(F.crc32(F.col(doc_id).cast("string")), F.lit(0))
    return (
        F.when(crc % modulus == out, OUT)
        .when(F.floor(crc / modulus) % held == 0, HELD)
        .otherwise(BASE)
    )


def perplexity(score: float, n_tokens: int) -> float:
    """Per token, from a base-10 log probability."""
    return math.pow(10, -score / n_tokens)
