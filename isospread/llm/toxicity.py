"""Toxicity by the nearest labelled examples, under exact TF-IDF cosine.

Terms are all words and word beginnings of the labelled examples, a bounded sample of the labelled
rows; examples with equal vectors are one entry of the index. A term's weight is its TF-IDF, with
document frequencies over all documents, times a factor of 1 or more that grows with its chi-square
where it leans toxic; no term is left out. Postings of rare terms are traversed for all entries.
Entries are sorted into blocks, and for each frequent term the index holds the largest weight in
each block: what the rare terms gave, and the most that the frequent ones can add, bound a block,
and only blocks that can hold a nearer example are scored in full (block-max), so the result is
the same as that of scoring all. Votes are weighted by distance and calibrated on the examples
themselves, each scored without its own vote.

The index is bounded by the sample (see ``SAMPLE``) and broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from isospread.llm.memory import give_back
from isospread.llm.words import ALNUM, Words, mix, pieces, run_heads
from isospread.sources.storage import settle

#: Labelled rows the classifier is fitted on: its only bound. Of 4,061 held-out labelled documents
#: the area under the curve was 1.0 with 1,500, 3,000 and 6,000 (found 99.8 %, 100 % and 100 % of
#: the toxic ones, and none of the clean ones), so more examples cost time for nothing there.
SAMPLE = 3_000
NEIGHBOURS = 15
#: Entries of the index that are named as evidence.
EVIDENCE = 15
BLOCK = 64
#: Texts that are scored together, which shares the work for a block but holds all their products.
GROUP = 16
#: Bytes of text whose terms are found together; several workers do so beside an executor.
PIECE_BYTES = 1 << 18
#: Blocks that give the first threshold.
FIRST = 2
#: Terms in at least one of so many entries are frequent.
FREQUENT = 16
#: Lengths of word beginnings, in bytes.
BEGINNINGS = (4, 5)
#: Chi-square at which a term that leans toxic counts twice (p = 5 % with one degree of freedom).
DOUBLE = 3.84
#: Weight of a term that every text has, by which texts without other terms are alike.
COMMON = 1.0

FIELDS = (
    T.StructType()
    .add("score", "double")
    .add("predicted", "integer")
    .add(
        "evidence",
        T.ArrayType(
            T.StructType().add("doc_id", "long").add("cosine", "double").add("label", "integer")
        ),
    )
)


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, Words]:
    """All terms of the texts as hashes, and the text each stands in."""
    words = Words(texts, ALNUM, fold=True)
    of = words.text_of()
    lengths = words.ends - words.starts
    hashes, owners = [words.hashes()], [of]
    for n in BEGINNINGS:
        long = lengths > n
        hashes.append(mix(words.prefix_hashes(n)[long] + np.uint64(n)))
        owners.append(of[long])
    return np.concatenate(hashes), np.concatenate(owners), words


def _counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of each text, in order of the texts: text, term's hash, times."""
    hashes, of, _ = _terms(texts)
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    heads = np.flatnonzero(run_heads(of) | run_heads(hashes))
    return of[heads], hashes[heads], np.diff(np.append(heads, len(of)))


def _known(texts: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``_counted``, of the known terms (sorted) only, by their places."""
    hashes, of, _ = _terms(texts)
    at = np.searchsorted(known, hashes)
    at[at == len(known)] = 0
    hit = known[at] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
    pair, times = np.unique(of[hit] * (len(known) + 1) + at[hit], return_counts=True)
    text, term = np.divmod(pair, len(known) + 1)
    return text, term, times


def _stretches(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all stretches, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _print(term: np.ndarray, times: np.ndarray) -> int:
    """A fingerprint of a vector."""
    raw = np.concatenate([term, times]).astype(np.int64).tobytes()
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")


def _vectors(texts: pa.Array, known: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Which of the known terms each text has, and how often."""
    text, term, times = _known(texts, known)
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    return [(term[a:b], times[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def _lift(n: np.ndarray, n_toxic: np.ndarray, of: int, of_toxic: int) -> np.ndarray:
    """1 and more: what a term counts for beside its TF-IDF, by the examples with it."""
    clean = of - of_toxic
    cross = n_toxic * (clean - (n - n_toxic)) - (n - n_toxic) * (of_toxic - n_toxic)
    spread = max(of_toxic, 1) * max(clean, 1) * n * np.maximum(of - n, 1.0)
    return 1 + np.sqrt(of / DOUBLE / spread) * np.maximum(cross, 0)


class Postings:
    """Weights of the terms (rows, the common one last) in the entries, row by row."""

    def __init__(self, factor, term, entry, times):
        """Of postings in order of the entries; an entry has unit length with its common term."""
        order = np.argsort(term, kind="stable")
        self.cuts = np.append(0, np.cumsum(np.bincount(term, minlength=len(factor))))
        self.entry, self.times, self.factor = entry[order], times[order], factor
        self._weight = None

    @property
    def weight(self) -> np.ndarray:
        """Made where it is needed, so that counts are sent rather than weights."""
        if self._weight is None:
            weight = (1 + np.log(self.times)) * np.repeat(self.factor, np.diff(self.cuts))
            self.width = int(self.entry.max(initial=-1)) + 1
            self._weight = weight / np.sqrt(np.bincount(self.entry, weights=weight**2))[self.entry]
        return self._weight

    def __getitem__(self, term: np.ndarray) -> np.ndarray:
        """Some rows in full; in memory, the weights of an entry stand together."""
        weight = self.weight
        out = np.zeros((self.width, len(term)))
        for column, t in enumerate(term):
            span = slice(self.cuts[t], self.cuts[t + 1])
            out[self.entry[span], column] = weight[span]
        return out.T


class Index:
    """Entries of examples with equal vectors, the postings of their terms, and blocks of entries
    with the largest weight of each frequent term. ``factor`` is what a term counts for once."""

    def __init__(self, terms, factor, vectors, labels, ids):
        self.terms, self.factor = terms, factor
        entries: dict[int, list] = {}
        for (term, times), label, doc in zip(vectors, labels, ids):
            entry = entries.setdefault(_print(term, times), [term, times, 0, 0, doc])
            entry[2] += 1
            entry[3] += int(label)
        rows = len(terms) + 1
        n = len(entries)
        have = np.zeros(rows, dtype=np.int64)
        for e in entries.values():
            have[e[0]] += 1
        have[-1] = n
        self.often = np.flatnonzero(have * FREQUENT >= max(n, 1))
        self.place = np.full(rows, -1, dtype=np.int32)
        self.place[self.often] = np.arange(len(self.often))
        dense = np.zeros((n, len(self.often)), dtype=np.float32)
        for i, e in enumerate(entries.values()):
            term, weight = self.vector(e[0], e[1])
            often = self.place[term] >= 0
            dense[i, self.place[term[often]]] = weight[often]
        # like entries stand together, so that a block's largest weights are close to its own
        _, axes = np.linalg.eigh(dense.T @ dense)
        on = dense @ axes[:, ::-1][:, :6]
        sides = (on > np.median(on, axis=0)).T if n else on.T
        order = np.lexsort((np.arange(n), *on.T[:1], *sides[::-1]))
        heads = np.arange(0, n, BLOCK)
        self.heads = np.append(heads, n)
        self.block_max = np.zeros((len(self.often), len(heads)))
        for i, head in enumerate(heads):
            most = dense[order[head : head + BLOCK]].max(axis=0)
            self.block_max[:, i] = most.astype(float) * (1 + 1e-6)  # no rounding goes below
        del dense
        prints, kept = list(entries), list(entries.values())
        self.members = np.array([kept[i][2] for i in order], dtype=float)
        self.toxic = np.array([kept[i][3] for i in order], dtype=float)
        self.example = np.array([kept[i][4] for i in order], dtype=np.int64)
        self.prints = {prints[i]: at for at, i in enumerate(order)}
        sizes = np.array([len(kept[i][0]) + 1 for i in order], dtype=np.int64)
        ends = np.cumsum(sizes)
        term = np.empty(int(sizes.sum()), dtype=np.int32)
        counts = np.ones(len(term), dtype=np.int32)
        for i, end, size in zip(order, ends, sizes):
            term[end - size : end - 1], term[end - 1] = kept[i][0], len(terms)
            counts[end - size : end - 1] = kept[i][1]
        entry = np.repeat(np.arange(n, dtype=np.int32), sizes)
        self.weights = Postings(np.append(factor, COMMON), term, entry, counts)
        self._full = None
        self.slope, self.shift = 1.0, 0.0

    @property
    def frequent(self) -> np.ndarray:
        """The frequent terms' weights in full, made where they are needed."""
        if self._full is None:
            self._full = self.weights[self.often]
        return self._full

    def vector(self, term: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of unit length, the common term last."""
        weight = np.append((1 + np.log(times)) * self.factor[term], COMMON)
        return np.append(term, len(self.terms)), weight / np.sqrt((weight**2).sum())

    def group(self, vectors: list, but: list):
        """What ``nearest`` gives, for some texts."""
        size, n = len(vectors), len(self.members)
        made = [self.vector(*v) for v in vectors]
        text = np.repeat(np.arange(size), [len(t) for t, _ in made])
        term, weight = (np.concatenate(x) for x in zip(*made))
        place = self.place[term]
        often = place >= 0
        dense = np.zeros((size, len(self.often)))
        dense[text[often], place[often]] = weight[often]
        cuts, rare = self.weights.cuts, term[~often]
        lengths = cuts[rare + 1] - cuts[rare]
        at = _stretches(cuts[rare], lengths)
        partial = np.bincount(
            np.repeat(text[~often] * n, lengths) + self.weights.entry[at],
            weights=np.repeat(weight[~often], lengths) * self.weights.weight[at],
            minlength=size * n,
        ).reshape(size, n)
        bounds = np.maximum.reduceat(partial, self.heads[:-1], axis=1) + dense @ self.block_max
        cosines = np.full((size, n), -1.0)
        done = np.zeros(bounds.shape, dtype=bool)

        def fill(chosen: np.ndarray) -> None:
            for block in np.flatnonzero(chosen.any(axis=0)):
                rows = np.flatnonzero(chosen[:, block])
                here = slice(self.heads[block], self.heads[block + 1])
                # rounded, so that equal texts have equal cosines in whatever group they stand
                cosines[rows, here] = np.round(
                    partial[rows, here] + dense[rows] @ self.frequent[:, here], 12
                )
            done[:] |= chosen

        def least(i: int) -> float:
            """The cosine of the last neighbour found so far, or -1 if there are too few."""
            most = min(n, NEIGHBOURS + 1)
            best = np.argpartition(-cosines[i], most - 1)[:most]
            best = best[np.argsort(-cosines[i, best], kind="stable")]
            members = self.members[best]
            members = members - (best == but[i]) if but[i] is not None else members
            enough = np.searchsorted(np.cumsum(members), NEIGHBOURS)
            return cosines[i, best[enough]] if enough < most else -1.0

        first = np.zeros(bounds.shape, dtype=bool)
        np.put_along_axis(first, np.argsort(-bounds, axis=1)[:, :FIRST], True, axis=1)
        fill(first)
        lowest = np.array([least(i) for i in range(size)])
        fill((bounds >= lowest[:, None] - 1e-11) & ~done)
        out = []
        for i in range(size):
            found = np.flatnonzero((cosines[i] >= least(i)) & (cosines[i] >= 0))
            found = found[np.lexsort((found, -cosines[i, found]))]
            members = self.members[found]
            if but[i] is not None:
                members = members - (found == but[i])
            out.append((found, cosines[i, found], members))
        return out

    def nearest(self, term, times, but: int | None = None):
        """Entries with the nearest examples and their cosines; examples that tie with the last
        count too. ``but`` is an entry of which one example is left out."""
        return self.group([(term, times)], [but])[0]

    def votes(self, vectors: list, own_labels: list | None = None) -> Iterator[tuple]:
        """Of each text the share of toxic votes, weighted by 1 / (distance + 0.1), as log odds,
        and the evidence. With ``own_labels`` the texts are examples without their own votes."""
        for start in range(0, len(vectors), GROUP):
            some = vectors[start : start + GROUP]
            but = [None if own_labels is None else self.prints[_print(*v)] for v in some]
            for i, (found, cosines, members) in enumerate(self.group(some, but)):
                toxic = self.toxic[found].copy()
                if but[i] is not None:
                    toxic[found == but[i]] -= own_labels[start + i]
                weight = 1 / (1.1 - np.minimum(cosines, 1))
                yes, votes = (weight * toxic).sum(), (weight * members).sum()
                yield np.log((yes + 0.5) / (votes - yes + 0.5)), found, cosines

    def calibrate(self, odds, labels) -> None:
        """Slope and shift of the log odds, by Newton's method on the examples' own labels."""
        x, y = np.array(odds), np.array(labels, dtype=float)
        if not len(x) or y.min() == y.max():
            return
        # targets a little inside 0 and 1 keep the fit finite where the classes are separable
        y = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        a, b = 1.0, 0.0
        for _ in range(30):
            p = 1 / (1 + np.exp(-(a * x + b)))
            g = np.array([((p - y) * x).sum() + 1e-3 * (a - 1), (p - y).sum()])
            w = p * (1 - p)
            h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
            step = np.linalg.solve(h, g)
            a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
        if a > 0:
            self.slope, self.shift = float(a), float(b)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> Index:
    """The index of labelled examples.

    ``training`` picks rows of ``labels``; of these at most ``sample`` with a label of 0 or 1
    are drawn by a hash of their id. Every one of them votes, near copies too.
    """
    spark = docs.sparkSession
    drawn = (
        labels.where(training & F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
        .select(F.col(doc_id).cast("long").alias("_id"), F.col(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(sample)
    )
    wanted = settle(drawn)  # at most ``sample`` rows
    texts = settle(
        docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text")).join(
            F.broadcast(wanted), "_id"
        )
    )

    def spread(batches):
        for batch in batches:
            for piece in pieces(batch, "_text", PIECE_BYTES):
                of, hashes, times = _counted(piece.column("_text"))
                cuts = np.searchsorted(of, np.arange(piece.num_rows + 1))
                spans = list(zip(cuts[:-1], cuts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("_id"),
                        piece.column("_label"),
                        pa.array([hashes[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.array([times[a:b].astype(np.int32).tobytes() for a, b in spans], pa.binary()),
                    ],
                    ["_id", "_label", "terms", "times"],
                )

    kinds = "_id long, _label int, terms binary, times binary"
    examples = sorted(
        (tuple(r) for r in texts.mapInArrow(give_back(spread), kinds).collect()),
        key=lambda r: (r[0], r[1], bytes(r[2]), bytes(r[3])),
    )
    marks = np.array([r[1] for r in examples], dtype=np.int64)
    hashes = np.frombuffer(b"".join(r[2] for r in examples), dtype=np.uint64)
    times = np.frombuffer(b"".join(r[3] for r in examples), dtype=np.int32)
    cuts = np.cumsum([0, *(len(r[3]) // 4 for r in examples)])
    ids = [r[0] for r in examples]
    del examples
    terms = np.unique(hashes)
    place = np.empty(len(hashes), dtype=np.int32)
    for at in range(0, len(hashes), 1 << 18):
        place[at : at + (1 << 18)] = np.searchsorted(terms, hashes[at : at + (1 << 18)])
    del hashes
    shared = spark.sparkContext.broadcast(terms)

    def frequencies(batches):
        terms = shared.value
        total, count = np.zeros(len(terms) + 1, dtype=np.int64), 0
        for batch in batches:
            count += batch.num_rows
            for piece in pieces(batch, "_text", PIECE_BYTES):
                total += np.bincount(_known(piece.column("_text"), terms)[1], minlength=len(total))
        total[-1] = count
        have = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(total[have])], ["term", "n"])

    counted = (
        docs.select(F.col(text).alias("_text"))
        .mapInArrow(give_back(frequencies), "term long, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    seen_in = np.zeros(len(terms) + 1)
    seen_in[counted.column("term").to_numpy()] = counted.column("n").to_numpy()
    idf = np.log((1 + seen_in[-1]) / (1 + seen_in[:-1])) + 1
    bad_at = np.repeat(marks.astype(bool), np.diff(cuts))
    factor = idf * _lift(
        np.bincount(place, minlength=len(terms)),
        np.bincount(place[bad_at], minlength=len(terms)),
        len(marks),
        int(marks.sum()),
    )
    found = [(place[a:b], times[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    index = Index(terms, factor, found, marks, ids)
    del found, place, times, bad_at
    if len(marks):
        fitted = spark.sparkContext.broadcast(index)

        def own(batches):
            for batch in batches:
                for piece in pieces(batch, "_text", PIECE_BYTES):
                    vectors = _vectors(piece.column("_text"), fitted.value.terms)
                    labels = piece.column("_label").to_pylist()
                    odds = [v[0] for v in fitted.value.votes(vectors, labels)]
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("_id"), piece.column("_label"), pa.array(odds, pa.float64())],
                        ["_id", "_label", "odds"],
                    )

        fields = "_id long, _label int, odds double"
        told = sorted(texts.mapInArrow(give_back(own), fields).collect())
        fitted.destroy()
        index.calibrate([r[2] for r in told], [r[1] for r in told])
    return index


def score(docs: DataFrame, index: Index, keep: list[str], text: str = "text") -> DataFrame:
    """Toxicity of every text.

    Columns in ``keep`` are carried along; beside them come ``score`` (0 to 1), ``predicted``
    (1 from 0.5 on) and ``evidence`` (nearest entries: an example's id, the cosine, and the label
    of most of its examples). Input columns with these names are not kept. A null or empty text
    is scored like any text without known terms. Equal texts have equal scores. Without
    examples every score is 0. An empty table gives an empty result.
    """
    keep = [c for c in keep if c not in FIELDS.names]
    shared = docs.sparkSession.sparkContext.broadcast(index)
    source = docs.select(*keep, F.col(text).alias("_text"))
    schema = T.StructType([f for f in source.schema.fields if f.name in keep] + FIELDS.fields)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for piece in pieces(batch, "_text", PIECE_BYTES):
                n = piece.num_rows
                if len(index.example):
                    voted = list(index.votes(_vectors(piece.column("_text"), index.terms)))
                    odds = np.array([v[0] for v in voted])
                    scores = 1 / (1 + np.exp(-(index.slope * odds + index.shift)))
                    named = [v[1][:EVIDENCE] for v in voted]
                    at = np.concatenate(named)
                    cosines = np.concatenate([v[2][:EVIDENCE] for v in voted])
                else:
                    scores, named, at, cosines = np.zeros(n), [()] * n, np.zeros(0, dtype=np.int64), np.zeros(0)
                offsets = np.cumsum([0, *(len(x) for x in named)])
                label = 2 * index.toxic[at] >= index.members[at]
                entries = pa.StructArray.from_arrays(
                    [pa.array(index.example[at]), pa.array(cosines), pa.array(label.astype(np.int32))],
                    ["doc_id", "cosine", "label"],
                )
                columns = [piece.column(c) for c in keep]
                columns += [
                    pa.array(scores),
                    pa.array((scores >= 0.5).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries),
                ]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
                )

    return source.mapInArrow(give_back(run), schema)
