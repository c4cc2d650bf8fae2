"""The operators against brute force, on texts with nulls, blanks, copies and repeated rows."""

from __future__ import annotations

import itertools
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from isospread.llm import (
    components,
    decontam,
    html,
    jaccard,
    linededup,
    lm,
    maxscore,
    memory,
    mix,
    substring,
    tokens,
    toxicity,
    words,
)
from isospread.llm.queries import ORACLES, QUERIES, tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, score double, hits int"


def _texts() -> list[str | None]:
    draw = random.Random(3)
    vocabulary = [a + b for a in "ab cd éf gh ij".split() for b in "kl mn op qr st".split()]

    def line(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    base = ["\n".join(line(draw.randint(1, 30)) for _ in range(draw.randint(1, 6))) for _ in range(30)]
    passage = line(50)
    near = [" ".join(w if i % 40 else "odd" for i, w in enumerate(b.split(" "))) for b in base[:8]]
    swapped = []
    for b in base[8:14]:
        parts = b.split("\n")
        longest = max(range(len(parts)), key=lambda i: len(parts[i]))
        w = parts[longest].split(" ")
        for edit in (w[:3] + ["new"] + w[4:], w[:3] + w[4:], w[:3] + ["new"] + w[3:]):
            swapped.append("\n".join([*parts[:longest], " ".join(edit), *parts[longest + 1 :]]))
    odd = [None, "", " \t\n", "one", "two words", "a\x0bb\x0c c\r\nd", "\n\n", "é é ÀÉ Zz", "x" * 5000]
    shared = [line(20) + " " + passage, passage + " " + line(9), line(4) + " " + passage[:40]]
    return base + base[:6] + near + swapped + odd + odd[:4] + shared + ["word " * 3000]


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, 0.5, 1) for i, t in enumerate(TEXTS)]
    rows += [rows[3], rows[3], (None, "a null id", None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def test_words_and_hashes():
    texts = pa.array(["a bb\ta", None, "", "bb", " x "])
    found = words.Words(texts)
    assert [found.word(i) for i in range(len(found))] == [b"a", b"bb", b"a", b"bb", b"x"]
    assert found.counts.tolist() == [3, 0, 0, 1, 1]
    h = found.hashes()
    assert h[0] == h[2] != h[1] == h[3]
    assert words.hash_word(b"bb") == int(h[1])
    distinct, places = words.distinct_places(h)
    assert (distinct[places] == h).all() and len(distinct) == 3


def test_mix(spark, docs, empty):
    found = mix.mix(docs).toPandas()
    assert len(found) == docs.count()
    again = mix.mix(docs.repartition(3)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(str, found[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))
    assert (found.taken <= 2 * found["size"]).all()
    for _, g in found.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= max(64, 0.02 * g.target.iloc[0])
    for r in found.itertuples():
        assert sum((s["end"] - s["start"]) * s["times"] for s in r.takes) == r.taken
    assert mix.mix(empty).count() == 0


def test_targets_and_seats():
    goal = mix.targets([10, 100, 100], [3, 1, 2], 315, 2)
    assert goal.tolist() == pytest.approx([20, 98.3333, 196.6667], abs=1e-3)
    # highest quotients, one seat at a time
    votes, most = np.array([53.0, 24.0, 23.0, 0.0, 5.0]), np.array([4, 9, 9, 9, 9])
    seats = [0] * 5
    for _ in range(13):
        best = max(
            (i for i in range(5) if seats[i] < most[i] and votes[i]),
            key=lambda i: (votes[i] / (2 * seats[i] + 1), -i),
        )
        seats[best] += 1
    assert mix.sainte_lague(votes, 13, most).tolist() == seats
    assert mix.sainte_lague(votes, 1000, most).sum() == 31


def test_lm(docs, rows, empty):
    found = lm.score(docs, lm.crc_split(), ["doc_id"]).toPandas()
    assert len(found) == len(rows)
    import zlib

    def lower(word):
        return bytes(c + 32 if 65 <= c <= 90 else c for c in word)

    texts = [[lower(w) for w in _split(t)] + [b"\n"] for _, t in rows]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    seen = Counter(w for t, o in zip(texts, out) if not o for w in t)
    n, kinds = sum(seen.values()), len(seen)
    expected = sorted(
        (len(t), sum(seen[w] > 0 for w in t), n, round(sum(np.log10((seen[w] + 1) / (n + kinds + 1)) for w in t), 6))
        for t in texts
    )
    got = sorted(
        (r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found.itertuples()
    )
    assert got == expected
    assert (found.score <= 0).all() and found.score.sum() > found.base_score.sum()
    assert lm.score(empty, lm.crc_split(), ["doc_id"]).count() == 0


def test_lm_interpolates_counts(spark):
    draw = random.Random(6)
    texts = [[draw.choice("abcdef") for _ in range(draw.randint(0, 9))] for _ in range(60)]
    parts = [(0, 1, 0, 2)[i % 4] for i in range(60)]
    table = spark.createDataFrame(
        [(i, " ".join(t), p) for i, (t, p) in enumerate(zip(texts, parts))],
        "doc_id long, text string, part int",
    )

    def counts(which):
        single, pair = Counter(), Counter()
        for t, p in zip(texts, parts):
            if p in which:
                padded = ["^", *t, "$"]
                single.update(padded)
                pair.update(zip(padded, padded[1:]))
        return single, pair

    def estimates(single, pair, before, word):
        n = sum(v for k, v in single.items() if k != "^")
        kinds = sum(k != "^" for k in single)
        seen = single[before]
        return int(seen).bit_length(), 1 / (kinds + 1), single[word] / n, pair[before, word] / max(seen, 1)

    cells = Counter()
    for t, p in zip(texts, parts):
        for before, word in zip(["^", *t], [*t, "$"]):
            if p == 1:
                bucket, p0, p1, p2 = estimates(*counts([0]), before, word)
                b1, b2 = lm._bins(np.array([p1 / p0, p2 / p0]))
                cells[(bucket << 2 * lm._BITS) | int(b1) | (int(b2) << lm._BITS)] += 1
    weights = lm.learn_weights(cells, 2)
    assert weights.sum(axis=1) == pytest.approx(np.ones(65))
    single, pair = counts([0, 1])
    found = {r.doc_id: r.score for r in lm.score(table, F.col("part"), ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        expected = 0.0
        for before, word in zip(["^", *t], [*t, "$"]):
            bucket, p0, p1, p2 = estimates(single, pair, before, word)
            w = weights[bucket]
            expected += np.log10(w[0] * p0 + w[1] * p1 + w[2] * p2)
        assert found[i] == pytest.approx(expected, abs=1e-6)


def test_toxicity(spark, empty):
    draw = random.Random(1)
    plain = [f"w{i}" for i in range(60)]
    made = []
    for i in range(600):
        toxic = i % 8 == 0
        text = [draw.choice(plain) for _ in range(40)] + ([draw.choice(["Vile", "vileness", "scum"])] * 2 if toxic else [])
        draw.shuffle(text)
        made.append((i, " ".join(text), int(toxic)))
    table = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    labels = table.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    more = spark.createDataFrame([(1000, None), (1001, ""), (None, "scum vile")], "doc_id long, text string")
    index = toxicity.fit(table.select("doc_id", "text"), labels, F.col("doc_id") % 5 != 0)
    scored = toxicity.score(table.select("doc_id", "text").unionByName(more), index, ["doc_id"]).toPandas()
    by_id = dict(zip(scored.doc_id, scored.predicted))
    held = [(i, y) for i, _, y in made if i % 5 == 0]
    assert np.mean([by_id[i] == y for i, y in held]) > 0.97
    assert scored.score.between(0, 1).all() and by_id[1000] == by_id[1001] == 0
    # block-max gives what scoring every entry gives
    for term, times in [(np.array([0]), np.array([1])), (np.array([0, 1]), np.array([2, 1]))]:
        _, cosines, members = index.nearest(term, times)
        at, weight = index.vector(term, times)
        every = np.repeat(weight @ index.weights[at], index.members.astype(int))
        least = np.sort(every)[::-1][min(toxicity.NEIGHBOURS, len(every)) - 1]
        assert cosines.min() == pytest.approx(least)
        assert members.sum() == (every >= least - 1e-12).sum()
    assert toxicity.score(empty, index, ["doc_id"]).count() == 0
    none = toxicity.fit(empty, labels, F.lit(True))
    assert toxicity.score(more, none, ["doc_id"]).toPandas().score.tolist() == [0, 0, 0]


def test_toxicity_keeps_every_example(spark):
    draw = random.Random(4)
    shared = [f"p{i}" for i in range(30)]
    made = []
    for i in range(120):
        own = [f"w{draw.randrange(400)}" for _ in range(40)]
        made.append((i, " ".join(shared + own), int(i % 3 == 0)))
    table = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    index = toxicity.fit(table, table.select("doc_id", "toxic"), F.lit(True))
    assert index.members.sum() == 120 and index.toxic.sum() == 40


def test_toxicity_counts_every_term(spark):
    draw = random.Random(8)
    common = [f"c{i}" for i in range(30)]
    made = []
    for i in range(400):
        text = draw.sample(common, 12) + [f"rare{draw.randrange(300)}" for _ in range(8)]
        made.append((i, " ".join(text + ["scum"] * (i % 9 == 0)), int(i % 9 == 0)))
    table = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    index = toxicity.fit(table, table.select("doc_id", "toxic"), F.lit(True))
    # clean words are terms too, so a text without toxic ones is nearest to its own copy
    scored = toxicity.score(table, index, ["doc_id"]).collect()
    assert len(index.terms) > 300
    for r in scored:
        assert r.evidence[0].doc_id == r.doc_id and r.evidence[0].cosine == pytest.approx(1)
        assert len(r.evidence) == toxicity.NEIGHBOURS
    # only some blocks are scored, with the result of scoring all
    for _, text, _ in made[:40]:
        (term, times), = toxicity._vectors(pa.array([text]), index.terms)
        found, cosines, _ = index.nearest(term, times)
        at, weight = index.vector(term, times)
        every = weight @ index.weights[at]
        assert cosines[:15] == pytest.approx(np.sort(every)[::-1][:15])
        assert cosines == pytest.approx(every[found])


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD", 70)
    monkeypatch.setattr(maxscore, "BLOCK", 7)
    draw = np.random.default_rng(2)
    vectors = [(i, v.tolist()) for i, v in enumerate(draw.normal(0, 0.2, (300, 9)).round(2))]
    vectors += [(300 + i, vectors[i][1]) for i in range(40)]
    vectors += [(400, None), (401, [None] * 9), (402, [float("nan")] + [0.0] * 8), (403, [float("inf")] * 9)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    for k in (5, 500):
        found = maxscore.top_k(table.where("vec_id % 20 = 0"), table, k=k)
        got = sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())
        fine = [(i, np.floor(64 * np.float32(v).astype(float)).astype(int)) for i, v in vectors if i < 400]
        expected = []
        for q, a in fine:
            if q % 20 == 0:
                best = sorted((-int(a @ b), i) for i, b in fine if i != q)[:k]
                expected += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
        assert got == sorted(expected)
    assert maxscore.top_k(table.limit(0), table).count() == 0
    assert maxscore.top_k(table.where("vec_id = 0"), table.limit(0)).count() == 0


def test_top_k_with_repeated_ids(spark, monkeypatch):
    draw = np.random.default_rng(5)
    made = draw.normal(0, 0.2, (400, 9)).round(2)
    vectors = [(i, v.tolist()) for i, v in enumerate(made)]
    vectors += [(0, (3 * made[0]).round(2).tolist())] * 25 + [(7, vectors[7][1])] * 25
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").coalesce(2)
    fine = [(i, np.floor(64 * np.float32(v).astype(float)).astype(int)) for i, v in vectors]
    asked = [x for x in fine[:400] if x[0] in (0, 7, 11)]
    expected = []
    for q, a in asked:
        best = sorted((-int(a @ b), i) for i, b in fine if i != q)[:20]
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    queries = spark.createDataFrame([vectors[q] for q, _ in asked], table.schema)
    for shard in (4096, 70):
        monkeypatch.setattr(maxscore, "SHARD", shard)
        found = maxscore.top_k(queries, table, k=20).select("query_id", "rank", "vec_id", "score")
        assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
    # the rows of one id are dealt to all shards
    same = spark.createDataFrame([vectors[7]] * 400, table.schema)
    parts = maxscore._pack(maxscore.quantised(same, "vec_id", "embedding"), 4).collect()
    assert len(parts) == 4 and max(len(r.ids) // 8 for r in parts) < 200


def test_substring(docs, rows, empty):
    found = substring.remove_repeats(docs, ["doc_id", "n_words"][:1]).toPandas()
    split = [_split(t) for _, t in rows]
    seen = Counter(tuple(w[k : k + 35]) for w in split for k in range(len(w) - 34))
    expected = []
    for (i, _), w in zip(rows, split):
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        expected.append((str(i), len(w), sum(gone), kept))
    ids = [None if np.isnan(i) else int(i) for i in found.doc_id]
    got = list(zip(map(str, ids), found.n_words, found.n_removed, found.kept_text))
    assert sorted(got) == sorted(expected) and found.n_removed.sum() > 0
    for r in found.itertuples():
        assert sum(s["end"] - s["start"] for s in r.removed) == r.n_removed
    assert substring.remove_repeats(empty, ["doc_id"]).count() == 0


def test_decontaminate(spark, docs, rows, empty, monkeypatch):
    items = [(i, " ".join((t or "").split()[2:30])) for i, t in enumerate(TEXTS[:40:3])]
    items += [(77, None), (78, ""), (None, TEXTS[1]), (79, "Two WORDS"), (79, "two words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def split(text):
        return word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    windows = defaultdict(set)
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(None if i is None else str(i))
    expected = []
    for _, t in rows:
        w, names = split(t), set()
        hit = [False] * len(w)
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit[k : k + n] = [True] * n
                    names |= windows[tuple(w[k : k + n])]
        expected.append((len(w), sum(hit), sorted(names - {None})))
    for size in (decontam.PART_BYTES, 700):
        monkeypatch.setattr(decontam, "PART_BYTES", size)
        found = decontam.find_items(docs, bench, ["doc_id", "hits"]).collect()
        assert sorted((r.n_words, r.n_hit, r["items"]) for r in found) == sorted(expected)
    assert decontam.find_items(empty, bench, ["doc_id"]).count() == 0
    clean = decontam.find_items(docs, bench.limit(0), ["doc_id"])
    assert clean.where("n_hit > 0").count() == 0 and clean.count() == len(rows)


def _one_edit(a, b) -> bool:
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def test_line_dedup(docs, rows, empty):
    found = linededup.dedup_lines(docs, ["doc_id"]).toPandas()
    lines = [
        (10**9 if i is None else i, at, n, tuple(w))
        for at, (i, t) in enumerate(rows)
        for n, line in enumerate((t or "").split("\n"))
        if (w := _split(line))
    ]
    lines.sort(key=lambda x: x[:3])
    gone = Counter()
    for k, (i, _, n, w) in enumerate(lines):
        if any(v == w or (min(len(v), len(w)) >= 8 and _one_edit(v, w)) for *_, v in lines[:k]):
            gone[i, n] += 1
    got = Counter(
        (10**9 if np.isnan(r.doc_id) else int(r.doc_id), x["line"])
        for r in found.itertuples()
        for x in r.removed
    )
    assert got == gone and len(gone) > 20
    one = found[found.doc_id == 1].iloc[0]
    assert one.n_lines == sum(bool(x.split()) for x in TEXTS[1].split("\n"))
    assert linededup.dedup_lines(empty, ["doc_id"]).count() == 0


def test_jaccard(docs, rows, empty, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    found = jaccard.similar(docs).toPandas()
    assert len(found) == len(rows)
    sets = []
    for _, t in rows:
        w = _split(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = Counter()
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
            n[a] += 1
            n[b] += 1
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    expected = sorted((str(i), str(least.get(g)), n[k]) for k, ((i, _), g) in enumerate(zip(rows, group)))

    def name(x):
        return str(None if np.isnan(x) else int(x))

    got = sorted((name(r.doc_id), name(r.class_id), r.n_links) for r in found.itertuples())
    assert got == expected and max(n.values()) >= 2
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(group)) - sum(c - 1 for c in Counter(i for (i, t) in rows if not _split(t)).values())
    assert jaccard.similar(empty).count() == 0


def test_least_agreement():
    least = jaccard.least_agreement(0.8, 1e-7)
    assert least[16] < 0.8 * 16 and least[160] < 0.8 * 160 and (np.diff(least) >= 0).all()


def test_components(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(50)] + [(draw.randrange(100, 160), draw.randrange(100, 160)) for _ in range(40)]
    found = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: root[x] for x in touched}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_token_counts(spark, docs, rows, empty):
    from tokenizers import Tokenizer

    texts = [t for _, t in rows] + ["a<|endoftext|>b Don't", "İstanbul ΣΑΣ é é ́x", "<|startoftext|>"]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    library = Tokenizer.from_file(tokenizer_file())
    found = tokens.count_prefixes(table, tokenizer_file(), ["text"])
    for r in found.withColumn("cut", tokens.truncated(7)).collect():
        text = r.text or ""
        assert r.n_bytes == len(text.encode())
        assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
        for end, count in list(zip(r.prefix_ends, r.prefix_tokens))[:20]:
            assert count == len(library.encode(text[:end], add_special_tokens=False).ids)
        if r.text:
            assert len(library.encode(r.cut, add_special_tokens=False).ids) <= 7
    counter = tokens.WordCounter(open(tokenizer_file(), encoding="utf-8").read())
    some = "ab Don't <|endoftext|> x"
    assert counter.prefix("Don't stop")[-1] == len(library.encode("Don't stop", add_special_tokens=False).ids)
    assert counter.prefix(some)[-1] == len(library.encode(some, add_special_tokens=False).ids)
    assert tokens.count_prefixes(empty, tokenizer_file(), ["doc_id"]).count() == 0


PAGES = "/root/testdata/sf0.01/pages.parquet"


def test_main_text(spark):
    pages = spark.read.parquet(PAGES)
    model = html.train(pages, sample=60)
    other = [
        ("null", None),
        ("empty", ""),
        ("text", "  only   text "),
        (
            "layout",
            "<div class=page><div class='site-header'><a href=/>Home</a></div><ul id=menu><li><a href=/a>A</a></li>"
            "<li><a href=/b>B</a></li></ul><div class=post-content><h1>A title &amp; more</h1><p>The first paragraph of the "
            "article, which is long enough to read.<p>The second one,\n with   space &lt;here&gt;, and a few more words.</div>"
            "<div class=comments><div class=comment><p>Great article, thanks for sharing it with us all!</p></div></div>"
            "<div class=footer>&copy; 2020 somebody</div><script>var x = '<p>no</p>';</script></div>",
        ),
    ]
    table = pages.select(F.col("page_id").cast("string").alias("id"), "html").union(
        spark.createDataFrame(other, "id string, html string")
    )
    found = {r.id: r for r in html.extract(table, model, ["id"]).collect()}
    assert found["null"].text == found["empty"].text == ""
    assert found["layout"].blocks == [
        "A title & more",
        "The first paragraph of the article, which is long enough to read.",
        "The second one, with space <here>, and a few more words.",
    ]
    import html as entities

    wrong = 0
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        parts = [re.sub(r"<[^>]*>", " ", x) for x in re.split(r"<(?:/?p|/?h1)[^>]*>", body)]
        expected = [y for x in parts if (y := " ".join(entities.unescape(x).split()))]
        wrong += found[str(r.page_id)].text != "\n\n".join(expected)
    assert wrong <= 5
    assert html.extract(pages.limit(0), model, ["page_id"]).count() == 0


def test_decoding_has_no_contradictions():
    nodes = html.Nodes()
    nodes.read("<div><p>one</p><div><p>two</p><p>three</p></div></div>")
    draw = np.random.default_rng(4)
    parent = np.array(nodes.parent)
    for _ in range(50):
        keep = nodes.decode(draw.normal(0, 3, len(parent)))
        assert (keep[1:] <= keep[parent[1:]]).all()
        for i in np.flatnonzero(keep):
            assert nodes.text[i] or keep[parent == i].any()


def test_pipeline(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stage_docs = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, stage_docs, "/root/testdata/sf0.001")
        assert out.dtypes == docs.dtypes
        rows = out.collect()
        assert 0 < len(rows) <= stage_docs.count()
        stage_docs = spark.createDataFrame(rows, docs.schema)
    mixed = corpus_pipeline.run(spark, "/root/testdata/sf0.001").toPandas()
    assert sorted(mixed.doc_id) == sorted(r.doc_id for r in rows) and mixed.taken.sum() > 0


def test_pipeline_keeps_one_set_of_workers(spark):
    """RDD and DataFrame stages use workers of one daemon."""

    def parents(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([os.getppid()])], ["pid"])

    before = {k: spark.conf.get(k) for k in (corpus_pipeline.BATCH_SETTING, corpus_pipeline.TRACEBACK_SETTING)}
    try:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
        corpus_pipeline.drop_toxic(spark, docs, "/root/testdata/sf0.001")
        by_frame = {r.pid for r in spark.range(4).mapInArrow(parents, "pid long").collect()}
        by_rdd = set(spark.sparkContext.range(4).map(lambda _: os.getppid()).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert by_frame == by_rdd and len(by_rdd) == 1


def test_powers_go_with_the_task():
    texts = pa.array(["ab cd " * 5_000])

    def hashed(batches):
        for text in batches:
            found = words.Words(text)
            yield words.run_hashes(found.hashes(), np.array([0, 7]), np.array([9_000, 9_999]))

    first, again = (np.concatenate(list(memory.give_back(hashed)(iter([texts])))) for _ in range(2))
    assert (first == again).all()
    for base in (words._BYTES, words.WORD_RUNS, words.WORD_RUNS_2):
        assert len(base._powers) == len(base._inverses) == 1


def test_every_query_is_registered():
    from __spark_entry__ import oracle_sql, queries

    names = {q.split("_")[0] for q in QUERIES}
    assert names == {f"op{i}" for i in range(1, 14)}
    assert QUERIES.keys() | {"pipeline"} <= queries().keys()
    assert ORACLES.keys() <= oracle_sql().keys()
