"""Tokenizer alignment, conversation repair and sketched near copies against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from isospread.llm import align, decontam, neardup, repair, tokens, toxicity
from isospread.llm.queries import ALIGNED, tokenizer_file
from isospread.llm.words import SPACED, Words

SCHEMA = "doc_id long, text string, row long, block long, node string, root int, mark string, pairs int"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def _documents() -> list[tuple]:
    draw = random.Random(11)
    vocabulary = [a + b for a in "Ab cd éf gh ij".split() for b in "kl mn op qr st".split()]

    def text(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    base = [text(draw.randint(1, 60)) for _ in range(25)]
    near = [" ".join(w if i % 30 else "odd" for i, w in enumerate(b.split(" "))) for b in base]
    near += [b.upper().replace(" ", "  ") for b in base[:5]]
    odd = [None, "", " \t\n", "one", "One", "two words", "words two", "a b c", "a\x0bb\x0c c\r\nd"]
    odd += [" ", "  x", "x  ", "▁ mark", "<s> </s> <|endoftext|>", "a  b　 c\x85 d", "日本 語 \U0001f600 z"]
    odd += ["it's  don't 'll 9,9 1\t\t 2 \r\n x", "\x00 a\x1c b", "word " * 3000, "x" * 4000]
    texts = base + base[:4] + near + odd
    rows = [(i, t, 7, 7, "n", 7, "m", 7) for i, t in enumerate(texts)]
    return rows + [rows[2], rows[2], (None, base[0], *rows[0][2:]), (None, "only here now", *rows[0][2:])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_documents(), SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# alignment


@pytest.fixture(scope="module")
def tokenizers():
    with open(tokenizer_file(ALIGNED[0])) as a, open(tokenizer_file(ALIGNED[1]), "rb") as b:
        return align.Tokenizers(a.read(), b.read())


def _aligned(texts, by) -> list[dict]:
    """By whole texts and a walk over both token lists."""
    out = []
    for t in texts:
        raw = f" {t}".encode()
        x = by.a.encode(f" {t}", add_special_tokens=False).ids if t else []
        y = by.b.encode(t) if t else []
        if not t or b"".join(by.bytes_a[i] for i in x) != raw or b"".join(by.bytes_b[i] for i in y) != raw:
            out.append({"n": (0, 0, 0), "links": [], "sha": ""})
            continue
        ends = [np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in ((by.bytes_a, x), (by.bytes_b, y))]
        i = j = 0
        links, groups, a, b = [], [], [x[0]], [y[0]]
        while True:
            links.append((x[i], y[j]))
            if ends[0][i] == ends[1][j]:
                groups.append(",".join(map(str, a)) + "|" + ",".join(map(str, b)))
                i, j = i + 1, j + 1
                if i == len(x):
                    break
                a, b = [x[i]], [y[j]]
            elif ends[0][i] < ends[1][j]:
                i += 1
                a.append(x[i])
            else:
                j += 1
                b.append(y[j])
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append({"n": (len(x), len(y), len(groups)), "links": links, "sha": sha})
    return out


def test_align(docs, tokenizers, monkeypatch):
    monkeypatch.setattr(align, "BLOCK_LINKS", 500)  # several blocks a task
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wanted = _aligned([t for _, t in rows], tokenizers)
    held = Counter(p for w in wanted for p in set(w["links"]))
    best: dict[int, int] = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    expected = [
        (
            doc, *w["n"], len(w["links"]), sum(held[p] == best[p[0]] for p in w["links"]),
            sum(held[p] for p in w["links"]), w["sha"],
        )
        for (doc, _), w in zip(rows, wanted)
    ]
    found = align.align_tokens(docs, *map(tokenizer_file, ALIGNED))
    assert found.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    # the mark of B's vocabulary is a space to it, so that text has no tokens
    assert sum(w["n"][0] == 0 for w in wanted) == 3


def test_align_pieces(tokenizers):
    """Cut texts give the ids of whole texts; the quick library those of the named one."""
    assert tokenizers.separable and tokenizers.quick is not None
    texts = [t for _, t, *_ in _documents() if t]
    data, offsets = align.text_buffer(pa.array([" " + t for t in texts]))
    starts = align._cut(data, offsets, True)
    assert len(starts) > len(texts)
    cut = [data[s:e].tobytes().decode() for s, e in zip(starts, np.append(starts[1:], len(data)))]
    a, b = tokenizers.encode(cut)
    whole_a = [i for e in tokenizers.a.encode_batch([" " + t for t in texts], add_special_tokens=False) for i in e.ids]
    assert [i for ids in a for i in ids] == whole_a
    assert [i for ids in b for i in ids] == [i for ids in tokenizers.b.encode(texts) for i in ids]


def test_align_nothing(spark, empty):
    files = list(map(tokenizer_file, ALIGNED))
    assert align.align_tokens(empty, *files).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    found = align.align_tokens(blank, *files).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


# conversation repair


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv, known, role, text = (" " if v is None else str(v) for v in (conv, turn, role, text))
        what = zlib.crc32(f"{conv}:{known}".encode()) % 20
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        out += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    return out


def _repaired(rows):
    """By all states of every row, with whole texts carried along."""
    seen, counts, kinds = set(), Counter(), []
    for _, role, text in rows:
        end = text.rstrip(repair.BLANKS)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else ""
        fault = fault or ("" if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
        counts[fault] += 1
        kinds.append((role[:1], fault))

    def closed(states):
        for _ in range(3):
            for state, (cost, audit, out) in list(states.items()):
                for role in ("user", "assistant"):
                    to = repair.STEPS.get((state, role[0]))
                    made = (cost + 5, audit + "I", out + [f"{role}:"])
                    if to is not None and (to not in states or made < states[to]):
                        states[to] = made
        return states

    states = {0: (0, "", [])}
    for (initial, fault), (_, role, text) in zip(kinds, rows):
        states, later = closed(states), {}
        for state, (cost, audit, out) in states.items():
            ways = [(state, (cost + 2, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                ways.append((repair.STEPS.get((state, initial)), (cost + more, audit + "K", out + [f"{role}:{text}"])))
                for to in ("user", "assistant"):
                    made = (cost + more + 1, audit + "R", out + [f"{to}:{text}"])
                    ways.append((repair.STEPS.get((state, to[0])), made))
            for to, made in ways:
                if to is not None and (to not in later or made < later[to]):
                    later[to] = made
        states = later
    cost, audit, out = min(v for s, v in closed(states).items() if s in (0, 3))
    illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(kinds, kinds[1:]))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)


def _conversations() -> list[tuple]:
    draw, rows = random.Random(5), []
    for conv in [*range(60), None]:
        for i in range(draw.choice([1, 2, 3, 8, 40])):
            turn = draw.choice([None, i, i, i, i + 3])
            role = draw.choice(["user", "assistant", "system", "tool", None, "", "User"])
            text = draw.choice(["a.", "b", "c!", " ", "", None, "é?", "d. \n", f"x{i}.", f"y{i}", "z" * 3000 + "."])
            rows.append((conv, turn, role, text))
    rows += [(61, t, r, f"{t}.") for t, r in enumerate(["user", "assistant"] * 150)]
    return rows + [(62, 1, "user", "same."), (62, 1, "user", "same."), (62, 1, "assistant", "same.")]


@pytest.mark.parametrize("bits", [2, 12])
def test_repair(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "SEGMENT_BITS", bits)  # 2: nearly all conversations have several segments
    rows = _conversations()
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.withColumns({c: F.lit("other") for c in ("conv", "mark", "at", "what", "name", "audit", "kind")})
    by = defaultdict(list)
    for row in rows:
        by[row[0]].append(row)
    found = {r[0]: tuple(r)[1:] for r in repair.repair_damaged(table).collect()}
    assert found == {conv: _repaired(_damage(held)) for conv, held in by.items()}


def test_repair_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_damaged(none).count() == 0
    gone = next(c for c in range(99) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "x.")], none.schema)
    sha = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in repair.repair_damaged(table).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", sha)]


def test_re_pair_gives_the_sequences_back():
    draw = random.Random(2)
    texts = ["".join(draw.choice("uaS-") for _ in range(draw.randint(0, 60))) for _ in range(40)]
    texts += ["u" * 33, "ua" * 200, "", "x"]
    left, rules = repair.re_pair(texts)

    def spelled(symbol):
        if symbol < len(repair.SYMBOLS):
            return repair.SYMBOLS[symbol]
        return "".join(map(spelled, rules[symbol - len(repair.SYMBOLS)]))

    assert ["".join(map(spelled, rest)) for rest in left] == texts
    pairs = Counter()
    for rest in left:
        i = 0
        while i + 1 < len(rest):
            pairs[rest[i], rest[i + 1]] += 1
            i += 2 if i + 2 < len(rest) and rest[i] == rest[i + 1] == rest[i + 2] else 1
    assert max(pairs.values(), default=0) < 2


def test_ropes_order_like_their_texts():
    draw = random.Random(3)
    ropes = ["", "D", "K"]
    for _ in range(300):
        parts = [draw.choice(ropes[-6:]), draw.choice(ropes[:9])]
        draw.shuffle(parts)
        ropes.append(repair.joined(*parts))
    for a in ropes[-40:]:
        for b in ropes[-40:]:
            assert repair.precedes(a, b) == (repair.written(a) < repair.written(b))


# near copies


def _groups(rows) -> list[tuple]:
    sets = []
    for _, text in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
        sets.append({tuple(words[i : i + 4]) for i in range(max(len(words) - 3, 1))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least: dict[int, int | None] = {}
    for i, (doc, _) in enumerate(rows):
        now = least.get(find(i))
        least[find(i)] = now if doc is None else doc if now is None else min(now, doc)
    return [(doc, len(s), least[find(i)], doc == least[find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("nodes", [512, 3])
def test_near_copies(docs, monkeypatch, nodes):
    monkeypatch.setattr(neardup, "BLOCK_NODES", nodes)  # 3: components are cut into blocks
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = neardup.near_copies(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, _groups(rows)))


def test_near_copies_in_chains_and_crowds(spark, monkeypatch):
    """A chain whose ends aren't alike, a crowd of near copies, and a crowd of many null ids."""
    monkeypatch.setattr(neardup, "BLOCK_NODES", 16)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(90)]
    rows += [(1000 + i, " ".join(["c" + w if n == i else "c" + w for n, w in enumerate(words[:80])] + [f"end{i}"])) for i in range(60)]
    rows += [(None, f"null {i} " + " ".join("n" + w for w in words[:40])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = neardup.near_copies(docs)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, _groups(rows)))


def test_near_copies_nothing(empty):
    assert neardup.near_copies(empty).count() == 0


def test_sketches_fill_and_estimate():
    draw = np.random.default_rng(1)
    pool = np.unique(draw.integers(1, 1 << 63, 6000, dtype=np.uint64))
    sets = [pool[:1], pool[:2], pool[:5000], pool[500:5500]]
    made = neardup.sketches(sets)
    assert made.shape == (4, neardup.COORDINATES) and (made != neardup.EMPTY).all()
    assert abs((made[2] == made[3]).mean() - 4500 / 5500) < 0.13
    # a union's coordinate is the least of its parts'
    both = neardup.sketches([np.union1d(pool[:1], pool[100:103])])
    assert (both[0] == np.minimum(made[0], neardup.sketches([pool[100:103]])[0])).all()


def test_word_hashes_have_no_rule():
    """Two words of 1,024 letters that collide under every polynomial modulo 2**64."""
    signs = [bin(i).count("1") & 1 for i in range(1024)]
    one, other = ("".join("1a"[s ^ k] for s in signs) for k in (0, 1))
    words = Words(pa.array([f"{one} {other} {one.upper()}"]), SPACED, fold=True)
    h = neardup.word_hashes(words)
    assert h[0] != h[1] and h[0] == h[2]


def test_token_counts_of_words_that_share_hashes(spark):
    signs = [bin(i).count("1") & 1 for i in range(1024)]
    texts = ["".join(letters[s ^ k] for s in signs) for letters in ("1a", "an") for k in (0, 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = tokens.count_prefixes(docs, tokenizer_file(), ["doc_id"]).orderBy("doc_id").collect()
    with open(tokenizer_file()) as file:
        counter = tokens.WordCounter(file.read())
    wanted = counter.encode_counts(texts)
    assert [r.n_tokens for r in found] == wanted and len(set(wanted)) == 4


# pipeline stages


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Columns named like those that the operators add, or use inside, keep their values."""
    names = [*toxicity.FIELDS.names, *decontam.FIELDS.names, "n_lines", "removed", "kept_text", "_text", "_id", "_hash", "_key", "class_id"]
    names = list(dict.fromkeys(n for n in names if n not in ("doc_id", "text")))
    words = " ".join(f"w{i}" for i in range(40))
    texts = [words, words + " more", "one line\none line", None, "", "a clean text"]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], schema)
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names})
    spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i", "nothing of this")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, str(tmp_path))
        assert done.columns == docs.columns, name
        rows = done.collect()
        assert len(rows) >= 4, name
        assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names), name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
