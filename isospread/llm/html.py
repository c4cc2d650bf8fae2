"""Main text of web pages, by boosted trees over the nodes of the page and a consistent decoding.

A page is read into its block elements and the runs of text between their borders. Boosted trees
give each node the log odds that its subtree holds main text, from its share of the page's text
and links, density, tag, words of its attributes, depth and siblings. The decoding then takes the
most likely choice in which a node is kept only if its parent is: no kept text under a dropped
ancestor, no kept node without anything kept below. Text runs that are kept make the text.

There are no labelled pages, so the trees are trained on a bounded sample of the pages themselves,
where an ``article`` or ``main`` element marks the main text, and on variants of these: the same
texts laid out anew under other tags, class names and depths, with menus, notices, adverts, forms,
sidebars and reader comments made of texts of other pages. What is main is known there. The names
used are listed below.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from isospread.llm.gbdt import BoostedTrees
from isospread.llm.memory import give_back
from isospread.llm.words import pieces

#: Pages drawn for training, and layouts made of each: the only bounds of the model.
SAMPLE = 200
VARIANTS = 3
#: Weight of a page as it is, beside its variants.
OWN_WEIGHT = 3.0
#: Part of an element's evidence that its children inherit.
INHERIT = 0.4
#: Longer pages are not used for training; all pages are extracted whole.
TRAINING_CHARS = 60_000

# Elements of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template svg iframe object canvas math title textarea".split())
BLOCK = set(
    "html head body article section main nav header footer aside form fieldset div p h1 h2 h3 h4 "
    "h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure "
    "figcaption address details summary dialog center menu hgroup search".split()
)
NO_TEXT = set("head button select option datalist label legend".split())
#: An opening tag closes open elements of these kinds, up to the nearest border.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
ENDS_P = BLOCK - {"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}

# Words of class names, ids and roles, by what they usually mark.
NAMES = {
    "main": "article content main post entry story body text prose page-content maincontent "
    "articlebody markdown document reader blog lead paragraph",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toolbar tabs toc pagination pager "
    "sitemap skip topbar",
    "header": "header masthead banner-top logo branding hero-bar site-title",
    "footer": "footer foot copyright colophon legal imprint credits bottom",
    "side": "sidebar side aside related widget rail recommended trending popular teaser "
    "complementary more-stories read-next see-also tags",
    "advert": "ad ads advert advertisement advertising sponsor sponsored promo promotion banner "
    "adsense dfp outbrain taboola commercial affiliate",
    "notice": "cookie cookies consent gdpr notice alert notification popup modal overlay newsletter "
    "subscribe paywall disclaimer message warning toast",
    "form": "form search login signup signin register contact input feedback captcha",
    "comment": "comment comments commentlist discussion disqus reply replies respond responses "
    "reviews guestbook thread reader-comments user-comments",
    "share": "share sharing social follow like tweet facebook twitter print email",
    "meta": "meta byline author date time published info caption credit",
    "hidden": "hidden invisible sr-only screen-reader-text noprint visually-hidden",
}
KINDS = list(NAMES)
_WORD_KIND = {w: i for i, k in enumerate(KINDS) for name in NAMES[k].split() for w in [name]}
TAGS = (
    "article main section div p h1 h2 h3 ul ol li table td blockquote pre figure nav header footer "
    "aside form details address body #text"
).split()
_TAG = {t: i for i, t in enumerate(TAGS)}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_LETTERS = re.compile(r"[A-Za-z]+(?:-[A-Za-z]+)*")


def _marks(attributes: str) -> tuple[int, bool]:
    """Bits of what the attributes' words mark, and whether the trainer marked the node."""
    bits, main = 0, False
    for name, a, b, c in _ATTR.findall(attributes):
        name = name.lower()
        if name == "x-main":
            main = True
        elif name in ("class", "id", "role", "aria-label", "itemprop"):
            for token in _LETTERS.findall((a or b or c).replace("_", "-")):
                parts = [token, *token.split("-"), *_CAMEL.findall(token)]
                for word in parts:
                    kind = _WORD_KIND.get(word.lower())
                    if kind is None and word.lower().endswith("s"):
                        kind = _WORD_KIND.get(word.lower()[:-1])
                    if kind is not None:
                        bits |= 1 << kind
        elif name in ("hidden",) or (name == "style" and "display:none" in (a or b).replace(" ", "")):
            bits |= 1 << KINDS.index("hidden")
    return bits, main


class Nodes:
    """Block elements and runs of text of many pages, parents before children."""

    def __init__(self):
        self.page, self.parent, self.tag, self.marks = [], [], [], []
        self.depth, self.main, self.links, self.linked, self.inline = [], [], [], [], []
        self.text: list[str | None] = []
        self.pages = 0

    def _add(self, parent: int, tag: str, marks: int, main: bool, text: str | None) -> int:
        self.page.append(self.pages)
        self.parent.append(parent)
        self.tag.append(_TAG.get(tag, _TAG["div"]))
        self.marks.append(marks)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.main.append(main or (parent >= 0 and self.main[parent]))
        self.text.append(text)
        self.links.append(0)
        self.linked.append(0)
        self.inline.append(0)
        return len(self.page) - 1

    def read(self, page: str) -> None:
        """Read one page; broken markup is closed the way browsers do, roughly."""
        root = self._add(-1, "body", 0, False, None)
        stack: list[tuple[str, int]] = [("", root)]  # tag and its nearest block node
        run: list[str] = []
        state = {"links": 0, "linked": 0, "inline": 0, "in_link": 0}

        def flush():
            if run:
                text = " ".join(entities.unescape("".join(run)).split())
                run.clear()
                if text:
                    node = self._add(stack[-1][1], "#text", 0, False, text)
                    self.links[node], self.linked[node] = state["links"], min(state["linked"], len(text))
                    self.inline[node] = state["inline"]
                state["links"] = state["linked"] = state["inline"] = 0

        def pop(to: int):
            del stack[to:]

        def say(piece: str):
            if piece and not any(t in NO_TEXT for t, _ in stack):
                run.append(piece)
                if state["in_link"]:
                    state["linked"] += len(piece.strip())

        at = 0
        end = len(page)
        while at < end:
            found = _TOKEN.search(page, at)
            if found is None:
                say(page[at:])
                break
            say(page[at : found.start()])
            at = found.end()
            closing, name, attributes = found.group(1), found.group(2), found.group(3)
            if name is None:
                continue
            name = name.lower()
            if closing:
                if name in ("html", "body"):
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        if name in BLOCK:
                            flush()
                        pop(i)
                        break
                    if stack[i][0] in BLOCK and name not in BLOCK:
                        break
                if name == "a":
                    state["in_link"] = 0
                continue
            if name in RAW:
                if not attributes.endswith("/"):
                    close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = close.end() if close else end
                continue
            if name == "br" or name in VOID:
                if name in ("br", "hr", "img"):
                    run.append(" ")
                if name == "hr":
                    flush()
                if name == "input":
                    state["inline"] += 1
                continue
            if name in ("html", "body"):
                bits, main = _marks(attributes) if attributes else (0, False)
                self.marks[root] |= bits
                continue
            if name not in BLOCK:
                state["inline"] += 1
                if name == "a":
                    state["links"] += 1
                    state["in_link"] = 1
                if not attributes.endswith("/"):
                    stack.append((name, stack[-1][1]))
                continue
            flush()
            state["in_link"] = 0
            if name in ENDS_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        pop(i)
                        break
                    if stack[i][0] in BLOCK:
                        break
            if name in CLOSES:
                kinds, borders = CLOSES[name]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in borders:
                        break
                    if stack[i][0] in kinds:
                        pop(i)
            bits, main = _marks(attributes) if attributes else (0, False)
            if name == "head":
                stack.append((name, stack[-1][1]))
            else:
                stack.append((name, self._add(stack[-1][1], name, bits, main, None)))
                if any(t == "head" for t, _ in stack):
                    pop(next(i for i, (t, _) in enumerate(stack) if t == "head"))
                    stack.append((name, len(self.page) - 1))
        flush()
        self.pages += 1

    def features(self) -> np.ndarray:
        """Own and subtree sums, shares of page and parent, tags and names of the path."""
        n = len(self.page)
        parent, page = np.array(self.parent), np.array(self.page)
        tag, marks = np.array(self.tag), np.array(self.marks, dtype=np.int64)
        depth = np.array(self.depth)
        length = np.array([len(t) if t else 0 for t in self.text], dtype=float)
        is_text = tag == _TAG["#text"]
        ends = np.array([bool(t) and t[-1] in ".!?:;…\"')" for t in self.text], dtype=float)
        commas = np.array([t.count(",") + t.count(". ") if t else 0 for t in self.text], dtype=float)
        sums = np.stack(
            [
                length,
                np.array(self.linked, dtype=float),
                np.array(self.links, dtype=float),
                np.array(self.inline, dtype=float),
                is_text.astype(float),
                ends,
                commas,
                (tag == _TAG["p"]).astype(float),
                (tag == _TAG["li"]).astype(float),
                np.ones(n),
            ]
        )
        own = sums.copy()
        by_depth = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]
        for rows in reversed(by_depth[1:]):
            for k in range(len(sums)):
                sums[k] += np.bincount(parent[rows], weights=sums[k, rows], minlength=n)
        path = marks.copy()
        path_tags = np.zeros(n, dtype=np.int64)
        special = {"nav": 0, "header": 1, "footer": 2, "aside": 3, "form": 4, "article": 5, "main": 6}
        for t, bit in special.items():
            path_tags[tag == _TAG[t]] |= 1 << bit
        tags_above = path_tags.copy()
        for rows in by_depth[1:]:
            path[rows] |= path[parent[rows]]
            tags_above[rows] |= tags_above[parent[rows]]
        up = np.maximum(parent, 0)
        roots = np.flatnonzero(parent < 0)[page]
        children = np.bincount(parent[parent >= 0], minlength=n).astype(float)
        order = np.arange(n)
        first_child = np.full(n, n)
        np.minimum.at(first_child, up[parent >= 0], order[parent >= 0])
        same_tag = np.zeros(n)
        key = up * len(TAGS) + tag
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        same_tag = counts[inverse].astype(float)
        position = (order - roots) / np.maximum(sums[9, roots], 1)
        sub, total, above = sums, sums[:, roots], sums[:, up]

        def share(a, b):
            return a / np.maximum(b, 1)

        columns = [
            np.log1p(sub[0]), share(sub[0], total[0]), share(sub[0], above[0]),
            share(sub[1], sub[0]), share(sub[1], total[1]), np.log1p(sub[2]),
            share(sub[0], sub[9]), share(sub[0], sub[4]), share(sub[5], sub[4]),
            share(100 * sub[6], sub[0]), np.log1p(sub[7]), share(sub[7], total[7]),
            np.log1p(sub[8]), share(sub[3], sub[4]), np.log1p(sub[9]),
            depth, children, children[up], same_tag, position,
            share(above[1], above[0]), share(above[0] - sub[0], total[0]),
            share(above[5], above[4]), own[3],
        ]
        columns += [(tag == i).astype(float) for i in range(len(TAGS))]
        columns += [((marks >> i) & 1).astype(float) for i in range(len(KINDS))]
        columns += [((path >> i) & 1).astype(float) for i in range(len(KINDS))]
        columns += [((tags_above >> i) & 1).astype(float) for i in range(len(special))]
        return np.stack(columns, axis=1)

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """Which nodes are kept in the most likely choice without contradictions.

        A node's log odds, and a part of its ancestors', speak for or against keeping it. A text
        run is worth that much; an element is worth its own and the best of its children, if
        something below is kept and the sum is positive, else it is dropped with all below.
        """
        n = len(self.page)
        parent = np.array(self.parent)
        depth = np.array(self.depth)
        is_text = np.array(self.tag) == _TAG["#text"]
        by_depth = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]
        margins = margins.copy()
        for rows in by_depth[1:]:
            margins[rows] += INHERIT * np.clip(margins[parent[rows]], -8, 8)
        best = np.where(is_text, np.maximum(margins, 0), margins)
        below = np.zeros(n)
        for rows in reversed(by_depth):
            inner = rows[~is_text[rows]]
            best[inner] = np.where(below[inner] > 0, np.maximum(margins[inner] + below[inner], 0), 0)
            held = rows[parent[rows] >= 0]
            below += np.bincount(parent[held], weights=best[held], minlength=n)
        keep = best > 0
        for rows in by_depth[1:]:
            keep[rows] &= keep[parent[rows]]
        return keep

    def blocks(self, keep: np.ndarray) -> list[list[str]]:
        """The kept text runs of each page, in order."""
        out: list[list[str]] = [[] for _ in range(self.pages)]
        for i, text in enumerate(self.text):
            if text and keep[i]:
                out[self.page[i]].append(text)
        return out

    def holds_main(self) -> np.ndarray:
        """Training labels: whether a node's subtree has a text run that is main."""
        is_text = np.array(self.tag) == _TAG["#text"]
        out = np.array(self.main) & is_text
        parent, depth = np.array(self.parent), np.array(self.depth)
        for d in range(int(depth.max(initial=0)), 0, -1):
            rows = np.flatnonzero((depth == d) & out)
            out[parent[rows]] = True
        return out


def _pick(draw: random.Random, kind: str) -> str:
    name = draw.choice(NAMES[kind].split())
    style = draw.random()
    prefix = draw.choice(["", "", "", "site-", "page-", "c-", "block-", "js-"])
    value = prefix + name + draw.choice(["", "", "", "-inner", "-wrap", "-box", "-1", "-list"])
    return f' id="{value}"' if style < 0.25 else f' class="{value}"'


def _wrapped(draw: random.Random, body: str, depth: int, named: float = 0.3) -> str:
    for _ in range(depth):
        names = _pick(draw, "main") if draw.random() < named * 0.3 else ""
        if not names and draw.random() < named:
            names = f' class="{draw.choice(["container", "row", "col", "wrapper", "grid", "inner", "layout"])}"'
        body = f"<div{names}>{body}</div>"
    return body


def _clutter(draw: random.Random, kind: str, other: list[str]) -> str:
    """Text that isn't main, laid out as one of the kinds of names."""
    def some(n):
        words = draw.choice(other).split()
        start = draw.randrange(max(1, len(words) - n))
        return entities.escape(" ".join(words[start : start + n]))

    def links(n):
        return "".join(f'<li><a href="/{i}">{some(draw.randint(1, 4))}</a></li>' for i in range(n))

    def long():
        return " ".join(f"<p>{some(draw.randint(5, 60))}</p>" for _ in range(draw.randint(1, 3)))

    def comments():
        names = ["comment", "reply", "comment-body", "c-item"]
        return "".join(
            f'<div class="{draw.choice(names)}"><b>{some(1)}</b><p>{some(draw.randint(5, 80))}</p></div>'
            for _ in range(draw.randint(1, 5))
        )

    tags, layouts = {
        "menu": ("nav div ul", [lambda: f"<ul>{links(draw.randint(3, 9))}</ul>"]),
        "header": ("header div", [lambda: f'<a href="/">{some(2)}</a> {some(draw.randint(1, 8))}']),
        "footer": (
            "footer div",
            [
                lambda: f"&copy; {some(3)} &middot; {some(draw.randint(2, 25))}",
                long,
                lambda: f"<p>{some(9)}</p><ul>{links(4)}</ul>",
            ],
        ),
        "side": (
            "aside div section",
            [
                lambda: f"<h3>{some(2)}</h3>{long()}",
                lambda: f"<h3>{some(2)}</h3><ul>{links(5)}</ul>",
                lambda: f"<h3>{some(2)}</h3><p>{some(20)}</p>",
            ],
        ),
        "advert": (
            "div aside section p",
            [lambda: some(draw.randint(3, 30)), lambda: f'<a href="/x">{some(8)}</a>'],
        ),
        "notice": (
            "div section aside p",
            [
                lambda: some(draw.randint(5, 40)),
                lambda: f"{some(20)} <button>{some(1)}</button>",
            ],
        ),
        "form": (
            "form",
            [
                lambda: f'<label>{some(2)}</label><input type="text">'
                f"<p>{some(draw.randint(2, 15))}</p><button>{some(1)}</button>"
            ],
        ),
        "share": ("div ul", [lambda: f"<ul>{links(3)}</ul>"]),
        "comment": ("section div ol", [lambda: f"<h3>{some(2)}</h3>{comments()}"]),
    }[kind]
    tag, inner = draw.choice(tags.split()), draw.choice(layouts)()
    semantic = tag in ("nav", "header", "footer", "aside", "form")
    names = "" if semantic and draw.random() < 0.5 else _pick(draw, kind)
    return f"<{tag}{names}>{inner}</{tag}>"


def variant(draw: random.Random, blocks: list[str], other: list[str]) -> str:
    """The blocks of a page laid out anew, main text marked with ``x-main``."""
    parts = []
    for i, block in enumerate(blocks):
        text = entities.escape(block)
        if i == 0:
            tag = draw.choice(["h1", "h1", "h2"])
        else:
            tag = draw.choices(["p", "blockquote", "h2", "li", "pre", "div"], [20, 1, 1, 2, 0.5, 2])[0]
        body = f"<{tag} x-main>{text}</{tag}>"
        parts.append(f"<ul>{body}</ul>" if tag == "li" else body)
    kinds = ["advert", "share", "side", "notice", "form", "comment"]
    for kind in draw.sample(kinds, draw.choice([0, 0, 1, 2])):
        parts.insert(draw.randint(1, len(parts)) if kind != "comment" else len(parts), _clutter(draw, kind, other))
    tag = draw.choice(["article", "main", "div", "div", "section"])
    names = _pick(draw, "main") if draw.random() < (0.3 if tag in ("article", "main") else 0.85) else ""
    body = _wrapped(draw, "".join(parts), draw.choice([0, 0, 1]), 0.5)
    body = f"<{tag}{names}>{body}</{tag}>"
    if draw.random() < 0.3:
        body = f"<main>{body}</main>"
    before = [k for k in ("header", "menu", "notice", "advert") if draw.random() < 0.6]
    after = [k for k in ("comment", "side", "share", "advert", "form", "footer", "notice") if draw.random() < 0.5]
    draw.shuffle(before)
    page = [_clutter(draw, k, other) for k in before] + [body] + [_clutter(draw, k, other) for k in after]
    return _wrapped(draw, "".join(page), draw.choice([0, 0, 1, 2]))


def train(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> BoostedTrees:
    """Trees trained on ``sample`` pages, drawn by a hash of their text, and variants of them.

    A sampled page without an ``article`` or ``main`` element lends its longest element's texts
    to variants only. Without any pages the trees rest on built-in words.
    """
    hashed = pages.where(F.length(html).between(1, TRAINING_CHARS)).select(
        F.xxhash64(html).alias("_hash"), F.col(html).alias("_html")
    )
    # hashes first, so that only the sampled pages themselves reach the driver
    least = hashed.select("_hash").distinct().orderBy("_hash").limit(sample)
    last = least.agg(F.max("_hash")).head()[0]
    chosen = hashed.where(F.col("_hash") <= F.lit(last)) if last is not None else hashed.limit(0)
    found = chosen.groupBy("_hash").agg(F.min("_html").alias("_html")).collect()
    drawn = [(r[1],) for r in sorted(found)]
    draw = random.Random(11)
    known, sources, plain = Nodes(), [], 0
    for (page,) in drawn:
        marked = re.sub(r"<(article|main)\b", r"<\1 x-main", page, flags=re.I)
        own = Nodes()
        own.read(marked)
        mine = [t for t, m in zip(own.text, own.main) if t and m]
        if mine:
            known.read(marked)
        else:
            mine = [t for t in own.text if t and len(t) > 80]
        if mine:
            sources.append(mine)
    if not sources:
        sources = [["The first of a few sentences, in place of a page.", "And a second one, a little longer, with more words."]]
    other, plain = [t for s in sources for t in s], known.pages
    for mine in sources:
        for _ in range(VARIANTS):
            start = draw.randrange(len(mine))
            blocks = mine[start : start + draw.randint(1, 12)] if draw.random() < 0.5 else mine
            known.read(variant(draw, blocks, other))
    y = known.holds_main().astype(float)
    page = np.array(known.page)
    weight = np.where(page < plain, OWN_WEIGHT, 1) * 30 / np.bincount(page)[page]
    return BoostedTrees().fit(known.features(), y, weight)


FIELDS = T.StructType().add("blocks", T.ArrayType(T.StringType())).add("text", "string")


def extract(pages: DataFrame, model: BoostedTrees, keep: list[str], html: str = "html") -> DataFrame:
    """The main text of every page.

    Columns in ``keep`` are carried along; beside them come ``blocks`` (the texts of the kept
    runs, in order: character references decoded, white space turned into single spaces,
    trimmed) and ``text`` (the blocks joined by two line feeds). Input columns with these names
    are not kept. A null or empty page, or one without text, has no blocks and an empty text.
    Repeated rows have equal results. An empty table gives an empty result.
    """
    keep = [c for c in keep if c not in FIELDS.names]
    shared = pages.sparkSession.sparkContext.broadcast(model)
    source = pages.select(*keep, F.col(html).alias("_html"))
    schema = T.StructType([f for f in source.schema.fields if f.name in keep] + FIELDS.fields)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            for piece in pieces(batch, "_html", 1 << 20):
                nodes = Nodes()
                for page in piece.column("_html").to_pylist():
                    nodes.read(page or "")
                blocks = nodes.blocks(nodes.decode(trees.margins(nodes.features())))
                columns = [piece.column(c) for c in keep]
                columns += [
                    pa.array(blocks, pa.list_(pa.string())),
                    pa.array(["\n\n".join(b) for b in blocks], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
                )

    return source.mapInArrow(give_back(run), schema)
