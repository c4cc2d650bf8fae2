"""Repair of conversations: the cheapest edits after which roles alternate and no row is faulty.

A row is one symbol, its role's kind and its fault, and a conversation a sequence of symbols. What
a symbol does is a 4 x 4 transfer matrix over the states of the wanted form ``(s?(ua)+)?``: each
entry holds the least cost of going from one state to another and, of the cheapest, the ASCII-least
audit, as a rope. Matrices are multiplied in the min-plus sense. Equal costs come with audits of
which none begins with another (over the same rows they could differ by insertions only, which
cost something), so the least audit of a product is the product of least audits.

Sequences are cut into segments of bounded length, equal segments of all conversations are one,
and a task compresses its distinct segments by Re-Pair: the most frequent pair of neighbouring
symbols becomes a rule until no pair occurs twice. Every rule's matrix is made once from those of
its two parts, bottom-up, and shared by all conversations. Conversations longer than a segment
multiply the matrices of their segments in order.

Rows are ordered by one range-partitioned sort of slim rows, so a conversation that holds a large
share of all rows is spread over tasks. Only its audit, and the hash of its repaired text, which is
fed row by row in order, are made in one place.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isospread.llm.memory import give_back
from isospread.sources.storage import broadcast_if_small, settle

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: States of ``(s?(ua)+)?``: nothing yet, after s, after u, after a.
STATES = 4
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
#: Symbols: a row that must go, and rows by their role's initial (``x``: any other), with a capital
#: letter where the row is truncated.
MUST_GO = "-"
#: Rows of a segment are those whose numbers agree but for so many bits.
SEGMENT_BITS = 12
#: Symbols that a task compresses together.
PACK = 200_000
#: Audits up to this length are kept as text, longer ones as ropes of their parts.
LEAF = 64
BLANKS = " \t\n\x0b\x0c\r"


class Rope:
    """A long audit: two audits after each other, shared and never copied."""

    __slots__ = ("left", "right", "size")

    def __init__(self, left: Rope | str, right: Rope | str):
        self.left, self.right = left, right
        self.size = _size(left) + _size(right)


Audit = Rope | str


def _size(audit: Audit) -> int:
    return len(audit) if isinstance(audit, str) else audit.size


def joined(a: Audit, b: Audit) -> Audit:
    if not _size(a):
        return b
    if not _size(b):
        return a
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= LEAF:
        return a + b
    return Rope(a, b)


def _leaves(audit: Audit) -> Iterator[str]:
    stack = [audit]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            yield top
        else:
            stack += [top.right, top.left]


def written(audit: Audit) -> str:
    return audit if isinstance(audit, str) else "".join(_leaves(audit))


def precedes(a: Audit, b: Audit) -> bool:
    """Whether ``a`` is ASCII-less than ``b``. Parts that both share at the same place are skipped
    whole."""
    if a is b:
        return False
    if isinstance(a, str) and isinstance(b, str):
        return a < b
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        n, m = _size(x), _size(y)
        if isinstance(x, str) and isinstance(y, str):
            k = min(n, m)
            if x[:k] != y[:k]:
                return x[:k] < y[:k]
            if n > k:
                left.append(x[k:])
            if m > k:
                right.append(y[k:])
        elif isinstance(x, str) or (n < m and not isinstance(y, str)):
            left.append(x)
            right += [y.right, y.left]
        else:
            right.append(y)
            left += [x.right, x.left]
    return bool(right) and not left


Matrix = list[list[tuple[int, Audit] | None]]


def product(a: Matrix, b: Matrix) -> Matrix:
    """Least cost, then least audit, over the states in between."""
    out: Matrix = []
    for row in a:
        made: list[tuple[int, Audit] | None] = [None] * STATES
        for x, entry in zip(row, b):
            if x is None:
                continue
            for j, y in enumerate(entry):
                if y is None:
                    continue
                cost, best = x[0] + y[0], made[j]
                if best is not None and best[0] < cost:
                    continue
                audit = joined(x[1], y[1])
                if best is None or cost < best[0] or precedes(audit, best[1]):
                    made[j] = (cost, audit)
        out.append(made)
    return out


def _insertions() -> Matrix:
    """Any number of inserted users and assistants."""
    one: Matrix = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        one[i][i] = (0, "")
        for role in "ua":
            if (i, role) in STEPS:
                one[i][STEPS[i, role]] = (INSERT, "I")
    # from any state at most two are needed to reach any other
    return product(one, one)


def _edits(symbol: str) -> Matrix:
    """Keeping, giving another role to, or deleting one row."""
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    role = symbol.lower()
    more = TRUNCATED if symbol != role else 0
    for i in range(STATES):
        options = {i: (DELETE, "D")}
        for to in "sua" if symbol != MUST_GO else "":
            if (i, to) not in STEPS or (to == "s" and role != "s"):
                continue
            options[STEPS[i, to]] = (more, "K") if to == role else (more + REROLE, "R")
        for j, entry in options.items():
            out[i][j] = entry
    return out


INSERTIONS = _insertions()
SYMBOLS = [MUST_GO, *"suax", *"SUAX"]
#: Insertions before the row, and what is done with it.
TRANSFER = {s: product(INSERTIONS, _edits(s)) for s in SYMBOLS}
NOTHING: Matrix = [[(0, "") if i == j else None for j in range(STATES)] for i in range(STATES)]


def re_pair(texts: list[str]) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """Re-Pair over some sequences together: what is left of each, and the rules.

    Symbols are numbers in ``SYMBOLS``; rule k is the number ``len(SYMBOLS) + k``. The most
    frequent pair of neighbours, of equally frequent ones the least, is replaced everywhere, until
    no pair occurs twice.
    """
    number = {s: i for i, s in enumerate(SYMBOLS)}
    symbol: list[int] = []
    heads = []
    for text in texts:
        heads.append(len(symbol))
        symbol += [number[c] for c in text]
        symbol.append(-1)
    n = len(symbol)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], set[int]] = defaultdict(set)

    def pair_at(i: int) -> tuple[int, int] | None:
        if i < 0 or symbol[i] < 0 or symbol[after[i]] < 0:
            return None
        return symbol[i], symbol[after[i]]

    for i in range(n - 1):
        pair = pair_at(i)
        if pair:
            places[pair].add(i)
    heap = [(-len(at), pair) for pair, at in places.items() if len(at) > 1]
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        count, pair = heapq.heappop(heap)
        held = places.get(pair)
        if held is None or len(held) < 2:
            continue
        if len(held) != -count:
            heapq.heappush(heap, (-len(held), pair))
            continue
        new = len(SYMBOLS) + len(rules)
        touched = set()
        n_made = 0
        for i in sorted(held):
            if pair_at(i) != pair:  # an overlap with a place just replaced, as in aaa
                continue
            j, p = after[i], before[i]
            for at in (p, i, j):
                old = pair_at(at)
                if old:
                    places[old].discard(at)
            symbol[i], symbol[j] = new, -2
            after[i] = after[j]
            before[after[j]] = i
            n_made += 1
            for at in (p, i):
                made = pair_at(at)
                if made:
                    places[made].add(at)
                    touched.add(made)
        places.pop(pair, None)
        if n_made:
            rules.append(pair)
        for made in touched:
            if len(places[made]) > 1:
                heapq.heappush(heap, (-len(places[made]), made))
    left = []
    for head in heads:
        rest, i = [], head
        while symbol[i] >= 0:
            rest.append(symbol[i])
            i = after[i]
        left.append(rest)
    return left, rules


def transfers(texts: list[str]) -> Iterator[Matrix]:
    """Each sequence's transfer matrix, by the matrices of the rules that all of them share."""
    left, rules = re_pair(texts)
    made = [TRANSFER[s] for s in SYMBOLS]
    for a, b in rules:
        made.append(product(made[a], made[b]))
    for rest in left:
        whole = NOTHING
        for s in rest:
            whole = product(whole, made[s])
        yield whole


def finished(row: list[tuple[int, Audit] | None]) -> tuple[int, str]:
    """The cheapest way from where a sequence began, with insertions after its last row."""
    ends = product([row] + [[None] * STATES] * (STATES - 1), INSERTIONS)[0]
    found = [(cost, written(audit)) for cost, audit in (ends[j] for j in ENDS if ends[j])]
    return min(found)


def _filled(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by the hash of their conversation and turn; nulls count as a space.

    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes its
    role user. Columns: ``conv`` and ``turn`` as they are, ``role``, ``text``.
    """
    what = F.crc32(F.concat(_filled(F.col("conv_id")), F.lit(":"), _filled(F.col("turn")))) % 20
    rows = conversations.select(
        F.col("conv_id").alias("conv"),
        F.col("turn"),
        _filled(F.col("role")).alias("role"),
        _filled(F.col("text")).alias("text"),
        what.alias("what"),
    )
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", ""))
    times = F.when(F.col("what") == 3, 2).otherwise(1)
    return rows.where("what <> 0").select(
        "conv",
        "turn",
        F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(True), times)).alias("_copy"),
    ).drop("_copy")


ORDER = ("turn_known", "turn", "role", "mark")


def _with_place(rows: DataFrame) -> DataFrame:
    """Rows with what orders them in a conversation: turn, nulls first, then role and the digest
    of the text, so that rows of one turn have an order too."""
    return rows.withColumn("turn_known", F.col("turn").isNotNull()).withColumn("mark", F.sha2("text", 256))


def symbols(rows: DataFrame) -> DataFrame:
    """A slim row for each row: its place, its role's initial, and its symbol."""
    slim = _with_place(rows).withColumn(
        "ending", F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    ).drop("text")
    seen = Window.partitionBy("conv", "role", "mark").orderBy("turn_known", "turn")
    fault = (
        F.when(F.col("ending") == "", "blank")
        .when(F.row_number().over(seen) > 1, "duplicate")
        .when(~F.col("ending").isin(".", "!", "?"), "truncated")
    )
    initial = F.left("role", F.lit(1))
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO)
        .when(F.col("fault") == "truncated", F.upper(kind))
        .otherwise(kind)
    )
    return slim.withColumn("fault", fault).select(
        "conv", *ORDER, initial.alias("initial"), "fault", symbol.alias("symbol")
    )


def _segments(slim: DataFrame) -> DataFrame:
    """Segments of bounded length, with what can be said of each alone."""
    ordered = slim.orderBy("conv", *ORDER).select(
        "conv", "turn", "initial", "fault", "symbol", F.monotonically_increasing_id().alias("at")
    )
    row = F.struct("at", "turn", "initial", "symbol")
    gathered = ordered.groupBy("conv", F.shiftright("at", SEGMENT_BITS).alias("segment")).agg(
        F.array_sort(F.collect_list(row)).alias("rows"),
        *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")),
    )
    turns = F.array_compact(F.col("rows.turn"))
    following = F.slice("rows", 2, F.greatest(F.size("rows") - 1, F.lit(0)))
    pairs = F.arrays_zip(F.slice("rows", 1, F.size("rows") - 1).alias("a"), following.alias("b"))
    steps = F.transform(pairs, lambda p: F.concat(p["a"]["initial"], p["b"]["initial"]))
    wrong = F.filter(steps, lambda s: ~s.isin("su", "ua", "au"))
    return gathered.select(
        "conv",
        "segment",
        "blank",
        "duplicate",
        "truncated",
        F.size(wrong).cast("long").alias("illegal"),
        F.size(F.array_distinct(turns)).cast("long").alias("n_turns"),
        F.array_min(turns).alias("first_turn"),
        F.array_max(turns).alias("last_turn"),
        F.element_at("rows.initial", 1).alias("first_initial"),
        F.element_at("rows.initial", -1).alias("last_initial"),
        F.array_join(F.col("rows.symbol"), "").alias("symbols"),
    )


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct segment's cost and audit as a whole conversation, or its matrix as a part."""
    for batch in batches:
        texts, parts = batch.column("symbols").to_pylist(), batch.column("part").to_pylist()
        start = 0
        while start < len(texts):
            end, held = start, 0
            while end < len(texts) and (end == start or held + len(texts[end]) <= PACK):
                held += len(texts[end])
                end += 1
            costs, audits, costs_of, audits_of = [], [], [], []
            for matrix, part in zip(transfers(texts[start:end]), parts[start:end]):
                entries = [e for row in matrix for e in row] if part else None
                costs_of.append(entries and [e and e[0] for e in entries])
                audits_of.append(entries and [e and written(e[1]) for e in entries])
                cost, audit = (None, None) if part else finished(matrix[0])
                costs.append(cost)
                audits.append(audit)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(texts[start:end], pa.string()),
                    pa.array(parts[start:end], pa.bool_()),
                    pa.array(costs, pa.int64()),
                    pa.array(audits, pa.string()),
                    pa.array(costs_of, pa.list_(pa.int64())),
                    pa.array(audits_of, pa.list_(pa.string())),
                ],
                ["symbols", "part", "cost", "audit", "costs", "audits"],
            )
            start = end


_SUMMED = ("blank", "duplicate", "truncated", "illegal", "n_turns")


def _fold(key: str):
    """Segments in order, grouped by conversation, to one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, row = None, None, None

        def done() -> pa.RecordBatch:
            cost, audit = finished(row)
            out = {key: state["id"], **{c: state[c] for c in _SUMMED}, "cost": cost, "audit": audit}
            out |= {c: state[c] for c in ("first_turn", "last_turn")}
            return pa.RecordBatch.from_pylist([out], schema=fold_schema)

        for batch in batches:
            for part in batch.to_pylist():
                entries = [c if c is None else (c, a) for c, a in zip(part["costs"], part["audits"])]
                matrix = [entries[i : i + STATES] for i in range(0, STATES * STATES, STATES)]
                if state is None or part[key] != now:
                    if state is not None:
                        yield done()
                    now, state, row = part[key], part | {"id": part[key]}, matrix[0]
                    continue
                row = product([row] + [[None] * STATES] * (STATES - 1), matrix)[0]
                for c in _SUMMED:
                    state[c] += part[c]
                state["illegal"] += state["last_initial"] + part["first_initial"] not in ("su", "ua", "au")
                if part["first_turn"] is not None:
                    # turns rise, so only the turn at the cut can stand in both
                    state["n_turns"] -= part["first_turn"] == state["last_turn"]
                    state["last_turn"] = part["last_turn"]
                    if state["first_turn"] is None:
                        state["first_turn"] = part["first_turn"]
                state["last_initial"] = part["last_initial"]
        if state is not None:
            yield done()

    fold_schema = pa.schema(
        [(key, pa.string()), *((c, pa.int64()) for c in _SUMMED), ("cost", pa.int64()),
         ("audit", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64())]
    )
    return run


def _hash_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation's repaired rows. Its audit stands before its rows, and rows
    are taken one after another, so of a conversation only the audit is held."""
    def found(conv: str, digest: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": digest}], schema=schema)

    schema = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])

    def every():
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text")]
            yield from zip(*columns)

    out: list[dict] = []
    now, audit, at, state, digest, any_row = None, "", 0, 0, None, False

    def write(role: str, text: str) -> None:
        nonlocal any_row
        digest.update((("\n" if any_row else "") + f"{role}:{text}").encode())
        any_row = True

    def inserted() -> None:
        """Rows that stand before the next damaged one."""
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            role = "assistant" if state == 2 else "user"
            write(role, "")
            state = STEPS[state, role[0]]
            at += 1

    for conv, its_audit, role, text in every():
        if its_audit is not None:
            if digest is not None:
                inserted()
                out.append({"conv": now, "repaired_sha256": digest.hexdigest()})
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            now, audit, at, state, digest, any_row = conv, its_audit, 0, 0, hashlib.sha256(), False
            continue
        inserted()
        edit = audit[at]
        at += 1
        if edit == "D":
            continue
        if edit == "R":
            role = "assistant" if state == 2 else "user"
        write(role, text)
        state = STEPS[state, role[0]]
    if digest is not None:
        inserted()
        out.append({"conv": now, "repaired_sha256": digest.hexdigest()})
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """The repair of every conversation.

    ``rows`` has ``conv``, ``turn`` (a whole number), ``role`` and ``text``; a null role or text
    counts as one space. Other columns are ignored. ``conversations`` names the conversations in ``conv``, also those
    without rows. Rows stand in the order of their turns, nulls first; of one turn they are ordered
    by role and then by the SHA-256 of their text. A row's fault is the first of: blank (without any
    character but ASCII white space), duplicate (the same role and text stand before), truncated
    (its last such character is none of ``.!?``).

    Edits: keeping a row costs 0, making it a user's or an assistant's 1, deleting it 2, which
    blank rows and duplicates demand, inserting an empty row of a user or an assistant 5; a
    truncated row that stays costs 5 more. Returns a row for each conversation: ``conv``, ``gaps``
    (turns missing between the first and the last), ``blank``, ``duplicate``, ``truncated``,
    ``illegal`` (neighbours whose roles' initials are not su, ua or au), ``cost``, ``audit`` (the
    initials of the cheapest edits, ASCII-least, that leave roles of the form ``(s?(ua)+)?``) and
    ``repaired_sha256`` (of ``role:text`` of the repaired rows, joined by newlines).

    A conversation without rows has zeros, an empty audit and the hash of an empty text. A null
    ``conv`` is a conversation. An empty table gives an empty result.
    """
    kind = conversations.schema["conv"].dataType
    rows = rows.select(
        "conv", F.col("turn").cast("long").alias("turn"), *(_filled(F.col(c)).alias(c) for c in ("role", "text"))
    )
    named = F.to_json(F.struct("conv"))  # one text per conversation, also for a null one
    slim = symbols(rows)
    segments = settle(_segments(slim.withColumn("conv", named)))
    several = segments.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv")
    marked = segments.join(
        broadcast_if_small(settle(several.withColumn("part", F.lit(True)))), "conv", "left"
    ).withColumn("part", F.coalesce("part", F.lit(False)))
    distinct = marked.select("symbols", "part").distinct()
    fields = "symbols string, part boolean, cost long, audit string, costs array<long>, audits array<string>"
    solved = settle(distinct.mapInArrow(give_back(_solve), fields))
    placed = marked.join(broadcast_if_small(solved), ["symbols", "part"])
    single = placed.where(~F.col("part"))
    parts = (
        placed.where("part")
        .select("conv", "segment", *_SUMMED, "first_turn", "last_turn", "first_initial", "last_initial", "costs", "audits")
        .repartition("conv")
        .sortWithinPartitions("conv", "segment")
    )
    folded = parts.mapInArrow(
        _fold("conv"),
        "conv string, blank long, duplicate long, truncated long, illegal long, n_turns long, "
        "cost long, audit string, first_turn long, last_turn long",
    )
    columns = ["conv", *_SUMMED, "cost", "audit", "first_turn", "last_turn"]
    made = settle(single.select(*columns).unionByName(folded.select(*columns)))

    none = F.lit(None).cast("string")
    audits = made.select(
        "conv", F.lit(0).alias("kind"), F.lit(False).alias("turn_known"), F.lit(None).cast("long").alias("turn"),
        none.alias("role"), none.alias("mark"), none.alias("text"), "audit",
    )
    texts = _with_place(rows).select(
        named.alias("conv"), F.lit(1).alias("kind"), *ORDER, "text", none.alias("audit")
    )
    stream = audits.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "kind", *ORDER)
    hashed = stream.select("conv", "audit", "role", "text").mapInArrow(
        give_back(_hash_repaired), "conv string, repaired_sha256 string"
    )
    every = conversations.select("conv").distinct().withColumn("name", named)
    zero = F.lit(0).cast("long")
    gaps = F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns")
    return (
        every.join(made.withColumnRenamed("conv", "name"), "name", "left")
        .join(hashed.withColumnRenamed("conv", "name"), "name", "left")
        .select(
            F.col("conv").cast(kind).alias("conv"),
            F.coalesce(gaps, zero).alias("gaps"),
            *(F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows of a table with ``conv_id``, ``turn``, ``role`` and ``text``."""
    found = repair(damaged(conversations), conversations.select(F.col("conv_id").alias("conv")))
    return found.withColumnRenamed("conv", "conv_id")
