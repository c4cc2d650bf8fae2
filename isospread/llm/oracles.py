"""DuckDB SQL for the results that SQL can express."""

from __future__ import annotations

_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = list_count(embedding)
      AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP5 = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
    FROM documents
), starts AS (
    SELECT r, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35
), windows AS (
    SELECT starts.r, s, list_aggregate(w[s : s + 34], 'string_agg', ' ') AS text
    FROM starts JOIN d USING (r)
), repeated AS (
    SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY text) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM repeated
), words AS (
    SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d
), marked AS (
    SELECT words.r, word, words.p, covered.p IS NOT NULL AS gone
    FROM words LEFT JOIN covered ON words.r = covered.r AND words.p = covered.p
), kept AS (
    SELECT r, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS t
    FROM marked GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP6 = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, list_aggregate(w[s : s + 9], 'string_agg', ' ') AS text,
           least(len(w), 10) AS n
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM item_windows
), windows AS (
    SELECT r, s, n, list_aggregate(w[s : s + n - 1], 'string_agg', ' ') AS text
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)
), found AS (
    SELECT windows.r, s, windows.n, item_id FROM windows JOIN item_windows USING (text, n)
), hits AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + n)) AS p FROM found) GROUP BY r
), items AS (
    SELECT r, count(*) AS n, string_agg(i, ',' ORDER BY i) AS names
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit,
       coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

OP8 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, list_aggregate(w[s : s + 4], 'string_agg', ' ') AS x
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM d WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 10 * common.n >= 8 * (x.n + y.n - common.n)
), reach AS (
    SELECT doc_id, doc_id AS other FROM d
    UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
), copies AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY w) AS copy_id FROM d WHERE len(w) > 0)
SELECT d.doc_id, class_id, coalesce(copy_id, d.doc_id) AS copy_id, coalesce(n, 0)::BIGINT AS n_links
FROM d JOIN (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id) USING (doc_id)
LEFT JOIN copies USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a) USING (doc_id)
"""


def _after(state: str, cost: str, edit: str, line: str | None = None, only: str = "true") -> str:
    """A state after one more edit, null where the state is or where the edit isn't allowed."""
    lines = f"list_append({state}.lines, {line})" if line else f"{state}.lines"
    return (
        f"CASE WHEN {state} IS NOT NULL AND {only} THEN {{'cost': {state}.cost + {cost}, "
        f"'audit': {state}.audit || '{edit}', 'lines': {lines}}} END"
    )


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _closed(table: str) -> str:
    """States 2 and 3 after any number of insertions; 0 and 1 are only left by them."""
    two = _least(f"{table}.s2", *(_after(f"{table}.s{i}", "5", "I", "'user:'") for i in (0, 1, 3)))
    return (
        f"SELECT *, {_least('s3', _after('c2', '5', 'I', chr(39) + 'assistant:' + chr(39)))} AS c3 "
        f"FROM (SELECT *, {two} AS c2 FROM {table})"
    )


def _taken(start: str, initial: str, full: str) -> list[str]:
    return [
        _after(start, "more", "K", "role || ':' || text", f"stays AND initial = '{initial}'"),
        _after(start, "more + 1", "R", f"'{full}:' || text", "stays"),
    ]


OP12 = f"""
WITH RECURSIVE crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(
            [i::UBIGINT] || list_transform(range(8), lambda x: x::UBIGINT),
            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END
        ) AS v FROM range(256) r(i)
    )
), named AS (
    SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS k, turn, coalesce(role, ' ') AS role,
           coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS id
    FROM conversations
), hit AS (
    SELECT named.*, xor(4294967295::UBIGINT, list_reduce(
        [4294967295::UBIGINT] || list_transform(string_split(id, ''), lambda c: ascii(c)::UBIGINT),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::INT + 1])
    )) % 20 AS what
    FROM named, crc_table
), damaged AS (
    SELECT k, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
           CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE WHEN what = 3 THEN 2 ELSE 1 END)) AS copy
    FROM hit WHERE what <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(text)) AS n,
           left(role, 1) AS initial,
           right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending
    FROM damaged
), faulty AS (
    SELECT *, CASE WHEN ending = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY n) > 1 THEN 'duplicate'
        WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY k ORDER BY n) || initial AS step
    FROM placed
), rows AS (
    SELECT *, fault NOT IN ('blank', 'duplicate') AS stays,
           CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more
    FROM faulty
), dp AS (
    SELECT DISTINCT k, 0::BIGINT AS n, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS s0,
           NULL::STRUCT(cost INT, audit VARCHAR, lines VARCHAR[]) AS s1,
           NULL::STRUCT(cost INT, audit VARCHAR, lines VARCHAR[]) AS s2,
           NULL::STRUCT(cost INT, audit VARCHAR, lines VARCHAR[]) AS s3
    FROM named
    UNION ALL
    SELECT c.k, c.n + 1, {_after("s0", "2", "D")},
           {_least(_after("s1", "2", "D"), _taken("s0", "s", "")[0])},
           {_least(_after("c2", "2", "D"), *(w for s in ("s0", "s1", "c3") for w in _taken(s, "u", "user")))},
           {_least(_after("c3", "2", "D"), *_taken("c2", "a", "assistant"))}
    FROM ({_closed("dp")}) c JOIN rows ON rows.k = c.k AND rows.n = c.n + 1
), summed AS (
    SELECT k, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY k
), done AS (
    SELECT k, n, {_least("s0", "c3")} AS best FROM ({_closed("dp")})
)
SELECT any_value(conv_id) AS conv_id, coalesce(any_value(gaps), 0)::BIGINT AS gaps,
       coalesce(any_value(blank), 0)::BIGINT AS blank,
       coalesce(any_value(duplicate), 0)::BIGINT AS duplicate,
       coalesce(any_value(truncated), 0)::BIGINT AS truncated,
       coalesce(any_value(illegal), 0)::BIGINT AS illegal,
       any_value(best.cost)::BIGINT AS cost, any_value(best.audit) AS audit,
       sha256(any_value(array_to_string(best.lines, chr(10)))) AS repaired_sha256
FROM named LEFT JOIN summed USING (k) JOIN done ON done.k = named.k AND done.n = coalesce(summed.n, 0)
GROUP BY named.k
"""

OP13 = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT r, list_aggregate(w[s : s + 3], 'string_agg', ' ') AS x
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM d WHERE len(w) > 0)
), sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r
), common AS (
    SELECT a.r AS a, b.r AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.x = b.x AND a.r <> b.r GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN sizes x ON a = x.r JOIN sizes y ON b = y.r
    WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)
), reach AS (
    SELECT r, r AS other FROM d
    UNION SELECT reach.r, links.b FROM reach JOIN links ON reach.other = links.a
), least AS (
    SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON reach.other = d.r GROUP BY reach.r
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN least USING (r) LEFT JOIN sizes USING (r)
"""

ORACLES = {
    "op4_maxscore_topk": OP4,
    "op5_substring_dedup": OP5,
    "op6_decontaminate": OP6,
    "op8_jaccard_join": OP8,
    "op12_conversation_repair": OP12,
    "op13_sketch_near_copies": OP13,
}
