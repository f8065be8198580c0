"""SQL (DuckDB) for the queries of this subpackage that SQL can express."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned crc32 of an ASCII text, bit by bit."""
    step = "lambda r, z: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)"
    zeros = "[0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT]"
    bits = f"list_reduce(list_prepend(xor(c, b), {zeros}), {step})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::UBIGINT)"
    return f"xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda c, b: {bits}))::BIGINT"


def _after(letter: str, cost: str, state: str, line: str = "''") -> str:
    return f"{{'c': {cost} + {state}.c, 'a': '{letter}' || {state}.a, 'l': {line} || {state}.l}}"


_DUE = {"e": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}
_KEPT = {"e": "CASE initial WHEN 's' THEN p.s WHEN 'u' THEN p.u WHEN '' THEN p.e END", "s": "CASE initial WHEN 'u' THEN p.u WHEN '' THEN p.s END",
         "u": "CASE initial WHEN 'a' THEN p.a WHEN '' THEN p.u END", "a": "CASE initial WHEN 'u' THEN p.u WHEN '' THEN p.a END"}


def _turn(state: str) -> str:
    """The best of deleting, keeping and re-roling a turn from a state, where that is allowed."""
    due, role = _DUE[state]
    keep = _after("K", "extra", f"({_KEPT[state]})", "chr(10) || r.role || ':' || r.text")
    retype = _after("R", "3 + extra", f"p.{due}", f"chr(10) || '{role}:' || r.text")
    legal = f"NOT must_go AND ({_KEPT[state]}) IS NOT NULL"
    return f"least({_after('D', '4', f'p.{state}')}, CASE WHEN {legal} THEN {keep} END, CASE WHEN NOT must_go THEN {retype} END) AS {state}"


def _place(state: str) -> str:
    """The best of inserting no, one or two turns before a turn."""
    due, role = _DUE[state]
    then, after = _DUE[due]
    one = _after("I", "3", due, f"chr(10) || '{role}:'")
    two = _after("II", "6", then, f"chr(10) || '{role}:' || chr(10) || '{after}:'")
    return f"least({state}, {one}, {two}) AS {state}"


AUCTION_REPAIR = f"""
WITH RECURSIVE rows AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM rows, (VALUES (0), (1)) AS copies (k) WHERE fault <> 0 AND (k = 0 OR fault = 3)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), marked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last, role[1] AS initial
    FROM numbered
), turns AS (
    SELECT *, last = '' OR again AS must_go, last = '' AS blank, last <> '' AND again AS duplicate,
        last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS truncated,
        CASE WHEN last IN ('.', '!', '?') THEN 0 ELSE 3 END AS extra,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
    FROM marked
), counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
        count_if(duplicate) AS duplicate, count_if(truncated) AS truncated, count_if(pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
), best AS (
    SELECT conv_id, n AS i, {{'c': 0, 'a': '', 'l': ''}} AS e, {{'c': 6, 'a': 'II', 'l': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s,
        {{'c': 3, 'a': 'I', 'l': chr(10) || 'assistant:'}} AS u, {{'c': 0, 'a': '', 'l': ''}} AS a FROM counts
    UNION ALL
    SELECT conv_id, i, {", ".join(_place(x) for x in "esua")} FROM (
        SELECT p.conv_id, p.i - 1 AS i, {", ".join(_turn(x) for x in "esua")}
        FROM best p JOIN turns r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i
    )
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.a, '') AS audit,
    sha256(coalesce(substr(e.l, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id AND b.i = 0
"""

CENTROID_TRIE = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS spot
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {crc32("conv_id::VARCHAR")} % 4 AS h FROM turns GROUP BY conv_id
), lent AS (
    SELECT c.conv_id, t.spot, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.spot < c.h
), lead_n AS (
    SELECT c.conv_id, c.h, count(l.conv_id) AS k FROM convs c LEFT JOIN lent l USING (conv_id) GROUP BY ALL
), steps AS (
    SELECT conv_id, spot + 1 AS depth, role, text FROM lent
    UNION ALL
    SELECT conv_id, k + spot - h + 1, role, text FROM turns JOIN lead_n USING (conv_id) WHERE spot >= h
), ways AS (
    SELECT conv_id, 0 AS depth, '' AS path, 0 AS words FROM convs
    UNION ALL
    SELECT conv_id, depth, string_agg(md5(length(role)::VARCHAR || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth),
        len(regexp_extract_all(text, '[^ \\t-\\r]+')) FROM steps
), nodes AS (
    SELECT path, depth, min(conv_id) AS owner, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved FROM ways GROUP BY path, depth
), parents AS (
    SELECT n.*, left(path, greatest(length(path) - 32, 0)) AS up FROM nodes n
), tree AS (
    SELECT p.*, q.owner AS parent, (SELECT count(*) FROM parents x WHERE x.up = p.path AND x.depth = p.depth + 1) AS n_children
    FROM parents p LEFT JOIN nodes q ON q.path = p.up AND q.depth = p.depth - 1
), sums AS (
    SELECT w.path, sum((t.n_children = 0)::BIGINT) AS n_leaves, sum(t.saved) AS saved
    FROM tree t JOIN ways w ON w.conv_id = t.owner AND w.depth <= t.depth GROUP BY w.path
), ends AS (
    SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS numbers
    FROM (SELECT conv_id, max_by(path, depth) AS path FROM ways GROUP BY conv_id) GROUP BY path
)
SELECT t.owner AS conv_id, t.depth::BIGINT AS depth, t.parent AS parent_conv_id, t.n_convs::BIGINT AS n_convs, t.n_children::BIGINT AS n_children,
    s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.numbers, '')) AS ends_sha256
FROM tree t JOIN sums s USING (path) LEFT JOIN ends e USING (path)
"""
