"""SQL twins of the conversation, line and manifest operators.

DuckDB has no crc32: ``crc`` spells it out, byte by byte and bit by bit.
"""

from __future__ import annotations


def crc(text: str) -> str:
    """Unsigned crc32 of an ASCII text that is not empty."""
    bit = "list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda v, b: xor(v >> 1, 3988292384 * (v & 1)), xor(r, c))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda r, c: {bit}, 4294967295::BIGINT), 4294967295)"


def _more(state: str, cost: str, letter: str) -> str:
    """A state is one text, twelve digits of cost and the audit, so that texts compare as repairs do."""
    return f"lpad((left({state}, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({state}, 13) || '{letter}'"


# States by the last initial: e (nothing yet), s, u, a. With inserts in front of a row:
_CLOSED = f"""list_transform([list_transform([f], lambda f: {{
      e: f.e, s: f.s, a: f.a, u: least(f.u, {_more('f.e', '3', 'I')}, {_more('f.s', '3', 'I')}, {_more('f.a', '3', 'I')})}})[1]],
    lambda f: {{e: f.e, s: f.s, u: f.u, a: least(f.a, {_more('f.u', '3', 'I')})}})[1]"""
_STEP = f"""list_transform([{_CLOSED}], lambda f: list_transform([least(f.e, f.s, f.a)], lambda g: {{
      e: {_more('f.e', '4', 'D')},
      s: least({_more('f.s', '4', 'D')}, CASE WHEN r.code = 's' THEN {_more('f.e', 'r.more', 'K')} END),
      u: least({_more('f.u', '4', 'D')}, CASE WHEN r.code = 'u' THEN {_more('g', 'r.more', 'K')} END,
               CASE WHEN r.code <> 'x' THEN {_more('g', '3 + r.more', 'R')} END),
      a: least({_more('f.a', '4', 'D')}, CASE WHEN r.code = 'a' THEN {_more('f.u', 'r.more', 'K')} END,
               CASE WHEN r.code <> 'x' THEN {_more('f.u', '3 + r.more', 'R')} END)}})[1])[1]"""
_LINE = """list_transform([CASE WHEN l = 'I' THEN {role: '', text: ''} ELSE {role: rows[o.i].role, text: rows[o.i].text} END], lambda row:
      list_transform([CASE WHEN l = 'K' THEN row.role WHEN o.last = 'u' THEN 'assistant' ELSE 'user' END], lambda role: {
        i: o.i + CASE WHEN l = 'I' THEN 0 ELSE 1 END, last: CASE WHEN l = 'D' THEN o.last ELSE left(role, 1) END,
        out: CASE WHEN l = 'D' THEN o.out ELSE list_append(o.out, role || ':' || row.text) END})[1])[1]"""

CONVERSATION_REPAIR = f"""
WITH named AS (
  SELECT *, {crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS x FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN x = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE WHEN x = 1 THEN '' WHEN x = 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text,
         unnest(CASE WHEN x = 3 THEN [1, 2] ELSE [1] END) AS copy FROM named WHERE x <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, left(role, 64), left(text, 64), md5(length(role)::VARCHAR || ':' || role || text), copy) AS place,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen FROM hurt),
faults AS (
  SELECT *, CASE WHEN seen = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'd'
                 WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM placed),
grouped AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{code: CASE WHEN fault IN ('b', 'd') THEN 'x' WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'o' END,
               more: CASE WHEN fault = 't' THEN 3 ELSE 0 END, role: role, text: text}} ORDER BY place) AS rows FROM faults GROUP BY conv_id),
folded AS (
  SELECT *, list_reduce(rows, lambda f, r: {_STEP},
                        {{e: '000000000000', s: NULL::VARCHAR, u: NULL::VARCHAR, a: NULL::VARCHAR}}) AS f FROM grouped),
ended AS (SELECT * EXCLUDE (f), least(f.e, f.a) AS best FROM (SELECT * EXCLUDE (f), {_CLOSED} AS f FROM folded)),
told AS (
  SELECT *, left(best, 12)::BIGINT AS cost, substr(best, 13) AS audit,
    list_reduce(list_filter(string_split(substr(best, 13), ''), lambda l: l <> ''), lambda o, l: {_LINE}, {{i: 1::BIGINT, last: '', out: []::VARCHAR[]}}).out AS lines
  FROM ended)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN told t ON c.conv_id IS NOT DISTINCT FROM t.conv_id
"""

_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_RUNS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
k AS (SELECT *, {_KEY} AS k FROM l),
held AS (SELECT k, max(doc_id) AS top FROM k WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT r) >= 5),
m AS (SELECT k.*, h.k IS NOT NULL AND k.doc_id IS DISTINCT FROM h.top AS gone FROM k LEFT JOIN held h ON k.k = h.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""


def _framed(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_framed(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _level(name: str, below: str) -> str:
    """Parents of (t, p, n, node): every three nodes of a tree that has several."""
    return f"""{name} AS (
      SELECT t, p // 3 AS p, (max(n) + 2) // 3 AS n, list(node ORDER BY p) AS cells,
             CASE WHEN max(n) = 1 THEN max(node) ELSE sha256(string_agg(node, '' ORDER BY p)) END AS node, max(n) AS below
      FROM {below} GROUP BY t, p // 3)"""


def _fold(name: str, before: str, level: str, step: int) -> str:
    """Siblings of a level added to the proof, and the altered node hashed with them."""
    slot = f"(p // {3**step}) % 3 + 1"
    return f"""{name} AS (
      SELECT b.* EXCLUDE (proof, back), CASE WHEN l.below = 1 THEN proof ELSE
          proof || array_to_string(list_filter(l.cells, lambda c, i: i <> {slot.replace('p //', 'b.p //')}), '') END AS proof,
        CASE WHEN l.below = 1 THEN back ELSE sha256(array_to_string(
          list_transform(l.cells, lambda c, i: CASE WHEN i = {slot.replace('p //', 'b.p //')} THEN back ELSE c END), '')) END AS back
      FROM {before} b JOIN {level} l ON l.t = b.t AND l.p = b.p // {3 ** (step + 1)})"""


def merkle(depth: int = 12, upper: int = 5) -> str:
    """The manifest with ``depth`` levels for each source and ``upper`` above: 3**depth rows a source."""
    parts = [f"""base AS (
      SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '+' || source END AS t, {_leaf('text')} AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {crc("coalesce(doc_id, 0)::VARCHAR")} % 2 = 0
          THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS back FROM documents)""",
             """l0 AS (SELECT *, leaf AS node, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
        count(*) OVER (PARTITION BY t) AS n FROM base)"""]  # fmt: skip
    parts += [_level(f"l{i + 1}", f"l{i}") for i in range(depth)]
    parts.append(f"""u0 AS (SELECT '' AS t, t AS source, node, row_number() OVER (ORDER BY t) - 1 AS p, count(*) OVER () AS n FROM l{depth})""")
    parts += [_level(f"u{i + 1}", f"u{i}") for i in range(upper)]
    parts.append("f0 AS (SELECT doc_id, t, leaf, p, '' AS proof, back FROM l0)")
    parts += [_fold(f"f{i + 1}", f"f{i}", f"l{i + 1}", i) for i in range(depth)]
    parts.append(f"g0 AS (SELECT f.doc_id, f.leaf, u.node AS subroot, '' AS t, u.p, f.proof, f.back FROM f{depth} f JOIN u0 u ON f.t = u.source)")
    parts += [_fold(f"g{i + 1}", f"g{i}", f"u{i + 1}", i) for i in range(upper)]
    return (
        "WITH " + ",\n".join(parts) + f"""
    SELECT g.doc_id, leaf, subroot, r.node AS root, sha256(proof) AS proof_sha256, back AS folded_root, back = r.node AS verified
    FROM g{upper} g CROSS JOIN u{upper} r"""
    )
