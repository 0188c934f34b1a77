r"""DuckDB SQL for the operators that SQL can express.

Written from the operators' definitions, by other means than their Spark plans:
windows of words as joined strings, sets of positions, plain running sums.
"""

from __future__ import annotations

from terrascore.llm import secret_scan

WORDS = r"[^\x20\x09-\x0D]+"
AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item,
    regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS t
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS t
    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT DISTINCT r, i, bw.k AS k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.t = bw.t),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
ids AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
    FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit,
    coalesce(ids.n, 0)::BIGINT AS n_items, sha256(coalesce(ids.s, '')) AS items_sha256,
    coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN ids USING (r)"""

OP9 = rf"""
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}'))::BIGINT AS size,
    md5('20260:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS n,
    [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM s GROUP BY source),
o AS (SELECT *, 3.0::DOUBLE * n AS cap, row_number() OVER (ORDER BY 3.0::DOUBLE * n / w, source NULLS LAST) AS k FROM p),
l AS (SELECT *, (sum(n) OVER () ::DOUBLE - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev FROM o),
t AS (SELECT source, n, least(cap, w * max(lev) OVER ()) AS target FROM l),
q AS (SELECT *, CASE WHEN n > 0 THEN floor(target / n)::BIGINT ELSE 0 END AS whole FROM t),
z AS (SELECT s.doc_id, s.size, q.n, q.target, q.whole, floor(q.target + 0.5)::BIGINT - q.whole * q.n AS rest,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS before,
    sum(s.size) OVER (PARTITION BY s.source, h) AS ties
    FROM s JOIN q ON s.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, n AS source_size, target,
    (size * whole + CASE WHEN before + ties < rest THEN size
        WHEN before < rest THEN size * (rest - before) // ties ELSE 0 END)::BIGINT AS taken FROM z"""

OP10 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS t
    FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, t) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
ln AS (SELECT r, host, body, l, len(regexp_extract_all(l, '{WORDS}')) AS words,
    trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
        'abcdefghijklmnopqrstuvwxyz000000000'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
    FROM (SELECT r, host, body, unnest(string_split(body, chr(10))) AS l FROM d)
    WHERE regexp_matches(l, '{WORDS}')),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM ln GROUP BY r),
common AS (SELECT host, norm FROM ln GROUP BY host, norm HAVING count(DISTINCT r) > 25),
lost AS (SELECT r, sum(words) AS n FROM ln JOIN common c
    ON ln.norm = c.norm AND ln.host IS NOT DISTINCT FROM c.host GROUP BY r),
f AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lost.n, 0)::BIGINT AS boilerplate_words
    FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN lost USING (r)),
g AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND n_words - boilerplate_words >= 10
        AND 100 * (n_words - boilerplate_words) >= 20 * n_words AS kept, boilerplate_words FROM g"""

#: Bitwise CRC-32 of a short ASCII text, by a table made here.
CRC_TABLE = """SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([1, 2, 3, 4, 5, 6, 7, 8],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, i) AS c FROM range(256) r(i))"""


def _crc32(text: str, table: str) -> str:
    return (f"xor(list_reduce(list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT), "
            f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)")


def _leaf(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _levels(name: str, base: str, levels: int = 5) -> str:
    """``{name}_0`` .. : the nodes (src, pos, n, node) of every level of each tree
    over ``base``, and their runs of 16 as lists."""
    out = [f"{name}_0 AS ({base})"]
    for k in range(levels):
        out.append(f"{name}_run{k} AS (SELECT src, pos // 16 AS run, any_value(n) AS n, list(node ORDER BY pos) AS m "
                   f"FROM {name}_{k} GROUP BY src, pos // 16)")
        out.append(f"{name}_{k + 1} AS (SELECT src, run AS pos, (n + 15) // 16 AS n, "
                   f"CASE WHEN n = 1 THEN m[1] ELSE sha256(array_to_string(m, '')) END AS node FROM {name}_run{k})")
    return ",\n".join(out)


def _climb(name: str, tree: str, base: str, src: str, pos: str, levels: int = 5) -> str:
    """``{name}_0`` .. : rows of ``base`` (proof, cur) led up the levels of ``tree``."""
    out = [f"{name}_0 AS ({base})"]
    for k in range(levels):
        at = f"({pos} // {16 ** k}) % 16 + 1"
        out.append(f"""{name}_{k + 1} AS (SELECT b.* EXCLUDE (proof, cur),
    CASE WHEN t.n = 1 THEN proof ELSE proof || array_to_string(m[1:{at} - 1], '') || array_to_string(m[{at} + 1:], '') END AS proof,
    CASE WHEN t.n = 1 THEN cur ELSE sha256(array_to_string(m[1:{at} - 1], '') || cur || array_to_string(m[{at} + 1:], '')) END AS cur
    FROM {name}_{k} b JOIN {tree}_run{k} t ON t.src = b.{src} AND t.run = b.{pos} // {16 ** (k + 1)})""")
    return ",\n".join(out)


OP11 = f"""
WITH crc AS ({CRC_TABLE}),
d AS (SELECT doc_id, coalesce('1' || source, '0') AS src, {_leaf('text')} AS leaf, {_leaf(f"translate(text, {AZ})")} AS lower_leaf,
    doc_id IS NOT NULL AND {_crc32('doc_id::VARCHAR', 't')} % 5 = 0 AS hit FROM documents, crc),
p AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY src) AS n FROM d),
{_levels('t', 'SELECT src, pos, n, leaf AS node FROM p')},
{_levels('u', "SELECT '' AS src, row_number() OVER (ORDER BY src) - 1 AS pos, count(*) OVER () AS n, node, src AS member FROM t_5")},
{_climb('a', 't', "SELECT *, '' AS proof, CASE WHEN hit THEN lower_leaf ELSE leaf END AS cur FROM p", 'src', 'pos')},
{_climb('b', 'u', "SELECT a_5.*, u_0.node AS subroot, u_0.pos AS spot, '' AS top FROM a_5 JOIN u_0 ON u_0.member = a_5.src", 'top', 'spot')}
SELECT doc_id, leaf, subroot, r.node AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.node AS verified
FROM b_5, u_5 r"""


def _dice(*parts: str) -> str:
    return f"('0x' || substr(sha256(concat_ws(':', {', '.join(parts)})), 1, 4))::INT"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(map(_text, values)) + "]"


S = secret_scan
OP12 = f"""
WITH ids AS (SELECT id, id % {S.STYLES} AS style, {_list(S.RANDOM_ALPHABETS)}[id % {len(S.RANDOM_ALPHABETS)} + 1] AS a,
    list_transform(range(1, 3 + {_dice("'n'", 'id')} % 3), lambda k: {_list(S.WORDS)}[{_dice("'w'", 'id', 'k')} % {len(S.WORDS)} + 1]) AS w
    FROM range({S.SAMPLES}) r(id)),
samples AS (SELECT 0 AS random, CASE style WHEN 0 THEN array_to_string(w, '_') WHEN 1 THEN array_to_string(w, '-')
        WHEN 2 THEN array_to_string(list_transform(w, lambda x: upper(x[1]) || x[2:]), '') WHEN 3 THEN upper(array_to_string(w, '_'))
        WHEN 4 THEN '/' || array_to_string(w, '/') WHEN 5 THEN array_to_string(w, '')
        ELSE array_to_string(w, '_') || '_' || {_dice("'y'", 'id')} % 3000 END AS text FROM ids
    UNION ALL SELECT 1, array_to_string(list_transform(range(1, 21 + {_dice("'l'", 'id')} % 44),
        lambda k: a[{_dice("'c'", 'id', 'k')} % length(a) + 1]), '') FROM ids),
pairs AS (SELECT random, text[i] AS a, text[i + 1] AS b FROM (SELECT *, unnest(range(1, length(text))) AS i FROM samples)),
letters AS (SELECT unnest(string_split({_text(S.ALPHABET)}, '')) AS c),
grid AS (SELECT x.c AS a, y.c AS b FROM letters x, letters y),
seen AS (SELECT a, b, count(*) FILTER (random = 1) AS r, count(*) FILTER (random = 0) AS o FROM grid LEFT JOIN pairs USING (a, b) GROUP BY a, b),
model AS (SELECT a, b, ln((r + {S.SMOOTHING}) / (sum(r) OVER (PARTITION BY a) + {S.SMOOTHING * len(S.ALPHABET)}))
    - ln((o + {S.SMOOTHING}) / (sum(o) OVER (PARTITION BY a) + {S.SMOOTHING * len(S.ALPHABET)})) AS w FROM seen),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
rules AS (SELECT * FROM (VALUES {', '.join(f"({i}, {_text(k)}, {_text(p)})" for i, (k, p) in enumerate(S.KINDS.items()))}) v(rank, kind, pattern)),
pieces AS ({' UNION ALL '.join(f"SELECT r, {i} AS rank, string_split_regex(text, {_text(p)}) AS gaps, regexp_extract_all(text, {_text(p)}) AS ms FROM d"
                               for i, p in enumerate(S.KINDS.values()))}),
found AS (SELECT r, rank, m, (sum(length(gap) + length(m)) OVER (PARTITION BY r, rank ORDER BY i) - length(m))::BIGINT AS s
    FROM (SELECT r, rank, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap FROM pieces)),
ratios AS (SELECT m, sum(w) AS w FROM (SELECT m, m[i] AS a, m[i + 1] AS b FROM (SELECT m, unnest(range(1, length(m))) AS i
    FROM (SELECT DISTINCT m FROM found WHERE rank = 3))) JOIN model USING (a, b) GROUP BY m),
spans AS (SELECT r, rank, kind, s, s + length(m) AS e FROM found JOIN rules USING (rank) LEFT JOIN ratios USING (m)
    WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(m, {_text(S.ASSIGN)}, 2)) >= {S.LEAST['assign']}
        WHEN 'access' THEN length(m) >= {S.LEAST['access']} WHEN 'hex' THEN length(m) >= {S.LEAST['hex']} ELSE w >= {S.MIN_RATIO} END),
kept AS (SELECT * FROM spans x WHERE rank < 3 OR NOT EXISTS (SELECT 1 FROM spans y WHERE y.r = x.r AND y.rank < 3 AND y.s <= x.s AND x.e <= y.e)),
told AS (SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(told.spans, '') AS spans FROM d LEFT JOIN told USING (r)"""

SQL = {"op6_decontamination": OP6, "op9_mixing": OP9, "op10_quality_lines": OP10, "op11_merkle_manifest": OP11,
       "op12_secret_scan": OP12}
