"""DuckDB SQL for the results of operators that SQL can express, by the plainest way."""

SUBSTRING_DEDUP = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 33, 1))) AS i FROM w),
hashed AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM win),
twice AS (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM hashed JOIN twice USING (h)),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i, unnest(range(0, 35)) AS k FROM hit)),
word AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT word.doc_id, string_agg(w, ' ' ORDER BY word.p) AS t FROM word ANTI JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p GROUP BY word.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1) g ON g.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id"""

LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS n FROM d),
w AS (SELECT doc_id, n, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM l),
t AS (SELECT doc_id, n, len(ws) AS m, array_to_string(ws, ' ') AS s, ws FROM w WHERE len(ws) >= 5),
f AS (SELECT s, any_value(m) AS m, any_value(ws) AS ws, min((doc_id, n)) AS pl FROM t GROUP BY s),
i AS (SELECT s, pl, m, ws, unnest(range(1, m + 1)) AS i FROM f WHERE m >= 8),
v AS (SELECT s, pl, m, i, array_to_string(list_concat(ws[1:i - 1], ws[i + 1:]), ' ') AS v FROM i),
sub AS (SELECT v, i, min(pl) AS first FROM v GROUP BY v, i),
near AS (
  SELECT v.s FROM v JOIN sub ON sub.v = v.v AND sub.i = v.i WHERE sub.first < v.pl
  UNION SELECT v.s FROM v JOIN f ON f.s = v.v WHERE f.m >= 8 AND f.pl < v.pl
  UNION SELECT f.s FROM f JOIN v ON f.s = v.v WHERE f.m >= 8 AND v.pl < f.pl),
gone AS (SELECT t.doc_id, t.n FROM t JOIN f ON f.s = t.s LEFT JOIN near ON near.s = t.s WHERE near.s IS NOT NULL OR (t.doc_id, t.n) <> f.pl),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.n) AS k FROM l ANTI JOIN gone ON gone.doc_id = l.doc_id AND gone.n = l.n GROUP BY l.doc_id)
SELECT d.doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(coalesce(g.c, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS c FROM gone GROUP BY 1) g ON g.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

DECONTAMINATION = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS ws FROM benchmark),
it AS (SELECT item_id, ws, len(ws) AS n, len(ws) - 4 AS m FROM iw WHERE len(ws) >= 5),
ip AS (SELECT item_id, n, m, ws, unnest(range(1, m + 1)) AS i FROM it),
ig AS (SELECT item_id, n, m, array_to_string(ws[i:i + 4], ' ') AS s, count(*) AS c FROM ip GROUP BY 1, 2, 3, 4),
dp AS (SELECT doc_id, ws, len(ws) AS nd, unnest(range(1, greatest(len(ws) - 3, 1))) AS p FROM dw),
dg AS (SELECT doc_id, nd, p, array_to_string(ws[p:p + 4], ' ') AS s FROM dp),
hit AS (SELECT doc_id, item_id, least(n, nd) AS size, nd, m, p FROM dg JOIN ig USING (s)),
able AS (SELECT doc_id, item_id FROM hit GROUP BY doc_id, item_id, m HAVING count(*) >= 0.8 * m),
win AS (SELECT DISTINCT doc_id, item_id, size, m, unnest(range(greatest(1, p - size + 5), least(p, nd - size + 1) + 1)) AS b FROM hit SEMI JOIN able ON able.doc_id = hit.doc_id AND able.item_id = hit.item_id),
wg AS (SELECT w.doc_id, w.item_id, w.size, w.m, w.b, dg.s, count(*) AS c FROM win w JOIN dg ON dg.doc_id = w.doc_id AND dg.p >= w.b AND dg.p <= w.b + w.size - 5 GROUP BY 1, 2, 3, 4, 5, 6),
k AS (SELECT wg.doc_id, wg.item_id, wg.size, wg.m, wg.b, sum(least(wg.c, coalesce(ig.c, 0))) AS k FROM wg LEFT JOIN ig ON ig.item_id = wg.item_id AND ig.s = wg.s GROUP BY 1, 2, 3, 4, 5),
sim AS (SELECT *, CAST(k AS DOUBLE) / CAST(size - 4 + m - k AS DOUBLE) AS similarity FROM k),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, b) AS rn FROM sim WHERE similarity >= 0.8)
SELECT doc_id, item_id, CAST(b - 1 AS BIGINT) AS start, CAST(size AS BIGINT) AS n_words, similarity FROM best WHERE rn = 1"""


def _manifest(levels: int = 5, source_levels: int = 3) -> str:
    """Trees of at most 16^levels leaves a source and 16^source_levels sources, one CTE per level."""
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ord(ch)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

    def told(c):
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"

    def climb(name, count):
        parts = []
        for k in range(count + 1):
            parts.append(f"""{name}s{k} AS (SELECT t, p, n, d,
  coalesce(string_agg(d, '') OVER (PARTITION BY t, p // 16 ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
  coalesce(string_agg(d, '') OVER (PARTITION BY t, p // 16 ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM {name}{k})""")
            parts.append(f"""{name}{k + 1} AS (SELECT t, p // 16 AS p, (n + 15) // 16 AS n,
  CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY p)) ELSE any_value(d) END AS d FROM {name}{k} GROUP BY t, p // 16, n)""")
        return ",\n".join(parts)

    head = told("doc_id") + " || " + " || ".join(told(c) for c in ("source", "lang", "n_chars"))
    steps, last = [], "f0"
    for k in range(levels + source_levels):
        name, j, key = ("a", k, "x.t = w.t") if k < levels else ("b", k - levels, "x.t = ''")
        at = f"w.p // {16 ** k}" if k < levels else f"w.sp // {16 ** j}"
        steps.append(f"""f{k + 1} AS (SELECT w.doc_id, w.t, w.p, w.sp, w.leaf, w.subroot,
  w.proof || x.lft || x.rgt AS proof, CASE WHEN x.n > 1 THEN sha256(x.lft || w.f || x.rgt) ELSE w.f END AS f
  FROM f{k} w JOIN {name}s{j} x ON {key} AND x.p = {at})""")
        last = f"f{k + 1}"
    return f"""
WITH lv AS (SELECT doc_id, coalesce('s' || source, '') AS t, sha256({head} || {told("text")}) AS d,
  CASE WHEN {crc} % 5 = 0 THEN sha256({head} || {told("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS changed FROM documents),
leaf AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, d) - 1 AS p, count(*) OVER (PARTITION BY t) AS n FROM lv),
a0 AS (SELECT t, p, n, d FROM leaf),
{climb("a", levels)},
b0 AS (SELECT '' AS t, row_number() OVER (ORDER BY t) - 1 AS p, count(*) OVER () AS n, d, t AS source FROM a{levels}),
{climb("b", source_levels)},
f0 AS (SELECT leaf.doc_id, leaf.t, leaf.p, b0.p AS sp, leaf.d AS leaf, b0.d AS subroot, '' AS proof, coalesce(changed, leaf.d) AS f FROM leaf JOIN b0 ON b0.source = leaf.t),
{(","+chr(10)).join(steps)}
SELECT doc_id, leaf, subroot, r.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = r.d AS verified FROM {last}, b{source_levels} r"""


MERKLE_MANIFEST = _manifest()


def _chat() -> str:
    """The digests, and the length of the format, from the rows themselves."""
    from .chat import CONTROLS, END, NEXT, SEP, START

    def escaped(c):
        out = f"replace({c}, '\\', '\\\\')"
        for control in CONTROLS:
            out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
        return out

    return f"""
WITH src AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before FROM src WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({escaped("text")}) + CASE WHEN i > 1 AND role = before THEN {len(NEXT)} ELSE length({escaped("role")}) + {len(START + SEP + END)} END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id"""


CHAT_FORMAT = _chat()
