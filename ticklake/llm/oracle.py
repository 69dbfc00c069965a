"""DuckDB SQL for the operators of this folder that SQL can express."""

from __future__ import annotations

ASSIGN = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"
          "[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)")
# kind, pattern, what a match x must pass
SECRETS = (
    ("assign", ASSIGN, f"length(regexp_extract(x, '{ASSIGN}', 2)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(x) >= 20"),
    ("hex", "[0-9a-f]+", "length(x) >= 24"),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", "true"),
    ("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", "true"),
    ("pem", "-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", "true"),
)


def _spans(rank: int, kind: str, pattern: str, valid: str) -> str:
    """Spans of one kind: the pieces between matches give the offsets."""
    return f"""list_filter(list_transform(range(1, len(m{rank}) + 1), lambda i: {{
      'start': CAST(list_sum(list_transform(g{rank}[:i], lambda s: length(s))) + coalesce(list_sum(list_transform(m{rank}[:i - 1], lambda s: length(s))), 0) AS BIGINT),
      'rank': {rank}, 'kind': '{kind}', 'match': m{rank}[i]}}), lambda z: list_transform([z.match], lambda x: {valid})[1])"""


def _joined(spans: str) -> str:
    return (f"array_to_string(list_transform({spans}, lambda z: z.kind || ':' || z.start || ':' || "
            "(z.start + length(z.match))), ',')")


def _secrets() -> str:
    base = [k for k, _, _ in SECRETS[:3]]
    found = ", ".join(f"regexp_extract_all(t, '{p}') AS m{i}, string_split_regex(t, '{p}') AS g{i}" for i, (_, p, _) in enumerate(SECRETS))
    every = "list_sort(" + "\n  || ".join(_spans(i, *r) for i, r in enumerate(SECRETS)) + ")"
    counts = ", ".join(f"CAST(len(list_filter(s, lambda z: z.kind = '{k}')) AS BIGINT) AS n_{k}" for k in base)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id, {found} FROM d),
s AS (SELECT doc_id, {every} AS s FROM f)
SELECT doc_id, {counts}, sha256({_joined("list_filter(s, lambda z: z.rank < 3)")}) AS base_sha256, {_joined("s")} AS spans FROM s"""


def _turns() -> str:
    """Conversation repair as a table of labels filled row by row: the least
    cost (nine digits) and audit of each of the four nodes, in one string.
    One insert between two rows is enough: a second one is never cheapest."""
    key = "(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))"
    crc = (f"xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(range(1, length({key}) + 1), "
           f"lambda i: [CAST(ascii(substr({key}, i, 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])), "
           "lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))")

    def add(label: str, cost: str, edit: str) -> str:
        return f"lpad(CAST(CAST(left({label}, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({label}, 10) || '{edit}'"

    def insert(src: str) -> str:
        u = ", ".join(add(f"{src}.{q}", "2", "I") for q in ("n", "s", "a"))
        return (f"{src}.n AS n, {src}.s AS s, least({src}.u, {u}) AS u, least({src}.a, {add(f'{src}.u', '2', 'I')}) AS a")

    def row(q: str, keep: str, keep_from: tuple, rerole_from: tuple) -> str:
        live = [f"CASE WHEN r.ini = '{keep}' THEN {add(f'l.{p}', 'r.cut', 'K')} END" for p in keep_from]
        live += [add(f"l.{p}", "2 + r.cut", "R") for p in rerole_from]
        d = add(f"l.{q}", "3", "D")
        return f"CASE WHEN r.forced THEN {d} ELSE least({', '.join([d, *live])}) END AS {q}"

    body = "'[^\\x20\\x09-\\x0D]'"
    cols = ", ".join((row("n", "-", (), ()), row("s", "s", ("n",), ()), row("u", "u", ("n", "s", "a"), ("n", "s", "a")),
                      row("a", "a", ("u",), ("u",))))
    return f"""WITH RECURSIVE f AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS fate FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM f JOIN (VALUES (0), (1)) AS c(copy) ON copy = 0 OR fate = 3 WHERE fate <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS ini,
         regexp_extract_all(text, {body}) AS seen FROM d),
m AS (
  SELECT *, len(seen) = 0 AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         len(seen) > 0 AND seen[len(seen)] NOT IN ('.', '!', '?') AS open,
         coalesce(lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au'), false) AS odd FROM o),
r AS (SELECT *, blank OR again AS forced, CASE WHEN open THEN 1 ELSE 0 END AS cut FROM m),
c AS (SELECT DISTINCT conv_id FROM conversations),
z AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS n, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM c),
l AS (
  SELECT conv_id, i, {insert("z")} FROM z
  UNION ALL
  SELECT w.conv_id, w.i, {insert("w")} FROM (
    SELECT r.conv_id, r.i, {cols} FROM l JOIN r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i + 1) w),
e AS (
  SELECT conv_id, arg_max(least(n, a), i) AS best FROM l GROUP BY conv_id),
g AS (SELECT conv_id, CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS audit FROM e),
w AS (
  SELECT conv_id, p, substr(audit, p, 1) AS edit, length(replace(left(audit, p), 'I', '')) AS at
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM g)),
t AS (
  SELECT w.conv_id, p, edit, r.role, CASE WHEN edit = 'I' THEN '' ELSE r.text END AS text,
         row_number() OVER (PARTITION BY w.conv_id ORDER BY p) - 1 AS nth,
         first_value(CASE WHEN edit = 'K' AND r.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY w.conv_id ORDER BY p) AS led
  FROM w LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.at AND edit <> 'I' WHERE edit <> 'D'),
h AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - led) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text,
         chr(10) ORDER BY p) AS whole FROM t GROUP BY conv_id),
q AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
         count_if(again AND NOT blank) AS duplicate, count_if(open AND NOT again) AS truncated, count_if(odd) AS illegal FROM r GROUP BY conv_id)
SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, cost, audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM g LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM g.conv_id"""


def _phrases() -> str:
    """Phrases by ``lead`` over the words of a piece."""
    leads = ", ".join(f"lead(w, {k}) OVER p AS w{k}" for k in range(1, 5))
    grams = "\nUNION ALL\n".join(
        f"SELECT lang, [{', '.join(['w', *[f'w{i}' for i in range(1, k)]])}] AS ws, count(*) AS f FROM t "
        f"WHERE {f'w{k - 1} IS NOT NULL' if k > 1 else 'true'} GROUP BY ALL HAVING count(*) >= 100" for k in range(1, 6))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text
  FROM documents),
s AS (SELECT doc, lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
i AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM s),
o AS (SELECT lang, piece, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM i),
t AS (SELECT lang, w, {leads} FROM o WINDOW p AS (PARTITION BY piece ORDER BY pos)),
n AS (SELECT lang, count(*) AS n FROM o GROUP BY lang),
g AS ({grams}),
c AS (SELECT lang, ws, f AS a, unnest(range(1, len(ws))) AS k FROM g WHERE len(ws) > 1),
u AS (
  SELECT c.lang, c.ws, a, k, l.f AS l, r.f AS r, n, (CAST(1000 AS HUGEINT) * a * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM c JOIN g l ON l.lang = c.lang AND l.ws = c.ws[:k] JOIN g r ON r.lang = c.lang AND r.ws = c.ws[k + 1:] JOIN n ON n.lang = c.lang),
b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
x AS (
  SELECT lang, ws[j:j + m - 1] AS ws, max(f) AS longer
  FROM (SELECT lang, ws, f, m, unnest(range(1, len(ws) - m + 2)) AS j FROM g JOIN (VALUES (2), (3), (4)) AS v(m) ON m < len(ws)) GROUP BY ALL),
y AS (
  SELECT b.lang, array_to_string(b.ws, ' ') AS phrase, a, l, r, n, score
  FROM b LEFT JOIN x ON x.lang = b.lang AND x.ws = b.ws WHERE 100 * coalesce(longer, 0) < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM y QUALIFY rank <= 2000"""


ORACLE_SQL: dict[str, str] = {
    "op1_secrets": _secrets(),
    "op2_exact_dedup": """WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op7_embeddings": """WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
parts AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT p.vec_id, (SELECT count(*) FROM links l WHERE l.a = p.vec_id) AS n_links, p.component_id, p.vec_id = p.component_id AS kept
FROM parts p""",
    "op12_conversations": _turns(),
    "op13_phrases": _phrases(),
}
