"""DuckDB equivalents of the registered queries."""

from __future__ import annotations

from corpusloom.functions.labels import PLACEHOLDER, SYNONYMS
from corpusloom.plans.taxonomy import OTHER

_NULLISH = "lower(trim(x, ' ' || chr(9) || chr(10) || chr(13))) IN ('nan', 'none', 'null', '')"


def _replaced(x: str, steps: list[tuple[str, str]]) -> str:
    for pattern, put in steps:
        p = pattern.replace("'", "''")
        x = f"regexp_replace({x}, '{p}', {put}, 'g')"
    return x


_STRIP = (r"^\s+|\s+$", "''")
_DECODE = [(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "''"), (r"_x000[AaDd]_", "chr(10)"), (r"_x0009_", "' '")]
_CUT = (
    r"(?:(?i:\*\*\s*Created via Incoming Email Processor\s*\*\*)|(?im:^[ \t>]*(?:van|verzonden|onderwerp|from|sent|subject)\s*:\s*\S)"
    r"|(?im:^[ \t]*(?:met (?:vriendelijke|hartelijke) groet(?:en)?|vriendelijke groet(?:en)?|hartelijke groet(?:en)?|kind regards|best regards|mvg)\b)|(?m:^[ \t]*[-_]{6,}[ \t]*$))[\s\S]*",
    "''",
)
_MIDDLE = [(r"(?i)\[cid:[^\]]*\]", "' '"), (r"\s*<(?:mailto:|tel:|https?://)[^>]*>", "''")]
_URL = [(r"https?://\S+", "' '")]
_END = [
    (r"(?i)</?(?:p|br|div|span|a|b|i|u|strong|em|ul|ol|li|table|tr|td|th|thead|tbody|img|font|h[1-6]|blockquote|hr|pre|code)\b[^>]*>", "' '"),
    (r"\?{3,}", "' '"), (r"[ \t\f\v]+", "' '"), (r"\s*\n\s*", "chr(10)"), _STRIP,
]


def scrub(x: str, *, urls: bool, cut: bool) -> str:
    return _replaced(x, _DECODE + ([_CUT] if cut else []) + _MIDDLE + ([] if urls else _URL) + _END)


NOISY = """CASE WHEN doc_id % 2 = 0 THEN 'Hallo_x000D__x000a__x0009_ ' || chr(7) ELSE '' END || text || CASE doc_id % 7
    WHEN 0 THEN chr(10) || 'Van: iemand' || chr(10) || 'RE' WHEN 1 THEN chr(10) || '  Kind regards' || chr(10) || 'Jo'
    WHEN 2 THEN ' **  created via Incoming Email Processor **x' WHEN 3 THEN chr(10) || ' --------  ' || chr(10) || 'old'
    WHEN 4 THEN ' see https://example.com/a?b=c <https://example.com/t>[CID:i@x] <b>x</b>????y' ELSE '' END"""


def _cleaned(expression: str) -> str:
    return f"""WITH d AS (SELECT doc_id, {NOISY} AS x FROM documents),
        c AS (SELECT doc_id, CASE WHEN {_NULLISH} THEN '' ELSE {expression} END AS c FROM d)
        SELECT doc_id, CAST(length(c) AS BIGINT) AS n, md5(c) AS hash FROM c"""


_BUILT = """t AS (
        SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority ELSE '' END AS title,
            CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS description, o_orderstatus AS issue_type, o_orderpriority AS sub_issue_type,
            CASE WHEN o_orderkey % 7 IN (0, 1) THEN 0 ELSE o_totalprice END AS own
        FROM orders
    ), e AS (
        SELECT l_orderkey AS k, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_shipdate END AS started, l_linenumber AS line, l_returnflag AS s,
            CASE WHEN l_quantity < 5 THEN '' ELSE l_linestatus END AS i, l_quantity AS h FROM lineitem
    ), r AS (
        SELECT *, row_number() OVER (PARTITION BY k ORDER BY (started IS NULL), started, line, s, i) AS rn FROM e
    ), p AS (
        SELECT k, rn, 0 AS part, s AS x FROM r UNION ALL SELECT k, rn, 1, i FROM r
    ), f AS (
        SELECT *, lag(x) OVER (PARTITION BY k ORDER BY rn, part) AS before FROM p WHERE x <> ''
    ), n AS (
        SELECT k, string_agg(x, ' — ' ORDER BY rn, part) AS notes FROM f WHERE before IS NULL OR before <> x GROUP BY k
    ), a AS (
        SELECT k, CAST(count(*) AS INT) AS touches, sum(h) AS h FROM e GROUP BY k
    ), b AS (
        SELECT t.k, 'main::' || t.k AS ticket_id, 'main' AS instance, title, description, coalesce(notes, '') AS notes, issue_type, sub_issue_type,
            CASE WHEN own <> 0 THEN own ELSE coalesce(h, 0) END AS hours, coalesce(touches, 1) AS touches,
            title <> '' OR description <> '' OR coalesce(notes, '') <> '' AS kept
        FROM t LEFT JOIN a USING (k) LEFT JOIN n USING (k)
    )"""

_META = """SELECT count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS dropped, round(coalesce(sum(hours) FILTER (kept), 0), 3) AS kept_hours,
        round(coalesce(sum(hours) FILTER (NOT kept), 0), 3) AS dropped_hours, round(coalesce(sum(hours), 0), 3) AS total_hours FROM b"""

_SYNONYMS = ", ".join(f"('{k}', '{v}')" for k, v in SYNONYMS.items())


def _canonical(x: str) -> str:
    steps = [(r"^\s+|\s+$", "''"), (r"^(?:qnp\s*-\s*|td\s+|ict\s*-\s*|klant\s*-\s*)", "''"), ("_", "' '"), ("[-/]+", "' '"), (r"[^\p{L}\p{N}_\s.]", "' '"), (r"\s+", "' '"), _STRIP]
    return _replaced(f"lower({x})", steps)


_LABELS = f"""m(c, v) AS (VALUES {_SYNONYMS})"""

_ITEMS = f"""d AS (SELECT doc_id, text AS x FROM documents),
    items AS (SELECT * FROM (SELECT 'd::' || doc_id AS ticket_id, doc_id, CASE WHEN {_NULLISH} THEN '' ELSE {scrub("x", urls=False, cut=False)} END AS text FROM d) WHERE length(text) >= 40)"""
_CACHE = "cache AS (SELECT 'd::' || conv_id AS id, arg_max(coalesce(text, ''), (turn, text)) AS text FROM conversations GROUP BY conv_id)"
_TODO = "todo AS (SELECT * FROM items WHERE ticket_id NOT IN (SELECT id FROM cache))"
_VECTORS = "v AS (SELECT vec_id, label AS cluster_id, list_transform(embedding, lambda y: CAST(y AS DOUBLE)) AS x FROM embeddings)"
_TOTALS = """w AS (SELECT label AS cluster_id, CAST(n_chars AS DOUBLE) AS hours FROM embeddings JOIN documents ON vec_id = doc_id),
    s AS (SELECT CAST(sum(n_chars) AS DOUBLE) AS total FROM documents),
    c AS (SELECT cluster_id, count(*) AS n_tickets, sum(hours) AS hours, sum(hours) / any_value(total) AS f FROM w, s GROUP BY cluster_id),
    o AS (SELECT cluster_id, n_tickets, round(hours, 2) AS hours, round(f, 4) AS hours_frac, n_tickets >= 25 AND f >= 0.003 AS big_enough FROM c)"""
_UNIT = "list_transform({x}, lambda y: y / {n})"


def _slice(a: int) -> str:
    return f"x[{a}:{a + 15}]"


def _norm(x: str) -> str:
    return f"sqrt(list_sum(list_transform({x}, lambda y: y * y)))"


_WEIGHTS = (0.3, 0.3, 1.0, 0.5)
_PARTS = ", ".join(f"{_norm(_slice(1 + 16 * i))} AS n{i}" for i in range(4))
_ALL = " || ".join(f"list_transform({_slice(1 + 16 * i)}, lambda y: y / n{i} * {w})" for i, w in enumerate(_WEIGHTS))
_DISTANCE = "sqrt(list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"

# The detectors without what this dialect lacks. A match of 'phone' takes all digits there are, so nothing has
# to follow; what may not come before it is matched too and put back.
_DETECTORS = {
    "email": (r"\b[\w.+-]+@[\w-]+\.[\w.-]+\b", "[EMAIL]"),
    "ipv4": (r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "[IP]"),
    "phone": (r"(^|[^0-9])\+?[0-9][0-9\s\x1c-\x1f().-]{7,}[0-9]", r"\1[PHONE]"),
    "iban": (r"\b[A-Z]{2}\d{2}[A-Z0-9]{10,30}\b", "[IBAN]"),
    "url_creds": (r"\b\w+://[^\s:@]+:[^\s:@]+@\S+", "[URL]"),
}
_PERSONAL = "d AS (SELECT doc_id, text || CASE WHEN doc_id % 4 = 0 THEN ' a.b@example.com ftp://u:p@h.example/x NL02ABCD0123456789 10.0.0.1 +31 (20) 555-0199, 123456782 ' ELSE '' END AS x FROM documents)"


def _matches(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def _counted() -> str:
    counts = [f"CAST({_matches('x', p)} AS INT) AS {kind}" for kind, (p, _) in _DETECTORS.items()]
    counts.append("CAST(len(list_filter(regexp_extract_all(x, '[0-9]+'), lambda y: length(y) = 9)) AS INT) AS bsn")
    return f"WITH {_PERSONAL} SELECT doc_id, {', '.join(counts)} FROM d"


def _redacted() -> str:
    """Each detector in turn; numbers of nine digits are none any more once phone numbers are."""
    steps, last = [_PERSONAL.replace(" AS x FROM", " AS x, 0 AS n FROM")], "d"
    for kind, (pattern, put) in _DETECTORS.items():
        steps.append(f"r_{kind} AS (SELECT doc_id, regexp_replace(x, '{pattern}', '{put}', 'g') AS x, n + {_matches('x', pattern)} AS n FROM {last})")
        last = f"r_{kind}"
    return f"WITH {', '.join(steps)} SELECT doc_id, md5(x) AS hash, CAST(n AS BIGINT) AS n FROM {last}"


ORACLES = {
    "records": f"WITH {_BUILT} SELECT ticket_id, instance, title, description, notes, issue_type, sub_issue_type, hours, touches FROM b WHERE kept",
    "records_meta": f"WITH {_BUILT} {_META}",
    "records_limited": f"WITH {_BUILT}, cut AS (SELECT max(k) AS last FROM (SELECT k FROM b WHERE kept ORDER BY k LIMIT 500)) {_META}, cut WHERE k <= last",
    "first_rows": "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text",
    "clean_description": _cleaned(scrub("x", urls=False, cut=True)),
    "clean_note": _cleaned(scrub("x", urls=True, cut=True)),
    "prepass_description": _cleaned(scrub("x", urls=False, cut=False)),
    "record_text": _cleaned(_replaced("x", [(r"\s+", "' '"), _STRIP])),
    "labels": f"""WITH {_LABELS}, r AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'QNP - ' || p_type WHEN 1 THEN ' Back-Up ' WHEN 2 THEN 'E_mail/' || p_brand
            WHEN 3 THEN 'Overig' WHEN 4 THEN 'Wachtwoord  Reset!' ELSE upper(p_type) END AS raw FROM part),
        l AS (SELECT p_partkey, {_canonical("raw")} AS canonical FROM r)
        SELECT p_partkey, canonical, CASE WHEN coalesce(v, canonical) = '{PLACEHOLDER}' THEN '' ELSE coalesce(v, canonical) END AS label FROM l LEFT JOIN m ON c = canonical""",
    "label_audit": f"""WITH {_LABELS}, r AS (SELECT trim(o_orderstatus) AS raw, o_orderkey AS o, 0 AS i, 'issue_type' AS field FROM orders
            UNION ALL SELECT trim(o_orderpriority), o_orderkey, 1, 'sub_issue_type' FROM orders),
        g AS (SELECT raw, arg_min(field, (o, i)) AS field, count(*) AS n FROM r WHERE raw <> '' GROUP BY raw),
        l AS (SELECT *, {_canonical("raw")} AS canonical FROM g)
        SELECT raw, CASE WHEN coalesce(v, canonical) = '{PLACEHOLDER}' THEN '' ELSE coalesce(v, canonical) END AS canonical, field, n FROM l LEFT JOIN m ON c = canonical""",
    "tfidf": f"""WITH {_LABELS}, r AS (SELECT CAST(o_orderkey AS VARCHAR) AS ticket_id, 'issue=' AS p, {_canonical("o_orderstatus")} AS l FROM orders
            UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'sub=', {_canonical("o_orderpriority")} FROM orders),
        t AS (SELECT ticket_id, p || replace(coalesce(v, l), ' ', '_') AS token FROM r LEFT JOIN m ON c = l WHERE coalesce(v, l) NOT IN ('', '{PLACEHOLDER}')),
        f AS (SELECT ticket_id, token, count(*) AS tf FROM t GROUP BY ALL),
        i AS (SELECT token, ln((1 + (SELECT count(*) FROM orders)) / (1 + count(*))) + 1 AS idf FROM f GROUP BY token HAVING count(*) >= 2),
        w AS (SELECT ticket_id, token, tf * idf AS w FROM f JOIN i USING (token))
        SELECT ticket_id, token, round(w / sqrt(sum(w * w) OVER (PARTITION BY ticket_id)), 9) AS weight FROM w""",
    "personal_data": _counted(),
    "cache_latest": f"WITH {_CACHE} SELECT id, md5(text) AS hash FROM cache",
    "todo": f"WITH {_ITEMS}, {_CACHE}, {_TODO} SELECT ticket_id, md5(text) AS hash FROM todo",
    "request_groups": f"""WITH {_ITEMS}, {_CACHE}, {_TODO}, n AS (SELECT *, row_number() OVER (ORDER BY doc_id, ticket_id) - 1 AS p FROM todo),
        m AS (SELECT *, p // 12 AS c, '--- TICKET ' || (p % 12) || ' ---' || chr(10) || CASE WHEN length(text) > 1500 THEN left(text, 1500) || ' …[truncated]' ELSE text END AS part FROM n)
        SELECT printf('g%06d', c) AS custom_id, string_agg(ticket_id, ',' ORDER BY p) AS ids, md5(string_agg(part, chr(10) || chr(10) ORDER BY p)) AS hash FROM m GROUP BY c""",
    "request_cost": f"WITH {_ITEMS} SELECT CAST(ceil(count(*) / 12.0) AS BIGINT) AS requests, CAST(coalesce(sum(length(text)), 0) // 4 AS BIGINT) AS input_tokens FROM items",
    "ticket_twin": f"""WITH d AS (SELECT doc_id, text AS x FROM documents), {_CACHE},
        c AS (SELECT doc_id, CASE WHEN {_NULLISH} THEN '' ELSE {scrub("x", urls=False, cut=True)} END AS c FROM d)
        SELECT doc_id, id IS NOT NULL AS by_model, md5(CASE WHEN id IS NOT NULL THEN {_replaced("cache.text", _DECODE[:1])} ELSE c END) AS hash FROM c LEFT JOIN cache ON id = 'd::' || doc_id""",
    "token_batches": """WITH RECURSIVE d AS (SELECT source, doc_id, CAST(ceil(least(length(text), 24000) / 4.0) AS BIGINT) AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
        r AS (SELECT source, doc_id, rn, 0 AS batch, size AS t, 1 AS k FROM d WHERE rn = 1
            UNION ALL SELECT d.source, d.doc_id, d.rn, CASE WHEN r.t + d.size > 5000 OR r.k >= 8 THEN r.batch + 1 ELSE r.batch END, CASE WHEN r.t + d.size > 5000 OR r.k >= 8 THEN d.size ELSE r.t + d.size END, CASE WHEN r.t + d.size > 5000 OR r.k >= 8 THEN 1 ELSE r.k + 1 END
            FROM r JOIN d ON d.source = r.source AND d.rn = r.rn + 1)
        SELECT source, doc_id, batch FROM r""",
    "cluster_totals": f"WITH {_TOTALS} SELECT * FROM o",
    "coverage": f"""WITH {_TOTALS}, q AS (SELECT hours, big_enough AND cluster_id % 2 = 0 AS q FROM o)
        SELECT round(coalesce(sum(hours) FILTER (q), 0) / any_value(total), 4) AS coverage, round(coalesce(sum(hours) FILTER (q), 0), 2) AS covered_hours, round(any_value(total), 2) AS total_hours,
            count(*) FILTER (q) AS n_named_clusters, count(*) AS n_clusters FROM q, s""",
    "agreement": """WITH p AS (SELECT label AS a, CASE WHEN vec_id % 3 = 0 THEN vec_id % 7 ELSE label END AS b FROM embeddings),
        x AS (SELECT sum(n * (n - 1) / 2.0) AS s FROM (SELECT count(*) AS n FROM p GROUP BY a, b)), y AS (SELECT sum(n * (n - 1) / 2.0) AS s FROM (SELECT count(*) AS n FROM p GROUP BY a)),
        z AS (SELECT sum(n * (n - 1) / 2.0) AS s FROM (SELECT count(*) AS n FROM p GROUP BY b)), t AS (SELECT count(*) * (count(*) - 1) / 2.0 AS s FROM p)
        SELECT round(CAST((x.s - y.s * z.s / t.s) / ((y.s + z.s) / 2 - y.s * z.s / t.s) AS DOUBLE), 9) AS ari FROM x, y, z, t""",
    "silhouette": f"""WITH {_VECTORS}, c AS (SELECT cluster_id, count(*) AS n FROM v GROUP BY 1),
        d AS (SELECT p.vec_id, p.cluster_id AS own, q.cluster_id AS other, sum({_DISTANCE.format(a="p.x", b="q.x")}) AS s FROM v p, v q WHERE p.vec_id <> q.vec_id GROUP BY ALL),
        a AS (SELECT vec_id, any_value(o.n) AS n, sum(CASE WHEN own = other THEN s END) / (any_value(o.n) - 1) AS a, min(CASE WHEN own <> other THEN s / c.n END) AS b
            FROM d JOIN c ON c.cluster_id = other JOIN c o ON o.cluster_id = own GROUP BY vec_id)
        SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 9) AS silhouette FROM a""",
    "combine": f"""WITH {_VECTORS}, n AS (SELECT vec_id, x, {_PARTS} FROM v), c AS (SELECT vec_id, {_ALL} AS y FROM n), u AS (SELECT vec_id, y, {_norm("y")} AS l FROM c)
        SELECT vec_id, len(y) AS width, {", ".join(f"round(y[{i}] / l, 9) AS x{i}" for i in (1, 17, 33, 64))} FROM u""",
    "nearest_members": f"""WITH {_VECTORS}, e AS (SELECT cluster_id, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM v), m AS (SELECT cluster_id, i, avg(y) AS y FROM e GROUP BY ALL),
        c AS (SELECT cluster_id, list(y ORDER BY i) AS centre FROM m GROUP BY 1), d AS (SELECT cluster_id, vec_id, {_DISTANCE.format(a="x", b="centre")} AS distance FROM v JOIN c USING (cluster_id)),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY distance, CAST(vec_id AS VARCHAR)) AS INT) AS place FROM d)
        SELECT cluster_id, place, vec_id, round(distance, 7) AS distance FROM r WHERE place <= 8""",
    "ranked_groups": """WITH g AS (SELECT source AS combo, count(*) AS k, CAST(sum(n_chars) // 100000 AS BIGINT) AS coverage, CAST(count(*) % 3 AS DOUBLE) AS llm_overall, count(*) AS n_named FROM documents GROUP BY source)
        SELECT *, CAST(row_number() OVER (ORDER BY coverage DESC, llm_overall DESC, combo) AS INT) AS place FROM g""",
    "redacted": _redacted(),
    "rubric": f"""WITH {_TOTALS} SELECT 'Cluster ' || cluster_id AS name, 'Uncategorized' AS category, 'mail [EMAIL], ' || n_tickets AS description FROM o WHERE big_enough
        UNION ALL SELECT {", ".join(f"'{v}'" for v in OTHER)}""",
}
