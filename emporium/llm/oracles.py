"""The corpus queries that DuckDB SQL can state, written from their contracts."""

from __future__ import annotations

WHITE = r"[\x20\x09-\x0D]"

#: kind: (pattern, test of a match ``z.v`` between ``z.before`` and ``z.after``, in SQL)
_DIGITS = "regexp_replace(z.v, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
    CASE WHEN i % 2 = 1 THEN CAST(reverse({_DIGITS})[i] AS INT)
    ELSE (2 * CAST(reverse({_DIGITS})[i] AS INT)) % 10 + CAST(reverse({_DIGITS})[i] AS INT) // 5 END)) % 10 = 0"""
_PLAIN = "replace(z.v, ' ', '')"
_TURNED = f"({_PLAIN}[5:] || {_PLAIN}[1:4])"
_MOD97 = f"""list_reduce(list_transform(string_split({_TURNED}, ''), lambda c:
    CASE WHEN c BETWEEN '0' AND '9' THEN CAST(c AS BIGINT) ELSE 1000 + ascii(c) - 55 END),
    lambda acc, c: CASE WHEN c < 1000 THEN (acc * 10 + c) % 97 ELSE (acc * 100 + c - 1000) % 97 END, 0) = 1"""
_SSN_WORDS = r"regexp_matches(lower(z.before[-40:] || ' \n ' || z.after[1:40]), '(^|[^\p{L}])(ssn|social security|sozialversicherung)')"
_SSN_DOUBT = r"regexp_matches(lower(z.before[-40:] || ' \n ' || z.after[1:40]), '(^|[^\p{L}])(order|serial|part)')"
KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(z.v, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0"),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
    "iban": (
        r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}",
        f"length({_PLAIN}) BETWEEN 15 AND 34 AND {_MOD97} AND NOT regexp_matches(z.before[-1:], '[A-Za-z0-9]') AND NOT regexp_matches(z.after[1:1], '[A-Za-z0-9]')",
    ),
    "ssn": (
        "[0-9]{3}-[0-9]{2}-[0-9]{4}",
        "NOT regexp_matches(z.v, '^(000|666|9[0-9]{2})|-00-|-0000$') AND NOT regexp_matches(z.before[-1:], '[0-9-]') "
        f"AND NOT regexp_matches(z.after[1:1], '[0-9-]') AND {_SSN_WORDS} AND NOT {_SSN_DOUBT}",
    ),
}
BASE = ("email", "ip", "card", "phone")


def _personal_data() -> str:
    lists = ",\n".join(
        f"regexp_extract_all(t, '{p}') AS m_{k}, string_split_regex(t, '{p}') AS g_{k}" for k, (p, _) in KINDS.items()
    )
    found = ",\n".join(
        f"""list_transform(list_filter(list_transform(range(1, len(m_{k}) + 1), lambda i: struct_pack(
            v := m_{k}[i], before := g_{k}[i], after := g_{k}[i + 1],
            at := CAST(list_sum(list_transform(g_{k}[1:i], lambda x: length(x))) AS BIGINT) + coalesce(CAST(list_sum(list_transform(m_{k}[1:i - 1], lambda x: length(x))) AS BIGINT), 0)
        )), lambda z: {test}), lambda z: '{k}:' || z.at || ':' || (z.at + length(z.v))) AS {k}"""
        for k, (_, test) in KINDS.items()
    )
    base = " || ".join(f"{k}" for k in BASE)
    every = " || ".join(KINDS)
    return f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    l AS (SELECT doc_id, {lists} FROM t),
    f AS (SELECT doc_id, {found} FROM l)
    SELECT doc_id, {", ".join(f"CAST(len({k}) AS BIGINT) AS n_{k}" for k in BASE)},
        sha256(coalesce(array_to_string({base}, ','), '')) AS base_sha256,
        coalesce(array_to_string({every}, ','), '') AS spans
    FROM f"""


_QUALITY = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT *, list_filter(string_split_regex(t, '{WHITE}+'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM t
),
g AS (SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS k FROM w, unnest(range(1, greatest(len(words) - 6, 1))) AS r(i)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM g) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT i + j) AS n FROM again, range(0, 8) AS o(j) GROUP BY rid),
m AS (
    SELECT doc_id, t, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
        len(regexp_extract_all(t, '!')) AS n_bang, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper, len(lines) AS n_lines
    FROM w LEFT JOIN covered USING (rid)
),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_bang > n_words OR 100 * n_upper > 45 * length(t)
        OR 2 * n_dup_lines > n_lines OR coalesce(word_chars, 0) < 2 * n_words OR coalesce(word_chars, 0) > 16 * n_words) AS kept
FROM b
"""


def _shingles(table: str, id_: str, short: bool = False) -> str:
    """``rid, id, sh``: the distinct five-word shingles of every row; with ``short`` a shorter text is one shingle."""
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')"
    least = "1" if short else "5"
    return f"""
    SELECT DISTINCT rid, {id_} AS id, array_to_string(w[i:i + 4], ' ') AS sh
    FROM (SELECT rid, {id_}, {words} AS w FROM {table}), unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i)
    WHERE len(w) >= {least}"""


_CONTAMINATION = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
items AS MATERIALIZED (SELECT row_number() OVER () AS rid, item_id, text FROM benchmark),
d AS MATERIALIZED ({_shingles("docs", "doc_id")}),
b AS MATERIALIZED ({_shingles("items", "item_id")}),
n AS (SELECT rid, count(*) AS n_item FROM b GROUP BY rid)
SELECT any_value(d.id) AS doc_id, any_value(b.id) AS item_id, n_item, count(*) AS n_shared, CAST(count(*) AS DOUBLE) / n_item AS containment
FROM d JOIN b ON d.sh = b.sh JOIN n ON b.rid = n.rid GROUP BY d.rid, b.rid, n_item HAVING 5 * count(*) >= 4 * n_item
"""

_JACCARD = f"""
WITH RECURSIVE docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
d AS MATERIALIZED ({_shingles("docs", "doc_id", short=True)}),
sets AS MATERIALIZED (SELECT rid, any_value(id) AS id, count(*) AS n, md5(string_agg(sh, '|' ORDER BY sh)) AS node FROM d GROUP BY rid),
nodes AS MATERIALIZED (SELECT node, min(rid) AS rid, any_value(n) AS n, count(*) AS copies, min(id) AS least FROM sets GROUP BY node),
s AS MATERIALIZED (SELECT node, n, sh FROM d JOIN nodes USING (rid)),
links AS MATERIALIZED (
    SELECT a.node AS a, b.node AS b FROM s a JOIN s b ON a.sh = b.sh AND a.node <> b.node
    GROUP BY a.node, b.node, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
),
reach AS (SELECT node AS a, node AS b FROM nodes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
class AS (SELECT a AS node, min(least) AS class_id FROM reach JOIN nodes ON b = node GROUP BY a),
linked AS (SELECT a AS node, CAST(sum(copies) AS BIGINT) AS others FROM links JOIN nodes ON b = node GROUP BY a),
found AS (
    SELECT sets.rid, class_id, copies - 1 + coalesce(others, 0) AS n_links
    FROM sets JOIN nodes USING (node) JOIN class USING (node) LEFT JOIN linked USING (node)
)
SELECT doc_id, CASE WHEN found.rid IS NULL THEN doc_id ELSE class_id END AS class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM docs LEFT JOIN found ON docs.rid = found.rid
"""


def _url_filter(rules) -> str:
    values = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in rules)
    return f"""
    WITH u AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ),
    p AS (
        SELECT row_number() OVER () AS rid, page_id,
            translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM u
    ),
    r(verdict, r_host, r_path) AS (VALUES {values}),
    fit AS (
        SELECT rid, arg_max(r_host || r_path, 100000 * length(r_host) + length(r_path)) AS rule,
            arg_max(verdict, 100000 * length(r_host) + length(r_path)) AS verdict
        FROM p JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
        GROUP BY rid
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN fit USING (rid)"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "xor(acc, b)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda x: xor(x >> 1, 3988292384 * (x & 1)))[1]"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda acc, b: {step}, 4294967295), 4294967295)"


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _manifest(levels: int = 12) -> str:
    """Level by level, for up to 8 ** ``levels`` leaves of a language and as many languages."""
    fields = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = f"""
    WITH leaves AS (
        SELECT doc_id, lang, sha256({fields} || {_field("text")}) AS leaf,
            CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({fields} || {_field(lowered)}) END AS changed
        FROM documents
    ),
    placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
    l0 AS (SELECT lang, place, leaf AS h FROM placed),
    v0 AS (SELECT row_number() OVER () AS rid, doc_id, lang, place, leaf, coalesce(changed, leaf) AS node, '' AS proof FROM placed),
    """
    for k in range(levels):
        sql += _level(f"l{k}", f"l{k + 1}", f"v{k}", f"v{k + 1}", "lang")
    sql += f"""
    t0 AS (SELECT 0 AS lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, h, lang AS of FROM l{levels}),
    u0 AS (SELECT v.* EXCLUDE (lang, place), 0 AS lang, t0.place, t0.h AS subroot FROM v{levels} v JOIN t0 ON v.lang IS NOT DISTINCT FROM t0.of),
    """
    for k in range(levels):
        sql += _level(f"t{k}", f"t{k + 1}", f"u{k}", f"u{k + 1}", "lang")
    return sql + f"""
    done AS (SELECT u.*, t.h AS root FROM u{levels} u, t{levels} t)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified FROM done"""


def _level(low: str, high: str, versions: str, higher: str, by: str) -> str:
    """The level above ``low``, and ``versions`` folded into it; a row of one node stays as it is."""
    return f"""
    {low}s AS MATERIALIZED (
        SELECT a.*, count(*) OVER (PARTITION BY {by}) AS n,
            coalesce(string_agg(h, '') OVER (PARTITION BY {by}, place // 8 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
            coalesce(string_agg(h, '') OVER (PARTITION BY {by}, place // 8 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
        FROM {low} a
    ),
    {high} AS MATERIALIZED (
        SELECT {by}, place // 8 AS place, CASE WHEN n = 1 THEN h ELSE sha256(lefts || h || rights) END AS h
        FROM {low}s WHERE place % 8 = 0
    ),
    {higher} AS MATERIALIZED (
        SELECT v.* REPLACE (v.place // 8 AS place, CASE WHEN n = 1 THEN node ELSE sha256(lefts || node || rights) END AS node, proof || lefts || rights AS proof)
        FROM {versions} v JOIN {low}s s ON v.{by} IS NOT DISTINCT FROM s.{by} AND v.place = s.place
    ),
    """


_MIXING = r"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        CAST('0x' || md5(concat_ws('|', 'mix', coalesce(CAST(doc_id AS VARCHAR), '-'), coalesce(source, '-'), md5(coalesce(text, ''))))[1:13] AS BIGINT) / 4503599627370496.0 AS draw
    FROM documents
),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight FROM s),
-- a source's limit for each unit of weight, in tenths; those with less are full before it is
x AS (SELECT *, 3 * source_size * 10 // weight AS ratio, sum(source_size) OVER () AS words, sum(weight) OVER () AS all_weight FROM w),
y AS (
    SELECT *, words - coalesce(sum(3 * source_size) OVER below, 0) AS rest, all_weight - coalesce(sum(weight) OVER below, 0) AS share
    FROM x WINDOW below AS (ORDER BY ratio RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
z AS (SELECT *, 3 * source_size * share < weight * rest AS above FROM y),
l AS (
    SELECT max(words) - coalesce(sum(3 * source_size) FILTER (above), 0) AS rest, sum(weight) FILTER (NOT above) AS share FROM z
),
t AS (
    SELECT source, source_size, CAST(weight AS BIGINT) AS weight,
        CASE WHEN above THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(weight * l.rest AS DOUBLE) / l.share END AS target
    FROM z, l
),
r AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0.0 END AS rate FROM t),
k AS (
    SELECT d.doc_id, d.size, r.*, i / 16.0 AS turn,
        CAST(floor(rate) + CASE WHEN draw + i / 16.0 - floor(draw + i / 16.0) < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies
    FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, range(16) AS x(i)
),
b AS (
    SELECT source, arg_min(turn, [away, turn]) AS turn
    FROM (SELECT source, turn, abs(CAST(sum(size * copies) AS BIGINT) - any_value(target)) AS away FROM k GROUP BY source, turn) GROUP BY source
)
SELECT doc_id, size, source_size, target, size * copies AS taken, k.source, weight, rate, CAST(k.turn AS DOUBLE) AS turn, copies
FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.turn = b.turn
"""

_FILTER_AUDIT = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM t),
lab AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
m AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        concat(CASE WHEN len(words) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' END,
            CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' END,
            CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN least < w.doc_id THEN 'E' END) AS fails
    FROM w LEFT JOIN lab ON w.doc_id = lab.doc_id
),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
s AS (SELECT filter_order, CAST(i AS INT) AS step, filter_order[i] AS own, filter_order[1:i - 1] AS before FROM o, range(1, 6) AS r(i)),
x AS (
    SELECT c.*, s.*, contains(fails, own) AS failing,
        len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0 AND fails <> '' AND before <> '' AS gone
    FROM c, s
),
y AS (
    SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0) AS kept,
        coalesce(sum(n) FILTER (NOT gone AND failing), 0) AS removed, coalesce(sum(n) FILTER (gone AND failing), 0) AS redundant,
        coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
        coalesce(sum(good) FILTER (NOT gone AND failing), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND failing), 0) AS toxic_lost
    FROM x GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
    CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM y
"""


def statements(url_rules) -> dict[str, str]:
    return {
        "op4_personal_data": _personal_data(),
        "op6_benchmark_decontamination": _CONTAMINATION,
        "op7_quality_rules": _QUALITY,
        "op8_ngram_jaccard_join": _JACCARD,
        "op9_url_filter": _url_filter(url_rules),
        "op11_merkle_manifest": _manifest(),
        "op12_mixing": _MIXING,
        "op13_filter_audit": _FILTER_AUDIT,
    }
