"""DuckDB SQL of those text queries that SQL can express."""

from __future__ import annotations

BLANKS = r"[\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op1_exact_dedup"] = rf"""
WITH read AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '{BLANKS}', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       sha256(norm) AS text_sha256
FROM read
WINDOW same AS (PARTITION BY norm)
"""


def _spans(kind: str, pattern: str, holds: str) -> str:
    """List of kind:start:end of one kind; ``m`` is a match, ``near`` 40 code
    points before it and as many after it, parted by a line feed."""
    return f"""
    (SELECT list(printf('{kind}:%d:%d', s.at, s.at + length(s.m)) ORDER BY s.at)
     FROM (SELECT x.m, x.at, right(left(text, x.at), 40) || chr(10) || left(substr(text, x.at + length(x.m) + 1), 40) AS near FROM (
        SELECT ms[i] AS m,
               CAST(coalesce(list_sum(list_transform(gs[1:i], lambda x: length(x))), 0)
               + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS at
        FROM (
            SELECT ms, gs, unnest(range(1, len(ms) + 1)) AS i
            FROM (SELECT regexp_extract_all(text, '{pattern}') AS ms,
                         string_split_regex(text, '{pattern}') AS gs)
        )) AS x) AS s WHERE {holds})"""


_NUMBER = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_NUMBER}) + 1), lambda k:
    CASE WHEN k % 2 = 1 THEN CAST(reverse({_NUMBER})[k] AS INT)
         ELSE 2 * CAST(reverse({_NUMBER})[k] AS INT)
              - CASE WHEN CAST(reverse({_NUMBER})[k] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
_MOVED = "m[5:] || m[1:4]"
_MOD97 = f"""CAST(list_aggregate(list_transform(range(1, length({_MOVED}) + 1), lambda k:
    CAST(strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', ({_MOVED})[k]) - 1 AS VARCHAR)),
    'string_agg', '') AS HUGEINT) % 97 = 1"""
_PARTS = (
    "list_max(list_transform(string_split(m, '.'), "
    "lambda x: CAST(right('000' || ltrim(x, '0'), 4) AS INT))) <= 255 "
    "AND list_max(list_transform(string_split(m, '.'), lambda x: length(ltrim(x, '0')))) <= 3"
)

_PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", _PARTS),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", f"CASE WHEN length({_NUMBER}) BETWEEN 16 AND 19 THEN {_LUHN} ELSE false END"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_NUMBER}) BETWEEN 8 AND 15"),
    "iban": (r"[A-Z]{2}[0-9]{2}[A-Z0-9]+", f"CASE WHEN length(m) BETWEEN 15 AND 34 THEN {_MOD97} ELSE false END"),
    "ssn": (
        r"[0-9]+-[0-9]+-[0-9]+",
        "regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}') "
        "AND regexp_matches(lower(near), 'ssn|social|security')",
    ),
}

ORACLES["op3_pii"] = f"""
WITH found AS (
    SELECT doc_id, {", ".join(f"coalesce({_spans(k, *v)}, []) AS {k}" for k, v in _PII.items())}
    FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) AS read
)
SELECT doc_id, len(email) AS n_email, len(ip) AS n_ip, len(card) AS n_card, len(phone) AS n_phone,
       sha256(array_to_string(email || ip || card || phone, ',')) AS base_sha256,
       array_to_string(email || ip || card || phone || iban || ssn, ',') AS spans
FROM found
"""


def _parts(rank: int, kind: str, role: str, pattern: str, group: int, least: int) -> str:
    """Rows of doc_id, pos, upto, kind, rank, role: a kind's matches with a long enough group."""
    return f"""
    SELECT doc_id, pos, pos + length(m) AS upto, '{kind}' AS kind, {rank} AS rank, '{role}' AS role
    FROM (
        SELECT doc_id, ms[i] AS m, vs[i] AS v,
               coalesce(list_sum(list_transform(gs[1:i], lambda x: length(x))), 0)
               + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS pos
        FROM (
            SELECT doc_id, ms, vs, gs, unnest(range(1, len(ms) + 1)) AS i
            FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms,
                         regexp_extract_all(text, '{pattern}', {group}) AS vs,
                         string_split_regex(text, '{pattern}') AS gs FROM read)
        )
    ) WHERE length(v) >= {least}"""


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_AFTER = r"[\"'']?\x20*[:=]\x20*[\"'']?"
_SECRETS = " UNION ALL ".join(
    (
        _parts(0, "assign", "secret", f"(?:{_either_case('password|passwd|secret|token|api_?key')}){_AFTER}([A-Za-z0-9+/_.=-]+)", 1, 6),
        _parts(1, "access", "identifier", "AKIA[A-Z0-9]+", 0, 20),
        _parts(2, "hex", "secret", "[0-9a-f]{24,}", 0, 24),
        _parts(3, "name", "identifier", f"(?:{_either_case('username|user|login|client_id|account')}){_AFTER}([A-Za-z0-9_.@-]+)", 1, 3),
        _parts(4, "key", "secret", "[A-Za-z0-9+/]{40,}", 0, 40),
        _parts(5, "endpoint", "endpoint", "[a-z]{2,12}://[A-Za-z0-9_.:@/-]+", 0, 8),
    )
)

ORACLES["op10_secrets"] = f"""
WITH read AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({_SECRETS}),
sure AS (
    SELECT doc_id, count_if(kind = 'assign') AS n_assign,
           count_if(kind = 'access') AS n_access, count_if(kind = 'hex') AS n_hex,
           string_agg(kind || ':' || pos || ':' || upto, ',' ORDER BY pos, rank) AS told
    FROM parts WHERE rank < 3 GROUP BY doc_id
),
linked AS (
    SELECT * FROM parts AS w WHERE rank >= 3 AND EXISTS (
        SELECT 1 FROM parts AS o WHERE o.doc_id = w.doc_id AND o.role <> w.role
        AND (o.pos BETWEEN w.pos - 200 AND w.upto + 200 OR o.upto BETWEEN w.pos - 200 AND w.upto + 200))
),
all_spans AS (
    SELECT doc_id, string_agg(kind || ':' || pos || ':' || upto, ',' ORDER BY pos, rank) AS spans
    FROM (SELECT * FROM parts WHERE rank < 3 UNION ALL SELECT * FROM linked) GROUP BY doc_id
)
SELECT read.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(told, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM read LEFT JOIN sure USING (doc_id) LEFT JOIN all_spans USING (doc_id)
"""

_TOKENS = r"[^\x20\x09-\x0D]+"
ORACLES["op2_ngram_join"] = rf"""
WITH RECURSIVE read AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '{_TOKENS}') AS w FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
        END AS s FROM read
),
items AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM items AS a JOIN items AS b ON a.h = b.h AND a.doc_id <> b.doc_id
    WHERE b.n BETWEEN 0.85 * a.n AND a.n / 0.85
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reached AS (
    SELECT doc_id AS x, doc_id AS least FROM sets
    UNION
    SELECT l.y, r.least FROM reached AS r JOIN links AS l ON l.x = r.x
)
SELECT doc_id, len(s) AS n_shingles, (SELECT min(least) FROM reached WHERE x = doc_id) AS component_id
FROM sets
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op11_collocations"] = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), listed AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), runs AS (
    SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase
    FROM (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
          FROM listed, (SELECT unnest([1, 2, 3]) AS size) AS sizes)
), f AS (
    SELECT lang, size, phrase, CAST(count(*) AS HUGEINT) AS f FROM runs GROUP BY ALL
), n AS (
    SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND f >= 10
), cuts AS (
    SELECT c.lang, c.phrase, c.size, c.a, c.k, x.f AS l, y.f AS r,
           (1000000 * c.a * c.a) // (x.f * y.f) AS score
    FROM (SELECT *, array_to_string(ws[1:k], ' ') AS first_part, array_to_string(ws[k + 1:], ' ') AS rest
          FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)) AS c
    JOIN f AS x ON x.lang = c.lang AND x.phrase = c.first_part
    JOIN f AS y ON y.lang = c.lang AND y.phrase = c.rest
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, part, max(a) AS a
    FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part
          FROM candidates WHERE size = 3)
    GROUP BY ALL
)
SELECT lowest.lang,
       row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, lowest.a DESC, phrase) AS rank,
       phrase, CAST(lowest.a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM lowest JOIN n ON n.lang = lowest.lang
LEFT JOIN longer ON longer.lang = lowest.lang AND longer.part = lowest.phrase
WHERE longer.a IS NULL OR 100 * longer.a < 50 * lowest.a
QUALIFY rank <= 2000
"""


def _repair_sql() -> str:
    """Cheapest edits row by row from the last one up, for the four states of the order."""

    def cell(cost: str, audit: str, text: str) -> str:
        return f"{{'c': {cost}, 'a': {audit}, 't': {text}}}"

    def least(*ways: str) -> str:
        return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1]"

    def put(letter: str, state: str, cost: str, role: str, text: str) -> str:
        line = f"chr(10) || {role} || ':' || {text}"
        return cell(f"{state}.c + {cost}", f"'{letter}' || {state}.a", f"{line} || {state}.t")

    more = "CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END"

    def edited(state: str) -> str:
        new, role = ("va", "'assistant'") if state == "vu" else ("vu", "'user'")
        ways = [cell(f"{state}.c + 3", f"'D' || {state}.a", f"{state}.t")]
        for initial, after in (("s", "vs"), ("u", "vu"), ("a", "va")):
            if (state, initial) in {("v0", "s"), ("v0", "u"), ("vs", "u"), ("vu", "a"), ("va", "u")}:
                kept = put("K", after, more, "role", "text")
                ways.append(f"CASE WHEN may AND left(role, 1) = '{initial}' THEN {kept} END")
        ways.append(f"CASE WHEN may THEN {put('R', new, f'2 + {more}', role, 'text')} END")
        return least(*ways)

    def added(state: str, new: str, role: str) -> str:
        return least(state, put("I", new, "2", f"'{role}'", "''"))

    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations
), hits AS (
    SELECT *, xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length(name) + 1),
            lambda i: [CAST(ascii(name[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
                          ELSE c >> 1 END), 4294967295) % 20 AS hit
    FROM named
), damaged AS (
    SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
           CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy
    FROM hits WHERE hit <> 0
), placed AS (
    SELECT conv_id, turn, role, text, rtrim(text, {blanks}) AS solid,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
    FROM damaged
), told AS (
    SELECT conv_id, turn, role, text, place,
           CASE WHEN solid = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS pair
    FROM placed
), counts AS (
    SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM told GROUP BY conv_id
), derived AS (
    SELECT conv_id, n + 1 AS place, {cell("CAST(0 AS BIGINT)", "''", "''")} AS v0,
           {cell("CAST(4 AS BIGINT)", "'II'", "chr(10) || 'user:' || chr(10) || 'assistant:'")} AS vs,
           {cell("CAST(2 AS BIGINT)", "'I'", "chr(10) || 'assistant:'")} AS vu,
           {cell("CAST(0 AS BIGINT)", "''", "''")} AS va
    FROM counts
    UNION ALL
    SELECT conv_id, place, {added("b0", "vu", "user")} AS v0, {added("bs", "vu", "user")} AS vs, vu, va
    FROM (
        SELECT conv_id, place, b0, bs, {added("bu", "ba", "assistant")} AS vu, {added("ba", "bu", "user")} AS va
        FROM (
            SELECT told.conv_id, told.place, fault NOT IN ('blank', 'duplicate') AS may,
                   {edited("v0")} AS b0, {edited("vs")} AS bs, {edited("vu")} AS bu, {edited("va")} AS ba
            FROM derived JOIN told
              ON told.conv_id IS NOT DISTINCT FROM derived.conv_id AND told.place = derived.place - 1
        )
    )
), best AS (
    SELECT conv_id, v0.c AS cost, v0.a AS audit, v0.t[2:] AS repaired FROM derived WHERE place = 1
)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS every
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM every.conv_id
"""


ORACLES["op13_repair"] = _repair_sql()
