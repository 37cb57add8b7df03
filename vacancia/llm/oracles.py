"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

import string

from vacancia.llm.chat import CONTROLS, Template

#: Every gram of two to five words counted where it stands; the cut, the drop and the ranking by definition.
COLLOCATIONS = f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(p, '[ \\t]+'), lambda w: w <> '') AS ws
        FROM (SELECT lang, unnest(string_split_regex(
                  translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                  '[.,;:!?\\n-\\r]')) AS p FROM documents)),
    places AS (
        SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS g
        FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces), (SELECT unnest(range(1, 6)) AS m)
        WHERE i + m - 1 <= len(ws)),
    f AS (SELECT lang, m, g, count(*) AS a FROM places GROUP BY ALL),
    totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
    candidates AS (SELECT * FROM f WHERE m > 1 AND a >= 100),
    own AS (
        SELECT c.* FROM candidates c WHERE NOT EXISTS (
            SELECT 1 FROM candidates o WHERE o.lang = c.lang AND o.m > c.m AND o.a >= c.a
              AND contains(' ' || o.g || ' ', ' ' || c.g || ' '))),
    cuts AS (
        SELECT lang, g, a, k, array_to_string(string_split(g, ' ')[:k], ' ') AS gl,
               array_to_string(string_split(g, ' ')[k + 1:], ' ') AS gr
        FROM own, (SELECT unnest(range(1, 5)) AS k) WHERE k < m),
    scored AS (
        SELECT c.lang, c.g, c.a, c.k, l.a AS l, r.a AS r, n,
               ((1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a))::BIGINT AS score
        FROM cuts c JOIN f l ON l.lang = c.lang AND l.g = gl JOIN f r ON r.lang = c.lang AND r.g = gr
             JOIN totals t ON t.lang = c.lang),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM best)
    SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join([*map(_field, ("doc_id", "source", "lang", "n_chars")), _field(text)]) + ")"


def _tree(name: str, bottom: str, depth: int) -> str:
    """CTEs ``name0 ... name{depth}``: (tree, place, digest, width), and ``name`` with a level; single nodes stop."""
    levels = [f"{name}0 AS ({bottom})"]
    for i in range(depth):
        levels.append(f"""{name}{i + 1} AS (
        SELECT tree, place // 8 AS place, sha256(string_agg(digest, '' ORDER BY place)) AS digest,
               (any_value(width) + 7) // 8 AS width
        FROM {name}{i} WHERE width > 1 GROUP BY tree, place // 8)""")
    every = " UNION ALL ".join(f"SELECT {i} AS level, * FROM {name}{i}" for i in range(depth + 1))
    return ",\n    ".join([*levels, f"{name} AS ({every})"])


def _climb(start: str, nodes: str, depth: int, name: str) -> str:
    """CTEs that carry (id, tree, place, folded, proof) up through ``depth`` levels of ``nodes``."""
    steps = [f"{name}0 AS ({start})"]
    for i in range(depth):
        steps.append(f"""{name}{i + 1} AS (
        SELECT s.id, s.tree, s.place // 8 AS place,
               CASE WHEN any_value(n.width) > 1 THEN sha256(string_agg(
                   CASE WHEN n.place = s.place THEN folded ELSE n.digest END, '' ORDER BY n.place))
                    ELSE any_value(folded) END AS folded,
               any_value(proof) || coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place <> s.place), '') AS proof
        FROM {name}{i} s LEFT JOIN {nodes} n ON n.level = {i} AND n.tree = s.tree AND n.place // 8 = s.place // 8
        GROUP BY s.id, s.tree, s.place)""")
    return ",\n    ".join(steps)


#: Levels below which trees of the query's languages end: 8 ** 7 leaves, 8 ** 2 languages.
_LEAF_LEVELS, _TOP_LEVELS = 7, 2

#: CRC-32 by its table, bytes from the front.
_CRC = """list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(doc_id::VARCHAR) + 1),
                lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
            lambda h, b: xor(h >> 8, crc[xor(h & 255, b) + 1]))"""
_CRC_ENTRY = "list_reduce(list_prepend(x, range(8)), lambda h, i: CASE WHEN h & 1 = 1 THEN xor(h >> 1, 3988292384) ELSE h >> 1 END)"

MANIFEST = f"""
    WITH crc_table AS (SELECT list({_CRC_ENTRY} ORDER BY x) AS crc FROM (SELECT unnest(range(256)) AS x)),
    leaves AS (
        SELECT row_number() OVER () AS id, *, CASE WHEN xor({_CRC}, 4294967295) % 3 = 0 THEN changed END AS tampered
        FROM (SELECT doc_id, lang, {_leaf('text')} AS leaf,
                     {_leaf(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} AS changed
              FROM documents), crc_table),
    langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM leaves)),
    numbered AS (
        SELECT l.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
               count(*) OVER (PARTITION BY tree) AS width
        FROM leaves l JOIN langs g ON l.lang IS NOT DISTINCT FROM g.lang),
    {_tree("n", "SELECT tree, place, leaf AS digest, width FROM numbered", _LEAF_LEVELS)},
    subroots AS (SELECT tree, digest FROM n WHERE width = 1),
    {_tree("t", "SELECT 0 AS tree, tree AS place, digest, (SELECT count(*) FROM subroots) AS width FROM subroots", _TOP_LEVELS)},
    {_climb("SELECT id, tree, place, coalesce(tampered, leaf) AS folded, '' AS proof FROM numbered", "n", _LEAF_LEVELS, "c")},
    {_climb(f"SELECT id, 0 AS tree, tree AS place, folded, proof FROM c{_LEAF_LEVELS}", "t", _TOP_LEVELS, "d")},
    top AS (SELECT digest AS root FROM t WHERE width = 1)
    SELECT doc_id, leaf, s.digest AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM numbered JOIN d{_TOP_LEVELS} d USING (id) JOIN subroots s ON s.tree = numbered.tree, top"""

_MARKS = len(Template().opening) + len("\n") + len(Template().closing)
_ESCAPED = "|".join(
    rf"{f}\\*(?:{'|'.join(c[1:].replace('|', chr(92) + '|').replace(']', chr(92) + ']') for c in CONTROLS if c[0] == f.strip(chr(92)))})"
    for f in ("<", r"\["))

#: Lengths of escaped texts and roles: each control string, each special character is one longer.
CHAT = rf"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
    said AS (
        SELECT conv_id, count(*) AS n_turns,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS spoken,
               coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
               sum({_MARKS} + length(text) + len(regexp_extract_all(text, '{_ESCAPED}'))
                   + length(role) + len(regexp_extract_all(role, '[\\\n<\[]'))) AS formatted_chars
        FROM turns GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(spoken) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
           formatted_chars::BIGINT AS formatted_chars FROM said"""
