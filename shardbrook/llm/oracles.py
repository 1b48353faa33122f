"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from shardbrook.llm.licenses import DRIFT, GRAM, LEAST_SCORE, PHRASES, SEPARATOR, TEMPLATES

TOP_PRODUCTS = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _words(text: str) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    lowered = f"translate(coalesce({text}, ''), '{upper}', '{lower}')"
    parts = f"regexp_split_to_array({lowered}, {_text(SEPARATOR)})"
    return f"list_filter({parts}, lambda w: w <> '')"


def _starts(size: int, wanted: str = "") -> str:
    """Where windows of ``size`` words start, or only those with a wording."""
    every = f"range(0, greatest(len(w) - {size - 1}, 0))"
    if not wanted:
        return every
    return f"list_filter({every}, lambda i: array_to_string(w[i + 1 : i + {size}], ' ') = {_text(wanted)})"


def _grams(source: str, keep: str) -> str:
    return (
        f"SELECT {keep}, unnest({_starts(GRAM)}) AS place, unnest(list_transform({_starts(GRAM)}, "
        f"lambda i: array_to_string(w[i + 1 : i + {GRAM}], ' '))) AS gram FROM {source}"
    )


_PHRASE_STARTS = ", ".join(
    f"{_starts(len(phrase.split()), phrase)} AS p{i}" for i, (phrase, _) in enumerate(PHRASES)
)
_ALL_STARTS = " || ".join(f"p{i}" for i in range(len(PHRASES)))
_BASE_LABELS = ", ".join(
    f"CASE WHEN len(p{i}) > 0 THEN {_text(label)} END" for i, (_, label) in enumerate(PHRASES)
)
_TEMPLATE_ROWS = ", ".join(
    f"({i}, {_text(label)}, {_text(text)})" for i, (label, text) in enumerate(TEMPLATES)
)

# The most places that ascend: the least last place of a row of 1, 2, 3, ... of them.
_IN_ORDER = (
    "len(list_reduce(list_prepend(CAST([] AS BIGINT[]), list([place] ORDER BY here, place DESC)), "
    "lambda ends, p: list_filter(ends, lambda e: e < p[1]) || p || list_filter(ends, lambda e: e >= p[1])[2:]))"
)

LICENSES = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_words("text")} AS w FROM documents),
based AS (
    SELECT rid, doc_id, len(w) AS n_words, p, list_filter([{_BASE_LABELS}], lambda l: l IS NOT NULL) AS base
    FROM (SELECT *, {_ALL_STARTS} AS p FROM (SELECT *, {_PHRASE_STARTS} FROM docs))
), templates AS (
    SELECT t AS template, label, {_words("body")} AS w FROM (VALUES {_TEMPLATE_ROWS}) v(t, label, body)
), places AS (
    {_grams("templates", f"template, label, len(w) - {GRAM - 1} AS grams")}
), found AS (
    {_grams("docs", "rid")}
), votes AS (
    SELECT rid, template, label, grams, found.place AS here, places.place AS place,
           found.place - places.place AS diagonal
    FROM found JOIN places USING (gram)
), marked AS (
    SELECT *, coalesce(diagonal - lag(diagonal) OVER along > {DRIFT}, true) AS opens FROM votes
    WINDOW along AS (PARTITION BY rid, template ORDER BY diagonal)
), numbered AS (
    SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY rid, template ORDER BY diagonal) AS span
    FROM marked
), spans AS (
    SELECT rid, label, {_IN_ORDER} / any_value(grams) AS share
    FROM numbered GROUP BY rid, template, label, span
), told AS (
    SELECT rid, max(share) AS share,
           coalesce(list(label) FILTER (WHERE share >= {LEAST_SCORE}), []) AS more
    FROM spans GROUP BY rid
)
SELECT doc_id, n_words, CAST(len(p) AS BIGINT) AS n_base, list_min(p) AS first_word, list_max(p) AS last_word,
       array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ',') AS labels,
       CAST(CASE WHEN len(p) > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS DOUBLE) AS score
FROM based LEFT JOIN told USING (rid)
"""


def _assigned(turn: int) -> str:
    """Nearest centroid of every vector, then the centroids that follow."""
    return f"""
a{turn} AS (
    SELECT rid, min({{'d': CAST(list_sum(list_transform(list_zip(u.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
                           AS BIGINT), 'c': c.c}}) AS best
    FROM usable u CROSS JOIN c{turn} c GROUP BY rid
)"""


def _moved(turn: int) -> str:
    return f"""
m{turn} AS (
    SELECT c, list(mean ORDER BY place) AS v FROM (
        SELECT a.best.c AS c, place, CAST(floor(sum(u.v[place]) / count(*)) AS BIGINT) AS mean
        FROM a{turn} a JOIN usable u USING (rid) CROSS JOIN range(1, 65) t(place) GROUP BY 1, 2)
    GROUP BY c
), c{turn + 1} AS (SELECT c, coalesce(m.v, old.v) AS v FROM c{turn} old LEFT JOIN m{turn} m USING (c))"""


CENTROIDS = f"""
WITH usable AS (
    SELECT row_number() OVER () AS rid, vec_id,
           list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS c, v
    FROM usable QUALIFY c < 16
), {", ".join(_assigned(turn) + "," + _moved(turn) for turn in range(3))}, {_assigned(3)}
SELECT vec_id, CAST(a.best.c AS INTEGER) AS cluster, a.best.d AS distance,
       CAST(sum(a.best.d) OVER (PARTITION BY a.best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a3 a JOIN usable USING (rid) JOIN c3 c ON c.c = a.best.c
"""


def _value(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_value, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _tree(name: str, group: str, nodes: str) -> str:
    """All levels of the trees over ``nodes`` (group, pos, h, n): n nodes on a level."""
    return f"""
{name} AS (
    SELECT {group}, 0 AS lvl, pos, h, n FROM {nodes}
    UNION ALL
    SELECT {group}, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
    FROM {name} WHERE n > 1 GROUP BY {group}, lvl, pos // 2, n
)"""


# CRC-32 of a decimal number, by its bytes and their bits.
_CRC_TURN = (
    "list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]), "
    "lambda x, bit: xor(x >> 1, (x & 1) * 3988292384))"
)
_CRC = (
    "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
    f"lambda c: CAST(ascii(c) AS BIGINT))), lambda crc, byte: {_CRC_TURN}), 4294967295)"
)


def _beside(tree: str, group: str, low: str, height: int) -> str:
    """Digests beside the way up from the nodes of ``low`` (id, group, pos)."""
    return f"""
    SELECT x.id, {height} + t.lvl AS step, t.pos & 1 AS odd, coalesce(s.h, '') AS h
    FROM {low} x JOIN {tree} t ON t.{group} = x.{group} AND t.pos = x.pos >> t.lvl AND t.n > 1
    LEFT JOIN {tree} s ON s.{group} = t.{group} AND s.lvl = t.lvl AND s.pos = xor(t.pos, 1)"""


MANIFEST = f"""
WITH RECURSIVE leaves AS (
    SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS grp, {_leaf("n_chars")} AS h,
           CASE WHEN doc_id IS NOT NULL AND {_CRC} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS found
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h, id) - 1 AS pos,
           count(*) OVER (PARTITION BY grp) AS n FROM leaves
), {_tree("tree", "grp", "placed")}, subroots AS (
    SELECT 0 AS one, grp, h, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), {_tree("upper", "one", "subroots")}, tops AS (
    SELECT placed.id, one, subroots.pos FROM placed JOIN subroots USING (grp)
), paths AS (
    SELECT id, list({{'odd': odd, 'h': h}} ORDER BY step) AS path
    FROM ({_beside("tree", "grp", "placed", 0)} UNION ALL {_beside("upper", "one", "tops", 1000)})
    GROUP BY id
), found AS (
    SELECT doc_id, placed.h AS leaf, subroots.h AS subroot, (SELECT h FROM upper WHERE n = 1) AS root,
           sha256(array_to_string(list_transform(coalesce(path, []), lambda s: s.h), '')) AS proof_sha256,
           list_reduce(list_prepend({{'odd': 0, 'h': found}}, coalesce(path, [])), lambda low, s: {{'odd': 0,
               'h': sha256(CASE WHEN s.odd = 1 THEN s.h || low.h ELSE low.h || s.h END)}}).h AS folded_root
    FROM placed JOIN subroots USING (grp) LEFT JOIN paths USING (id)
)
SELECT *, folded_root = root AS verified FROM found
"""

LLM_ORACLES: dict[str, str] = {
    "op2_license_scan": LICENSES,
    "op8_top_products": TOP_PRODUCTS,
    "op12_centroids": CENTROIDS,
    "op13_merkle_manifest": MANIFEST,
}
