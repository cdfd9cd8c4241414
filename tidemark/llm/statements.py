"""DuckDB statements of the numbered queries that SQL can express on whole tables."""

from __future__ import annotations

from tidemark.llm import merkle
from tidemark.llm.decontamination import WINDOW

_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), {WINDOW}) AS n FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (SELECT doc_id, i, p.n, item FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM places) p JOIN windows v ON v.n = p.n AND v.words = p.words),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY 1),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

NEAR_VECTORS = """
WITH RECURSIVE good AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, c.component_id, vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY 1) c ON c.a = e.vec_id"""


#: The unsigned crc32 of the digits of doc_id: eight shifts (the -1 steps) after each byte is mixed in.
_CRC32 = """xor(list_reduce(list_transform(range(0, 9 * length(CAST(doc_id AS VARCHAR))), lambda k: CASE WHEN k % 9 = 0 THEN CAST(ord(substr(CAST(doc_id AS VARCHAR), k // 9 + 1, 1)) AS BIGINT) ELSE -1 END),
  lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END, CAST(4294967295 AS BIGINT)), 4294967295)"""


def _leaf(text: str) -> str:
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    return "sha256(" + " || ".join(field(text if c == "text" else c) for c in merkle.FIELDS) + ")"


def _tree(name: str, levels: int) -> tuple[str, str]:
    """Levels of a tree from ``{name}0`` (t, i, n, h); a tree with one node left stays as it is. And the name of the last."""
    k = merkle.FANOUT
    ctes = "".join(
        f"""
{name}r{x} AS (SELECT t, i // {k} AS i, (n + {k - 1}) // {k} AS n, CASE WHEN n > 1 THEN string_agg(h, '' ORDER BY i) ELSE '' END AS run, min(h) AS one FROM {name}{x} GROUP BY t, i // {k}, n),
{name}{x + 1} AS (SELECT t, i, n, CASE WHEN run = '' THEN one ELSE sha256(run) END AS h FROM {name}r{x}),"""
        for x in range(levels)
    )
    return ctes, f"{name}{levels}"


def _fold(name: str, levels: int, start: str) -> tuple[str, str]:
    """From ``start`` (row, t, p, i, h, proof; p is the place), a join for every level."""
    k, last, ctes = merkle.FANOUT, start, ""
    for x in range(levels):
        s = f"64 * (p % {k})"
        ctes += f"""
{name}f{x} AS (SELECT row, s.t, p // {k} AS p, CASE WHEN run = '' THEN h ELSE sha256(substr(run, 1, {s}) || h || substr(run, {s} + 65)) END AS h, proof || substr(run, 1, {s}) || substr(run, {s} + 65) AS proof
  FROM {last} s JOIN {name}r{x} r ON r.t = s.t AND r.i = s.p // {k}),"""
        last = f"{name}f{x}"
    return ctes, last


def merkle_statement(levels: int = 6, top_levels: int = 4) -> str:
    """Enough levels for 16 million rows of a source and 65,536 sources."""
    tree, subroots = _tree("a", levels)
    fold, folded = _fold("a", levels, "begun")
    top, root = _tree("b", top_levels)
    top_fold, proved = _fold("b", top_levels, "half")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH d AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '+' || source END AS t, {_leaf("text")} AS leaf, CASE WHEN {_CRC32} % 5 = 0 THEN {_leaf(lower)} ELSE {_leaf("text")} END AS shown FROM documents),
placed AS (SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY t) AS n FROM d),
a0 AS (SELECT t, i, n, leaf AS h FROM placed),{tree}
begun AS (SELECT row, t, i AS p, shown AS h, '' AS proof FROM placed),{fold}
b0 AS (SELECT '' AS t, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n, t AS name, h FROM {subroots}),{top}
half AS (SELECT row, '' AS t, i AS p, f.h, proof FROM {folded} f JOIN b0 ON name = f.t),{top_fold}
ends AS (SELECT h AS root FROM {root})
SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM placed JOIN {proved} f USING (row) JOIN {subroots} s ON s.t = placed.t CROSS JOIN ends"""


MERKLE = merkle_statement()
