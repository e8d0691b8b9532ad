"""The same results in SQL, for the operators that SQL can express."""

from __future__ import annotations

from quotewire.llm.url_filter import ALLOW, BLOCK, RULES, SOFT, SOFT_LIMIT, STRICT

_SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Integer inner products are exact in any engine, so SQL can check the search.
TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def lexical_search() -> str:
    terms = (
        f"unnest(regexp_extract_all({_SMALL.format('text')}, "
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
    )
    return f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
found AS (SELECT r, {terms} FROM rows),
tf AS (SELECT r, term, count(*) AS tf FROM found GROUP BY ALL),
lengths AS (SELECT r, count(*) AS n FROM found GROUP BY r),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, total GROUP BY term, n_docs
),
shares AS (SELECT r, 100 - 75 + (75 * n * n_docs) // n_terms AS m FROM lengths, total),
asked AS (SELECT item_id, term, count(*) AS n FROM (
    SELECT item_id, {terms} FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
scored AS (
    SELECT item_id, doc_id,
           CAST(sum(asked.n * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN shares USING (r) JOIN rows USING (r)
    GROUP BY item_id, r, doc_id
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def url_filter() -> str:
    """Every rule and every term is tried on every url."""
    rules = ", ".join(f"('{r}', '{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for r, v in RULES)
    terms = ", ".join(f"('{t}', {t in STRICT})" for t in [*STRICT, *SOFT])
    part = lambda i: f"regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', {i}, 's')"
    edge = r"[^0-9a-z\x{80}-\x{10FFFF}]"
    return f"""
WITH rules(rule, says, rule_host, rule_path) AS (VALUES {rules}),
terms(term, is_strict) AS (VALUES {terms}),
urls AS (SELECT row_number() OVER () AS r, page_id, {_SMALL.format('url')} AS url,
                {_SMALL.format(part(1))} AS host, {part(2)} AS path FROM pages),
fits AS (
    SELECT r, max_by(rule, strlen(rule)) AS rule, max_by(says, strlen(rule)) AS says
    FROM urls JOIN rules ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
    GROUP BY r
),
hits AS (
    SELECT r, count(*) FILTER (is_strict) AS n_strict, count(*) FILTER (NOT is_strict) AS n_soft
    FROM urls JOIN terms ON regexp_matches(url, '(^|{edge})' || term || '({edge}|$)', 's') GROUP BY r
)
SELECT page_id, host, path, rule, CAST(coalesce(n_strict, 0) AS INTEGER) AS n_strict,
       CAST(coalesce(n_soft, 0) AS INTEGER) AS n_soft,
       coalesce(says, CASE WHEN n_strict > 0 OR n_soft >= {SOFT_LIMIT} THEN '{BLOCK}' ELSE '{ALLOW}' END) AS verdict
FROM urls LEFT JOIN fits USING (r) LEFT JOIN hits USING (r)
"""


def _tree(name: str, leaves: str, depth: int) -> str:
    """Common tables of a tree over ``leaves`` (grp, rank, n, h) of up to 16 ** depth leaves.

    ``{name}_p{k}`` holds the nodes of level k with the hashes before and after them in
    their run of 16, ``{name}_n{k}`` the nodes of level k; the last of these are the roots.
    """
    out = [f"{name}_n0 AS (SELECT grp, rank, n, h FROM {leaves})"]
    for k in range(depth):
        run = "OVER (PARTITION BY grp, rank // 16 ORDER BY rank ROWS BETWEEN {})"
        left = run.format("UNBOUNDED PRECEDING AND 1 PRECEDING")
        right = run.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
        out.append(
            f"{name}_p{k} AS (SELECT grp, rank, n, coalesce(string_agg(h, '') {left}, '') AS l, "
            f"coalesce(string_agg(h, '') {right}, '') AS r FROM {name}_n{k})"
        )
        out.append(
            f"{name}_n{k + 1} AS (SELECT grp, rank // 16 AS rank, n, CASE WHEN n <= {16**k} THEN min(h) "
            f"ELSE sha256(string_agg(h, '' ORDER BY rank)) END AS h FROM {name}_n{k} GROUP BY grp, rank // 16, n)"
        )
    return ",\n".join(out)


def _climb(name: str, start: str, depth: int, grp: str, rank: str) -> tuple[str, str]:
    """Common tables that follow each row of ``start`` (siblings, acc) up the tree; and the last."""
    out = []
    for k in range(depth):
        more = f"p.n > {16**k}"
        out.append(
            f"{name}_c{k} AS (SELECT s.* REPLACE (CASE WHEN {more} THEN siblings || p.l || p.r ELSE siblings END "
            f"AS siblings, CASE WHEN {more} THEN sha256(p.l || acc || p.r) ELSE acc END AS acc) "
            f"FROM {start} s JOIN {name}_p{k} p ON p.grp IS NOT DISTINCT FROM s.{grp} AND p.rank = s.{rank} // {16**k})"
        )
        start = f"{name}_c{k}"
    return ",\n".join(out), start


def merkle_manifest(source_depth: int = 5, depth: int = 3) -> str:
    """Holds for up to 16 ** source_depth rows of a source and 16 ** depth sources."""
    value = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(
        value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    inside, within = _climb("d", "known", source_depth, "source", "rank")
    over, last = _climb("s", "placed", depth, "one", "place")
    return f"""
WITH crc AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
    FROM range(256) x(i)
),
hashed AS (
    SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(_SMALL.format('text'))} AS lowered,
           xor(list_reduce(list_prepend(4294967295, list_transform(
               string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
               lambda a, b: xor(t[xor(a, b) % 256 + 1], a >> 8)), 4294967295) % 5 = 0 AS tampered
    FROM documents, crc
),
known AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
           '' AS siblings, CASE WHEN tampered THEN lowered ELSE leaf END AS acc
    FROM hashed
),
leaves AS (SELECT source AS grp, rank, count(*) OVER (PARTITION BY source) AS n, leaf AS h FROM known),
{_tree("d", "leaves", source_depth)},
{inside},
sources AS (
    SELECT 1 AS grp, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS rank, count(*) OVER () AS n, h, grp AS source
    FROM d_n{source_depth}
),
{_tree("s", "sources", depth)},
placed AS (
    SELECT c.*, 1 AS one, s.rank AS place, s.h AS subroot
    FROM {within} c JOIN sources s ON s.source IS NOT DISTINCT FROM c.source
),
{over}
SELECT doc_id, leaf, subroot, n.h AS root, sha256(siblings) AS proof_sha256, acc AS folded_root,
       acc = n.h AS verified
FROM {last}, s_n{depth} n
"""
