"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from fraudmart.llm.line_dedup import MIN_SITES
from fraudmart.llm.url_filter import LINK, RULES

UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def url_filters(damping: float = 0.85, rounds: int = 12, prior: float = 0.05, threshold: float = 0.5) -> str:
    """Rules by a ranked join; propagation as one pair of CTEs a round."""
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
    link = LINK.replace("'", "''")
    ctes = [
        f"rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules})",
        "rests AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages)",
        f"""parsed AS (SELECT page_id, html, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), {UPPER_LOWER}), '') AS host,
            coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rests)""",
        """fits AS (SELECT page_id, rule_host || rule_path AS rule, rule_verdict,
            row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC, length(rule_path) DESC) AS place
            FROM parsed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))""",
        "ruled AS (SELECT p.*, f.rule, f.rule_verdict FROM parsed p LEFT JOIN fits f ON f.page_id = p.page_id AND f.place = 1)",
        f"hrefs AS (SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS href FROM parsed)",
        f"""ends AS (SELECT src, translate(regexp_extract(href, '(?i)^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)', 1), {UPPER_LOWER}) AS dst FROM hrefs)""",
        "edges AS (SELECT DISTINCT src, dst FROM ends WHERE src <> '' AND dst <> '' AND src <> dst)",
        """weighted AS (SELECT src, dst, count(*) OVER (PARTITION BY src) AS out_n, count(*) OVER (PARTITION BY dst) AS in_n FROM edges)""",
        """judged AS (SELECT host, avg(CASE WHEN rule_verdict = 'allow' THEN 1.0 ELSE 0.0 END) AS ts,
            avg(CASE WHEN rule_verdict = 'block' THEN 1.0 ELSE 0.0 END) AS ds FROM ruled WHERE host <> '' GROUP BY host)""",
        """seeds AS (SELECT host, coalesce(ts, 0) AS ts, coalesce(ds, 0) AS ds
            FROM (SELECT host FROM judged UNION SELECT src FROM edges UNION SELECT dst FROM edges) LEFT JOIN judged USING (host))""",
        f"r0 AS (SELECT host, {1 - damping} * ts AS trust, {1 - damping} * ds AS distrust FROM seeds)",
    ]
    for k in range(rounds):
        ctes += [
            f"""m{k} AS (SELECT host, sum(t) AS t, sum(d) AS d FROM (
                SELECT dst AS host, trust / out_n AS t, 0.0 AS d FROM weighted JOIN r{k} ON host = src
                UNION ALL SELECT src, 0.0, distrust / in_n FROM weighted JOIN r{k} ON host = dst) GROUP BY host)""",
            f"""r{k + 1} AS MATERIALIZED (SELECT host, {1 - damping} * ts + {damping} * coalesce(t, 0) AS trust,
                {1 - damping} * ds + {damping} * coalesce(d, 0) AS distrust FROM seeds LEFT JOIN m{k} USING (host))""",
        ]
    return (
        "WITH " + ",\n".join(ctes) + f"""
        SELECT page_id, ruled.host, path, rule, coalesce(rule_verdict,
            CASE WHEN coalesce(distrust / (trust + distrust + {prior}), 0) >= {threshold} THEN 'block' ELSE 'allow' END) AS verdict
        FROM ruled LEFT JOIN r{rounds} ON r{rounds}.host = ruled.host"""
    )


def decontamination(window: int = 10) -> str:
    """Windows of documents joined with windows of items, for each length that items have."""
    words = f"regexp_extract_all(translate(text, {UPPER_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    windows = "unnest(range(1, greatest(len(w) - {n} + 1, 1) + 1)) AS spot"
    return f"""
        WITH items AS (SELECT item_id, {words} AS w FROM benchmark),
        item_at AS (SELECT item_id, w, {windows.format(n=window)} FROM items WHERE len(w) > 0),
        item_windows AS (SELECT DISTINCT item_id, len(w[spot:spot + {window - 1}]) AS n, array_to_string(w[spot:spot + {window - 1}], ' ') AS part FROM item_at),
        docs AS (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
        lengths AS (SELECT DISTINCT n FROM item_windows),
        doc_at AS (SELECT doc_id, w, n, {windows.format(n="n")} FROM docs, lengths WHERE len(w) >= n),
        hits AS (SELECT doc_id, spot, i.n, item_id FROM doc_at d JOIN item_windows i ON i.n = d.n AND i.part = array_to_string(w[spot:spot + d.n - 1], ' ')),
        hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(spot, spot + n)) AS p FROM hits) GROUP BY doc_id),
        hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


def line_dedup(min_sites: int = MIN_SITES) -> str:
    """Exact distinct counts of sites for every line."""
    return f"""
        WITH split AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS w FROM documents),
        lines AS (SELECT doc_id, source, unnest(w) AS line, generate_subscripts(w, 1) AS spot FROM split),
        trimmed AS (SELECT doc_id, source, spot, line, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM lines),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY bare ORDER BY doc_id, spot) AS place FROM trimmed),
        spread AS (SELECT bare, count(DISTINCT source) AS sites FROM trimmed WHERE bare <> '' GROUP BY bare),
        judged AS (SELECT r.*, coalesce(sites >= {min_sites} AND place > 1, false) AS gone FROM ranked r LEFT JOIN spread USING (bare)),
        docs AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
            string_agg(line, chr(10) ORDER BY spot) FILTER (NOT gone) AS cleaned FROM judged GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
            CASE WHEN text IS NOT NULL THEN sha256(coalesce(cleaned, '')) END AS kept_sha256
        FROM documents d LEFT JOIN docs USING (doc_id)"""


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf(change: dict[str, str] | None = None) -> str:
    texts = [f"CAST({(change or {}).get(c, c)} AS VARCHAR)" for c in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


def merkle_manifest() -> str:
    """Both trees level by level, then every leaf's way up."""
    polynomial = 0xEDB88320
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
        lambda h, b: list_reduce(list_prepend(xor(h, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, {polynomial} * (x & 1)))))"""
    step = """sha256(CASE WHEN s.h IS NULL THEN p.held WHEN p.i % 2 = 1 THEN s.h || p.held ELSE p.held || s.h END)"""
    return f"""WITH RECURSIVE hashed AS (
        SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf()} AS leaf,
            CASE WHEN {crc} % 7 = 0 THEN {_leaf({"n_chars": "n_chars + 1"})} END AS claim FROM documents),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY tree) AS total FROM hashed),
    tree AS (
        SELECT tree, 0 AS level, place AS i, total AS n, leaf AS h FROM leaves
        UNION ALL
        SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY tree, level, i // 2, n),
    subroots AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
    above AS (
        SELECT 0 AS level, i, n, h FROM subroots
        UNION ALL
        SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM above WHERE n > 1 GROUP BY level, i // 2, n),
    ways AS (
        SELECT tree, place, 0 AS level, place AS i, total AS n, coalesce(claim, leaf) AS held, '' AS proof FROM leaves
        UNION ALL
        SELECT p.tree, p.place, p.level + 1, p.i // 2, (p.n + 1) // 2, {step}, p.proof || coalesce(s.h, '')
        FROM ways p LEFT JOIN tree s ON s.tree = p.tree AND s.level = p.level AND s.i = xor(p.i, 1) WHERE p.n > 1),
    last AS (
        SELECT w.tree, w.place, 0 AS level, r.i, r.n, w.held, w.proof FROM ways w JOIN subroots r ON r.tree = w.tree WHERE w.n = 1
        UNION ALL
        SELECT p.tree, p.place, p.level + 1, p.i // 2, (p.n + 1) // 2, {step}, p.proof || coalesce(s.h, '')
        FROM last p LEFT JOIN above s ON s.level = p.level AND s.i = xor(p.i, 1) WHERE p.n > 1),
    roots AS (SELECT h AS root FROM above WHERE n = 1)
    SELECT l.doc_id, l.leaf, r.h AS subroot, root, sha256(w.proof) AS proof_sha256, w.held AS folded_root, w.held = root AS verified
    FROM leaves l JOIN last w ON w.tree = l.tree AND w.place = l.place AND w.n = 1 JOIN subroots r ON r.tree = l.tree, roots"""


def hard_negatives(every: int = 50, positives: int = 5, negatives: int = 3) -> str:
    """Every anchor against every row."""
    return f"""WITH rows_ AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
        FROM rows_ a JOIN rows_ r ON a.vec_id % {every} = 0 AND a.vec_id <> r.vec_id),
    near AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives})
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM near JOIN pairs USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= {negatives}"""


ORACLES: dict[str, str] = {
    "op2_line_dedup": line_dedup(),
    "op5_decontamination": decontamination(),
    "op10_url_filters": url_filters(),
    "op11_merkle_manifest": merkle_manifest(),
    "op12_hard_negatives": hard_negatives(),
}
