"""What the queries of this subpackage return, as DuckDB SQL."""

from clipcurate.llm.url_templates import RULES, Settings

#: The pages given have one article element each, with headings, paragraphs, bold text and line breaks in it.
HTML_SQL = r"""
WITH article AS (
    SELECT page_id, url, coalesce(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '') AS part FROM pages
), bare AS (
    SELECT page_id, url, regexp_replace(regexp_replace(part, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS part FROM article
), decoded AS (
    SELECT page_id, url,
        regexp_replace(regexp_replace(part, '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS part
    FROM bare
), spaced AS (
    SELECT page_id, url, trim(regexp_replace(part, '\s+', ' ', 'g')) AS text FROM decoded
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM spaced
"""

MATCH_SQL = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM documents
), item AS (
    SELECT item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS key
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM item WHERE len(w) > 0)
), size AS (
    SELECT DISTINCT size FROM win
), place AS (
    SELECT r, size, p, array_to_string(w[p : p + size - 1], ' ') AS key
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM doc, size WHERE len(w) >= size)
), hit AS (
    SELECT DISTINCT r, p, place.size, item_id FROM place JOIN win ON place.size = win.size AND place.key = win.key
), word AS (
    SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + size)) AS q FROM hit) GROUP BY r
), items AS (
    SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(word.n, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
    coalesce(word.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN items USING (r)
"""

DIVERGENCE_SQL = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[a-z\x{80}-\x{10FFFF}]+') AS w
    FROM documents
), word AS (
    SELECT r, lang, source, unnest(w) AS term FROM doc
), kept AS (
    SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), seen AS (
    SELECT lang, source, term, count(*) AS n FROM word JOIN kept USING (lang, term) GROUP BY ALL
), grp AS (
    SELECT DISTINCT lang, source FROM doc
), size AS (
    SELECT lang, count(*) AS v FROM kept GROUP BY lang
), cell AS (
    SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n
    FROM grp g JOIN kept k USING (lang) LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
), grp_total AS (
    SELECT lang, source, sum(n) AS total FROM cell GROUP BY ALL
), grp_p AS (
    SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // CAST(total + v AS HUGEINT) AS p
    FROM cell JOIN grp_total USING (lang, source) JOIN size USING (lang)
), lang_n AS (
    SELECT lang, term, sum(n) AS n FROM seen GROUP BY ALL
), lang_total AS (
    SELECT lang, sum(n) AS total FROM lang_n GROUP BY lang
), lang_q AS (
    SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // CAST(total + v AS HUGEINT) AS q
    FROM lang_n JOIN lang_total USING (lang) JOIN size USING (lang)
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM grp_p a JOIN grp_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), term AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
    FROM grp_p JOIN lang_q USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def _cluster_sql(centroids: int = 40, rounds: int = 5) -> str:
    nearest = """
near{k} AS (
    SELECT r, cluster, distance FROM (
        SELECT r, c.n AS cluster, CAST(v.xx - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x) AS BIGINT) AS distance
        FROM vec v, cen{k} c
    ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1
)"""
    mean = """, sum{k} AS (
    SELECT cluster, i, sum(x) AS s, count(*) AS m
    FROM (SELECT cluster, unnest(range(1, 65)) AS i, unnest(list_transform(v.x, lambda e: CAST(e AS BIGINT))) AS x
          FROM near{k} JOIN vec v USING (r))
    GROUP BY cluster, i
), mean{k} AS (
    SELECT cluster, list(CAST((s - ((s % m) + m) % m) // m AS DOUBLE) ORDER BY i) AS x FROM sum{k} GROUP BY cluster
), cen{next} AS (
    SELECT c.n, coalesce(m.x, c.x) AS x FROM cen{k} c LEFT JOIN mean{k} m ON m.cluster = c.n
),"""
    steps = "".join(nearest.format(k=k) + mean.format(k=k, next=k + 1) for k in range(rounds)) + nearest.format(k=rounds)
    return f"""
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), vec AS (
    SELECT r, vec_id, x, list_inner_product(x, x) AS xx FROM kept
), cen0 AS (
    SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST) - 1 AS n, x FROM vec QUALIFY n < {centroids}
),{steps}, named AS (
    SELECT n, sha256(array_to_string(list_transform(x, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
    FROM cen{rounds}
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
    CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{rounds} JOIN vec USING (r) JOIN named ON named.n = cluster
"""


CLUSTER_SQL = _cluster_sql()


def _url_sql(rules=RULES, s: Settings = Settings()) -> str:
    rule = "CASE "
    for verdict, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        rule += (
            f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') "
            f"THEN {{'rule': '{host}{path}', 'verdict': '{verdict}'}} "
        )
    rule += "END"
    steps = []
    before = "t0"
    for k in range(1, s.depth + 1):
        steps.append(f"""
here{k} AS (
    SELECT *, parts[{k + 1}] AS part, coalesce(parts[{k + 2}], '') AS following FROM {before} WHERE len(parts) > {k}
), wild{k} AS (
    SELECT host, t, count(DISTINCT part) >= {s.children} AND count(DISTINCT part) > {s.variety} * sum(n) AS wild
    FROM here{k} GROUP BY ALL
), branch{k} AS (
    SELECT host, t, part, CASE WHEN wild THEN '*' ELSE part END AS child, following, n, labelled, blocked
    FROM here{k} JOIN wild{k} USING (host, t)
), total{k} AS (
    SELECT host, t, child, sum(n) AS b_n, sum(labelled) AS b_l, sum(blocked) AS b_b, sum(labelled) > 0 AS known
    FROM branch{k} GROUP BY host, t, child
), profile{k} AS (
    SELECT host, t, child, following, known, any_value(b_n) AS b_n, any_value(b_l) AS b_l, any_value(b_b) AS b_b, sum(n) AS n
    FROM branch{k} JOIN total{k} USING (host, t, child) GROUP BY host, t, child, following, known
), next{k} AS (
    SELECT host, t, known, following, sum(n) AS p_next FROM profile{k} GROUP BY ALL
), pool{k} AS (
    SELECT host, t, known, sum(b_n) AS p_n, sum(b_l) AS p_l, sum(b_b) AS p_b, count(*) AS p_c
    FROM total{k} GROUP BY ALL
), kinds{k} AS (
    SELECT host, t, known, greatest(count(DISTINCT following) - 1, 1) AS f FROM profile{k} GROUP BY ALL
), test{k} AS (
    SELECT host, t, child, known, b_l, b_b, p_l, p_b, p_c, f,
        sum((n - b_n * p_next / p_n) ** 2 / (b_n * p_next / p_n)) + any_value(b_n) - sum(b_n * p_next / p_n) AS chi
    FROM profile{k} JOIN next{k} USING (host, t, known, following) JOIN pool{k} USING (host, t, known)
        JOIN kinds{k} USING (host, t, known)
    GROUP BY ALL
), step{k} AS (
    SELECT host, t, child, CASE WHEN p_c > 1 AND chi <= f * (1 - 2 / (9 * f) + {s.normal} * sqrt(2 / (9 * f))) ** 3
        AND (NOT known OR abs(b_b / b_l - p_b / p_l)
             <= {s.label_gap} * sqrt((p_b + 1) / (p_l + 2) * (1 - (p_b + 1) / (p_l + 2)) / b_l))
        THEN CASE WHEN known THEN '~' ELSE '~?' END ELSE child END AS step
    FROM test{k}
), named{k} AS (
    SELECT DISTINCT host, t, part, step FROM branch{k} JOIN step{k} USING (host, t, child)
), t{k} AS (
    SELECT a.host, a.shape, a.parts, a.n, a.labelled, a.blocked,
        CASE WHEN b.step IS NULL THEN a.t ELSE a.t || '/' || b.step END AS t
    FROM {before} a LEFT JOIN named{k} b ON a.host = b.host AND a.t = b.t AND a.parts[{k + 1}] = b.part
)""")
        before = f"t{k}"
    return f"""
WITH raw AS (
    SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS mark FROM pages
), rest AS (
    SELECT page_id, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM raw
), split AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS named, rest FROM rest
), parsed AS (
    SELECT page_id, translate(named, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(named) + 1), '^[^?#]*') AS path
    FROM split
), judged AS (
    SELECT *, {rule} AS rule, regexp_replace(path, '[0-9]+', '#', 'g') AS shape FROM parsed
), t0 AS (
    SELECT host, shape, string_split(shape, '/') AS parts, '' AS t, CAST(count(*) AS DOUBLE) AS n,
        CAST(count(rule) AS DOUBLE) AS labelled, CAST(count(*) FILTER (rule.verdict = 'block') AS DOUBLE) AS blocked
    FROM judged GROUP BY host, shape
), {",".join(steps)}, named AS (
    SELECT host, shape, labelled, blocked, t || CASE WHEN len(parts) > {s.depth + 1}
        THEN '/' || array_to_string(parts[{s.depth + 2} :], '/') ELSE '' END AS template
    FROM {before}
), purity AS (
    SELECT host, template, (sum(blocked) + {0.5 * s.smoothing}) / (sum(labelled) + {s.smoothing}) AS purity
    FROM named GROUP BY host, template
)
SELECT page_id, j.host, j.path, rule.rule AS rule,
    coalesce(rule.verdict, CASE WHEN purity >= {s.reject} THEN 'block' ELSE 'allow' END) AS verdict, template
FROM judged j JOIN named USING (host, shape) JOIN purity USING (host, template)
"""


URL_SQL = _url_sql()
