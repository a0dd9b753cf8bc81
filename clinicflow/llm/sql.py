"""DuckDB SQL of the operators on secrets, vector codes and centroids."""

from __future__ import annotations

_ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r'["'
    r"'']?\x20*[:=]\x20*["
    r'"'
    r"'']?([A-Za-z0-9+/_.=-]+)"
)

SECRETS = r"""
    WITH d AS MATERIALIZED (
        SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents
    ), m AS (
        SELECT k, 0 AS kind, 12 AS least, regexp_extract_all(t, '@ASSIGN') AS hit, regexp_extract_all(t, '@ASSIGN', 2) AS val,
               string_split_regex(t, '@ASSIGN') AS gap FROM d
        UNION ALL
        SELECT k, 1, 18, regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'), string_split_regex(t, 'AKIA[A-Z0-9]+') FROM d
        UNION ALL
        SELECT k, 2, 16, regexp_extract_all(t, '[0-9a-f]{16,}'), regexp_extract_all(t, '[0-9a-f]{16,}'), string_split_regex(t, '[0-9a-f]{16,}') FROM d
    ), base AS MATERIALIZED (
        SELECT k, kind, val[i] AS val, s, s + length(hit[i]) AS e FROM (
            SELECT *, CAST(list_sum(list_transform(gap[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(hit[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
            FROM (SELECT *, unnest(range(1, len(hit) + 1)) AS i FROM m WHERE len(hit) > 0)
        ) WHERE length(val[i]) >= least
    ), hidden AS (
        SELECT DISTINCT k, unnest(range(s, e)) AS p FROM base
    ), spelt AS (
        SELECT 0 AS cls, k, CAST(0 AS BIGINT) AS s, 0 AS kind, c.p, CASE WHEN h.p IS NULL THEN ch ELSE ' ' END AS ch
        FROM (SELECT k, unnest(string_split(t, '')) AS ch, unnest(range(length(t))) AS p FROM d WHERE t <> '') c LEFT JOIN hidden h USING (k, p)
        UNION ALL
        SELECT 1, k, s, kind, unnest(range(length(val))), unnest(string_split(val, '')) FROM base
    ), numbered AS (
        SELECT *, CASE WHEN length(ch) = 1 THEN strpos('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789', ch) ELSE 0 END AS n
        FROM spelt
    ), one AS (
        SELECT *, CASE WHEN n BETWEEN 1 AND 26 AND x BETWEEN 27 AND 52 THEN 0 ELSE x END AS b
        FROM (SELECT *, lag(n, 1, 0) OVER (PARTITION BY cls, k, s, kind ORDER BY p) AS x FROM numbered)
    ), two AS MATERIALIZED (
        SELECT cls, k, p, ch, n, b, CASE WHEN b = 0 THEN 0 ELSE y END AS a
        FROM (SELECT *, lag(b, 1, 0) OVER (PARTITION BY cls, k, s, kind ORDER BY p) AS y FROM one)
    ), islands AS (
        SELECT k, p, ch, n, a, b, p - row_number() OVER (PARTITION BY k ORDER BY p) AS run
        FROM two WHERE cls = 0 AND (n > 0 OR length(ch) = 1 AND strpos('+/_=-', ch) > 0)
    ), runs AS MATERIALIZED (
        SELECT k, run, min(p) AS s, max(p) + 1 AS e FROM islands GROUP BY k, run HAVING count(*) >= 16 AND bool_or(n BETWEEN 1 AND 52)
    ), unknown AS (
        SELECT k, unnest(range(s, e)) AS p FROM runs
    ), n3 AS MATERIALIZED (
        SELECT cls, a, b, n AS c, count(*) AS n
        FROM two WHERE n > 0 AND (cls = 1 OR (k, p) NOT IN (SELECT (k, p) FROM unknown)) GROUP BY ALL
    ), n2 AS (SELECT cls, b, c, sum(n) AS n FROM n3 GROUP BY ALL),
    n1 AS (SELECT cls, c, sum(n) AS n FROM n3 GROUP BY ALL),
    x2 AS (SELECT cls, a, b, sum(n) AS n FROM n3 GROUP BY ALL),
    x1 AS (SELECT cls, b, sum(n) AS n FROM n3 GROUP BY ALL),
    x0 AS (SELECT cls, coalesce(sum(n), 0) AS n FROM (VALUES (0), (1)) v(cls) LEFT JOIN n3 USING (cls) GROUP BY cls),
    asked AS (
        SELECT DISTINCT a, b, n AS c FROM islands JOIN runs USING (k, run) WHERE n > 0
    ), chance AS (
        SELECT q.a, q.b, q.c, x0.cls,
               (coalesce(n3.n, 0) + 64 * (coalesce(n2.n, 0) + 64 * (coalesce(n1.n, 0) + (62 + x0.cls * x0.n) / 62.0::DOUBLE) / (x0.n + 62 + x0.cls * x0.n))
                   / (coalesce(x1.n, 0) + 64)) / (coalesce(x2.n, 0) + 64) AS pr
        FROM asked q CROSS JOIN x0
        LEFT JOIN n1 ON n1.cls = x0.cls AND n1.c = q.c
        LEFT JOIN n2 ON n2.cls = x0.cls AND n2.c = q.c AND n2.b = q.b
        LEFT JOIN n3 ON n3.cls = x0.cls AND n3.c = q.c AND n3.b = q.b AND n3.a = q.a
        LEFT JOIN x1 ON x1.cls = x0.cls AND x1.b = q.b
        LEFT JOIN x2 ON x2.cls = x0.cls AND x2.b = q.b AND x2.a = q.a
    ), weight AS (
        SELECT a, b, c, floor(1000 * (ln(max(pr) FILTER (cls = 1)) - ln(max(pr) FILTER (cls = 0))) + 0.5) AS w FROM chance GROUP BY a, b, c
    ), scored AS (
        SELECT k, run, sum(w) AS score
        FROM islands JOIN runs USING (k, run) JOIN weight ON weight.a = islands.a AND weight.b = islands.b AND weight.c = islands.n
        GROUP BY k, run
    ), added AS (
        SELECT k, 3 AS kind, s, e FROM runs JOIN scored USING (k, run)
        WHERE score > 1000 * ln(100 * ((SELECT count(*) FROM runs) + 1)::DOUBLE / ((SELECT count(*) FROM base) + 1))
    ), spans AS (
        SELECT k, kind, s, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || s || ':' || e AS span
        FROM (SELECT k, kind, s, e FROM base UNION ALL SELECT k, kind, s, e FROM added)
    )
    SELECT doc_id, count(span) FILTER (kind = 0) AS n_assign, count(span) FILTER (kind = 1) AS n_access, count(span) FILTER (kind = 2) AS n_hex,
           sha256(coalesce(string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 3), '')) AS base_sha256,
           coalesce(string_agg(span, ',' ORDER BY s, kind), '') AS spans
    FROM d LEFT JOIN spans USING (k) GROUP BY d.k, doc_id
""".replace("@ASSIGN", _ASSIGN)


def _rounds(rounds: int) -> str:
    """CTEs a0, c1, a1, ...: assignments (i, p, j, d) of the rows r (i, p, v) to the centroids c0 (p, j, c), and their floored means."""
    out = []
    for t in range(rounds + 1):
        out.append(f"""a{t} AS MATERIALIZED (
            SELECT i, p, arg_min(j, d * 1024 + j) AS j, min(d) AS d FROM (
                SELECT r.i, r.p, c.j, CAST(list_sum(list_transform(list_zip(r.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
                FROM r JOIN c{t} c ON r.p = c.p
            ) GROUP BY i, p
        )""")
        if t < rounds:
            out.append(f"""m{t} AS (
                SELECT p, j, list(CAST(CASE WHEN s % n < 0 THEN (s - s % n) // n - 1 ELSE (s - s % n) // n END AS BIGINT) ORDER BY e) AS c
                FROM (
                    SELECT p, j, e, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
                    FROM (SELECT a.p, a.j, unnest(r.v) AS x, unnest(range(len(r.v))) AS e FROM a{t} a JOIN r ON a.i = r.i AND a.p = r.p)
                    GROUP BY p, j, e
                ) GROUP BY p, j
            ), c{t + 1} AS MATERIALIZED (
                SELECT c.p, c.j, coalesce(m.c, c.c) AS c FROM c{t} c LEFT JOIN m{t} m ON m.p = c.p AND m.j = c.j
            )""")
    return ", ".join(out)


CODES = f"""
    WITH f AS MATERIALIZED (
        SELECT row_number() OVER () AS i, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), r AS MATERIALIZED (
        SELECT i, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS v FROM f, range(4) t(p)
    ), c0 AS MATERIALIZED (
        SELECT r.p, o.j, r.v AS c
        FROM (SELECT i, row_number() OVER (ORDER BY vec_id, v) - 1 AS j FROM f QUALIFY j < 256) o JOIN r USING (i)
    ), {_rounds(4)}, coded AS (
        SELECT i, string_agg(printf('%02x', CAST(j AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY i
    )
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) FROM c4) AS codebooks_sha256
    FROM f JOIN coded USING (i)
"""

CENTROIDS = f"""
    WITH r AS MATERIALIZED (
        SELECT row_number() OVER () AS i, 0 AS p, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), c0 AS MATERIALIZED (
        SELECT 0 AS p, row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS j, v AS c FROM r QUALIFY j < 16
    ), {_rounds(3)}
    SELECT vec_id, CAST(a3.j AS INTEGER) AS cluster, a3.d AS distance,
           CAST(sum(a3.d) OVER (PARTITION BY a3.j) AS BIGINT) AS cluster_inertia, CAST(sum(a3.d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c3.c, ',')) AS centroid_sha256
    FROM r JOIN a3 USING (i) JOIN c3 ON c3.j = a3.j
"""
