"""SQL that follows the iterative models step by step: recursive queries for K-means and principal components."""

from __future__ import annotations

POINTS = "p AS MATERIALIZED (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def kmeans(clusters: range, starts: int, turns: int, seed: int = 42, sample: int = 2_000) -> str:
    """CTEs up to ``fits(it, k, r, c, v)``, the centres of every run, and ``costs(k, r, cost)`` about the last ones."""
    return f"""
    {POINTS},
    s AS (SELECT row_number() OVER (ORDER BY md5(id || '/{seed}'), id) - 1 AS i, v FROM p
          QUALIFY row_number() OVER (ORDER BY md5(id || '/{seed}'), id) <= {sample}),
    -- farthest-first traversal from the first points of the sample
    f AS (SELECT r, 0 AS j, i, v, CAST('inf' AS DOUBLE) AS far, i = r % (SELECT count(*) FROM s) AS chosen
          FROM s, range({starts}) t(r)
          UNION ALL
          SELECT r, j + 1, i, v, far, row_number() OVER (PARTITION BY r ORDER BY far DESC, i) = 1
          FROM (SELECT a.r, a.j, a.i, a.v, least(a.far, list_distance(a.v, b.v)) AS far
                FROM f a JOIN f b ON a.r = b.r AND b.chosen WHERE a.j < {clusters[-1] - 1})),
    fits AS (SELECT 0 AS it, k, r, j AS c, v FROM f, range({clusters[0]}, {clusters[-1] + 1}) t(k) WHERE chosen AND j < k
          UNION ALL
          SELECT it + 1, k, r, c, coalesce(m, v)
          FROM fits LEFT JOIN (
              SELECT k, r, c, list(x ORDER BY g) AS m
              FROM (SELECT k, r, c, g, avg(x) AS x
                    FROM (SELECT k, r, c, unnest(v) AS x, generate_subscripts(v, 1) AS g
                          FROM (SELECT p.id, k, r, arg_min(c, list_distance(p.v, fits.v)) AS c FROM p, fits GROUP BY p.id, k, r)
                          JOIN p USING (id))
                    GROUP BY k, r, c, g) GROUP BY k, r, c) USING (k, r, c)
          WHERE it < {turns}),
    placed AS MATERIALIZED (SELECT p.id, k, r, arg_min(c, list_distance(p.v, fits.v)) AS c, min(list_distance(p.v, fits.v)) AS d
          FROM p, fits WHERE it = {turns} GROUP BY p.id, k, r),
    costs AS MATERIALIZED (SELECT k, r, sum(d * d) AS cost FROM placed GROUP BY k, r)"""


_SQUARED = """
    {name} AS (SELECT 0 AS t, i, j, v / max(abs(v)) OVER () AS v FROM {matrix}
          UNION ALL
          SELECT t + 1, i, j, v / max(abs(v)) OVER ()
          FROM (SELECT a.t, a.i, b.j, sum(a.v * b.v) AS v FROM {name} a JOIN {name} b ON a.j = b.i WHERE a.t < 16 GROUP BY a.t, a.i, b.j)),
    {name}_raw AS (SELECT i, v FROM {name} WHERE t = 16 AND j = (SELECT arg_max(i, v) FROM {name} WHERE t = 16 AND i = j)),
    {name}_axis AS MATERIALIZED (
          SELECT i, v / sqrt((SELECT sum(v * v) FROM {name}_raw)) * (SELECT sign(arg_max(v, abs(v))) FROM {name}_raw) AS v FROM {name}_raw),
    {name}_size AS MATERIALIZED (SELECT sum(a.v * m.v * b.v) AS size
          FROM {matrix} m JOIN {name}_axis a ON a.i = m.i JOIN {name}_axis b ON b.i = m.j)"""

COMPONENTS = f"""
    x AS MATERIALIZED (SELECT vec_id AS id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    z AS MATERIALIZED (SELECT id, i, v - avg(v) OVER (PARTITION BY i) AS v FROM x),
    cov AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.v * b.v) / (count(*) - 1) AS v FROM z a JOIN z b USING (id) GROUP BY a.i, b.i),
    -- 2 ** 16 steps of power iteration by squaring; the second component from what the first leaves
    {_SQUARED.format(name="one", matrix="cov")},
    rest AS MATERIALIZED (SELECT m.i, m.j, m.v - size * a.v * b.v AS v FROM one_size, cov m
             JOIN one_axis a ON a.i = m.i JOIN one_axis b ON b.i = m.j),
    {_SQUARED.format(name="two", matrix="rest")},
    projected AS MATERIALIZED (SELECT id, sum(z.v * a.v) AS pca1, sum(z.v * b.v) AS pca2
          FROM z JOIN one_axis a USING (i) JOIN two_axis b USING (i) GROUP BY id)"""


# ---- boosted trees ----------------------------------------------------------------------------------------------------
def feature_rows(numbers: list[str], categories: list[str]) -> str:
    """CTEs ``names(f, feature)`` and ``x(id, f, v)`` from ``data`` (id, columns) and ``train`` (id): means for missing numbers,
    a 0 or 1 for each level that the training rows have."""
    parts = [f"SELECT {i} AS f, '{c}' AS feature" for i, c in enumerate(numbers)]
    values = [
        f"SELECT id, {i} AS f, coalesce({c}, (SELECT avg({c}) FROM data SEMI JOIN train USING (id))) AS v FROM data"
        for i, c in enumerate(numbers)
    ]
    levels = " UNION ALL ".join(
        f"SELECT DISTINCT {k} AS k, '{c}' AS c, {c} AS level FROM data SEMI JOIN train USING (id)" for k, c in enumerate(categories)
    )
    flags = " UNION ALL ".join(
        f"SELECT id, f, CAST({c} = level AS INTEGER)::DOUBLE AS v FROM data, levels WHERE c = '{c}'" for c in categories
    )
    return f"""
    levels AS MATERIALIZED (SELECT *, {len(numbers) - 1} + row_number() OVER (ORDER BY k, level) AS f FROM ({levels})),
    names AS ({' UNION ALL '.join(parts)} UNION ALL SELECT f, c || '=' || level FROM levels),
    x AS MATERIALIZED ({' UNION ALL '.join(values)} UNION ALL {flags})"""


def boosting(trials: list[dict], folds: int = 5, seed: int = 42, bins: int = 32, cells: int = 1024) -> str:
    """CTEs that grow ``trials`` from ``train`` (id, y) and ``x`` (id, f, v; other ids are only scored).

    ``predicted(trial, id, p)`` holds the result, ``splits(trial, tree, node, f, bin, n, gain)`` all splits.
    """
    columns = ["trees", "rate", "depth", "min_split", "subsample", "fold"]
    rows = ", ".join(
        f"({i}, " + ", ".join("NULL" if t[c] is None else repr(t[c]) + ("::DOUBLE" if c in ("rate", "subsample") else "") for c in columns) + ")"
        for i, t in enumerate(trials)
    )
    mixed, steps = "xor(row, {start})", ((16, 2246822507), (13, 3266489909))
    out = [f"""
    params(trial, {', '.join(columns)}) AS (VALUES {rows}),
    ends AS MATERIALIZED (SELECT f, min(v) AS lo, max(v) AS hi, count(*) AS n FROM x SEMI JOIN train USING (id) GROUP BY f),
    cell AS MATERIALIZED (SELECT id, f, n, CASE WHEN hi > lo THEN greatest(0, least({cells - 1}, floor((v - lo) / ((hi - lo) / {cells}))))
                 ELSE 0 END::INTEGER AS cell FROM x JOIN ends USING (f)),
    upto AS MATERIALIZED (SELECT f, cell, sum(count(*)) OVER (PARTITION BY f ORDER BY cell) AS upto
                 FROM cell SEMI JOIN train USING (id) GROUP BY f, cell),
    b AS MATERIALIZED (SELECT c.id, c.f, (coalesce(u.upto, 0) * {bins} // c.n)::INTEGER AS bin
                 FROM cell c ASOF LEFT JOIN upto u ON c.f = u.f AND c.cell > u.cell),
    r AS MATERIALIZED (SELECT i.id, y, ('0x' || md5(i.id || '/{seed}/fold')[1:8])::BIGINT AS row,
                 ('0x' || md5(i.id || '/{seed}/fold')[9:16])::BIGINT % {folds} AS fold
                 FROM (SELECT DISTINCT id FROM x) i LEFT JOIN train USING (id)),
    p_0 AS MATERIALIZED (SELECT trial, id, avg(y) FILTER (y IS NOT NULL AND r.fold IS DISTINCT FROM params.fold)
                 OVER (PARTITION BY trial) AS p FROM r, params)"""]
    depth = max(t["depth"] for t in trials)
    for tree in range(max(t["trees"] for t in trials)):
        draw = mixed.format(start=tree * 2654435761 % (1 << 32))
        for shift, factor in steps:
            draw = f"((xor({draw}, ({draw}) >> {shift}))::HUGEINT * {factor} % 4294967296)::BIGINT" if len(draw) < 200 else (
                f"list_transform([{draw}], lambda z: (xor(z, z >> {shift})::HUGEINT * {factor} % 4294967296)::BIGINT)[1]")
        draw = f"list_transform([{draw}], lambda z: xor(z, z >> 16))[1]"
        out.append(f"""
    g_{tree}_0 AS MATERIALIZED (SELECT p.trial, id, y - p AS res, 0 AS node,
                 y IS NOT NULL AND r.fold IS DISTINCT FROM params.fold AND (subsample >= 1 OR {draw} < subsample * 4294967296.0) AS used
                 FROM p_{tree} p JOIN r USING (id) JOIN params USING (trial) WHERE trees > {tree})""")
        for level in range(depth):
            out.append(f"""
    s_{tree}_{level} AS MATERIALIZED (
        SELECT trial, node, f, bin, n, gain FROM (
            SELECT *, round(sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n, 6) AS gain FROM (
                SELECT trial, node, f, bin, sum(c) OVER w AS nl, sum(s) OVER w AS sl, sum(c) OVER v AS n, sum(s) OVER v AS s
                FROM (SELECT trial, node, f, bin, count(*) AS c, sum(res) AS s FROM g_{tree}_{level} JOIN b USING (id)
                      WHERE used AND node >= {(1 << level) - 1} GROUP BY ALL)
                WINDOW w AS (PARTITION BY trial, node, f ORDER BY bin), v AS (PARTITION BY trial, node, f))
            WHERE nl < n) JOIN params USING (trial)
        WHERE gain > 0 AND n >= min_split AND {level} < depth
        QUALIFY row_number() OVER (PARTITION BY trial, node ORDER BY gain DESC, f, bin) = 1),
    g_{tree}_{level + 1} AS MATERIALIZED (
        SELECT g.trial, g.id, res, CASE WHEN s.node IS NULL THEN g.node ELSE 2 * g.node + 1 + (b.bin > s.bin)::INTEGER END AS node, used
        FROM g_{tree}_{level} g LEFT JOIN s_{tree}_{level} s ON g.trial = s.trial AND g.node = s.node
        LEFT JOIN b ON b.id = g.id AND b.f = s.f)""")
        out.append(f"""
    p_{tree + 1} AS MATERIALIZED (
        SELECT p.trial, p.id, p + coalesce(rate * value, 0) AS p
        FROM p_{tree} p JOIN params USING (trial) LEFT JOIN g_{tree}_{depth} g ON g.trial = p.trial AND g.id = p.id
        LEFT JOIN (SELECT trial, node, avg(res) AS value FROM g_{tree}_{depth} WHERE used GROUP BY trial, node) v
             ON v.trial = g.trial AND v.node = g.node)""")
    last = max(t["trees"] for t in trials)
    every = " UNION ALL ".join(f"SELECT {t} AS tree, * FROM s_{t}_{level}" for t in range(last) for level in range(depth))
    out.append(f" predicted AS (SELECT * FROM p_{last}), splits AS ({every})")
    return ",".join(out)
