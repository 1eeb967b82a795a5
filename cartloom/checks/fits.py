"""SQL for what the model fits must arrive at: the optimum, the best splits, the silhouette."""

from __future__ import annotations

from collections.abc import Sequence

NEWTON_STEPS = 8


def weighed(filled: str = "filled") -> str:
    """Rows with class weights (w) that make both classes count alike."""
    return f"""weighed AS (
    SELECT f.*, CASE WHEN label = 1 THEN n / (2e0 * pos) ELSE n / (2e0 * (n - pos)) END AS w
    FROM {filled} f, (SELECT count(*)::DOUBLE AS n, sum(label) AS pos FROM {filled})
)"""


def logit(features: Sequence[str], penalty: float, steps: int = NEWTON_STEPS) -> tuple[str, tuple[str, ...]]:
    """Terms of the weighted logistic model with a squared penalty on standardised coefficients, by Newton's method."""
    size = len(features) + 1
    moments = ", ".join(
        f"sum(w * {f}) / sum(w) AS m{i}, "
        f"sqrt((sum(w * {f} * {f}) - sum(w * {f}) ** 2 / sum(w)) / (sum(w) - sum(w * w) / sum(w))) AS s{i}"
        for i, f in enumerate(features, 1)
    )
    scaled = ", ".join(f"({f} - m{i}) / s{i} AS z{i}" for i, f in enumerate(features, 1))
    ctes = [
        f"moments AS (SELECT {moments} FROM weighed)",
        f"points AS MATERIALIZED (SELECT label AS y, w, 1e0 AS z0, {scaled} FROM weighed, moments)",
        "step_0 AS (SELECT " + ", ".join(f"0e0 AS b{i}" for i in range(size)) + ")",
    ]
    margin = " + ".join(f"b{i} * z{i}" for i in range(size))
    for step in range(steps):
        gradient = [
            f"sum(w * (p - y) * z{i}) / sum(w)" + (f" + {penalty} * max(b{i})" if i else "") + f" AS g{i}"
            for i in range(size)
        ]
        hessian = [
            f"sum(w * p * (1 - p) * z{i} * z{j}) / sum(w)" + (f" + {penalty}" if i == j and i else "") + f" AS h{i}{j}"
            for i in range(size)
            for j in range(i + 1)
        ]
        own = ", ".join(f"max(b{i}) AS b{i}" for i in range(size))
        ctes.append(
            f"sums_{step} AS (SELECT {own}, {', '.join(gradient + hessian)} FROM "
            f"(SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM points, step_{step}))"
        )
        ctes.append(f"step_{step + 1} AS ({_solved(size, f'sums_{step}')})")
    raw = [f"b{i} / s{i}" for i in range(1, size)]
    terms = [("intercept", "b0 - " + " - ".join(f"b{i} * m{i} / s{i}" for i in range(1, size))), *zip(features, raw)]
    select = " UNION ALL ".join(
        f"SELECT '{name}' AS term, round({value}, 4) AS coefficient FROM step_{steps}, moments" for name, value in terms
    )
    return select, tuple(ctes)


def _solved(size: int, sums: str) -> str:
    """Newton's next point: the Hessian as a product of triangles, solved forwards and backwards."""
    lines = []
    for i in range(size):
        for j in range(i + 1):
            rest = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            lines.append(f"sqrt(h{i}{i}{rest}) AS l{i}{i}" if i == j else f"(h{i}{j}{rest}) / l{j}{j} AS l{i}{j}")
    for i in range(size):
        rest = "".join(f" - l{i}{k} * u{k}" for k in range(i))
        lines.append(f"(g{i}{rest}) / l{i}{i} AS u{i}")
    for i in reversed(range(size)):
        rest = "".join(f" - l{k}{i} * x{k}" for k in range(i + 1, size))
        lines.append(f"(u{i}{rest}) / l{i}{i} AS x{i}")
    new = ", ".join(f"b{i} - x{i} AS b{i}" for i in range(size))
    return f"SELECT {new} FROM (SELECT *, {', '.join(lines)} FROM {sums})"


def _long(features: Sequence[str]) -> str:
    """One row per training pair and feature; every department is a feature of zeros and ones."""
    own = [f"SELECT user_id, product_id, '{f}' AS feature, {f}::DOUBLE AS x, label, w FROM weighed" for f in features]
    shelf = """SELECT user_id, product_id, 'p_department_id=' || d.id AS feature,
       CASE WHEN p_department_id = d.id THEN 1e0 ELSE 0e0 END AS x, label, w
FROM weighed, (SELECT DISTINCT p_department_id AS id FROM weighed) d"""
    return "long_rows AS (" + " UNION ALL ".join([*own, shelf]) + ")"


def _best(name: str, source: str, target: str) -> tuple[str, ...]:
    """The split of all features that lowers the weighted variance of the target most (ties: the first feature)."""
    return (
        f"""{name}_hist AS (
    SELECT feature, x, sum(w) AS w, sum(w * {target}) AS s FROM {source} GROUP BY feature, x
)""",
        f"""{name}_cuts AS (
    SELECT feature, (x + lead(x) OVER up) / 2 AS threshold, sum(w) OVER upto AS wl, sum(s) OVER upto AS sl,
           sum(w) OVER (PARTITION BY feature) AS wa, sum(s) OVER (PARTITION BY feature) AS sa
    FROM {name}_hist
    WINDOW up AS (PARTITION BY feature ORDER BY x),
           upto AS (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING)
)""",
        f"""{name} AS (
    SELECT feature, threshold, sl / wl AS "left", (sa - sl) / (wa - wl) AS "right"
    FROM {name}_cuts WHERE threshold IS NOT NULL
    ORDER BY sl * sl / wl + (sa - sl) * (sa - sl) / (wa - wl) DESC, feature LIMIT 1
)""",
    )


def _row(tree: int, name: str) -> str:
    return (
        f'SELECT {tree}::INT AS tree, feature, round(threshold, 6) AS threshold, round("left", 6) AS "left", '
        f'round("right", 6) AS "right" FROM {name}'
    )


def stump(features: Sequence[str]) -> tuple[str, tuple[str, ...]]:
    """The best Gini split: for two classes that is the best split by the variance of the label."""
    return _row(1, "best"), (_long(features), *_best("best", "long_rows", "label"))


def boosted(features: Sequence[str]) -> tuple[str, tuple[str, ...]]:
    """Two boosting steps of depth one: labels of -1 and 1, then the gradient of the logistic loss."""
    residual = """second_rows AS (
    SELECT l.user_id, l.product_id, l.feature, l.x, l.w,
           4 * l.sign / (1 + exp(2 * l.sign * CASE WHEN f.x <= first.threshold THEN first."left" ELSE first."right" END))
               AS residual
    FROM signed l, first JOIN long_rows f ON f.feature = first.feature
    WHERE f.user_id = l.user_id AND f.product_id = l.product_id
)"""
    return _row(1, "first") + " UNION ALL " + _row(2, "second"), (
        _long(features),
        "signed AS (SELECT *, 2 * label - 1 AS sign FROM long_rows)",
        *_best("first", "signed", "sign"),
        residual,
        *_best("second", "second_rows", "residual"),
    )


def silhouette(columns: Sequence[str]) -> tuple[str, tuple[str, ...]]:
    """Mean silhouette of thirty-day recency clusters from counts, sums and squared norms per cluster."""
    n = range(len(columns))
    z = ", ".join(
        f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0) AS z{i}"
        for i, c in enumerate(columns)
    )
    norm, cross = " + ".join(f"z{i} * z{i}" for i in n), " + ".join(f"p.z{i} * c.y{i}" for i in n)
    return "SELECT count(DISTINCT cluster) AS clusters, round(avg(s), 6) AS silhouette FROM scored_points", (
        f"placed_points AS (SELECT user_id, CAST(floor(recency / 30) AS INTEGER) AS cluster, {z} FROM rfv)",
        "groups AS (SELECT cluster, count(*) AS n, sum(" + norm + ") AS psi, "
        + ", ".join(f"sum(z{i}) AS y{i}" for i in n) + " FROM placed_points GROUP BY cluster)",
        f"""distances AS (
    SELECT p.user_id, p.cluster, c.cluster AS other, c.n, ({norm.replace("z", "p.z")}) + c.psi / c.n - 2 * ({cross}) / c.n AS d
    FROM placed_points p, groups c
)""",
        """scored_points AS (
    SELECT cluster, CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END AS s
    FROM (SELECT user_id, cluster, max(n) FILTER (other = cluster) AS n,
                 max(d * n / nullif(n - 1, 0)) FILTER (other = cluster) AS a, min(d) FILTER (other <> cluster) AS b
          FROM distances GROUP BY user_id, cluster)
)""",
    )
