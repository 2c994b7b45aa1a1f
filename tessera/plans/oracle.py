"""DuckDB SQL equivalents of the registered reports (same column names).

Tables are the pre-registered views (orders, lineitem, part, ...).  Floating
results are rounded like the Spark side, and ``+ 0.0`` folds -0.0 into 0.0.
"""

from __future__ import annotations

ORDER_FEATURES_CTE = """
per_order AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty,
         sum(l_extendedprice) AS sum_price,
         sum(l_extendedprice * (1.0 - l_discount)) AS sum_net
  FROM lineitem GROUP BY l_orderkey),
of AS (
  SELECT o_orderkey, o_orderdate, o_totalprice,
         CAST(coalesce(n_lines, 0) AS DOUBLE) AS n_lines,
         coalesce(sum_qty, 0.0) AS sum_qty,
         coalesce(sum_price, 0.0) AS sum_price,
         coalesce(sum_net, 0.0) AS sum_net
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey)
"""

ORDER_FEATURES = ["o_totalprice", "n_lines", "sum_qty", "sum_price"]


def _nonfinite(x: str) -> str:
    return f"({x} IS NULL OR isnan({x}) OR isinf({x}))"


CHECK_MATRIX = f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, coalesce(len(embedding), 0) AS w FROM embeddings),
b AS (SELECT vec_id, w,
             CASE WHEN w > 0 THEN len(list_filter(v, lambda x: {_nonfinite('x')})) ELSE 0 END AS nb
      FROM e)
SELECT count(*) AS n_rows,
       CAST(count(*) FILTER (WHERE w = 0) AS BIGINT) AS n_empty_rows,
       CAST(coalesce(sum(nb), 0) AS BIGINT) AS n_nonfinite_cells,
       count(*) FILTER (WHERE w = 0 OR nb > 0) AS n_bad_rows,
       CAST(coalesce(min(vec_id) FILTER (WHERE w = 0 OR nb > 0), -1) AS BIGINT) AS first_bad_id,
       CAST(min(w) AS INTEGER) AS min_width,
       CAST(max(w) AS INTEGER) AS max_width
FROM b
"""

CHECK_TARGETS = f"""
WITH j AS (SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS y
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT count(*) AS n_samples, count(y) AS n_targets,
       count(*) FILTER (WHERE y IS NOT NULL AND {_nonfinite('y')}) AS n_nonfinite_targets,
       CAST(coalesce(min(doc_id) FILTER (WHERE y IS NULL), -1) AS BIGINT) AS first_missing_id,
       CAST(coalesce(min(doc_id) FILTER (WHERE y IS NOT NULL AND {_nonfinite('y')}), -1) AS BIGINT) AS first_nonfinite_id
FROM j
"""

CHECK_LOGISTIC_TARGETS = f"""
WITH j AS (SELECT doc_id, CAST(toxic AS DOUBLE) AS y FROM labels),
k AS (SELECT doc_id, y, (y IS NOT NULL AND NOT {_nonfinite('y')} AND (y < 0 OR y > 1)) AS out FROM j)
SELECT count(y) AS n_targets, count(*) FILTER (WHERE out) AS n_out_of_range,
       CAST(coalesce(min(doc_id) FILTER (WHERE out), -1) AS BIGINT) AS first_out_of_range_id,
       min(y) AS min_target, max(y) AS max_target
FROM k
"""

_LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

CHECK_VARIANCE = "\nUNION ALL\n".join(
    f"""SELECT {i + 1} AS column_position, '{c}' AS column_name, count(*) AS n_samples,
       min(CAST({c} AS DOUBLE)) AS min_value, max(CAST({c} AS DOUBLE)) AS max_value,
       min(CAST({c} AS DOUBLE)) = max(CAST({c} AS DOUBLE)) AS is_constant
FROM lineitem"""
    for i, c in enumerate(_LINE_COLUMNS)
)

COLUMN_MOMENTS = (
    "WITH "
    + ORDER_FEATURES_CTE
    + "\nUNION ALL\n".join(
        f"""SELECT {i + 1} AS column_position, '{c}' AS column_name,
       round(avg({c}), 6) + 0.0 AS mean, round(stddev_samp({c}), 6) + 0.0 AS stddev,
       count(*) AS n_rows FROM of"""
        for i, c in enumerate(ORDER_FEATURES)
    )
)

STANDARDISE = (
    "WITH "
    + ORDER_FEATURES_CTE
    + "SELECT o_orderkey, "
    + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) + 0.0 AS {c}" for c in ORDER_FEATURES
    )
    + " FROM of"
)

COVARIANCE_MATRIX = (
    "WITH "
    + ORDER_FEATURES_CTE
    + ", z AS (SELECT "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS z{i}" for i, c in enumerate(ORDER_FEATURES))
    + " FROM of)\n"
    + "\nUNION ALL\n".join(
        f"SELECT {i + 1} AS row_position, {j + 1} AS column_position, "
        f"round(sum(z{min(i, j)} * z{max(i, j)}) / count(*), 6) + 0.0 AS covariance FROM z"
        for i in range(len(ORDER_FEATURES))
        for j in range(len(ORDER_FEATURES))
    )
)

# --- distances ---------------------------------------------------------------------

_EMB_CELLS = """
x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v,
             generate_subscripts(embedding, 1) AS pos
      FROM embeddings)"""


def _to_class_centre(metric: str) -> str:
    term = "(x.v - c.cv) * (x.v - c.cv)" if metric == "euclidean" else "abs(x.v - c.cv)"
    agg = f"sqrt(sum({term}))" if metric == "euclidean" else f"sum({term})"
    return f"""
WITH {_EMB_CELLS},
c AS (SELECT label, pos, avg(v) AS cv FROM x GROUP BY label, pos)
SELECT x.vec_id, x.label, round({agg}, 6) + 0.0 AS distance
FROM x JOIN c ON x.label IS NOT DISTINCT FROM c.label AND x.pos = c.pos
GROUP BY x.vec_id, x.label
"""


DISTANCE_JOIN = f"""
WITH {_EMB_CELLS},
p AS (SELECT a.vec_id AS query_id, b.vec_id AS train_id, sqrt(sum((a.v - b.v) * (a.v - b.v))) AS d
      FROM x a JOIN x b ON a.pos = b.pos
      GROUP BY a.vec_id, b.vec_id),
r AS (SELECT query_id, train_id, d,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, train_id) AS INTEGER) AS rn
      FROM p)
SELECT query_id, rn AS rank, train_id, round(d, 6) + 0.0 AS distance FROM r WHERE rn <= 5
"""

# --- k-means (recursive CTE: one state row per iteration) --------------------------------

KMEANS_K, KMEANS_MAX_ITER, KMEANS_TOL, KMEANS_SEED = 3, 100, 1e-9, 7


def _kmeans_state(k: int = KMEANS_K) -> str:
    cents = [(f"c{c}_1", f"c{c}_2") for c in range(k)]
    ds = [f"sqrt((x1 - {a}) * (x1 - {a}) + (x2 - {b}) * (x2 - {b}))" for a, b in cents]
    state_cols = [col for pair in cents for col in pair] + [f"n{c}" for c in range(k)]
    new1 = [f"coalesce(avg(x1) FILTER (WHERE cl = {c}), c{c}_1)" for c in range(k)]
    new2 = [f"coalesce(avg(x2) FILTER (WHERE cl = {c}), c{c}_2)" for c in range(k)]
    moves = " + ".join(
        f"sqrt((c{c}_1 - {new1[c]}) * (c{c}_1 - {new1[c]}) + (c{c}_2 - {new2[c]}) * (c{c}_2 - {new2[c]}))"
        for c in range(k)
    )
    init_cols = ", ".join(
        f"max(x1) FILTER (WHERE cluster = {c}) AS c{c}_1, max(x2) FILTER (WHERE cluster = {c}) AS c{c}_2"
        for c in range(k)
    )
    step_cols = ", ".join(f"{new1[c]}, {new2[c]}" for c in range(k))
    counts = ", ".join(f"count(*) FILTER (WHERE cl = {c})" for c in range(k))
    zero_counts = ", ".join("CAST(0 AS BIGINT)" for _ in range(k))
    return f"""
pts AS (
  SELECT p_partkey AS id,
         (CAST(p_size AS DOUBLE) - avg(CAST(p_size AS DOUBLE)) OVER ()) / stddev_samp(CAST(p_size AS DOUBLE)) OVER () AS x1,
         (p_retailprice - avg(p_retailprice) OVER ()) / stddev_samp(p_retailprice) OVER () AS x2
  FROM part),
ranked AS (SELECT id, x1, x2, row_number() OVER (ORDER BY id) - 1 AS rk FROM pts),
cnt AS (SELECT count(*) AS n FROM pts),
lcg(i, s) AS (
  SELECT 0, CAST({KMEANS_SEED} AS BIGINT)
  UNION ALL
  SELECT i + 1, (1664525 * s + 1013904223) % 4294967296 FROM lcg WHERE i < {k}),
picks AS (SELECT i - 1 AS cluster, s % n AS rk FROM lcg, cnt WHERE i >= 1),
init AS (SELECT {init_cols} FROM picks JOIN ranked USING (rk)),
km(it, {", ".join(state_cols)}, moved) AS (
  SELECT 0, {", ".join(c for pair in cents for c in pair)}, {zero_counts}, CAST('inf' AS DOUBLE) FROM init
  UNION ALL
  SELECT it + 1, {step_cols}, {counts}, {moves}
  FROM (SELECT k.*, p.x1, p.x2,
               list_position([{", ".join(ds)}], list_min([{", ".join(ds)}])) - 1 AS cl
        FROM km k, pts p
        WHERE k.moved > {KMEANS_TOL} AND k.it < {KMEANS_MAX_ITER}) a
  GROUP BY it, {", ".join(state_cols)}, moved),
fitted AS (SELECT * FROM km WHERE moved <= {KMEANS_TOL})"""


KMEANS_CENTROIDS = (
    "WITH RECURSIVE "
    + _kmeans_state()
    + "\n"
    + "\nUNION ALL\n".join(
        f"SELECT {c} AS cluster, n{c} AS n_members, round(c{c}_1, 6) + 0.0 AS c1, round(c{c}_2, 6) + 0.0 AS c2 FROM fitted"
        for c in range(KMEANS_K)
    )
)

_ds_fit = ", ".join(
    f"sqrt((p.x1 - f.c{c}_1) * (p.x1 - f.c{c}_1) + (p.x2 - f.c{c}_2) * (p.x2 - f.c{c}_2))" for c in range(KMEANS_K)
)
KMEANS_PREDICT = (
    "WITH RECURSIVE "
    + _kmeans_state()
    + f"""
SELECT p.id AS p_partkey, CAST(list_position([{_ds_fit}], list_min([{_ds_fit}])) - 1 AS INTEGER) AS cluster
FROM pts p, fitted f"""
)

# --- PCA (two standardised columns: closed form) ----------------------------------------

_REVENUE_Z = """
r AS (SELECT l_orderkey, sum(l_extendedprice) AS gross,
             sum(l_extendedprice * (1.0 - l_discount)) AS net
      FROM lineitem GROUP BY l_orderkey),
z AS (SELECT l_orderkey,
             (gross - avg(gross) OVER ()) / stddev_samp(gross) OVER () AS z1,
             (net - avg(net) OVER ()) / stddev_samp(net) OVER () AS z2
      FROM r)"""

# For d = 2 with positive correlation the covariance [[a, c], [c, a]] has
# eigenvalues a + c and a - c with vectors [1, 1] and [-1, 1] (last entry 1).
PCA_TRANSFORM = f"""
WITH {_REVENUE_Z}
SELECT l_orderkey, round(z1 + z2, 6) + 0.0 AS pc1, round(-z1 + z2, 6) + 0.0 AS pc2 FROM z
"""

PCA_COMPONENTS = f"""
WITH {_REVENUE_Z},
m AS (SELECT sum(z1 * z1) / count(*) AS a, sum(z1 * z2) / count(*) AS c FROM z)
SELECT 1 AS component, 1 AS feature_position, round(a + c, 6) + 0.0 AS eigenvalue, CAST(1.0 AS DOUBLE) AS loading FROM m
UNION ALL SELECT 1, 2, round(a + c, 6) + 0.0, CAST(1.0 AS DOUBLE) FROM m
UNION ALL SELECT 2, 1, round(a - c, 6) + 0.0, CAST(-1.0 AS DOUBLE) FROM m
UNION ALL SELECT 2, 2, round(a - c, 6) + 0.0, CAST(1.0 AS DOUBLE) FROM m
"""

# --- nearest neighbours ---------------------------------------------------------------------

KNN_K = 5
KNN_QUERY_YEAR = 2001


def _knn_pairs(features: list[str], metric: str) -> str:
    if metric == "euclidean":
        dist = "sqrt(" + " + ".join(f"(q.{f} - t.{f}) * (q.{f} - t.{f})" for f in features) + ")"
    else:
        dist = " + ".join(f"abs(q.{f} - t.{f})" for f in features)
    return (
        "WITH "
        + ORDER_FEATURES_CTE
        + f""",
t AS (SELECT * FROM of WHERE year(o_orderdate) < {KNN_QUERY_YEAR}),
q AS (SELECT * FROM of WHERE year(o_orderdate) >= {KNN_QUERY_YEAR}),
p AS (SELECT q.o_orderkey AS query_id, t.o_orderkey AS train_id, t.o_totalprice AS y, {dist} AS d FROM q, t),
nb AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, train_id) AS INTEGER) AS rn FROM p
       QUALIFY rn <= {KNN_K})"""
    )


def _knn_prediction(features: list[str], metric: str, weighting: str) -> str:
    if weighting == "uniform":
        pred = "avg(y)"
    else:
        pred = (
            "CASE WHEN count(*) FILTER (WHERE d = 0) > 0 THEN avg(y) FILTER (WHERE d = 0) "
            "WHEN sum(1.0 / d) FILTER (WHERE d > 0) <> 0 "
            "THEN sum((1.0 / d) * y) FILTER (WHERE d > 0) / sum(1.0 / d) FILTER (WHERE d > 0) ELSE 0.0 END"
        )
    return _knn_pairs(features, metric) + f"\nSELECT query_id, round({pred}, 4) + 0.0 AS prediction FROM nb GROUP BY query_id"


KNN_NEIGHBOURS = _knn_pairs(["n_lines", "sum_qty"], "euclidean") + (
    "\nSELECT query_id, rn AS rank, train_id, round(d, 6) + 0.0 AS distance FROM nb"
)

# --- gradient descent (recursive CTE: one weight row per iteration) ---------------------


def _gd_simple(data: str, features: list[str], target: str, lr: float, iterations: int, logistic: bool) -> str:
    d = len(features)
    ws = [f"w{i}" for i in range(d + 1)]
    z = " + ".join(["1.0 * w0"] + [f"{f} * w{i + 1}" for i, f in enumerate(features)])
    pred = f"1.0 / (1.0 + exp(-({z})))" if logistic else f"({z})"
    q = "least(greatest(p, 1e-7), 1.0 - 1e-7)"
    loss = f"avg(-{target} * ln({q}) - (1.0 - {target}) * ln(1.0 - {q}))" if logistic else "avg(e * e)"
    upd = [f"w0 - {lr} * sum(e) / count(*)"] + [
        f"w{i + 1} - {lr} * sum(e * {f}) / count(*)" for i, f in enumerate(features)
    ]
    zero = ", ".join("CAST(0.0 AS DOUBLE)" for _ in ws)
    return f"""
{data},
gd(it, {", ".join(ws)}, loss) AS (
  SELECT 0, {zero}, CAST(NULL AS DOUBLE)
  UNION ALL
  SELECT it + 1, {", ".join(upd)}, {loss}
  FROM (SELECT a.*, p - {target} AS e
        FROM (SELECT g.it, {", ".join("g." + w for w in ws)}, s.*, {pred} AS p
              FROM gd g, sample s WHERE g.it < {iterations}) a) b
  GROUP BY it, {", ".join(ws)})"""


LINEAR_FEATURES = ["n_lines", "sum_qty", "sum_price"]
LINEAR_LR, LINEAR_ITERATIONS = 0.1, 300

_LINEAR_DATA = (
    "WITH RECURSIVE "
    + ORDER_FEATURES_CTE
    + ", sample AS (SELECT o_orderkey AS id, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}" for c in LINEAR_FEATURES)
    + ", o_totalprice / 1000.0 AS price_k FROM of)"
)
_LINEAR_GD = _gd_simple(_LINEAR_DATA, LINEAR_FEATURES, "price_k", LINEAR_LR, LINEAR_ITERATIONS, False)


def _weights_select(n_weights: int, iterations: int) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {i} AS weight_position, round(w{i}, 6) + 0.0 AS weight FROM gd WHERE it = {iterations}"
        for i in range(n_weights)
    )


LINEAR_WEIGHTS = _LINEAR_GD + "\n" + _weights_select(len(LINEAR_FEATURES) + 1, LINEAR_ITERATIONS)
LINEAR_PREDICT = (
    _LINEAR_GD
    + "\nSELECT s.id AS o_orderkey, round("
    + " + ".join(["1.0 * g.w0"] + [f"s.{f} * g.w{i + 1}" for i, f in enumerate(LINEAR_FEATURES)])
    + f", 6) + 0.0 AS prediction FROM sample s, gd g WHERE g.it = {LINEAR_ITERATIONS}"
)
LINEAR_LOSS = _LINEAR_GD + (
    "\nSELECT CAST(it - 1 AS INTEGER) AS iteration, round(loss, 4) + 0.0 AS loss FROM gd "
    "WHERE it >= 1 AND (it - 1) % 100 = 0"
)

DOC_FEATURES = ["n_chars", "n_spaces"]
LOGISTIC_LR, LOGISTIC_ITERATIONS = 0.1, 150

_DOCS = """
docs AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars,
                CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS n_spaces
         FROM documents),
ld AS (SELECT d.*, CAST(l.quality AS DOUBLE) AS quality FROM docs d JOIN labels l ON d.doc_id = l.doc_id)"""

_LOGISTIC_DATA = (
    "WITH RECURSIVE "
    + _DOCS
    + ", sample AS (SELECT doc_id AS id, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}" for c in DOC_FEATURES)
    + ", quality FROM ld)"
)
_LOGISTIC_GD = _gd_simple(_LOGISTIC_DATA, DOC_FEATURES, "quality", LOGISTIC_LR, LOGISTIC_ITERATIONS, True)
LOGISTIC_WEIGHTS = _LOGISTIC_GD + "\n" + _weights_select(len(DOC_FEATURES) + 1, LOGISTIC_ITERATIONS)
LOGISTIC_PREDICT = (
    _LOGISTIC_GD
    + "\nSELECT s.id AS doc_id, round(1.0 / (1.0 + exp(-("
    + " + ".join(["1.0 * g.w0"] + [f"s.{f} * g.w{i + 1}" for i, f in enumerate(DOC_FEATURES)])
    + f"))), 6) + 0.0 AS prediction FROM sample s, gd g WHERE g.it = {LOGISTIC_ITERATIONS}"
)
LOGISTIC_LOSS = _LOGISTIC_GD + (
    "\nSELECT CAST(it - 1 AS INTEGER) AS iteration, round(loss, 6) + 0.0 AS loss FROM gd "
    "WHERE it >= 1 AND (it - 1) % 100 = 0"
)

SIGMOID = (
    "WITH "
    + _DOCS
    + """
SELECT doc_id, round(1.0 / (1.0 + exp(-((n_chars - avg(n_chars) OVER ()) / stddev_samp(n_chars) OVER ()))), 6) + 0.0 AS score
FROM docs"""
)

LOG_LOSS = (
    "WITH "
    + _DOCS
    + """,
p AS (SELECT doc_id, quality,
             least(greatest(1.0 / (1.0 + exp(-((n_chars - avg(n_chars) OVER ()) / stddev_samp(n_chars) OVER ()))), 1e-7), 1.0 - 1e-7) AS q
      FROM ld)
SELECT doc_id, round(-quality * ln(q) - (1.0 - quality) * ln(1.0 - q), 6) + 0.0 AS loss FROM p"""
)

# --- wide vectors: centroids and weights as lists -----------------------------------------

EMBEDDING_K, EMBEDDING_MAX_ITER = 8, 200
EMBEDDING_LR, EMBEDDING_ITERATIONS = 0.5, 40

_NEAREST = "list_position(list_transform({c}, lambda x: list_distance(p.v, x)), list_min(list_transform({c}, lambda x: list_distance(p.v, x))))"
KMEANS_EMBEDDINGS = f"""
WITH RECURSIVE
pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ranked AS (SELECT v, row_number() OVER (ORDER BY id) - 1 AS rk FROM pts),
cnt AS (SELECT count(*) AS n FROM pts),
lcg(i, s) AS (
  SELECT 0, CAST({KMEANS_SEED} AS BIGINT)
  UNION ALL
  SELECT i + 1, (1664525 * s + 1013904223) % 4294967296 FROM lcg WHERE i < {EMBEDDING_K}),
picks AS (SELECT i AS cluster, s % n AS rk FROM lcg, cnt WHERE i >= 1),
km(it, cents, moved) AS (
  SELECT 0, (SELECT list(v ORDER BY cluster) FROM picks JOIN ranked USING (rk)), CAST('inf' AS DOUBLE)
  UNION ALL
  SELECT it + 1, new, list_sum(list_transform(range(1, {EMBEDDING_K + 1}), lambda i: list_distance(cents[i], new[i])))
  FROM (SELECT it, cents, list_transform(range(1, {EMBEDDING_K + 1}), lambda i: coalesce(means[i], cents[i])) AS new
        FROM (SELECT it, cents, map(list(cl), list(mean)) AS means
              FROM (SELECT it, cents, cl, list(m ORDER BY j) AS mean
                    FROM (SELECT it, cents, cl, j, avg(x) AS m
                          FROM (SELECT it, cents, cl, unnest(v) AS x, generate_subscripts(v, 1) AS j
                                FROM (SELECT k.it, k.cents, p.v, {_NEAREST.format(c="k.cents")} AS cl
                                      FROM km k, pts p
                                      WHERE k.moved > {KMEANS_TOL} AND k.it < {EMBEDDING_MAX_ITER}) a) b
                          GROUP BY it, cents, cl, j) c
                    GROUP BY it, cents, cl) d
              GROUP BY it, cents) e) f),
fitted AS (SELECT cents FROM km WHERE moved <= {KMEANS_TOL})
SELECT p.id AS vec_id, CAST({_NEAREST.format(c="f.cents")} - 1 AS INTEGER) AS cluster FROM pts p, fitted f"""

LOGISTIC_EMBEDDINGS = f"""
WITH RECURSIVE
sample AS (SELECT list_prepend(CAST(1.0 AS DOUBLE), CAST(embedding AS DOUBLE[])) AS v, label / (label + 1.0) AS y
           FROM embeddings WHERE label IS NOT NULL),
gd(it, w) AS (
  SELECT 0, (SELECT list_transform(any_value(v), lambda x: CAST(0.0 AS DOUBLE)) FROM sample)
  UNION ALL
  SELECT it + 1, list(w[j] - {EMBEDDING_LR} * g ORDER BY j)
  FROM (SELECT it, w, j, sum(e * x) / count(*) AS g
        FROM (SELECT it, w, e, unnest(v) AS x, generate_subscripts(v, 1) AS j
              FROM (SELECT g.it, g.w, s.v, 1.0 / (1.0 + exp(-list_dot_product(g.w, s.v))) - s.y AS e
                    FROM gd g, sample s WHERE g.it < {EMBEDDING_ITERATIONS}) a) b
        GROUP BY it, w, j) c
  GROUP BY it, w)
SELECT CAST(j - 1 AS INTEGER) AS weight_position, round(x, 6) + 0.0 AS weight
FROM (SELECT unnest(w) AS x, generate_subscripts(w, 1) AS j FROM gd WHERE it = {EMBEDDING_ITERATIONS}) u"""

ORACLE: dict[str, str] = {
    "kmeans_embeddings": KMEANS_EMBEDDINGS,
    "logistic_embeddings": LOGISTIC_EMBEDDINGS,
    "check_matrix": CHECK_MATRIX,
    "check_targets": CHECK_TARGETS,
    "check_logistic_targets": CHECK_LOGISTIC_TARGETS,
    "check_variance": CHECK_VARIANCE,
    "column_moments": COLUMN_MOMENTS,
    "standardise": STANDARDISE,
    "covariance_matrix": COVARIANCE_MATRIX,
    "distance_euclidean": _to_class_centre("euclidean"),
    "distance_manhattan": _to_class_centre("manhattan"),
    "pairwise_euclidean": _to_class_centre("euclidean"),
    "pairwise_manhattan": _to_class_centre("manhattan"),
    "distance_join": DISTANCE_JOIN,
    "kmeans_centroids": KMEANS_CENTROIDS,
    "kmeans_predict": KMEANS_PREDICT,
    "pca_transform": PCA_TRANSFORM,
    "pca_components": PCA_COMPONENTS,
    "knn_neighbours": KNN_NEIGHBOURS,
    "knn_uniform": _knn_prediction(["n_lines", "sum_qty"], "euclidean", "uniform"),
    "knn_distance": _knn_prediction(["n_lines", "sum_qty"], "euclidean", "distance"),
    "knn_exact_match": _knn_prediction(["n_lines"], "euclidean", "distance"),
    "knn_manhattan": _knn_prediction(["n_lines", "sum_qty"], "manhattan", "distance"),
    "linear_weights": LINEAR_WEIGHTS,
    "linear_predict": LINEAR_PREDICT,
    "linear_loss": LINEAR_LOSS,
    "sigmoid": SIGMOID,
    "log_loss": LOG_LOSS,
    "logistic_weights": LOGISTIC_WEIGHTS,
    "logistic_predict": LOGISTIC_PREDICT,
    "logistic_loss": LOGISTIC_LOSS,
}
