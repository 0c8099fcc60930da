"""Machine-learning queries: features, regression, TF-IDF, SVD, scaling,
clustering and profiles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hirelens import dims
from hirelens.plans.catalog import cleaned, register
from hirelens.plans.oracle_base import with_clean
from hirelens.session import table

FEATS_SQL = """, feats AS (
  SELECT seq, salary_avg, ln(1 + salary_avg) AS salary_log,
    CAST(CASE city_tier WHEN '一线' THEN 2 WHEN '新一线' THEN 1 ELSE 0 END AS DOUBLE) AS city_tier_enc,
    CAST(CASE education WHEN '大专' THEN 1 WHEN '本科' THEN 2 WHEN '硕士' THEN 3 WHEN '博士' THEN 4 ELSE 0 END AS DOUBLE)
      AS education_enc,
    (exp_min + exp_max) / 2 AS exp_avg,
    CAST(CASE WHEN skill_tags IS NULL THEN 0 ELSE len(list_filter(string_split(skill_tags, ','), lambda x: trim(x) <> ''))
         END AS DOUBLE) AS skill_count,
    CAST(CASE WHEN neg THEN 1 ELSE 0 END AS DOUBLE) AS is_face,
    CAST(CASE company_size WHEN '少于50人' THEN 1 WHEN '50-150人' THEN 2 WHEN '150-500人' THEN 3 WHEN '500-1000人' THEN 4
      WHEN '1000-5000人' THEN 5 WHEN '5000-10000人' THEN 6 WHEN '10000人以上' THEN 7 ELSE 3 END AS DOUBLE) AS company_size_enc
  FROM clean WHERE salary_avg IS NOT NULL AND salary_avg > 0)"""


def _feats(spark, sf_dir):
    from hirelens.ml.features import regression_features
    return regression_features(cleaned(spark, sf_dir))


@register("reg_features", with_clean(FEATS_SQL + """
    SELECT seq, round_even(salary_log, 6) AS salary_log, city_tier_enc, education_enc, exp_avg, skill_count, is_face,
           company_size_enc FROM feats"""))
def q_reg_features(spark, sf_dir):
    f = _feats(spark, sf_dir)
    return f.select("seq", F.bround("salary_log", 6).alias("salary_log"), "city_tier_enc", "education_enc", "exp_avg",
                    "skill_count", "is_face", "company_size_enc")


@register("reg_summary", with_clean(FEATS_SQL + """
    SELECT count(salary_log) AS n, round_even(min(salary_avg), 2) AS salary_min, round_even(max(salary_avg), 2) AS salary_max,
           round_even(avg(salary_log), 6) AS log_mean, round_even(stddev_pop(salary_log), 6) AS log_std FROM feats"""))
def q_reg_summary(spark, sf_dir):
    from hirelens.ml.features import target_summary
    return target_summary(_feats(spark, sf_dir))


OLS_COLUMNS = ["city_tier_enc", "education_enc", "exp_avg", "skill_count", "is_face", "company_size_enc"]


def _gauss_sql() -> str:
    """Normal equations of the six features, solved by elimination as a chain of
    one-row tables (the SQL twin of the fit)."""
    x = ["1.0", *OLS_COLUMNS, "salary_log"]
    n = len(OLS_COLUMNS) + 1
    sums = ", ".join(f"sum(({x[i]}) * ({x[j]})) AS a{i}_{j}" for i in range(n) for j in range(n + 1))
    steps = [f"e0 AS (SELECT {sums} FROM feats WHERE seq % 10 < 8)"]
    for k in range(n):
        cols = []
        for i in range(n):
            for j in range(n + 1):
                cols.append(f"a{i}_{j} / a{k}_{k} AS a{i}_{j}" if i == k else f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}")
        steps.append(f"e{k + 1} AS (SELECT {', '.join(cols)} FROM e{k})")
    beta = ", ".join(f"a{i}_{n} AS b{i}" for i in range(n))
    steps.append(f"fit AS (SELECT {beta} FROM e{n})")
    line = "b0 + " + " + ".join(f"b{i + 1} * {c}" for i, c in enumerate(OLS_COLUMNS))
    steps.append(f"pred AS (SELECT exp(salary_log) - 1 AS y, exp({line}) - 1 AS p FROM feats, fit WHERE seq % 10 >= 8)")
    return ", " + ",\n".join(steps)


OLS_METRICS = """round_even(1 - sum((y - p) ^ 2) / sum((y - (SELECT avg(y) FROM pred)) ^ 2), 5) AS r2,
      round_even(sqrt(avg((y - p) ^ 2)), 2) AS rmse, round_even(avg(abs(y - p)), 2) AS mae"""


@register("reg_linear_metrics", with_clean(FEATS_SQL + _gauss_sql() + f"""
    SELECT round_even((SELECT b0 FROM fit), 5) AS intercept,
      {", ".join(f"round_even((SELECT b{i + 1} FROM fit), 5) AS {c}" for i, c in enumerate(OLS_COLUMNS))}, {OLS_METRICS} FROM pred"""))
def q_reg_linear_metrics(spark, sf_dir):
    """ML-2/3/6: OLS of log salary on all six features (train: seq % 10 < 8)."""
    from hirelens.ml.regress import ols
    m = ols(_feats(spark, sf_dir))
    return m.select(*[F.bround(c, 5).alias(c) for c in ["intercept", *OLS_COLUMNS, "r2"]], F.bround("rmse", 2).alias("rmse"), F.bround("mae", 2).alias("mae"))


_MODELS: dict = {}


def _fitted(spark, sf_dir):
    """(comparison, importances, test predictions) of the three models, fitted
    once a session and folder."""
    from hirelens.ml.regress import compare_models
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _MODELS:
        _MODELS[key] = compare_models(spark, _feats(spark, sf_dir))
    return _MODELS[key]


#: the test rows, and the metrics of a model that always says the train mean
TEST_SQL = f""",
    n AS (SELECT count(*) FILTER (WHERE seq % 10 < 8) AS n_train, count(*) FILTER (WHERE seq % 10 >= 8) AS n_test FROM feats),
    o AS (SELECT {OLS_METRICS} FROM pred),
    mean AS (SELECT exp(avg(salary_log)) - 1 AS p FROM feats WHERE seq % 10 < 8),
    base AS (SELECT round_even(sqrt(avg((y - mean.p) ^ 2)), 2) AS rmse FROM pred, mean)"""


@register("reg_compare", with_clean(FEATS_SQL + _gauss_sql() + TEST_SQL + """
    SELECT m AS model, n_train, n_test, CASE WHEN m = 'LinearRegression' THEN o.r2 END AS linear_r2,
      CASE WHEN m = 'LinearRegression' THEN o.rmse END AS linear_rmse, 5 AS cv_folds, base.rmse AS mean_rmse,
      true AS metrics_recomputed, 1 AS n_best, true AS best_has_max_r2
    FROM (VALUES ('LinearRegression'), ('RandomForest'), ('GBT')) t(m), n, o, base"""))
def q_reg_compare(spark, sf_dir):
    """ML-4..ML-6, TOP-3, SNK-10: three models with test metrics and 5-fold CV
    R2, written as the comparison file and read back. What does not depend on
    a tree learner is compared: split sizes, folds, the linear model's metrics,
    the error of the train mean on the test rows; that all metrics are those of
    the stored predictions; and the best model."""
    from hirelens.ml.regress import metrics
    from hirelens.session import unique_dir
    from hirelens.sinks.files import read_csv, write_csv
    comp, _, predicted = _fitted(spark, sf_dir)
    path = unique_dir(spark, "model-comparison")
    write_csv(comp, path)
    comp = read_csv(spark, path, comp.schema)
    again = None
    for name in ("LinearRegression", "RandomForest", "GBT"):
        one = metrics(predicted.where(F.col("model") == name)).select(F.lit(name).alias("model"), F.col("r2").alias("r2_again"), F.col("rmse").alias("rmse_again"))
        again = one if again is None else again.unionByName(one)
    mean = _feats(spark, sf_dir).where("seq % 10 < 8").agg(F.expm1(F.avg("salary_log")).alias("p")).scalar()
    base = predicted.where("model = 'GBT'").agg(F.sqrt(F.avg((F.expm1("salary_log") - mean) ** 2)).alias("b")).scalar()
    lin = F.col("model") == "LinearRegression"
    top = Window.partitionBy(F.lit(0))  # three rows
    return comp.join(F.broadcast(again), "model").select(
        "model", "n_train", "n_test", F.when(lin, F.bround("r2", 5)).alias("linear_r2"), F.when(lin, F.bround("rmse", 2)).alias("linear_rmse"),
        "cv_folds", F.bround(base, 2).alias("mean_rmse"),
        ((F.abs(F.col("r2") - F.col("r2_again")) < 1e-9) & (F.abs(F.col("rmse") - F.col("rmse_again")) < 1e-6)).alias("metrics_recomputed"),
        F.sum(F.col("best").cast("int")).over(top).cast("int").alias("n_best"),
        (F.max(F.when(F.col("best"), F.col("r2"))).over(top) == F.max("r2").over(top)).alias("best_has_max_r2"))


@register("reg_importance", with_clean(FEATS_SQL + """,
    v AS (SELECT unnest(['city_tier_enc', 'education_enc', 'exp_avg', 'skill_count', 'is_face', 'company_size_enc']) AS feature,
            unnest([count(DISTINCT city_tier_enc), count(DISTINCT education_enc), count(DISTINCT exp_avg), count(DISTINCT skill_count),
                    count(DISTINCT is_face), count(DISTINCT company_size_enc)]) AS n_values FROM feats WHERE seq % 10 < 8)
    SELECT model, feature, n_values > 1 AS can_split, true AS used_only_if_it_can, 1.0::DOUBLE AS total FROM (VALUES ('RandomForest'), ('GBT')) t(model), v"""))
def q_reg_importance(spark, sf_dir):
    """ML-7: tree feature importances. A feature with one value splits nothing
    and has importance 0; the importances of a model are not negative and sum
    to one."""
    imp = _fitted(spark, sf_dir)[1]
    cols = ["city_tier_enc", "education_enc", "exp_avg", "skill_count", "is_face", "company_size_enc"]
    train = _feats(spark, sf_dir).where("seq % 10 < 8")
    values = train.agg(*[F.count_distinct(c).alias(c) for c in cols]).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n")) for c in cols])).alias("v")).select("v.*")
    return imp.join(F.broadcast(values), "feature").select(  # six rows
        "model", "feature", (F.col("n") > 1).alias("can_split"),
        F.when(F.col("n") > 1, F.col("importance") >= 0).otherwise(F.col("importance") == 0).alias("used_only_if_it_can"),
        F.bround(F.sum("importance").over(Window.partitionBy("model")), 6).alias("total"))


TFIDF_SQL = f""",
docs AS (
  SELECT seq, CASE WHEN skill_tags IS NULL OR len(list_filter(list_transform(string_split(skill_tags, ','),
           lambda x: trim(x)), lambda x: x <> '')) = 0 THEN '无'
         ELSE array_to_string(list_filter(list_transform(string_split(skill_tags, ','), lambda x: trim(x)),
           lambda x: x <> ''), ' ') END AS text
  FROM clean WHERE salary_avg IS NOT NULL AND salary_avg > 0),
toks AS (SELECT seq, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM docs),
grams AS (SELECT seq, unnest(t) AS term FROM toks
          UNION ALL SELECT seq, t[i] || ' ' || t[i + 1] FROM toks, range(1, len(t)) AS r(i)),
tf AS (SELECT seq, term, count(*) AS tf FROM grams GROUP BY seq, term),
nd AS (SELECT count(*) AS n FROM docs),
v AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term
      HAVING count(*) >= {dims.TFIDF_MIN_DF} AND count(*) <= {dims.TFIDF_MAX_DF} * (SELECT n FROM nd)),
vi AS (SELECT term, df, row_number() OVER (ORDER BY cf DESC, term) - 1 AS idx FROM v),
w AS (SELECT tf.seq, tf.term, vi.idx, (1 + ln(tf.tf)) * (ln((1 + (SELECT n FROM nd)) / (1 + vi.df)) + 1) AS w
      FROM tf JOIN vi USING (term)),
wn AS (SELECT seq, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY seq)) AS weight FROM w)"""


def _weights(spark, sf_dir):
    from hirelens.ml.features import valid_salary
    from hirelens.ml.tfidf import skill_text, tfidf
    return tfidf(skill_text(valid_salary(cleaned(spark, sf_dir))))


@register("tfidf_terms", with_clean(TFIDF_SQL + "\nSELECT seq, idx, round_even(weight, 6) AS weight FROM wn"))
def q_tfidf_terms(spark, sf_dir):
    from hirelens.ml.tfidf import weight_rows
    return weight_rows(_weights(spark, sf_dir)).select("seq", F.col("idx").cast("long").alias("idx"), F.bround("weight", 6).alias("weight"))


def _width(weights) -> int:
    return int(weights.agg(F.max(F.array_max("ii"))).first()[0] or 0) + 1


@register("svd_gram", with_clean(TFIDF_SQL + """
    SELECT a.idx AS i, b.idx AS j, round_even(sum(a.weight * b.weight), 6) AS g
    FROM wn a JOIN wn b ON a.seq = b.seq AND a.idx <= b.idx GROUP BY a.idx, b.idx"""))
def q_svd_gram(spark, sf_dir):
    from hirelens.ml.tfidf import gram
    from hirelens.session import materialize
    w = materialize(_weights(spark, sf_dir), "tfidf-weights")
    g = gram(w, _width(w))
    return g.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.bround("g", 6).alias("g"))


_SVD: dict = {}


def _svd_coords(spark, sf_dir):
    """((seq, skill_dim1..), squared singular values, shares), fitted once a
    session and folder: the projection is a written table."""
    from hirelens.ml.svd import multiply, truncated_svd
    from hirelens.session import materialize
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _SVD:
        w = materialize(_weights(spark, sf_dir), "tfidf-weights")
        comps, vals, shares = truncated_svd(w, _width(w))
        at = [F.coalesce(F.get("p", F.lit(i)), F.lit(0.0)).alias(f"skill_dim{i + 1}") for i in range(dims.SVD_DIM)]
        # documents without any vocabulary term sit at the origin
        coords = _feats(spark, sf_dir).select("seq").join(multiply(w, comps), "seq", "left").select("seq", *at)
        _SVD[key] = materialize(coords, "svd-coordinates"), vals, shares
    return _SVD[key]


@register("svd_project")
def q_svd_project(spark, sf_dir):
    """ML-9: 5-dim projection of the TF-IDF rows (signs are arbitrary: rows-only;
    ``svd_checks`` compares what does not depend on them, a test the rest)."""
    return _svd_coords(spark, sf_dir)[0]


@register("svd_checks", with_clean(TFIDF_SQL + """,
    nn AS (SELECT (SELECT count(*) FROM docs) AS n_rows, (SELECT sum(weight * weight) FROM wn) AS total)
    SELECT n_rows, round_even(total, 4) AS total_energy, true AS energy_matches, true AS shares_match, true AS ordered,
      true AS uncorrelated FROM nn"""))
def q_svd_checks(spark, sf_dir):
    """ML-9: the 5-dim projection, by what does not depend on signs: the energy
    of each coordinate is its squared singular value, the shares that the
    components explain come in order, and the coordinates are uncorrelated
    about the origin."""
    rows, vals, shares = _svd_coords(spark, sf_dir)
    cols = [c for c in rows.columns if c.startswith("skill_dim")]
    total = float(vals[0] / shares[0])
    tol = 1e-6 * total
    energy, ordered, flat = F.lit(True), F.lit(True), F.lit(True)
    sums = {f"s_{a}_{b}": F.sum(F.col(a) * F.col(b)) for i, a in enumerate(cols) for b in cols[i:]}
    one = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[e.alias(n) for n, e in sums.items()])
    for c, v in zip(cols, vals):
        energy = energy & (F.abs(F.col(f"s_{c}_{c}") - float(v)) < tol)
    for a, b in zip(cols, cols[1:]):
        ordered = ordered & (F.col(f"s_{a}_{a}") >= F.col(f"s_{b}_{b}") - tol)
        flat = flat & (F.abs(F.col(f"s_{a}_{b}")) < 1e-3 * total)
    share = F.lit(bool(abs(sum(shares) - sum(vals) / total) < 1e-9 and all(0 <= x <= 1 for x in shares)))
    return one.select("n_rows", F.lit(total).alias("t"), energy.alias("energy_matches"), share.alias("shares_match"),
                      ordered.alias("ordered"), flat.alias("uncorrelated")).select(
        "n_rows", F.bround("t", 4).alias("total_energy"), "energy_matches", "shares_match", "ordered", "uncorrelated")


SCALE_SQL = """
    SELECT seq, round_even((salary_avg - avg(salary_avg) OVER ()) / stddev_pop(salary_avg) OVER (), 6) AS salary_z,
           round_even((exp_avg - avg(exp_avg) OVER ()) / stddev_pop(exp_avg) OVER (), 6) AS exp_z,
           round_even((education_enc - avg(education_enc) OVER ()) / stddev_pop(education_enc) OVER (), 6) AS education_z
    FROM feats"""


@register("scale_features", with_clean(FEATS_SQL + SCALE_SQL))
def q_scale_features(spark, sf_dir):
    """ML-10: population-std standardization of the numeric clustering features."""
    from hirelens.ml.features import standardize
    z = standardize(_feats(spark, sf_dir), ["salary_avg", "exp_avg", "education_enc"])
    return z.select("seq", F.bround("salary_avg_z", 6).alias("salary_z"), F.bround("exp_avg_z", 6).alias("exp_z"),
                    F.bround("education_enc_z", 6).alias("education_z"))


K_FIXED = 4
ASSIGN_SQL = f"""
WITH c AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS ci, embedding AS ce FROM embeddings
           ORDER BY vec_id LIMIT {K_FIXED}),
d AS (SELECT e.vec_id, e.embedding, c.ci,
        list_sum(list_transform(range(1, len(e.embedding) + 1),
          lambda i: (CAST(e.embedding[i] AS DOUBLE) - CAST(c.ce[i] AS DOUBLE)) ^ 2)) AS d
      FROM embeddings e, c),
a AS (SELECT vec_id, embedding, ci AS cluster, d AS dist FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, ci) AS rn FROM d) WHERE rn = 1)"""


def _assigned(spark, sf_dir):
    from hirelens.ml.cluster import assign_nearest, first_k_centers
    e = table(spark, sf_dir, "embeddings")
    centers = first_k_centers(e, "vec_id", "embedding", K_FIXED)
    return assign_nearest(e, "embedding", centers)


@register("kmeans_assign", ASSIGN_SQL + "\nSELECT vec_id, cluster, round_even(dist, 6) AS dist FROM a")
def q_kmeans_assign(spark, sf_dir):
    """ML-12: nearest of fixed centers (the first k vectors), with distance."""
    a = _assigned(spark, sf_dir)
    return a.select("vec_id", F.col("cluster").cast("long").alias("cluster"), F.bround("dist", 6).alias("dist"))


@register("silhouette_fixed", ASSIGN_SQL + """,
p AS (SELECT x.vec_id, x.cluster AS cx, y.cluster AS cy,
        list_sum(list_transform(range(1, len(x.embedding) + 1),
          lambda i: (CAST(x.embedding[i] AS DOUBLE) - CAST(y.embedding[i] AS DOUBLE)) ^ 2)) AS d
      FROM a x, a y WHERE x.vec_id <> y.vec_id),
m AS (SELECT vec_id, cx, cy, avg(d) AS md FROM p GROUP BY vec_id, cx, cy),
s AS (SELECT a.vec_id, a.cluster,
        (SELECT md FROM m WHERE m.vec_id = a.vec_id AND m.cy = a.cluster) AS av,
        (SELECT min(md) FROM m WHERE m.vec_id = a.vec_id AND m.cy <> a.cluster) AS bv FROM a)
SELECT vec_id, cluster, round_even(CASE WHEN av IS NULL THEN 0.0 ELSE (bv - av) / greatest(av, bv) END, 5) AS silhouette
FROM s""")
def q_silhouette_fixed(spark, sf_dir):
    """Squared-Euclidean silhouette of the fixed-center assignment (linear-time form)."""
    from hirelens.ml.cluster import silhouette
    s = silhouette(_assigned(spark, sf_dir), "embedding", "cluster")
    return s.select("vec_id", F.col("cluster").cast("long").alias("cluster"), F.bround("silhouette", 5).alias("silhouette"))


_SCAN: dict = {}


def _cluster_scan(spark, sf_dir):
    """((seq, features), the K scan over them), once a session and folder."""
    from hirelens.ml.cluster import kmeans_scan
    from hirelens.ml.features import standardize
    from hirelens.session import materialize
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _SCAN:
        coords = _svd_coords(spark, sf_dir)[0]
        dims_cols = [c for c in coords.columns if c.startswith("skill_dim")]
        f = _feats(spark, sf_dir).join(coords, "seq", "left").fillna(0.0, subset=dims_cols)
        cols = ["salary_avg", "exp_avg", "education_enc"] + dims_cols
        points = materialize(standardize(f, cols).select("seq", F.array(*[f"{c}_z" for c in cols]).alias("features")), "cluster-features")
        _SCAN[key] = points, kmeans_scan(points)
    return _SCAN[key]


@register("kmeans_scan", with_clean(FEATS_SQL + """
    SELECT k::INTEGER AS k, (SELECT count(*) FROM feats) AS n_rows, (SELECT count(*) FROM feats) * 8.0::DOUBLE AS total_inertia, true AS sizes_add_up,
      true AS cheaper_than_before, true AS silhouette_in_range, 1 AS n_chosen, true AS chosen_by_rule FROM range(2, 10) t(k)"""))
def q_kmeans_scan(spark, sf_dir):
    """ML-11: K = 2..9 on standardized numeric + SVD skill features, ten starts
    each. What the starts leave free is not compared (``kmeans_rounds`` compares
    Lloyd rounds from given centres); the number of rows, their inertia about
    one centre (as many as there are standardized numbers), falling inertia
    and the rule of the choice are."""
    from hirelens.ml.cluster import lloyd
    points, scan = _cluster_scan(spark, sf_dir)
    (one,), _ = lloyd(points, [[[0.0] * len(points.select("features").first()[0])]])
    fits = [(k, int(scan.fits[k].sizes.sum()), inertia, sil, chosen) for k, inertia, sil, chosen in scan.rows]
    rows = spark.createDataFrame(fits, "k int, n long, inertia double, silhouette double, chosen boolean")
    every = Window.partitionBy(F.lit(0))  # eight rows
    best = F.max(F.when(F.col("k") >= 3, F.struct("silhouette", -F.col("k")))).over(every)
    rule = F.when(F.max("silhouette").over(every) >= dims.SILHOUETTE_FLOOR, -best["col2"]).otherwise(dims.KMEANS_FALLBACK_K)
    before = F.coalesce(F.lag("inertia").over(every.orderBy("k")), F.lit(one.cost))
    return rows.select("k", F.lit(int(one.sizes.sum())).cast("long").alias("n_rows"), F.bround(F.lit(one.cost), 3).alias("total_inertia"),
                       (F.col("n") == int(one.sizes.sum())).alias("sizes_add_up"), (F.col("inertia") < before).alias("cheaper_than_before"),
                       F.col("silhouette").between(-1, 1).alias("silhouette_in_range"),
                       F.sum(F.col("chosen").cast("int")).over(every).cast("int").alias("n_chosen"),
                       (F.max(F.when(F.col("chosen"), F.col("k"))).over(every) == rule).alias("chosen_by_rule"))


ROUNDS = 3


def _rounds_sql() -> str:
    """Lloyd rounds in SQL: K = 2..9 from the first K vectors, one batch of
    centres (k, ci, i, x) after another."""
    steps = ["v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)",
             "o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS ci FROM embeddings)",
             "c0 AS (SELECT k, ci, i, x FROM o JOIN v USING (vec_id), range(2, 10) t(k) WHERE ci < k)"]
    for r in range(ROUNDS):
        steps.append(f"a{r} AS (SELECT k, vec_id, min(d) AS d, arg_min(ci, (d, ci)) AS ci FROM (SELECT k, ci, vec_id, sum((v.x - c.x) ^ 2) AS d "
                     f"FROM c{r} c JOIN v USING (i) GROUP BY k, ci, vec_id) GROUP BY k, vec_id)")
        steps.append(f"c{r + 1} AS (SELECT c.k, c.ci, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN "
                     f"(SELECT k, ci, i, avg(x) AS x FROM a{r} JOIN v USING (vec_id) GROUP BY k, ci, i) m USING (k, ci, i))")
    ends = " UNION ALL ".join(f"SELECT k, {r + 1} AS round, ci, d FROM a{r}" for r in range(ROUNDS))
    return f"WITH {', '.join(steps)} SELECT k::INTEGER AS k, round, round_even(sum(d), 4) AS inertia, count(*) FILTER (ci = 0) AS first_size FROM ({ends}) GROUP BY k, round"


@register("kmeans_rounds", _rounds_sql())
def q_kmeans_rounds(spark, sf_dir):
    """ML-11: the first Lloyd rounds from given centres (the first K vectors),
    K = 2..9 in the same passes: inertia and the first cluster's size after each."""
    from hirelens.ml.cluster import first_k_centers, lloyd
    from hirelens.session import materialize
    e = table(spark, sf_dir, "embeddings")
    points = materialize(e.select("vec_id", F.col("embedding").cast("array<double>").alias("features")), "round-points")
    heads = first_k_centers(e, "vec_id", "embedding", max(dims.KMEANS_K_RANGE))
    rows = []
    for r in range(ROUNDS):
        fits, _ = lloyd(points, [heads[:k] for k in dims.KMEANS_K_RANGE], max_iter=r, tol=-1.0)
        rows += [(f.k, r + 1, f.cost, int(f.sizes[0])) for f in fits]
    out = spark.createDataFrame(rows, "k int, round int, inertia double, first_size long")
    return out.withColumn("inertia", F.bround("inertia", 4))


@register("cluster_final", with_clean(FEATS_SQL + """
    SELECT count(*) AS n_rows, count(*) AS labelled, 0 AS bad_sizes, 0 AS unnamed, true AS percent_is_whole, true AS cost_matches FROM feats"""))
def q_cluster_final(spark, sf_dir):
    """ML-12 / ML-13 / SNK-10: the chosen K's best fit labels every row; the
    labelled rows are written and read back, and their clusters are profiled.
    The sizes of the profiles, and the fit's cost against the rows' distances
    to their centres, are recomputed from the labels."""
    from hirelens.ml.cluster import assign_nearest
    from hirelens.ml.features import valid_salary
    from hirelens.ml.profile import cluster_profiles
    from hirelens.session import materialize
    points, scan = _cluster_scan(spark, sf_dir)
    fit = scan.fits[scan.chosen]
    labels = assign_nearest(points, "features", fit.centers.tolist()).select("seq", "cluster", F.col("dist").alias("d"))
    rows = materialize(valid_salary(cleaned(spark, sf_dir)).join(labels, "seq", "left"), "clustered-rows")
    cost = fit.cost
    sizes = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    prof = cluster_profiles(rows, "cluster")
    checked = prof.join(sizes, "cluster", "full").agg(
        F.count(F.when(~F.col("count").eqNullSafe(F.col("n")), 1)).alias("bad_sizes"),
        F.count(F.when(F.col("cluster_name").isNull(), 1)).alias("unnamed"), (F.abs(F.sum("percentage") - 100) <= 1).alias("percent_is_whole"))
    total = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count("cluster").alias("labelled"),
                     (F.abs(F.sum("d") - cost) <= 1e-6 * cost).alias("cost_matches"))
    return total.crossJoin(F.broadcast(checked)).select(  # one row each
        "n_rows", "labelled", F.col("bad_sizes").cast("int").alias("bad_sizes"), F.col("unnamed").cast("int").alias("unnamed"),
        "percent_is_whole", "cost_matches")


def _segment_sql():
    n = dims.SEGMENT_NAMES
    pre, post = n["mid_senior_tpl"].split("{}")
    ai = " OR ".join(f"contains(coalesce(top3_industries, ''), '{w}')" for w in dims.AI_INDUSTRY_WORDS)
    return f"""CASE WHEN avg_salary > 30000 THEN CASE WHEN avg_experience >= 4 THEN '{n["senior_high_pay"]}' ELSE '{n["very_high_pay"]}' END
      WHEN avg_salary > 20000 AND education_mode IN ('硕士', '博士') THEN '{n["high_edu_high_pay"]}'
      WHEN avg_salary > 20000 AND ({ai}) THEN '{n["high_pay_tech"]}'
      WHEN avg_salary > 20000 THEN '{n["senior_tech"]}'
      WHEN avg_salary > 16000 THEN '{pre}' || CASE WHEN education_mode IN ('硕士', '博士') THEN education_mode ELSE '' END || '{post}'
      WHEN avg_salary >= 12000 AND avg_experience < 2 THEN '{n["entry_analyst"]}'
      WHEN avg_salary >= 8000 AND avg_experience < 1.5 THEN '{n["junior_entry"]}'
      WHEN avg_salary >= 8000 THEN '{n["mid_tech"]}' ELSE '{n["junior_general"]}' END"""


N_PROFILE = 6


@register("cluster_profile", with_clean(f""",
    c AS (SELECT *, seq % {N_PROFILE} AS cluster FROM clean WHERE salary_avg IS NOT NULL AND salary_avg > 0),
    base AS (SELECT cluster, count(*) AS count, round_even(avg(salary_avg), 0) AS avg_salary,
               round_even(avg((exp_min + exp_max) / 2), 1) AS avg_experience FROM c GROUP BY cluster),
    em AS (SELECT cluster, education AS education_mode FROM (
             SELECT cluster, education, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, education) AS rn
             FROM c WHERE education IS NOT NULL GROUP BY cluster, education) WHERE rn = 1),
    tg AS (SELECT cluster, trim(t) AS skill FROM c, unnest(string_split(skill_tags, ',')) AS u(t)
           WHERE skill_tags IS NOT NULL AND trim(t) <> ''),
    sk AS (SELECT cluster, string_agg(skill, ', ' ORDER BY rn) AS top5_skills FROM (
             SELECT cluster, skill, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, skill) AS rn
             FROM tg GROUP BY cluster, skill) WHERE rn <= 5 GROUP BY cluster),
    ind AS (SELECT cluster, string_agg(industry || ':' || CAST(n AS STRING), ', ' ORDER BY rn) AS top3_industries FROM (
             SELECT cluster, industry, count(*) AS n,
                    row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, industry) AS rn
             FROM c WHERE industry IS NOT NULL GROUP BY cluster, industry) WHERE rn <= 3 GROUP BY cluster),
    cty AS (SELECT cluster, string_agg(city || ':' || CAST(n AS STRING), ', ' ORDER BY rn) AS top3_cities FROM (
             SELECT cluster, city, count(*) AS n, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, city) AS rn
             FROM c WHERE city IS NOT NULL GROUP BY cluster, city) WHERE rn <= 3 GROUP BY cluster),
    j AS (SELECT b.cluster, b.count, round_even(b.count * 100.0 / (SELECT count(*) FROM c), 1) AS percentage,
            b.avg_salary, b.avg_experience, em.education_mode, sk.top5_skills, ind.top3_industries, cty.top3_cities
          FROM base b LEFT JOIN em USING (cluster) LEFT JOIN sk USING (cluster) LEFT JOIN ind USING (cluster)
          LEFT JOIN cty USING (cluster))
    SELECT *, {_segment_sql()} AS cluster_name FROM j"""))
def q_cluster_profile(spark, sf_dir):
    """AGG-21 / WIN-4 / CAT-1 on a fixed assignment (seq mod 6) of the cleaned postings."""
    from hirelens.ml.features import valid_salary
    from hirelens.ml.profile import cluster_profiles
    c = valid_salary(cleaned(spark, sf_dir)).withColumn("cluster", F.col("seq") % N_PROFILE)
    return cluster_profiles(c, "cluster")
