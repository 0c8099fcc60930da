"""Plans whose memory or tasks must not depend on what Spark guesses."""

from pyspark.sql import functions as F


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def texts(spark, n=40):
    rows = [(i, " ".join(f"w{(i // 2 * 7 + j) % 50}" for j in range(30))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string")


# ------------------------------------------------------------------ F1, F2
def test_simhash_builds_no_table_on_the_driver(spark):
    from hirelens.llm import simhash
    docs = texts(spark)
    fps = simhash.fingerprints(docs).select("fp").distinct()
    near = simhash.near_duplicates(docs)
    kept = simhash.keep_first(docs)
    for df in (simhash.linked(fps), near, kept):
        assert "Broadcast" not in plan(df), plan(df)
    assert near.select("component").distinct().count() == kept.count() <= 20


def test_components_builds_no_table_on_the_driver(spark):
    from hirelens.llm.common import components
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 9)], "a long, b long")
    got = components(edges)
    assert "Broadcast" not in plan(got)
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1), (3, 1), (7, 7), (9, 7)]


# ------------------------------------------------------------------ F13
def test_payloads_are_parsed_once_per_level(spark):
    """A page's text is parsed into a map once, an item's too."""
    from hirelens.sources.payload import explode_items, project_list_items
    pages = spark.createDataFrame([
        (1, '{"engine_search_result":[{"jobName":" a ","salary":"1-2万","workarea":"上海-浦东"},{"jobName":""}]}'),
        (2, '{"resultbody":{"job":{"items":[{"job_name":"b","degree":"本科"}]}}}'),
        (3, '{"resultbody":{"items":[{"jobTitle":"c"}]}}'),
        (4, '{"engine_search_result":[],"data":[{"jobName":"d","tags":["x","y"]}]}'),
        (5, "no json"), (6, None), (7, "{}"), (8, '{"resultbody":"text","list":[{"jobName":"e"}]}')], "page long, payload string")
    rows = project_list_items(explode_items(pages))
    got = {r["page"]: (r["pos"], r["job_title"], r["salary_min"], r["city"], r["education"], r["skill_tags"]) for r in rows.collect()}
    assert got == {1: (0, "a", 10000.0, "上海", "不限", ""), 2: (0, "b", None, "未知", "本科", ""), 3: (0, "c", None, "未知", "不限", ""),
                   4: (0, "d", None, "未知", "不限", "x, y"), 8: (0, "e", None, "未知", "不限", "")}
    parses = rows._jdf.queryExecution().optimizedPlan().toString().lower().count("from_json(") \
        + rows._jdf.queryExecution().optimizedPlan().toString().lower().count("jsontostructs(")
    assert parses <= 6, parses  # three levels of a page, its list, an item, the item's tags


# ------------------------------------------------------------------ F17
def test_stream_state_has_the_partitions_asked_for(spark, tmp_path):
    import glob

    from hirelens.streaming.jobs import stream_dedup_within
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-02 00:00:00"), (2, "2024-01-01 00:00:00")], "k long, ts string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/drops")
    out = stream_dedup_within(spark, f"{tmp_path}/drops", rows.schema, f"{tmp_path}/work", 1, ["k"], "ts", "2 days", 3)
    assert sorted(r["k"] for r in out.select("k").collect()) == [1, 2]
    state = [p for p in glob.glob(f"{tmp_path}/work/checkpoint/state/0/*") if p.rsplit("/", 1)[1].isdigit()]
    assert len(state) == 3 and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_once_keeps_order_and_evaluates_once(spark):
    from hirelens.session import once
    df = spark.createDataFrame([(1, "a"), (None, None)], "x long, s string")
    got = once(df, s=F.upper("s"), y=F.col("x") + 1)
    assert got.columns == ["x", "s", "y"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "A", 2), (None, None, None)]


# ------------------------------------------------------------------ F3, F4
def test_the_forest_remembers_the_nodes_of_its_rows(spark):
    """Same trees as without, and asked for by the settings."""
    from hirelens.ml.features import FEATURES
    from hirelens.ml.regress import assemble, models
    rows = spark.range(400).select("id", *[((F.col("id") * (i + 3)) % (i + 2)).cast("double").alias(c) for i, c in enumerate(FEATURES)]) \
        .withColumn("salary_log", F.col(FEATURES[2]) * 2 + F.col(FEATURES[4])).withColumn("n", F.lit(1.0))
    est = models()["RandomForest"]
    assert est.getCacheNodeIds()
    small = est.copy({est.numTrees: 5})
    data = assemble(rows).coalesce(1).cache()
    a, b = small.fit(data), small.copy({est.cacheNodeIds: False}).fit(data)
    assert a.toDebugString.split("\n", 1)[1] == b.toDebugString.split("\n", 1)[1]


# ---------------------------------------------------------- round 4: F1, F2
def _odd_rows(spark):
    """600 rows, a feature of one value, one of 47 (more than a tree's bins)."""
    import numpy as np

    from hirelens.ml.features import FEATURES
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, k, 600) for k in (3, 5, 47, 6, 1, 8)]).astype(float)
    y = 9 + 0.3 * x[:, 0] + 0.1 * x[:, 1] * x[:, 3] - 0.02 * x[:, 2] + rng.normal(0, 0.2, 600)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "seq long, " + ", ".join(f"{c} double" for c in FEATURES) + ", salary_log double")


def test_trees_from_cells_are_those_of_spark(spark):
    import numpy as np

    from hirelens.ml.regress import assemble, combined, fitted, models
    rows = _odd_rows(spark).coalesce(1).cache()
    groups = combined(rows).cache()
    gbt, forest = models()["GBT"], models()["RandomForest"]
    # of a few rows several splits are equally good, and rounding picks one
    for est in (gbt.copy({gbt.maxIter: 12, gbt.minInstancesPerNode: 12}), forest.copy({forest.numTrees: 1, forest.bootstrap: False, forest.minInstancesPerNode: 12})):
        own, spark_ml = fitted(est, groups), est.fit(assemble(groups))
        a, b = (m.transform(assemble(rows)).orderBy("seq").toPandas()["prediction"].to_numpy() for m in (own, spark_ml))
        assert np.allclose(a, b, rtol=1e-9)
        assert np.allclose(own.featureImportances.toArray(), spark_ml.featureImportances.toArray(), rtol=1e-6)
        assert own.featureImportances[4] == 0
    rows.unpersist()
    groups.unpersist()


def test_trees_take_a_few_jobs_whatever_their_number(spark):
    from hirelens.ml.regress import combined, fitted, models
    groups = combined(_odd_rows(spark)).cache()
    groups.count()
    sc = spark.sparkContext
    for name in ("GBT", "RandomForest"):
        sc.setJobGroup(f"trees-{name}", name)
        model = fitted(models()[name], groups)
        jobs = len(sc.statusTracker().getJobIdsForGroup(f"trees-{name}"))
        assert sum(b.n for b in model.blocks) == 200 and 0 < jobs < 20
    sc.setLocalProperty("spark.jobGroup.id", None)
    groups.unpersist()


def test_a_forest_draws_rows_with_replacement(spark):
    import numpy as np

    from hirelens.ml.regress import assemble, combined, fitted, metrics, models
    from hirelens.ml.trees import _poisson
    rng = np.random.default_rng(1)
    n = np.array([1.0, 3.0, 400.0])
    drawn = _poisson(n, rng.random((3, 200_000)), {})
    assert np.allclose(drawn.mean(axis=1), n, rtol=0.02) and np.allclose(drawn.var(axis=1), n, rtol=0.02)
    assert abs((drawn[0] == 0).mean() - np.exp(-1)) < 0.01
    rows, est = _odd_rows(spark).cache(), models()["RandomForest"]
    small = est.copy({est.numTrees: 40})
    a, b = (fitted(small, combined(rows.repartition(p))) for p in (1, 5))
    said = [m.transform(assemble(rows)).orderBy("seq").toPandas()["prediction"].to_numpy() for m in (a, b)]
    assert np.allclose(*said, rtol=1e-9)  # whatever the partitions
    trees = np.concatenate([[t.value[t.tree == i].shape[0] for i in range(t.n)] for t in a.blocks])
    assert len(trees) == 40 and len(set(trees)) > 5  # no two samples alike
    whole = small.fit(assemble(rows.withColumn("n", F.lit(1.0))))
    r2 = [metrics(m.transform(assemble(rows)), log_scale=True).first()["r2"] for m in (a, whole)]
    assert abs(r2[0] - r2[1]) < 0.02 and r2[0] > 0.8
    rows.unpersist()
