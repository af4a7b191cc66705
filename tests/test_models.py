"""Binary-relevance models on a small separable problem (2 labels)."""

import random

from noteledger.operators import features as FE
from noteledger.operators import models as MO
from noteledger.operators import scoring as S


def _data(spark, n=120):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        x = [rng.gauss(0, 1) for _ in range(4)]
        rows.append((i, x, [int(x[0] > 0), int(x[1] > 0.5)]))
    df = spark.createDataFrame(rows, "row_id long, x array<double>, y_true array<int>")
    return df.select("row_id", FE.array_to_vector("x").alias("features"), "y_true")


def test_lr_binary_relevance_learns(spark):
    df = _data(spark)
    models = MO.fit_binary_relevance(df, 2, "lr", parallelism=2)
    scored = MO.score(models, df)
    m = MO.evaluate(scored).collect()[0]
    assert m.element_accuracy > 0.9
    assert len(scored.select("scores").first()[0]) == 2
    top = S.top_k(scored, ["A", "B"], k=2).collect()
    assert len(top) == 2 * 120


def test_ensemble_join(spark):
    dense = spark.createDataFrame([(1, [0.5, 0.25]), (2, [1.0, 0.0])], "id long, v array<float>")
    eng = spark.createDataFrame([(1, 3.0), (2, 4.0)], "rid long, n double")
    out = FE.ensemble_features(dense, "id", "v", eng, "rid", ["n"]).orderBy("id").collect()
    assert [list(r.features) for r in out] == [[0.5, 0.25, 3.0], [1.0, 0.0, 4.0]]


def test_rows_without_a_record_stay(spark):
    dense = spark.createDataFrame([(1, [0.5]), (2, [1.0])], "id long, v array<float>")
    eng = spark.createDataFrame([(1, 3.0)], "rid long, n double")
    out = FE.ensemble_features(dense, "id", "v", eng, "rid", ["n"]).orderBy("id").collect()
    assert [list(r.features) for r in out] == [[0.5, 3.0], [1.0, 0.0]]


def test_search_ranks_by_micro_f1(spark):
    out = MO.grid_search(_data(spark, 60), {"regParam": [0.01, 5.0]}, "row_id", 2).collect()
    assert len(out) == 2 and out[0].cv_f1_mean >= out[1].cv_f1_mean and out[0].regParam == "0.01"


def test_a_forest_is_fitted_by_many_tasks(spark):
    # 4,000 vectors of 128 numbers, 4 MB: one partition before
    df = spark.range(4000).selectExpr("id as row_id", "array(int(id % 2)) as y_true", "transform(sequence(1, 128), j -> double((id * j) % 97)) as x")
    df = df.withColumn("features", FE.array_to_vector("x"))
    for kind, parts in (("rf", 4), ("lr", 1)):
        kept, n = MO.fit_frame(df, ["features", "y_true"], "features", "row_id", kind)
        assert (n, kept.rdd.getNumPartitions()) == (4000, parts)
        kept.unpersist()


def test_kept_nodes_do_not_change_a_forest(spark):
    df = _data(spark)
    assert MO.make_estimator("rf").getCacheNodeIds()
    kept, found = (MO.fit_binary_relevance(df, 1, "rf", id_col="row_id", numTrees=5, maxDepth=4, cacheNodeIds=c)[0].toDebugString for c in (True, False))
    assert kept.split("\n")[1:] == found.split("\n")[1:]
