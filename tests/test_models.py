"""The demand models: figures recomputed from the scored rows, importances, unseen categories."""
import math
import os
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from dockline.operators import demand as DM
from dockline.operators import sparse_trees as ST
from dockline.plans import registry

D = "/root/testdata/sf0.01"
SMALL = dict(rf_trees=5, rf_depth=3, gbt_rounds=4, gbt_depth=2)


@pytest.fixture(scope="module")
def fit(spark):
    return DM.fit_and_compare(registry._rd(spark, D), registry._st(spark, D), **SMALL)


def test_comparison_equals_recomputed_errors(spark, fit):
    comp, fitted, test = fit
    rows = comp.collect()
    assert [r.model for r in rows] == [r.model for r in sorted(rows, key=lambda r: (-r.r2, r.model))] and len(rows) == 3
    for r in rows:
        got = DM.prediction_vs_actual(fitted[r.model], test).collect()
        y, e = [g.actual for g in got], [g.predicted - g.actual for g in got]
        mean = sum(y) / len(y)
        assert r.mae == pytest.approx(sum(map(abs, e)) / len(e), abs=0.0051)
        assert r.rmse == pytest.approx(math.sqrt(sum(x * x for x in e) / len(e)), abs=0.0051)
        assert r.r2 == pytest.approx(1 - sum(x * x for x in e) / sum((v - mean) ** 2 for v in y), abs=0.00051)
    assert DM.best_model_name(comp) == rows[0].model
    assert DM.best_model_name(comp, trees_only=True) == next(r.model for r in rows if r.model in DM.TREE_MODELS)


@pytest.mark.parametrize("name", DM.TREE_MODELS)
def test_importances_are_a_table_of_named_slots(fit, name):
    _, fitted, test = fit
    rows = DM.feature_importance(fitted[name], test).collect()
    vector = fitted[name].stages[-1].featureImportances.toArray()
    assert [r["rank"] for r in rows] == list(range(1, 16)) and all(r.importance >= 0 for r in rows)
    assert sum(r.importance for r in rows) <= 1 + 1e-9
    assert [r.importance for r in rows] == sorted(vector, reverse=True)[:15]
    top = {r.feature: r.importance for r in rows}
    for i, c in enumerate(DM.FEATURES_NUM):
        assert top.get(c, 0.0) in (vector[i], 0.0)
    assert all(f in DM.FEATURES_NUM or f.startswith(("commune_ohe_", "station_id_ohe_")) for f in top)


def test_split_and_unseen_category(fit):
    _, fitted, test = fit
    assert test.filter("bucket < 80").count() == 0
    odd = test.limit(3).withColumn("station_id", F.lit("never seen")).withColumn("commune", F.lit("nowhere"))
    for model in fitted.values():
        scored = model.transform(odd).collect()
        assert len(scored) == 3 and all(r.prediction is not None and sum(r.station_id_ohe.toArray()) == 0 for r in scored)


def test_training_rows_are_dealt_over_the_cores(spark):
    rows = spark.range(0, 40_000, 1, 1).selectExpr("cast(id % 700 as string) station_id", "timestamp_seconds(id) observed_at", "id y")
    got = DM.spread(rows)
    sizes = got.rdd.glom().map(len).collect()
    assert len(sizes) == 4 and min(sizes) > 8_000
    assert got.exceptAll(rows).count() == rows.exceptAll(got).count() == 0
    assert DM.spread(rows).rdd.glom().collect() == got.rdd.glom().collect()
    assert DM.spread(rows.limit(9_000)).rdd.getNumPartitions() == 1


def test_saved_models_score_alike(spark, fit, scratch):
    comp, fitted, test = fit
    path = os.path.join(scratch, "m")
    DM.save(path, comp, fitted, test)
    comp2, model, test2 = DM.load(spark, path)
    assert comp2.collect() == comp.collect()
    name = DM.best_model_name(comp2)
    key = ["station_id", "observed_at", "actual", "predicted"]
    assert sorted(map(tuple, DM.prediction_vs_actual(model(name), test2).select(key).collect())) == \
        sorted(map(tuple, DM.prediction_vs_actual(fitted[name], test).select(key).collect()))


@pytest.fixture(scope="module")
def wide(spark):
    """Training rows of 60 stations, some of two capacities or communes, with rows that come twice; encoded."""
    r = random.Random(7)
    rows = []
    for _ in range(2500):
        s = r.randrange(60)
        c, n = 40 + s % 43 + (r.random() < 0.05), f"c{s % 9 if r.random() < 0.97 else 9}"
        rows += [(f"s{s}", n, c, h := r.randrange(24), d := r.randrange(7), float(r.randrange(12) + s % 5 + (h > 8) * 2 - (d > 4)))] * r.choice((1, 1, 2))
    train = spark.createDataFrame(rows, f"station_id string, commune string, capacity bigint, hour int, weekday int, {DM.TARGET} double").checkpoint()
    return DM._encoders().fit(train), train


def _grown(wide, **regressors):
    encoders, train = wide
    return DM.fit_trees(encoders.stages[0], encoders.stages[0].transform(train), regressors)


def _nodes(spark, model, path):
    model.write().overwrite().save(path)
    kept = spark.read.parquet(f"{path}/data").orderBy("id").collect()
    return [[*r[:-1], tuple(r[-1])] for r in kept]


def test_a_tree_is_the_one_of_spark(spark, wide, scratch):
    encoders, train = wide
    groups = DM._collected(DM.grouped(encoders.stages[0].transform(train)), *(len(x) for x in encoders.stages[0].labelsArray))
    assert len(groups.y) < train.count() and groups.n.sum() == train.count() and len(groups.cuts[ST.CAPACITY]) > 20
    for depth in (1, 4, 12):
        theirs = DecisionTreeRegressor(maxDepth=depth, labelCol=DM.TARGET).fit(encoders.transform(train))
        ours, fit = ST.grow(groups, groups.n, groups.y, depth)
        assert [list(n) for n in ours] == _nodes(spark, theirs, os.path.join(scratch, f"t{depth}"))
        scored = theirs.transform(encoders.transform(train)).select("prediction").collect()
        assert sorted(r.prediction for r in scored) == sorted(np.repeat(fit, groups.n))


def test_wide_sets_are_grown_without_the_zeros(spark, monkeypatch):
    """Spark ML's learners, whose work grows with rows x slots, are not called; the linear model is."""
    def dense(*_):
        raise AssertionError("dense")

    for of in (RandomForestRegressor, GBTRegressor):
        monkeypatch.setattr(of, "_fit", dense)
    monkeypatch.setattr(DM, "DENSE_CELLS", 0, raising=False)
    stations = spark.range(300).selectExpr("cast(id as string) station_id", "'n' name", "40 + id % 41 capacity", "concat('c', id % 7) commune",
                                           "48.8D latitude", "2.3D longitude")
    readings = spark.range(0, 4000, 1, 1).selectExpr("cast(id * 7 % 300 as string) station_id", "pmod(hash(id), 30) num_bikes_available",
                                                     "1 num_docks_available", "timestamp_seconds(1704067200 + id * 977) observed_at")
    comp, fitted, test = DM.fit_and_compare(readings, stations, **SMALL)
    assert {r.model for r in comp.collect()} == set(fitted) == {"linear_regression", *DM.TREE_MODELS}
    forest = fitted["random_forest"].stages[-1]
    assert forest.getNumTrees == 5 and len({t.toDebugString.partition("\n")[2] for t in forest.trees}) == 5
    assert max(t.depth for t in forest.trees) == 3 and fitted["gradient_boosting"].stages[-1].getNumTrees == 4


def _boosting(**kw):
    return GBTRegressor(maxIter=6, maxDepth=3, stepSize=0.1, seed=1, labelCol=DM.TARGET, featuresCol="features", **kw)


@pytest.fixture(scope="module")
def boosted(wide):
    """Boosted trees grown here, and by Spark ML."""
    encoders, train = wide
    return [PipelineModel([*encoders.stages, m]) for m in
            (_grown(wide, gradient_boosting=_boosting())["gradient_boosting"], _boosting().fit(encoders.transform(train)))]


def test_importances_of_grown_trees(wide, boosted):
    ours, theirs = (DM.feature_importance(m, wide[1]).collect() for m in boosted)
    assert len(ours) == 15 and [(r["rank"], r.feature) for r in ours] == [(r["rank"], r.feature) for r in theirs]
    assert [r.importance for r in ours] == pytest.approx([r.importance for r in theirs], abs=1e-9)
    assert ours[0].importance > 0


def test_grown_trees_score(spark, wide, boosted):
    encoders, train = wide
    test = train.dropDuplicates().limit(300).withColumn("observed_at", F.lit("2024-01-01").cast("timestamp"))
    test = test.unionByName(test.limit(3).withColumn("station_id", F.lit("never seen")).withColumn("commune", F.lit("nowhere")))
    test = test.checkpoint()
    ours, theirs = ([r.predicted for r in DM.prediction_vs_actual(m, test).collect()] for m in boosted)
    assert len(ours) == 303 and len(set(ours)) > 20 and ours == pytest.approx(theirs, abs=1e-9)

    def forest():
        return RandomForestRegressor(numTrees=7, maxDepth=6, seed=5, featureSubsetStrategy="all", labelCol=DM.TARGET, featuresCol="features")

    one, other = (_grown((encoders, t), random_forest=forest())["random_forest"] for t in (train, train.repartition(5)))
    scored = encoders.transform(test)
    a, b = ([r.prediction for r in m.transform(scored).collect()] for m in (one, other))
    assert a == b and one.getNumTrees == 7                                # however the rows are dealt
    trees = [[r.prediction for r in t.transform(scored).collect()] for t in one.trees]
    assert a == pytest.approx(np.mean(trees, 0)) and len({tuple(t) for t in trees}) == 7
