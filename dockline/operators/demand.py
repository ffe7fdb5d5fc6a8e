"""Demand models (M1-M10) with Spark ML.

Features: hour, weekday (Monday = 0), capacity, one-hot commune, one-hot
station; target: available bikes. Unknown categories at scoring time map to
an all-zero one-hot block (``handleInvalid='keep'`` + ``dropLast``).
The 80/20 split hashes a stable row key, so it does not depend on
partitioning (``randomSplit`` does).

The encoders are fitted once for all models. The linear model is Spark ML's; the trees are grown by
``sparse_trees``, which finds Spark ML's splits without the zeros of the one-hot slots, and become Spark ML's
models. Each task holds all groups of the training set (18 bytes a group) and grows some trees of the forest, or boosts.
"""
from __future__ import annotations

import json
import time

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, LinearRegression,
                                   RandomForestRegressionModel, RandomForestRegressor)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import timefn as T
from ..session import discard, materialize, shared_path
from . import sparse_trees as ST
from .recommend import ml_frame

ROWS_PER_TASK = 10_000                  # at least, where the training set is dealt over more tasks than it came in
FIT_MEMORY_MB = 64                      # of node statistics a task; only the number of passes depends on it
DENSE_CELLS = 2_000_000                 # rows x slots up to which Spark ML grows the forest, by its own bootstrap
TASKS_PER_CORE = 4                      # for the trees of a forest
SUM_DEPTH = 4                           # of sums over tasks: few of the linear model's matrices (slots^2 / 2) reach the driver at once
FEATURES_NUM = ["hour", "weekday", "capacity"]
FEATURES_CAT = ["commune", "station_id"]
TARGET = "num_bikes_available"
TREE_MODELS = ("random_forest", "gradient_boosting")


def training_set(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """M1: join, capacity > 0, non-null capacity/commune, calendar features."""
    d = ml_frame(readings, stations)
    return d.select("station_id", "observed_at", "commune", "capacity",
                    T.hour_of_day("observed_at").alias("hour"),
                    T.weekday_monday0("observed_at").alias("weekday"),
                    F.col(TARGET))


def split_bucket(df: DataFrame) -> DataFrame:
    """M2: bucket in [0, 100) from md5 of ``station_id|epoch micros``."""
    key = F.concat_ws("|", F.col("station_id"), F.unix_micros(F.col("observed_at").cast("timestamp")).cast("string"))
    b = F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("bigint") % 100
    return df.withColumn("bucket", b).withColumn(
        "split", F.when(F.col("bucket") < S.SPLIT_TRAIN_PERCENT, F.lit("train")).otherwise(F.lit("test")))


def split_counts(readings: DataFrame, stations: DataFrame) -> DataFrame:
    return split_bucket(training_set(readings, stations)).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def _encoders() -> Pipeline:
    idx = StringIndexer(inputCols=FEATURES_CAT, outputCols=[f"{c}_idx" for c in FEATURES_CAT],
                        handleInvalid="keep", stringOrderType="alphabetAsc")
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in FEATURES_CAT],
                        outputCols=[f"{c}_ohe" for c in FEATURES_CAT], dropLast=True)
    asm = VectorAssembler(inputCols=FEATURES_NUM + [f"{c}_ohe" for c in FEATURES_CAT], outputCol="features")
    return Pipeline(stages=[idx, ohe, asm])


def _features_pipeline(regressor) -> Pipeline:
    return Pipeline(stages=[*_encoders().getStages(), regressor])


def candidates(rf_trees: int = S.RF_TREES, rf_depth: int = S.RF_DEPTH, gbt_rounds: int = S.GBT_ROUNDS,
               gbt_depth: int = S.GBT_DEPTH) -> dict:
    kw = dict(featuresCol="features", labelCol=TARGET)
    return {
        "linear_regression": LinearRegression(regParam=0.0, aggregationDepth=SUM_DEPTH, **kw),
        "random_forest": RandomForestRegressor(numTrees=rf_trees, maxDepth=rf_depth, featureSubsetStrategy="all",
                                               seed=S.SEED, maxMemoryInMB=FIT_MEMORY_MB, **kw),
        "gradient_boosting": GBTRegressor(maxIter=gbt_rounds, maxDepth=gbt_depth, stepSize=S.GBT_STEP,
                                          seed=S.SEED, **kw),
    }


def fit_and_compare(readings: DataFrame, stations: DataFrame, **params):
    """M3-M8: fit every candidate on the train split, score the test split.
    Returns (comparison DataFrame sorted by R2 desc, fitted models, test set)."""
    data = split_bucket(training_set(readings, stations)).withColumn(TARGET, F.col(TARGET).cast("double"))
    train = spread(data.filter(F.col("split") == "train").checkpoint(eager=True))
    test = data.filter(F.col("split") == "test").checkpoint(eager=True)
    regressors = candidates(**params)
    encoders = _encoders().fit(train)
    encoded = encoders.transform(train)
    slots = sum(len(labels) for labels in encoders.stages[0].labelsArray)
    dense = ["linear_regression"] + ["random_forest"] * (train.count() * slots <= DENSE_CELLS)
    models = {name: regressors[name].fit(encoded) for name in dense}
    models |= fit_trees(encoders.stages[0], encoders.stages[0].transform(train),
                        {name: reg for name, reg in regressors.items() if name not in dense})
    fitted = {name: PipelineModel([*encoders.stages, models[name]]) for name in regressors}
    return compare(fitted, test), fitted, test


def grouped(indexed: DataFrame) -> DataFrame:
    """Rows alike in features and target, with their number."""
    key = [F.col("station_id_idx").cast("int").alias("station"), F.col("commune_idx").cast("int").alias("commune"),
           F.col("capacity").cast("double").alias("capacity"), F.col("hour").cast("tinyint").alias("hour"),
           F.col("weekday").cast("tinyint").alias("weekday"), F.col(TARGET).alias("y")]
    return indexed.groupBy(*key).agg(F.count(F.lit(1)).cast("int").alias("n"))


def _collected(rows: DataFrame, communes: int, stations: int) -> ST.Groups:
    """The ``grouped`` training set on the driver."""
    entity, rest = ["station", "commune", "capacity"], ["hour", "weekday", "y", "n"]
    rows = materialize(rows, "groups")
    entities = rows.groupBy(*entity).agg(F.count(F.lit(1)).alias("groups")).orderBy(*entity).toArrow()
    groups = rows.orderBy(*entity, *rest).select(*rest).toArrow()
    discard(rows)
    return ST.Groups(**{c: t[c].to_numpy() for t in (entities, groups) for c in t.column_names}, communes=communes, stations=stations)


TREE = ("model string, treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,"
        "gain:double,leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")
_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
_NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                   ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT)])
_TREES = pa.schema([("model", pa.string()), ("treeID", pa.int32()), ("nodeData", _NODE)])


def _tree_rows(model: str, tree: int, nodes: list) -> pa.RecordBatch:
    names, splits = [f.name for f in _NODE], [f.name for f in _SPLIT]
    data = [dict(zip(names, [*n[:-1], dict(zip(splits, n[-1]))])) for n in nodes]
    return pa.RecordBatch.from_arrays([pa.array([model] * len(data)), pa.array([tree] * len(data), pa.int32()),
                                       pa.array(data, _NODE)], schema=_TREES)


def fit_trees(indexer, indexed: DataFrame, regressors: dict) -> dict:
    """Spark ML's models of these regressors, grown in one job: a task boosts, the others share the forest's trees."""
    spark = indexed.sparkSession
    communes, stations = (len(labels) for labels in indexer.labelsArray)
    shared = spark.sparkContext.broadcast(_collected(grouped(indexed), communes, stations))
    boosting, forest = regressors.get("gradient_boosting"), regressors.get("random_forest")
    rounds, depth, step = (boosting.getMaxIter(), boosting.getMaxDepth(), boosting.getStepSize()) if boosting else (0, 0, 0.0)
    trees, tree_depth, seed = (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) if forest else (0, 0, 0)
    shares = min(trees, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)

    def work(batches):
        for batch in batches:
            for task in batch.column(0).to_pylist():
                if task == 0:
                    for m, nodes in enumerate(ST.boost(shared.value, rounds, depth, step)):
                        yield _tree_rows("gradient_boosting", m, nodes)
                for t in range(task - 1, trees, shares) if task else ():
                    yield _tree_rows("random_forest", t, ST.bagged(shared.value, t, seed, tree_depth))

    grown = spark.range(0, shares + 1, 1, shares + 1).mapInArrow(work, TREE)
    grown = materialize(grown, "trees")
    shared.destroy()
    size = len(FEATURES_NUM) + communes + stations
    models = {name: _as_model(reg, grown.filter(F.col("model") == name).select("treeID", "nodeData"), size) for name, reg in regressors.items()}
    discard(grown)
    return models


def _as_model(reg, nodes: DataFrame, size: int):
    """A Spark ML model with these nodes, by way of the files in which Spark ML keeps one."""
    spark, path = nodes.sparkSession, shared_path(nodes.sparkSession, reg.uid)
    boosting = isinstance(reg, GBTRegressor)
    count = reg.getMaxIter() if boosting else reg.getNumTrees()
    cls = GBTRegressionModel if boosting else RandomForestRegressionModel
    def described(uid: str, kind: str, of: set, **more) -> str:
        given, default = ({p.name: v for p, v in m.items() if p.name in of} for m in (reg._paramMap, reg._defaultParamMap))
        return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                           "uid": uid, "paramMap": given, "defaultParamMap": default, **more})

    meta = described(reg.uid, cls.__name__, {p.name for p in reg.params}, numFeatures=size, numTrees=count)
    of_trees = {p.name for p in DecisionTreeRegressor().params}
    trees = [(t, described(f"{reg.uid}_{t}", "DecisionTreeRegressionModel", of_trees), reg.getStepSize() if boosting and t else 1.0) for t in range(count)]
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes.write.parquet(f"{path}/data")
    return cls.load(path)


def spread(train: DataFrame) -> DataFrame:
    """The same rows dealt over the cores: a readings file of a few MB is one partition, and every pass of every
    fit would run in one task. Sorted, since the forest draws its bootstrap by a row's place in its partition."""
    tasks = min(train.sparkSession.sparkContext.defaultParallelism, train.count() // ROWS_PER_TASK)
    if tasks <= train.rdd.getNumPartitions():
        return train
    return train.repartition(tasks, "station_id", "observed_at").sortWithinPartitions(*train.columns).checkpoint(eager=True)


def compare(fitted: dict, test: DataFrame) -> DataFrame:
    """M7: MAE, RMSE and R2 of every model, each scored once, best R2 first."""
    scored = None
    for name, model in fitted.items():
        p = model.transform(test).select(F.lit(name).alias("model"), F.col(TARGET).alias("y"), (F.col("prediction") - F.col(TARGET)).alias("e"))
        scored = p if scored is None else scored.unionByName(p)
    m = scored.groupBy("model").agg(F.avg(F.abs("e")).alias("mae"), F.avg(F.col("e") * F.col("e")).alias("mse"), F.var_pop("y").alias("var"))
    return m.select("model", F.round("mae", 2).alias("mae"), F.round(F.sqrt("mse"), 2).alias("rmse"),
                    F.round(1 - F.col("mse") / F.nullif(F.col("var"), F.lit(0.0)), 3).alias("r2")).orderBy(F.desc("r2"), "model")


def best_model_name(comp: DataFrame, trees_only: bool = False) -> str:
    names = comp.filter(F.col("model").isin(*TREE_MODELS)) if trees_only else comp
    return names.orderBy(F.desc("r2"), "model").first()["model"]


def prediction_vs_actual(model, test: DataFrame) -> DataFrame:
    """M9: scored test rows."""
    return model.transform(test).select("station_id", "observed_at", F.col(TARGET).alias("actual"),
                                        F.col("prediction").alias("predicted"))


def feature_importance(model, test: DataFrame, top: int = S.TOP_FEATURES) -> DataFrame:
    """The ``top`` features of a tree model by importance. The vector is spread into rows and joined
    with the slots' names, which the assembled column carries as attributes in its metadata."""
    spark = test.sparkSession
    vector = model.stages[-1].featureImportances
    slots = (spark.createDataFrame([(vector,)], ["v"])
             .select(F.posexplode(vector_to_array("v")).alias("idx", "importance")))
    attrs = model.transform(test.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    kinds = "map<string,array<struct<idx:int,name:string>>>"
    names = (spark.createDataFrame([(json.dumps(attrs),)], "attrs string")
             .select(F.explode(F.flatten(F.map_values(F.from_json("attrs", kinds)))).alias("a")).select("a.idx", "a.name"))
    named = slots.join(names, "idx", "left").select(F.coalesce("name", F.concat(F.lit("f"), "idx")).alias("feature"), "importance")
    best = named.orderBy(F.desc("importance"), "feature").limit(top)
    w = Window.orderBy(F.desc("importance"), "feature")                  # over ``top`` rows
    return best.select(F.row_number().over(w).alias("rank"), "feature", "importance")


# ---- fitted models as files ------------------------------------------------
def save(path: str, comp: DataFrame, fitted: dict, test: DataFrame) -> None:
    for name, model in fitted.items():
        model.write().overwrite().save(f"{path}/models/{name}")
    comp.write.mode("overwrite").parquet(f"{path}/comparison")
    test.write.mode("overwrite").parquet(f"{path}/test")


def load(spark, path: str):
    """(comparison, function name -> model, test set) of a saved fit."""
    return (spark.read.parquet(f"{path}/comparison").orderBy(F.desc("r2"), "model"),
            lambda name: PipelineModel.load(f"{path}/models/{name}"), spark.read.parquet(f"{path}/test"))
