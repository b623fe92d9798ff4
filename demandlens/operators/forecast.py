"""Forecasting contenders as Spark ML pipelines and the tournament.

The slice is filtered from the feature table, split chronologically, written
once, and every contender is a ``Pipeline``: MLlib's ridge and forest, and the
library's own boosting under absolute error (``boosting``) and additive trend
(``moments``). A slice of any size trains on the cluster, and a fitted
``PipelineModel`` can be saved and reloaded for batch scoring.

``run_group_tournament`` trains one model per group instead of one slice:
every group's linear contenders from one aggregation, every group's boosted
trees in one job, every group's forest in another one.
"""

from __future__ import annotations

import dataclasses
import math
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import ElementwiseProduct, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from demandlens.config import DEFAULT_MODELS, FEATURE_COLUMNS, TrainConfig
from demandlens.operators import boosting, moments
from demandlens.operators.clean import not_null
from demandlens.operators.evaluate import forecast_metrics, leaderboard
from demandlens.operators.explore import slice_rows
from demandlens.operators.joins import attach_stats
from demandlens.session import shared_dir

LABEL = "Order_Demand"


# --------------------------------------------------------------------------
# data preparation
# --------------------------------------------------------------------------


def whale_slice(featured: DataFrame, warehouse: str, category: str) -> DataFrame:
    """One warehouse AND one category (Warehouse prunes partitions)."""
    return slice_rows(featured, warehouse, category)


def split_column(
    featured_slice: DataFrame, test_year: int, observation: Observation | None = None
) -> DataFrame:
    """``split`` = train for years before ``test_year``, test for it; later
    years belong to neither side and are dropped. Rows with any NULL are
    dropped first; with an ``observation`` the slice size and the number of
    dropped incomplete rows are recorded while the data is read."""
    y = F.col("year")
    if observation is not None:
        featured_slice = featured_slice.observe(
            observation,
            F.count(F.lit(1)).alias("slice_rows"),
            F.count_if(~not_null(featured_slice.columns)).alias("incomplete_rows"),
        )
    return (
        featured_slice.filter(not_null(featured_slice.columns))
        .withColumn(
            "split", F.when(y < test_year, F.lit("train")).when(y == test_year, F.lit("test"))
        )
        .filter(F.col("split").isNotNull())
    )


def train_test(
    featured_slice: DataFrame, test_year: int, observation: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    s = split_column(featured_slice, test_year, observation)
    train = s.filter(F.col("split") == "train").drop("split")
    test = s.filter(F.col("split") == "test").drop("split")
    return train, test


# --------------------------------------------------------------------------
# contenders
# --------------------------------------------------------------------------


def _assembler(cols: Sequence[str] = FEATURE_COLUMNS, out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def ridge_pipeline(train: DataFrame, alpha: float = 1.0) -> Pipeline:
    """Ridge on log1p(demand) with population-std scaling, expm1 and clip.

    MLlib's StandardScaler divides by the sample std; multiplying by
    sqrt(n/(n-1)) turns that into the population std. The normal-equation
    solver works on a standardised label, so the ridge penalty alpha maps to
    regParam = alpha * std_pop(label) / n."""
    stats = train.agg(
        F.count(F.lit(1)).alias("n"), F.stddev_pop(F.log1p(F.col(LABEL))).alias("sy")
    ).first()
    n = int(stats["n"])
    sy = float(stats["sy"] or 0.0)
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    reg = alpha * sy / n if n and sy > 0 else 0.0
    return Pipeline(
        stages=[
            _assembler(out="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="scaled", withMean=True, withStd=True),
            ElementwiseProduct(
                inputCol="scaled",
                outputCol="features",
                scalingVec=Vectors.dense([factor] * len(FEATURE_COLUMNS)),
            ),
            LinearRegression(
                featuresCol="features",
                labelCol="label_log",
                predictionCol="prediction_log",
                solver="normal",
                elasticNetParam=0.0,
                regParam=reg,
                standardization=False,
            ),
            SQLTransformer(
                statement="SELECT *, greatest(expm1(prediction_log), 0.0D) AS prediction FROM __THIS__"
            ),
        ]
    )


def random_forest_pipeline(num_trees: int = 200, seed: int = 42) -> Pipeline:
    return Pipeline(
        stages=[
            _assembler(),
            RandomForestRegressor(
                featuresCol="features",
                labelCol=LABEL,
                numTrees=num_trees,
                maxDepth=10,
                maxBins=256,
                minInstancesPerNode=5,
                featureSubsetStrategy="all",
                seed=seed,
                # nodes whose sums a task holds at once: half as many passes
                maxMemoryInMB=512,
            ),
        ]
    )


def boost_params(name: str, cfg: TrainConfig) -> boosting.BoostParams:
    """By level, or best leaf first with at most 31 leaves of 20 rows or more."""
    if name == LEAFWISE:
        return boosting.BoostParams(cfg.boost_iters, leaves=31, l2=0.0, min_rows=20)
    return boosting.BoostParams(cfg.boost_iters)


def boosted_pipeline(params: boosting.BoostParams) -> Pipeline:
    """Boosting under absolute error, robust to the huge demand spikes.
    Predictions are not clipped."""
    learner = boosting.AbsoluteBoosting(features=list(FEATURE_COLUMNS), label=LABEL)
    return Pipeline(stages=[learner.using(params)])


def seasonal_trend_pipeline() -> Pipeline:
    """Additive piecewise-linear trend, yearly and weekly terms and regressors
    with separate priors; the largest posterior, not a sample of it."""
    return Pipeline(stages=[moments.LinearTrend()])


RIDGE, TREND, FOREST, BY_LEVEL, LEAFWISE = DEFAULT_MODELS


def build_contender(name: str, train: DataFrame, cfg: TrainConfig) -> Pipeline:
    if name == RIDGE:
        return ridge_pipeline(train)
    if name == TREND:
        return seasonal_trend_pipeline()
    if name == FOREST:
        return random_forest_pipeline(cfg.num_trees, cfg.seed)
    if name in (BY_LEVEL, LEAFWISE):
        return boosted_pipeline(boost_params(name, cfg))
    raise ValueError(f"no such contender: {name!r}; there are {', '.join(DEFAULT_MODELS)}")


def fit(name: str, train: DataFrame, cfg: TrainConfig) -> PipelineModel:
    train_in = train.withColumn("label_log", F.log1p(F.col(LABEL).cast("double")))
    return build_contender(name, train_in, cfg).fit(train_in)


def ridge_residuals(train: DataFrame, cfg: TrainConfig, alpha: float = 1.0) -> DataFrame:
    """(feature, residual): how far the fitted ridge is from solving its
    normal equations, relative to the largest term of each."""
    model = fit(DEFAULT_MODELS[0], train, cfg)
    weights = [float(w) for w in model.stages[3].coefficients]
    y = F.log1p(F.col(LABEL).cast("double"))
    rows = model.transform(train).select(
        vector_to_array("features").alias("x"), (y - F.col("prediction_log")).alias("e"), y.alias("y")
    )
    n = len(weights)
    sums = rows.agg(
        *[F.sum(F.col("x")[k] * F.col("e")).alias(f"e{k}") for k in range(n)],
        *[F.sum(F.abs(F.col("x")[k] * F.col("y"))).alias(f"s{k}") for k in range(n)],
    )
    parts = ", ".join(
        f"'{c}', (e{k} - {alpha * weights[k]!r}D) / greatest(s{k}, 1.0D)" for k, c in enumerate(FEATURE_COLUMNS)
    )
    return sums.select(F.expr(f"stack({n}, {parts}) AS (feature, residual)"))


def first_stumps(train: DataFrame, params: boosting.BoostParams, ways: Sequence[str]) -> DataFrame:
    """The first boosting round's single best split of the training rows, with
    the median residuals of its two sides: one row per way of training ('one
    task', 'distributed'), none where no split helps."""
    spark, out = train.sparkSession, None
    for way in ways:
        local = params.local_rows if way == "one task" else 0
        one = dataclasses.replace(params, rounds=1, step=1.0, depth=1, local_rows=local)
        model = boosting.fit_table(train, list(FEATURE_COLUMNS), LABEL, one)
        tree = model.trees[0] if model.trees else boosting.Tree()
        if tree.feature[0] < 0:
            continue
        name, threshold = FEATURE_COLUMNS[tree.feature[0]], float(model.edges[tree.feature[0]][tree.cut[0]])
        goes_left = F.col(name).cast("double") <= threshold
        found = train.filter(not_null([*FEATURE_COLUMNS, LABEL])).agg(
            F.lit(way).alias("way"),
            F.lit(model.base).alias("base"),
            F.lit(name).alias("feature"),
            F.lit(threshold).alias("threshold"),
            F.count_if(goes_left).alias("left_rows"),
            F.count_if(~goes_left).alias("right_rows"),
            F.lit(tree.value[tree.left[0]]).alias("left_median"),
            F.lit(tree.value[tree.right[0]]).alias("right_median"),
        )
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame(
            [],
            "way string, base double, feature string, threshold double, left_rows long, "
            "right_rows long, left_median double, right_median double",
        )
    return out


def fit_predict(
    name: str, train: DataFrame, test: DataFrame, cfg: TrainConfig
) -> tuple[PipelineModel, DataFrame]:
    model = fit(name, train, cfg)
    pred = model.transform(test).select(
        F.lit(name).alias("model"), *test.columns, F.col("prediction").cast("double").alias("prediction")
    )
    return model, pred


def _timed_fit(
    name: str, train: DataFrame, test: DataFrame, cfg: TrainConfig
) -> tuple[PipelineModel, DataFrame, float]:
    began = time.monotonic()
    model, pred = fit_predict(name, train, test, cfg)
    return model, pred, time.monotonic() - began


def materialise(df: DataFrame) -> DataFrame:
    """A training frame written once to the shared folder: iterative learners
    read it again and again, and nothing stays cached afterwards. Adaptive
    execution sets the number of partitions by bytes."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Rows of a partition that learners go through again and again: as many
#: partitions as cores, of no fewer and no more rows than these.
LEAST_ROWS, MOST_ROWS = 1 << 14, 1 << 20


def materialise_sides(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) of a slice cut out of a larger table: written once, in
    partitions by the slice's own rows. A partition of a forest's rows sends sums
    for every node of every tree, so those of the table would multiply them."""
    written = materialise(split)
    rows = {r["split"]: r["count"] for r in written.groupBy("split").count().collect()}
    cores = split.sparkSession.sparkContext.defaultParallelism

    def side(name: str) -> DataFrame:
        n = rows.get(name, 0)
        parts = max(1, math.ceil(n / MOST_ROWS), min(cores, math.ceil(n / LEAST_ROWS)))
        return written.filter(F.col("split") == name).drop("split").coalesce(parts)

    return side("train"), side("test")


def run_tournament(
    featured: DataFrame, cfg: TrainConfig, observation: Observation | None = None
) -> tuple[DataFrame, dict[str, PipelineModel], DataFrame]:
    """Fit every configured contender on the train split of the slice,
    predict the test split, score them. Returns (leaderboard, models,
    predictions). Train and test are written once and read by all models; the
    leaderboard also has each contender's fit time in seconds."""
    s = whale_slice(featured, cfg.target_warehouse, cfg.target_category)
    train, test = materialise_sides(split_column(s, cfg.test_year, observation))
    # contenders are independent, seeded Spark jobs: fit them concurrently
    # so a small slice does not leave most cores idle
    with ThreadPoolExecutor(max_workers=max(1, min(len(cfg.models), 8))) as pool:
        futures = {name: pool.submit(_timed_fit, name, train, test, cfg) for name in cfg.models}
        fitted = {name: f.result() for name, f in futures.items()}
    models: dict[str, PipelineModel] = {name: fitted[name][0] for name in cfg.models}
    preds = None
    for name in cfg.models:
        p = fitted[name][1]
        preds = p if preds is None else preds.unionByName(p)
    metrics = forecast_metrics(preds, cfg.high_demand_threshold)
    # one entry per contender
    seconds = F.create_map(*[F.lit(x) for name in cfg.models for x in (name, fitted[name][2])])
    board = leaderboard(metrics).withColumn("fit_seconds", seconds[F.col("model")])
    return board, models, preds


# --------------------------------------------------------------------------
# one model per group
# --------------------------------------------------------------------------

#: Test rows of a group that one task predicts with the group's trees.
PREDICT_ROWS = 200_000
LINEAR = {RIDGE: "ridge", TREND: "trend"}


def predict_trees(test: DataFrame, models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``prediction`` by each group's trees (null without any). A group's rows
    are dealt to blocks, and its model goes to each of them."""
    keys = list(keys)
    blocks = test.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / PREDICT_ROWS).cast("int").alias("__blocks"))
    rows = attach_stats(test, blocks, keys).withColumn(
        "__block", F.pmod(F.monotonically_increasing_id(), F.col("__blocks")).cast("int")
    )
    fitted = models.join(blocks, keys).select(
        *keys, "ensemble", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("__block")
    )
    names, columns = list(FEATURE_COLUMNS), test.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in test.schema)

    def run(got: pa.Table, model: pa.Table) -> pa.Table:
        out = got.select(columns)
        if not model.num_rows:
            return out.append_column("prediction", pa.nulls(len(out), pa.float64()))
        ensemble = boosting.Ensemble.from_json(model.column("ensemble")[0].as_py())
        values = np.column_stack([got.column(c).cast(pa.float64()).to_numpy() for c in names])
        return out.append_column("prediction", pa.array(ensemble.predict(values)))

    by = [*keys, "__block"]
    return rows.groupBy(*by).cogroup(fitted.groupBy(*by)).applyInArrow(run, f"{schema}, prediction double")


def spread_forest(rows: DataFrame, cfg: TrainConfig) -> boosting.Ensemble:
    """MLlib's forest, for a group of more rows than one task trains."""
    model = random_forest_pipeline(cfg.num_trees, cfg.seed).fit(rows)
    return boosting.from_mllib(model.stages[1], len(FEATURE_COLUMNS))


def fit_predict_groups(
    name: str, train: DataFrame, test: DataFrame, cfg: TrainConfig
) -> tuple[DataFrame, DataFrame]:
    """(models, predictions) of one contender, a model per group of
    ``cfg.group_cols``."""
    keys = list(cfg.group_cols)
    if name in LINEAR:
        models = materialise(moments.fit(train, keys, LINEAR[name]))
        predicted = moments.predict(test, models, keys, LINEAR[name])
    elif name in (BY_LEVEL, LEAFWISE):
        models = materialise(
            boosting.fit_groups(train, keys, FEATURE_COLUMNS, LABEL, boost_params(name, cfg))
        )
        predicted = predict_trees(test, models, keys)
    elif name == FOREST:
        params = boosting.ForestParams(cfg.num_trees, seed=cfg.seed)
        models = materialise(
            boosting.fit_groups(train, keys, FEATURE_COLUMNS, LABEL, params, lambda rows: spread_forest(rows, cfg))
        )
        predicted = predict_trees(test, models, keys)
    else:
        raise ValueError(f"{name!r} is not trained per group")
    return models, predicted.select(F.lit(name).alias("model"), *test.columns, "prediction")


def run_group_tournament(
    featured: DataFrame, cfg: TrainConfig, contenders: Sequence[str] | None = None
) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """(leaderboard per group, models by contender, predictions) over all
    groups of ``cfg.group_cols`` at once. Rows of a group without training rows
    have no prediction and no part in the metrics. ``contenders`` are all
    trained; without them, those of ``cfg.models`` but the forest."""
    keys = list(cfg.group_cols)
    if not keys:
        raise ValueError("group_cols names no column to train by")
    # written once: both sides come from the same windows over all rows
    split = materialise(split_column(featured, cfg.test_year))
    train, test = (split.filter(F.col("split") == side).drop("split") for side in ("train", "test"))
    if contenders is None:
        contenders = [name for name in cfg.models if name != FOREST]
    if not contenders:
        raise ValueError("no contender that is trained per group")
    # independent jobs: one contender's last groups leave cores to the next
    with ThreadPoolExecutor(max_workers=min(len(contenders), 8)) as pool:
        futures = {name: pool.submit(fit_predict_groups, name, train, test, cfg) for name in contenders}
        fitted = {name: f.result() for name, f in futures.items()}
    models = {name: fitted[name][0] for name in contenders}
    predictions = None
    for name in contenders:
        found = fitted[name][1]
        predictions = found if predictions is None else predictions.unionByName(found)
    predictions = materialise(predictions)
    scored = predictions.filter("prediction is not null").withColumn("entry", F.struct(*keys, "model"))
    metrics = forecast_metrics(scored, cfg.high_demand_threshold, model_col="entry").select(
        "model.*", *[c for c in ("mae", "accuracy", "f1", "precision", "recall")]
    )
    best = F.row_number().over(Window.partitionBy(*keys).orderBy("mae", "model"))
    board = metrics.withColumn("rank", best).withColumn("is_winner", F.col("rank") == 1)
    return board, models, predictions
