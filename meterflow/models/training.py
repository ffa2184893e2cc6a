"""Training, importance and persistence of trip duration models."""

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.config import ModelSettings, TARGET
from meterflow.errors import DataValidationError
from meterflow.models.encoding import (
    Categories, categorical_features, choose_categories, coded_name, encoding_stages, index_name, to_log,
)
from meterflow.models.leaves import read_ensemble
from meterflow.models.lending import Trial, trial_losses
from meterflow.operators.evaluation import r2_score
from meterflow.operators.ordering import with_row_index
from meterflow.operators.splitting import head_rows, seeded_subsample
from meterflow.session import materialise, shared_folder
from meterflow.sources.zones import zone_path

# --- Fixed values: algorithm names that select a tree learner ---------------------------------
FOREST = ("forest", "RandomForestRegressor")
BOOSTING = ("boosting", "HistGradientBoostingRegressor", "XGBRegressor")
_LOG_TARGET, _LOG_PREDICTION = "log_minutes", "log_prediction"
_SHUFFLE_ROUNDS = 16


def learner(settings: ModelSettings, bins: int = 0):
    """The tree learner asked for, with at least ``bins`` bins."""
    if settings.trees <= 0:
        raise DataValidationError("the number of trees must be greater than zero")
    common = dict(featuresCol="features", labelCol=_LOG_TARGET, predictionCol=_LOG_PREDICTION,
                  maxDepth=settings.max_depth, maxBins=max(settings.bins, bins), seed=settings.seed)
    if settings.algorithm in FOREST:
        return RandomForestRegressor(numTrees=settings.trees, featureSubsetStrategy="all", **common)
    if settings.algorithm in BOOSTING:
        return GBTRegressor(maxIter=settings.trees, stepSize=settings.learning_rate, **common)
    raise ValueError(f"unsupported regression algorithm: {settings.algorithm!r}")


def train_model(train: DataFrame, settings: ModelSettings = ModelSettings(), key: str = "trip_id") -> PipelineModel:
    """Encoding, trees on the log target, and the way back to minutes, as one pipeline.

    Boosted trees split categories of at most ``max_categories`` values by sets of values, and larger ones by codes in the order
    of the mean log target. A forest takes codes in the order of the values for all of them.
    """
    learner(settings)  # refuses wrong settings before any row is read
    # boosting cuts its growing lineage in the shared folder
    shared_folder(train.sparkSession)
    if settings.subsample_rows is not None:
        train = seeded_subsample(train, settings.subsample_rows, settings.seed, key)
    minutes = SQLTransformer(statement=f"SELECT *, expm1({_LOG_PREDICTION}) AS prediction FROM __THIS__")
    fitted = train.select(*settings.features, to_log(F.col(TARGET)).alias(_LOG_TARGET))
    names = categorical_features(fitted, settings.features, settings.categorical)
    if settings.algorithm in BOOSTING:
        # chosen, ordered and trained on: read several times
        fitted = materialise(fitted, "training-rows")
        categories, target = choose_categories(fitted, names, settings.max_categories), _LOG_TARGET
    else:
        categories, target = Categories(ordered=tuple(names)), None
    stages = encoding_stages(fitted, settings.features, categories, target)
    return Pipeline(stages=[*stages, learner(settings, categories.bins), minutes]).fit(fitted)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The table with ``prediction`` in minutes."""
    return model.transform(df).select(*df.columns, "prediction")


def tree_importance(model: PipelineModel, spark: SparkSession, features: Sequence[str]) -> DataFrame:
    """Importance of each feature in the trees, highest first: as many rows as features."""
    scores = model.stages[-2].featureImportances.toArray()
    rows = [(name, float(score)) for name, score in zip(features, scores)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def shuffled_place(place: Column, rows: int, *keys: Column) -> Column:
    """Where a keyed bijection of all places below ``rows`` takes a place.

    Each round mirrors the places at a point drawn from the key and swaps each pair of mirror images, or not, by
    one bit drawn from key and pair. That is a bijection for any number of rows, and every place finds its own image alone.
    """

    def turned(at: Column, turn: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(turn, *keys), F.lit(rows)) - at, F.lit(rows))
        return F.when(F.xxhash64(turn, *keys, F.greatest(at, mirror)) % 2 == 0, mirror).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(_SHUFFLE_ROUNDS)), place.cast("bigint"), turned)


def _turn_hashes(*keys: Column) -> Column:
    """The hash each turn of ``shuffled_place`` starts from."""
    return F.transform(F.sequence(F.lit(1), F.lit(_SHUFFLE_ROUNDS)), lambda turn: F.xxhash64(turn, *keys))


def permutation_importance(model: PipelineModel, table: DataFrame, settings: ModelSettings = ModelSettings(),
                           order: Sequence[str] = ("pickup_datetime", "trip_id")) -> DataFrame:
    """Loss of R2, in minutes, when one feature's values are shuffled, averaged over repeats.

    All rows of the table take part, unless ``importance_rows`` asks for the first ones in order. Rows are numbered and
    encoded once; in every (feature, repeat) trial a keyed bijection of the numbers tells each row which other one lends it its
    value. All trials are lent and scored in one job. The model is one of ``train_model``.
    """
    features, spark = list(settings.features), table.sparkSession
    needed = list(dict.fromkeys([*order, *features, TARGET]))
    sample = table.select(*needed)
    if settings.importance_rows is not None:
        sample = head_rows(sample, settings.importance_rows, order)
    learned, inputs = model.stages[-2], model.stages[-3].getInputCols()
    scored = materialise(model.transform(with_row_index(sample, order, "_row")).select(
        (F.col("_row") - 1).alias("row"), vector_to_array(learned.getFeaturesCol()).alias("vector"),
        F.col(TARGET).cast("double").alias("target"), "prediction"), "importance")
    whole = scored.agg(F.count(F.lit(1)).alias("rows"), F.var_pop("target").alias("variance")).first()
    if not whole.rows:
        raise DataValidationError("importance needs at least one row")
    drawn = spark.range(1).select(F.posexplode(F.array(*[F.lit(name) for name in features])).alias("place", "feature")).select(
        "place", "feature", F.explode(F.sequence(F.lit(1), F.lit(settings.importance_repeats))).alias("repeat"))
    drawn = drawn.select("place", "feature", _turn_hashes(F.lit(settings.seed), F.col("feature"), F.col("repeat")).alias("turns"))
    drawn = drawn.orderBy("place", "repeat").collect()  # as many rows as trials
    entry = {name: next((i for i, column in enumerate(inputs) if column in (name, index_name(name), coded_name(name))), -1)
             for name in features}
    losses = trial_losses(scored, whole.rows, read_ensemble(learned, len(inputs)),
                          [Trial(entry[row.feature], tuple(row.turns)) for row in drawn], np.expm1)

    def r2(loss: int) -> Column:
        mse = F.when(F.col("known") > 0, F.col(f"loss_{loss}") / F.col("known"))
        return r2_score(F.lit(whole.rows), mse, F.lit(whole.variance).cast("double"))

    worse = losses.select(r2(0).alias("base"), F.explode(F.array(*[
        F.struct(F.lit(row.feature).alias("feature"), r2(i).alias("r2")) for i, row in enumerate(drawn, 1)])).alias("trial"))
    return (worse.groupBy(F.col("trial.feature").alias("feature"))
            .agg(F.avg(F.col("base") - F.col("trial.r2")).alias("importance")).orderBy(F.desc("importance"), "feature"))


def save_model(model: PipelineModel, root: str, name: str, version: int) -> str:
    path = zone_path(root, "models", f"{name}/v{version}")
    model.write().overwrite().save(path)
    return path


def load_model(root: str, name: str, version: int) -> PipelineModel:
    return PipelineModel.load(zone_path(root, "models", f"{name}/v{version}"))
