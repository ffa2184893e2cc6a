"""From the feature history to a judged, recorded model."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.config import ModelSettings, TARGET
from meterflow.errors import DataValidationError
from meterflow.models.registry import champion_version, next_version, read_runs, record_run
from meterflow.models.training import predict, save_model, train_model, tree_importance
from meterflow.operators.drift import reference_distribution
from meterflow.operators.evaluation import check_gate, flat_metrics, regression_metrics
from meterflow.operators.splitting import check_split, split_trips
from meterflow.operators.validation import validate_training_table
from meterflow.session import materialise, prepare
from meterflow.sources import manifest as mf
from meterflow.sources.planning import rolling_history
from meterflow.sources.zones import read_zone, write_small_json, zone_path


def load_history(spark: SparkSession, root: str, settings: ModelSettings = ModelSettings(),
                 filename: str | None = None, latest_only: bool = False, dataset: str | None = None,
                 mix_datasets: bool = False) -> DataFrame:
    """Features of one file, the latest month, or a rolling window of months, with only the needed columns.

    Months are chosen from the manifest and become a static partition filter.
    """
    done = mf.with_status(mf.read_events(spark, root), "features", mf.GENERATED).select("filename")
    if dataset is not None:
        done = done.filter(F.col("filename").startswith(f"{dataset}_"))
    chosen = done.filter(F.col("filename") == filename) if filename else rolling_history(
        done, 1 if latest_only else settings.history_months, mix_datasets)
    # at most a year of monthly names per dataset
    names = [row.filename for row in chosen.select("filename").collect()]
    if not names:
        raise DataValidationError("no feature files found: run the ETL job first")
    table = read_zone(spark, root, "features")
    in_month = F.format_string("%s_tripdata_%04d-%02d.parquet", "dataset", "year", "month").isin(names)
    return table.filter(in_month).select("trip_id", "pickup_datetime", *settings.features, TARGET)


def train_job(spark: SparkSession, root: str, settings: ModelSettings = ModelSettings(),
              validation_from: datetime | None = None, test_from: datetime | None = None,
              gated: bool = True, **history) -> dict:
    """History, split, training, evaluation, gate, run record, model and drift reference."""
    prepare(spark)
    started = datetime.now()
    table = load_history(spark, root, settings, **history)
    validate_training_table(table, settings.features, settings.categorical)
    # the split is compared, trained and evaluated on: fix it once
    split = materialise(split_trips(table, settings.ratios, validation_from, test_from), "split")
    sizes = check_split(split)
    train = split.filter("split = 'train'")
    model = train_model(train, settings)

    scored = predict(model, split.filter("split <> 'train'"))
    metrics_row = materialise(flat_metrics(regression_metrics(scored, by=["split"])), "metrics")
    metrics = metrics_row.first().asDict()
    if gated:
        check_gate(metrics_row, settings.gate)

    version = next_version(read_runs(spark, root), settings.name)
    path = save_model(model, root, settings.name, version)
    importance = tree_importance(model, spark, settings.features)
    importance_values = {f"fi_{row.feature}": row.importance for row in importance.collect()}  # one per feature
    write_small_json(metrics_row, zone_path(root, "metadata", f"metrics/v{version}"))
    reference = reference_distribution(train)
    write_small_json(reference, zone_path(root, "metadata", "reference_distribution"))
    params = {name: str(getattr(settings, name)) for name in ("algorithm", "trees", "learning_rate", "max_depth")}
    record_run(spark, root, settings.name, version, f"train_{settings.algorithm}_{started:%Y%m%d_%H%M%S}",
               settings.algorithm, params, {**metrics, **importance_values}, [path], started)
    champion = champion_version(read_runs(spark, root), settings.name)
    return {"version": version, "path": path, "metrics": metrics, "split": sizes, "champion": champion,
            "promoted": champion == version}
