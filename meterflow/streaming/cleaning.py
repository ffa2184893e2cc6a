"""Cleaning and features on a stream, with rejected rows and a report on the side."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.config import CleaningLimits
from meterflow.operators.cleaning import canonical_types, cleaning_rules, failed, parsed_trips, report_columns
from meterflow.operators.features import training_features
from meterflow.streaming.pickup import each_batch


def clean_stream(stream: DataFrame, out: str, checkpoint: str, limits: CleaningLimits = CleaningLimits()) -> StreamingQuery:
    """Write each batch once, split by ``accepted``; its report is observed on that same write."""

    def write(batch: DataFrame, number: int) -> None:
        parsed = parsed_trips(batch)
        rules = cleaning_rules(parsed, limits)
        observed = Observation(f"report_{number}")
        reasons = F.array_compact(F.array(*[F.when(failed(rule), F.lit(name)) for name, rule in rules.items()]))
        marked = (parsed.observe(observed, *report_columns(parsed, limits))
                  .withColumn("reject_reasons", reasons).withColumn("accepted", F.size("reject_reasons") == 0))
        marked.write.mode("overwrite").partitionBy("accepted").parquet(f"{out}/rows/batch={number}")
        row = {"batch": number, **observed.get}
        batch.sparkSession.createDataFrame([row]).coalesce(1).write.mode("overwrite").json(f"{out}/reports/batch={number}")

    return each_batch(stream, write, checkpoint)


def accepted_rows(spark, out: str) -> DataFrame:
    return canonical_types(spark.read.parquet(f"{out}/rows").filter("accepted = 'true'").drop("accepted", "reject_reasons", "batch"))


def rejected_rows(spark, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/rows").filter("accepted = 'false'").drop("accepted", "batch")


def feature_stream(stream: DataFrame, keep=("trip_id",), limits: CleaningLimits = CleaningLimits()) -> DataFrame:
    """Cleaned trips as features: filters and projections only, so any stream sink will do."""
    from meterflow.operators.cleaning import clean_trips

    return training_features(clean_trips(stream, limits), keep=list(keep), limits=limits)
