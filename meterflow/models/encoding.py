"""Turning feature columns into a model vector and the target into its log scale."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.config import CATEGORICAL
from meterflow.errors import DataValidationError

# values of one category whose labels are kept in a model; a column beyond is no category but a key
MOST_LABELS = 1_000_000
# a sketch this far beyond the threshold leaves no doubt: its relative deviation is a hundredth
_DOUBT, _DEVIATION = 2, 0.01


def to_log(minutes: Column) -> Column:
    return F.log1p(minutes)


def from_log(scaled: Column) -> Column:
    return F.expm1(scaled)


def category_sizes(df: DataFrame, names: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Distinct values per categorical column, all columns in one aggregate."""
    return df.agg(*[F.count_distinct(F.col(name)).alias(name) for name in names])


def coded_name(name: str) -> str:
    return f"{name}_code"


def value_name(name: str) -> str:
    return f"{name}_value"


def index_name(name: str) -> str:
    return f"{name}_index"


@dataclass(frozen=True)
class Categories:
    """Which categorical features a tree splits by sets of values, and which by the order of their codes.

    ``sizes`` counts the values of the nominal ones, which bound the bins that a learner needs.
    """

    nominal: tuple[str, ...] = ()
    ordered: tuple[str, ...] = ()
    sizes: tuple[int, ...] = ()

    @property
    def bins(self) -> int:
        """Bins for the largest nominal column and the code of values unseen in training."""
        return max(self.sizes, default=0) + 1


def categorical_features(df: DataFrame, features: Sequence[str], categorical: Sequence[str]) -> list[str]:
    """Features to treat as categories: those asked for, and every text column."""
    return [name for name in features if name in categorical or isinstance(df.schema[name].dataType, T.StringType)]


def choose_categories(df: DataFrame, names: Sequence[str], threshold: int) -> Categories:
    """Nominal up to ``threshold`` distinct values, ordered codes above it.

    One scan sketches all columns, so no row is copied per column. Only columns that may be within reach of the threshold are
    counted exactly, by sets of at most some two thresholds of values. Missing values are no category of their own.
    """
    if not names:
        return Categories()
    sketch = df.agg(*[F.approx_count_distinct(name, _DEVIATION).alias(name) for name in names]).first()
    wide = [name for name in names if sketch[name] > MOST_LABELS]
    if wide:
        raise DataValidationError(f"columns {wide} hold too many values for a category: more than {MOST_LABELS}")
    near = [name for name in names if sketch[name] <= _DOUBT * threshold]
    exact = df.agg(*[F.size(F.collect_set(name)).alias(name) for name in near]).first() if near else {}
    nominal = tuple(name for name in near if exact[name] <= threshold)
    return Categories(nominal, tuple(name for name in names if name not in nominal), tuple(exact[name] for name in nominal))


def _labels_by_mean(df: DataFrame, name: str, target: str) -> list[str]:
    """Values of a column, as text, by the mean of the target over the training rows, equal means by value.

    Means are compared to nine places, so the order in which rows are added up does not show. ``choose_categories`` bounds the list.
    """
    means = df.filter(F.col(name).isNotNull()).groupBy(F.col(name).cast("string").alias("label")).agg(
        F.round(F.avg(target), 9).alias("mean"))
    return [row.label for row in means.orderBy("mean", "label").select("label").collect()]


def encoding_stages(df: DataFrame, features: Sequence[str], categories: Categories | None = None,
                    target: str | None = None) -> list:
    """Codes for categories, fitted on the training rows ``df`` only, then one vector.

    A nominal column keeps the attribute that tells the trees to split it by sets of values; its codes follow the sorted values.
    Any other category enters as a plain number, its attribute dropped by adding zero: codes follow the mean of ``target``
    where one is given, so that a cut of the codes is a cut between short and long, else the sorted values. Values
    unseen in training, missing ones included, share one extra code. Values are brought to their type in training before they
    are looked up, so a vendor 1 that arrives as 1.0 is the same vendor. Without ``categories`` all text columns get ordered codes.
    """
    if categories is None:
        categories = Categories(ordered=tuple(categorical_features(df, features, ())))
    chosen = [name for name in features if name in categories.nominal or name in categories.ordered]
    stages = []
    if chosen:
        typed = {name: df.schema[name].dataType.simpleString() for name in chosen}
        values = ", ".join(f"CAST(CAST(`{name}` AS {kind}) AS STRING) AS `{value_name(name)}`" for name, kind in typed.items())
        stages.append(SQLTransformer(statement=f"SELECT *, {values} FROM __THIS__"))
        by_mean = [name for name in chosen if name in categories.ordered and target is not None]
        by_text = [name for name in chosen if name not in by_mean]
        if by_text:
            stages.append(StringIndexer(inputCols=[value_name(name) for name in by_text], handleInvalid="keep",
                                        outputCols=[index_name(name) for name in by_text], stringOrderType="alphabetAsc"))
        if by_mean:
            stages.append(StringIndexerModel.from_arrays_of_labels(
                [_labels_by_mean(df, name, target) for name in by_mean], handleInvalid="keep",
                inputCols=[value_name(name) for name in by_mean], outputCols=[index_name(name) for name in by_mean]))
        plain = [f"`{index_name(name)}` + 0D AS `{coded_name(name)}`" for name in chosen if name in categories.ordered]
        if plain:
            stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(plain)} FROM __THIS__"))
    inputs = [index_name(name) if name in categories.nominal else coded_name(name) if name in chosen else name
              for name in features]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]
