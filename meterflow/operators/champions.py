"""Which model runs became champion when they arrived."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.session import materialise

_FAN = 256


def _with_best_before(runs: DataFrame, model: str, version: str, metric: str, higher: bool, chunk: int) -> DataFrame:
    """The best metric of all earlier versions, by version chunks, so one busy model is many groups."""
    best = F.max if higher else F.min
    pick = F.greatest if higher else F.least
    chunked = runs.withColumn("_chunk", F.call_function("div", F.col(version), F.lit(chunk)))
    per_chunk = chunked.groupBy(model, "_chunk").agg(best(metric).alias("_chunk_best"))
    earlier_chunks = Window.partitionBy(model).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(F.col(model).alias("_model"), F.col("_chunk").alias("_of"),
                               best("_chunk_best").over(earlier_chunks).alias("_carried"))
    earlier = Window.partitionBy(model, "_chunk").orderBy(version).rowsBetween(Window.unboundedPreceding, -1)
    inside = chunked.withColumn("_inside", best(metric).over(earlier))
    same = F.col(model).eqNullSafe(F.col("_model")) & F.col("_chunk").eqNullSafe(F.col("_of"))
    return inside.join(carried, same).withColumn("_best", pick("_inside", "_carried"))


def champion_history(runs: DataFrame, model: str = "model", version: str = "version", metric: str = "val_mae",
                     tolerance: float = 0.0, higher_is_better: bool = False, chunk: int = 10_000) -> DataFrame:
    """Add ``promoted``: the run matched or beat the champion of its time, or there was none.

    Without a tolerance the champion is the running best. With one, only runs at least as good as every
    earlier run can be promoted (as long as metrics are not negative). Each of those points to the run that
    would follow it as champion, and the promoted runs are those that the first one leads to, found
    by doubling the pointers: no model is ever one group. A run without the metric, or with one that is
    not a number, is never promoted.
    """
    if tolerance < 0:
        raise ValueError("tolerance must not be negative")
    given, columns = "_given", [c if c != metric else F.col("_given").alias(metric) for c in runs.columns]
    # a metric that is not a number compares with nothing, so it is no metric
    runs = runs.withColumn(given, F.col(metric)).withColumn(metric, F.when(~F.isnan(metric), F.col(metric)))
    compared = _with_best_before(runs, model, version, metric, higher_is_better, chunk)
    ahead = F.col(metric) >= F.col("_best") if higher_is_better else F.col(metric) <= F.col("_best")
    record = F.col(metric).isNotNull() & (F.col("_best").isNull() | ahead)
    if tolerance == 0:
        return compared.select(*columns, record.alias("promoted"))

    eligible = F.col(metric).isNotNull() & (record | F.coalesce(F.col("_best") < 0, F.lit(False)))
    marked = materialise(compared.select(*runs.columns, eligible.alias("_eligible"), F.to_json(F.struct(model)).alias("_who")), "champions")
    rest = marked.filter(~F.col("_eligible")).select(*columns, F.lit(False).alias("promoted"))
    # signs are turned where the highest wins, so that a lower value is always the better one
    sign, factor = (-1, 1.0 + tolerance) if higher_is_better else (1, 1.0 - tolerance)
    candidates = materialise(_numbered(marked.filter("_eligible"), version, chunk).withColumns(
        {"_value": F.col(metric) * sign, "_bar": F.col(metric) * factor * sign}), "champions")
    won = _reached(_next_better(candidates.select("_who", "_at", "_value", "_bar")))
    promoted = candidates.join(won.withColumn("promoted", F.lit(True)), ["_who", "_at"], "left")
    return rest.unionByName(promoted.select(*columns, F.coalesce("promoted", F.lit(False)).alias("promoted")))


def _numbered(runs: DataFrame, version: str, chunk: int) -> DataFrame:
    """Add ``_at``, the place of a run among those of its model, counted by version chunks."""
    chunked = runs.withColumn("_chunk", F.call_function("div", F.col(version), F.lit(chunk)))
    sizes = chunked.groupBy("_who", "_chunk").agg(F.count(F.lit(1)).alias("_runs"))
    earlier = Window.partitionBy("_who").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_who", "_chunk", F.coalesce(F.sum("_runs").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_who", "_chunk").orderBy(version)) - 1
    return chunked.withColumn("_inside", inside).join(before, ["_who", "_chunk"]).withColumn(
        "_at", F.col("_before") + F.col("_inside")).drop("_chunk", "_inside", "_before")


def _next_better(runs: DataFrame) -> DataFrame:
    """``_who``, ``_at`` and ``_next``: the first later run whose value reaches the bar of this one, if any.

    Places are grouped by ``_FAN``, groups by ``_FAN`` again, and so on; an array holds the best value of each part
    of a group. A search climbs until a later part of its group has a good enough value, then descends into that part. All
    runs search at once, and each step is a join with one array per group.
    """
    last = runs.agg(F.max("_at")).first()[0]
    parts, levels = runs.select("_who", "_at", "_value"), []
    while last is not None:
        group = F.call_function("div", F.col("_at"), F.lit(_FAN)).alias("_group")
        in_order = F.array_sort(F.collect_list(F.struct("_at", "_value")))
        arrays = parts.groupBy("_who", group).agg(in_order.alias("_parts")).select("_who", "_group", F.col("_parts._value").alias("_values"))
        levels.append(materialise(arrays, "champion-tree"))
        last = None if last < _FAN else last // _FAN
        parts = levels[-1].select("_who", F.col("_group").alias("_at"), F.array_min("_values").alias("_value"))

    def first_reaching(start: Column) -> Column:
        places = F.when(start < F.size("_values"), F.sequence(start, F.size("_values") - 1))
        return F.get(F.filter(places, lambda k: F.get("_values", k) <= F.col("_bar")), 0)

    searching = runs.select("_who", "_at", "_bar", F.col("_at").alias("_place"))
    none, found = F.lit(None).cast("bigint"), []
    for level in levels:
        inside = F.pmod(F.col("_place"), F.lit(_FAN)).cast("int")
        looked = searching.withColumn("_group", F.call_function("div", F.col("_place"), F.lit(_FAN))).join(level, ["_who", "_group"])
        looked = materialise(looked.select("_who", "_at", "_bar", "_group", first_reaching(inside + 1).alias("_k")), "champion-search")
        found.append(looked.filter("_k IS NOT NULL").select("_who", "_at", "_bar", (F.col("_group") * _FAN + F.col("_k")).alias("_place")))
        searching = looked.filter("_k IS NULL").select("_who", "_at", "_bar", F.col("_group").alias("_place"))
    nowhere = searching.select("_who", "_at", none.alias("_next"))
    down = None
    for level, hits in reversed(list(enumerate(found))):
        down = hits if down is None else hits.unionByName(down)
        if level:
            inner = down.withColumnRenamed("_place", "_group").join(levels[level - 1], ["_who", "_group"])
            down = inner.select("_who", "_at", "_bar", (F.col("_group") * _FAN + first_reaching(F.lit(0))).alias("_place"))
    if down is None:
        return nowhere
    return down.select("_who", "_at", F.col("_place").alias("_next")).unionByName(nowhere)


def _reached(pointers: DataFrame) -> DataFrame:
    """Places that the first one of each model leads to, itself included, by pointers of 1, 2, 4, ... steps."""
    jumps = [materialise(pointers.filter("_next IS NOT NULL"), "champion-jumps")]
    while True:
        onward = jumps[-1].select("_who", F.col("_at").alias("_next"), F.col("_next").alias("_then"))
        twice = jumps[-1].join(onward, ["_who", "_next"]).select("_who", "_at", F.col("_then").alias("_next"))
        twice = materialise(twice, "champion-jumps")
        if twice.isEmpty():
            break
        jumps.append(twice)
    reached = pointers.filter("_at = 0").select("_who", "_at")
    for jump in reversed(jumps):
        landed = jump.join(reached, ["_who", "_at"], "left_semi").select("_who", F.col("_next").alias("_at"))
        reached = materialise(reached.unionByName(landed), "champions-reached")
    return reached.distinct()


def current_champions(history: DataFrame, model: str = "model", version: str = "version") -> DataFrame:
    """The last promoted run of each model."""
    rest = [c for c in history.columns if c not in (model, "promoted")]
    last = history.filter("promoted").groupBy(model).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_run"))
    return last.select(model, "_run.*")
