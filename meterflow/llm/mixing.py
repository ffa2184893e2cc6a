"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree, in SQL functions alone.

Targets share all words of the corpus by weight; a target stops at ``MOST`` times the words of its source and
the excess is shared again. Documents fall by hash into ``BLOCKS`` blocks per source. A source draws all its
blocks once per whole pass, then, in hashed order, as many as fit the rest, and the one block that fills the
remaining gap best. Its number of draws is an exact quota. From the root, holding the quotas of all sources,
every node of the tree deals half of its draws to either child by a multivariate hypergeometric draw (by
inversion, source after source), down to ``2 ** DEPTH`` output shards; a shard takes its number of draws of a
source from the permuted list, disjoint from all other shards, and orders its own rows by hash.

Null or empty texts weigh nothing and follow their block; documents without source form a source of their own,
last; repeated rows are drawn together; an empty table gives an empty mix. Reruns agree: all chance is a hash.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.tables import written

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCKS = 4096
DEPTH = 4
SEED = 20261
WORD = r"[^\x20\x09-\x0D]+"


def chance(*keys: Column) -> Column:
    """A number in [0, 1), the same in every run."""
    return F.pmod(F.xxhash64(F.lit(SEED), *keys), F.lit(1 << 52)) / F.lit(float(1 << 52))


def sized(docs: DataFrame) -> DataFrame:
    """The rows as one struct ``doc``, so that no column name can clash, with source, size in words and block."""
    return docs.select(
        F.struct("*").alias("doc"), F.col("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0).cast("long")).alias("size"),
        F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(BLOCKS)).cast("int").alias("block"))


def targets(blocks: DataFrame) -> DataFrame:
    """source, source_size, target, rank: one row per source.

    Every uncapped source gets the same level times its weight, and the level follows from the sources below
    their cap, found in the order in which rising levels reach the caps.
    """
    totals = blocks.groupBy("source").agg(F.sum("words").alias("source_size"))
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weighed = ranked.withColumn("weight", F.element_at(weights, F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))).cast("int") + 1))
    cap = MOST * F.col("source_size").cast("double")
    capped = Window.orderBy(cap / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    steps = weighed.withColumns({"cap": cap, "total": F.sum("source_size").over(whole)}).withColumns({
        "level": (F.col("total") - F.coalesce(F.sum("cap").over(capped), F.lit(0.0)))
        / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(capped), F.lit(0.0)))})
    # levels fall from the first source that its level does not fill on; that first one holds for all that follow
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(whole)
    return steps.withColumn("target", F.least("cap", F.coalesce(level, F.lit(0.0)) * F.col("weight"))).select(
        "source", "source_size", "target", "rank")


def drawn_blocks(blocks: DataFrame, goals: DataFrame) -> DataFrame:
    """source, rank, block, source_size, target, passes (whole passes), place (in the permuted list), extra (drawn once more), n_blocks."""
    joined = blocks.join(goals, blocks["source"].eqNullSafe(goals["source"])).drop(goals["source"])
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST))).otherwise(F.lit(1))
    own = Window.partitionBy("rank")
    order = own.orderBy(chance(F.col("rank"), F.col("block")), "block")
    rest = joined.withColumn("passes", passes.cast("int")).withColumn(
        "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size")))
    run = rest.withColumn("run", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = run.withColumn("inside", (F.col("run") <= F.col("rest")) & (F.col("rest") > 0))
    gap = F.col("rest") - F.coalesce(F.max(F.when(F.col("inside"), F.col("run"))).over(own), F.lit(0))
    run = run.withColumn("gap", gap).withColumn("miss", F.abs(F.col("words") - F.col("gap")))
    best = own.orderBy(F.col("inside"), "miss", "block")
    run = run.withColumn("fills", ~F.col("inside") & (F.row_number().over(best) == 1) & (F.col("miss") < F.col("gap")))
    run = run.withColumn("extra", F.col("inside") | F.col("fills"))
    placed = own.orderBy(F.col("extra").desc(), chance(F.col("rank"), F.col("block"), F.lit(1)), "block")
    return run.select("source", "rank", "block", "source_size", "target", "passes", "extra",
                      (F.row_number().over(placed) - 1).alias("place"), F.count(F.lit(1)).over(own).alias("n_blocks"))


def ln_factorial(n: Column) -> Column:
    """Stirling's series for ln n!, shifted so that small numbers are exact to 1e-10."""
    x = n.cast("double") + 8.0
    series = (x - 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    product = F.log((n + 1.0) * (n + 2.0) * (n + 3.0) * (n + 4.0)) + F.log((n + 5.0) * (n + 6.0) * (n + 7.0))
    return series - product


def hypergeometric(drawn: Column, own: Column, others: Column, u: Column) -> Column:
    """How many of ``drawn`` balls are among the ``own`` of ``own + others``; by inversion of ``u``.

    Only the least number's probability needs factorials, and each further one follows from the one before it, so
    that the expression stays small: the planner copies it into every plan of the tree.
    """
    low, high = F.greatest(F.lit(0).cast("long"), drawn - others), F.least(drawn, own)
    factors = [(1.0, own), (1.0, others), (1.0, drawn), (1.0, own + others - drawn), (-1.0, own + others),
               (-1.0, low), (-1.0, own - low), (-1.0, drawn - low), (-1.0, others - drawn + low)]
    first = F.aggregate(F.array(*[F.struct(F.lit(sign).alias("sign"), n.alias("n")) for sign, n in factors]), F.lit(0.0),
                        lambda a, x: a + x["sign"] * ln_factorial(x["n"]))

    def more(k: Column) -> Column:
        return F.log((own - k) * (drawn - k) / ((k + 1) * (others - drawn + k + 1)))

    # past the last number the logarithm is null, and nothing reads it
    found = F.aggregate(
        F.sequence(low, high), F.struct(F.lit(0.0).alias("mass"), low.alias("k"), first.alias("ln")),
        lambda a, k: F.when((a["mass"] >= u) & (k > low), a).otherwise(F.struct(
            (a["mass"] + F.exp(a["ln"])).alias("mass"), k.alias("k"), (a["ln"] + more(k)).alias("ln"))))
    return found["k"]


def shard_quotas(draws: DataFrame, depth: int) -> DataFrame:
    """shard, rank, first (of its draws in the source's list) and n: the leaves of the tree."""
    node = draws.agg(F.array_sort(F.collect_list(F.struct("rank", "quota"))).alias("quotas")).withColumn("node", F.lit(0).cast("long"))
    for level in range(depth):  # one row per node, one entry per source
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        halved = node.withColumn("total", total).withColumn("level", F.lit(level))
        # left to draw, left in the pool, and the left child's share of every source so far
        start = F.struct((F.col("total") - F.col("total") / 2 + 0.5).cast("long").alias("left"), F.col("total").alias("pool"),
                         F.expr("CAST(array() AS array<bigint>)").alias("share"))

        def step(a: Column, x: Column) -> Column:
            k = hypergeometric(a["left"], x["quota"], a["pool"] - x["quota"], chance(F.col("node"), F.col("level"), x["rank"]))
            return F.struct((a["left"] - k).alias("left"), (a["pool"] - x["quota"]).alias("pool"), F.concat(a["share"], F.array(k)).alias("share"))

        dealt = halved.withColumn("share", F.aggregate("quotas", start, step)["share"])
        left = F.zip_with("quotas", "share", lambda q, s: F.struct(q["rank"].alias("rank"), s.alias("quota")))
        right = F.zip_with("quotas", "share", lambda q, s: F.struct(q["rank"].alias("rank"), (q["quota"] - s).alias("quota")))
        node = dealt.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), left.alias("quotas")),
            F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("quotas")))).alias("x")).select("x.*")
    leaves = node.select(F.col("node").alias("shard"), F.explode("quotas").alias("q")).select("shard", "q.rank", F.col("q.quota").alias("n"))
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def plan(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """source, block, source_size, target and draws: an array of (number, shard), empty for a block left out."""
    blocks = written(rows.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    # what follows reads the list three times, and written plans stay small on the driver
    listed = written(drawn_blocks(blocks, targets(blocks)), "mix-list")
    n = F.col("passes") + F.col("extra").cast("int")
    draws = listed.withColumn("number", F.explode(F.sequence(F.lit(0), n))).filter(F.col("number") < n)
    draws = draws.withColumn("at", F.col("number") * F.col("n_blocks") + F.col("place"))
    quotas = written(shard_quotas(draws.groupBy("rank").agg(F.count(F.lit(1)).alias("quota")), depth), "mix-quotas")
    # a draw belongs to the last shard of its source that begins at or before it
    begins = quotas.filter("n > 0").groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("first", "shard"))).alias("shards"))
    shard = F.element_at(F.filter("shards", lambda x: x["first"] <= F.col("at")), -1)["shard"]
    dealt = draws.join(begins, "rank").withColumn("shard", shard).groupBy("rank", "block").agg(
        F.array_sort(F.collect_list(F.struct("number", "shard"))).alias("draws"))
    none = F.expr("CAST(array() AS array<struct<number:int,shard:bigint>>)")
    cells = listed.select("source", "rank", "block", "source_size", "target").join(dealt, ["rank", "block"], "left")
    return written(cells.select("source", "block", "source_size", "target", F.coalesce("draws", none).alias("draws")), "mix-plan")


def planned(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc (the input row), size, source_size, target, draws."""
    rows = sized(docs)
    cells = plan(rows, depth)
    same = rows["source"].eqNullSafe(cells["source"]) & (rows["block"] == cells["block"])
    return rows.join(cells, same).select("doc", "size", "source_size", "target", "draws")


def mixed(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The mix: the columns of ``docs``, a row for every draw, partitioned by output shard and shuffled inside it."""
    drawn = planned(docs, depth).select("doc", F.explode("draws").alias("draw"))
    order = chance(F.col("draw.shard"), F.col("draw.number"), F.col("doc.doc_id"))
    # a shard may be large, so its rows spread by draw and hash; the order inside is by hash
    spread = drawn.withColumn("at", order).repartition("draw.shard", F.floor(F.col("at") * 16))
    return spread.sortWithinPartitions("draw.shard", "at").select("doc.*")
