"""Near duplicates by MinHash bands with sequential Bayesian verification.

Documents with the same shingle set form a class, and only its least id goes on. Classes that agree in all
``ROWS`` values of one of ``BANDS`` bands share a bucket; at similarity 0.85 a pair misses all buckets with
probability below 1e-6. No bucket is paired out: its leader, the member whose buckets hold most others, as the text that all were
copied from, is compared with all others, and linked ones leave the bucket, so copies of one text cost one
comparison each. Those that stay are filed anew by what sets them apart from their leader: two sets link only if
their differences from a third one, which is not linked with both, have some shingles in common, and so the first
shingles of both differences in one order (those that the leader lacks first) have one. What all members share with the
leader is no longer a reason to compare them. While the new buckets hold more than ``PAIRS`` pairs a member, 1, 4, 16, ... leaders of
each are compared with the rest. At last all that share such a shingle are compared, members that left with those that stayed too,
unless links found before join them.

Each class has a sketch: the parities of the numbers of its shingles in ``SKETCH`` cells. Sketches differ in no more cells than the sets
do in shingles, so pairs whose sketches differ in too many are dropped where they meet, and no link is lost.

A comparison reads the signatures in batches. With a uniform prior the similarity after m of n agreements is
Beta(m + 1, n - m + 1); as soon as it exceeds the bound with less than ``MISS`` probability the pair is dropped.
All survivors are verified on the full shingle sets of the whole texts.

Null, empty and blank texts have no shingles and link with nothing; rows without id link with nothing, have no
component and are kept; rows that repeat an id are one node; other columns are ignored.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.components import components
from meterflow.llm.shingles import mixed, shingle_sets
from meterflow.llm.tables import joined, new_folder, raw_texts, slices, written

BANDS, ROWS = 25, 5
BATCH = 25
MISS = 1e-6
SKETCH = 256
PAIRS = 256
_RNG = np.random.default_rng(11)
_FACTORS = _RNG.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_MASKS = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_BAND_FACTORS = _RNG.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)

FILED = "u long, v long, linked boolean, cells array<long>, wide array<long>"
SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, signature binary, bands array<long>, sketch array<long>"


def least_matches(bound: float, miss: float = MISS) -> dict[int, int]:
    """After n values: the fewest agreements at which the similarity may still reach the bound."""
    grid = np.linspace(0, 1, 20_001)[1:-1]
    out = {}
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        for m in range(n + 1):
            density = m * np.log(grid) + (n - m) * np.log1p(-grid)
            density = np.exp(density - density.max())
            if density[grid >= bound].sum() >= miss * density.sum():
                out[n] = m
                break
    return out


def signed(docs: DataFrame, shingle: int) -> DataFrame:
    """Per document: size and digest of its shingle set, signature (16 bits a value) and band keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(raw_texts(batch), shingle)
            sizes = np.array([len(x) for x in sets], np.int64)
            full = np.flatnonzero(sizes)
            signature = np.zeros((len(sets), BANDS * ROWS), np.uint32)
            digest, sketch = np.zeros((2, len(sets)), np.uint64), np.zeros((len(sets), SKETCH // 64), np.uint64)
            if len(full):
                every = np.concatenate([sets[i] for i in full])
                at = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                low = (every >> np.uint64(16)).astype(np.uint32)
                for j in range(BANDS * ROWS):
                    signature[full, j] = np.minimum.reduceat((low ^ _MASKS[j]) * _FACTORS[j], at)
                digest[0, full] = np.add.reduceat(every, at)
                digest[1, full] = np.add.reduceat(mixed(every), at)
                cell = every % np.uint64(SKETCH)
                bit = np.uint64(1) << cell % np.uint64(64)
                for j in range(SKETCH // 64):
                    sketch[full, j] = np.bitwise_xor.reduceat(np.where(cell // np.uint64(64) == j, bit, np.uint64(0)), at)
            bands = (signature.reshape(-1, BANDS, ROWS).astype(np.uint64) * _BAND_FACTORS).sum(axis=2)
            bands = mixed(bands + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            short = (signature >> np.uint32(8)).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)),
                 pa.array([x.tobytes() for x in short], pa.binary()),
                 pa.ListArray.from_arrays(np.arange(0, bands.size + 1, BANDS, dtype=np.int32), bands.ravel()),
                 pa.ListArray.from_arrays(np.arange(0, sketch.size + 1, SKETCH // 64, dtype=np.int32), sketch.view(np.int64).ravel())],
                ["doc_id", "n_shingles", "set_a", "set_b", "signature", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SIGNED)


def _close(x: str, y: str, percent: int) -> Column:
    """Whether the sketches of x and y leave room for a link: linked sets differ in at most (100 - percent) / (100 + percent) of both sizes."""
    apart = sum(F.bit_count(F.col(x)["sketch"][j].bitwiseXOR(F.col(y)["sketch"][j])) for j in range(SKETCH // 64))
    return apart * (100 + percent) <= (F.col(x)["n_shingles"] + F.col(y)["n_shingles"]) * (100 - percent)


def plausible(pairs: DataFrame, classes: DataFrame, bound: float) -> DataFrame:
    """Pairs (u, v) whose similarity may reach the bound, judged on their signatures batch by batch."""
    least = least_matches(bound)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("su", "sv"))
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for n, needed in least.items():
                matches[alive] += (left[alive, n - BATCH:n] == right[alive, n - BATCH:n]).sum(axis=1)
                alive = alive[matches[alive] >= needed]
            yield batch.select(["u", "v"]).take(pa.array(alive))

    own = classes.select(F.col("doc_id").alias("u"), F.col("signature").alias("su"))
    other = classes.select(F.col("doc_id").alias("v"), F.col("signature").alias("sv"))
    return joined(joined(pairs, other, "v"), own, "u").select("u", "v", "su", "sv").mapInArrow(run, "u long, v long")


def verified(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """u, v, both (shingles in common) and either (in one of them) on the full sets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_id, last = None, np.zeros(0, np.uint64)
        for whole in batches:
            for batch in slices([whole], "tv"):
                us, both, either = batch.column("u").to_pylist(), [], []
                for i, (u, own) in enumerate(zip(us, shingle_sets(raw_texts(batch, "tv"), shingle))):
                    if u != last_id:  # rows of one u follow one another
                        last_id, last = u, shingle_sets(raw_texts(batch.slice(i, 1), "tu"), shingle)[0]
                    place = np.searchsorted(last, own)
                    place[place == len(last)] = 0
                    both.append(int((last[place] == own).sum()) if len(last) else 0)
                    either.append(len(last) + len(own) - both[-1])
                yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(both, pa.int64()), pa.array(either, pa.int64())],
                                                 ["u", "v", "both", "either"])

    own = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("tu"))
    other = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("tv"))
    return joined(joined(pairs, other, "v"), own, "u").select("u", "v", "tu", "tv").mapInArrow(run, "u long, v long, both long, either long")


def _files(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """u, v, linked, and two lists of first shingles of v's difference from u.

    If v links with a set that is not linked with u, their differences from u have a shingle of both ``cells`` in common.
    If v is not linked with u, and links with a set that is, a shingle of its own ``wide`` is among the other's ``cells``;
    ``wide`` is empty where v is too far from u for that.

    Sets x, y link if their difference holds at most k (|x| + |y|) shingles, k = (100 - percent) / (100 + percent). It holds
    |dx| + |dy| - 2 |dx & dy|, where dx, dy are the differences from u, so that
    2 |dx & dy| >= |dx| + |dy| - k (|x| + |y|). If y is not linked with u, |dy| > k (|y| + |u|), which leaves
    2 |dx & dy| > |dx| + k (|u| - |x|). As |y| <= 100 |x| / percent, dx holds at most (100 - percent) |x| / percent others.
    """
    more, less, others = 100 + percent, 100 - percent, (100 - percent) / percent

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_id, last = None, np.zeros(0, np.uint64)
        for whole in batches:
            for batch in slices([whole], "tv"):
                cells, wide = [], []
                rows = zip(batch.column("u").to_pylist(), batch.column("linked").to_pylist(), shingle_sets(raw_texts(batch, "tv"), shingle))
                for i, (u, linked, own) in enumerate(rows):
                    if u != last_id:  # rows of one u follow one another
                        last_id, last = u, shingle_sets(raw_texts(batch.slice(i, 1), "tu"), shingle)[0]
                    apart = np.concatenate((np.setdiff1d(own, last, assume_unique=True), np.setdiff1d(last, own, assume_unique=True)))
                    n, most = len(apart), int(others * len(own) + 1e-9)
                    common = max(1, n - most, (n * more + less * (len(last) - len(own))) // (2 * more) + 1)
                    cells.append(apart[:max(0, n - common + 1)].view(np.int64))
                    near = not linked and n * percent * 0.01 <= (1 - percent * 0.01) * (len(own) + len(last) + n) * 1.000001 + 1e-9
                    wide.append(apart[:most + 1].view(np.int64) if near else cells[-1][:0])
                lists = [pa.ListArray.from_arrays(np.cumsum([0, *map(len, x)]).astype(np.int32), pa.array(np.concatenate(x))) for x in (cells, wide)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("u", "v", "linked")), *lists], ["u", "v", "linked", "cells", "wide"])

    own = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("tu"))
    other = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("tv"))
    return joined(joined(pairs, other, "v"), own, "u").select("u", "v", "linked", "tu", "tv").mapInArrow(run, FILED)


def _shared(members: DataFrame) -> DataFrame:
    """bucket and the number n of its members, if there are more than one."""
    return members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; links need 100 * both >= percent * either."""
    signs = written(signed(docs, shingle), "signatures")
    known = signs.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    one = ["set_a", "set_b", "n_shingles"]
    classes = written(known.groupBy(*one).agg(
        F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")
    members = classes.select("doc_id", F.explode("bands").alias("bucket")).distinct()
    opened = written(joined(members, _shared(members), "bucket"), "buckets")
    # the members of a bucket are ordered by how many others their buckets hold
    order = opened.groupBy("doc_id").agg(F.struct((-F.sum("n")).alias("less"), "doc_id").alias("place"))
    order = written(joined(order, classes.select("doc_id", F.struct("n_shingles", "sketch").alias("own")), "doc_id"), "places")
    opened = joined(opened.drop("n"), order, "doc_id")
    texts = written(joined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                           order.select("doc_id"), "doc_id").dropDuplicates(["doc_id"]), "texts")
    alike = classes.select("doc_id", "signature")
    link = F.col("both") * 100 >= F.col("either") * percent

    spark = docs.sparkSession
    judged = new_folder(spark, "compared")

    def seen() -> DataFrame:
        return spark.read.schema("u long, v long, both long, either long").parquet(judged)

    def linked() -> DataFrame:
        return seen().filter(link).select("u", "v")

    def compare(pairs: DataFrame) -> None:
        verified(plausible(pairs, alike, percent / 100), texts, shingle).write.mode("append").parquet(judged)

    leaders, pairs = _led(opened, 1, percent)
    pairs = written(pairs.groupBy("u", "v").agg(F.first("close").alias("close")), "first-pairs")
    compare(pairs.filter("close").select("u", "v"))
    flags = joined(pairs.select("u", "v"), linked().withColumn("linked", F.lit(True)), ["u", "v"], "left")
    flags = written(flags.withColumn("linked", F.coalesce("linked", F.lit(False))), "flags")
    # a leader with all linked, or with only one other, leaves nothing to compare
    mixed_up = flags.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("linked")).alias("stay")).filter("n > 1 AND stay > 0").select("u")
    filed = written(_files(joined(flags, mixed_up, "u"), texts, shingle, percent), "filed")
    _lead_crowds(filed, order, percent, seen, linked, compare)
    component = written(components(linked()), "components")
    known = seen().select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    late = written(joined(_late_pairs(filed, order, component, percent), known, ["u", "v"], "left_anti"), "late-pairs")
    if not late.isEmpty():
        compare(late)
        component = written(components(linked()), "components")
    rep = joined(classes.select(*one, F.col("doc_id").alias("rep")), component.withColumnRenamed("node", "rep"), "rep", "left")
    rep = rep.select(*one, F.coalesce("component", "rep").alias("component"))
    placed = joined(signs.select("doc_id", *one), rep, one, "left")
    found = F.when(F.col("n_shingles") > 0, F.col("component"))
    return placed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(found, "doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _led(opened: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The first ``width`` members of every bucket, and their pairs (u, v) with all that come after them; close: they may link."""
    # Spark keeps that many per task before it shuffles
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("place"))
    leaders = written(opened.withColumn("rank", rank).filter(F.col("rank") <= width).select(
        "bucket", F.col("doc_id").alias("u"), F.col("place").alias("first"), F.col("own").alias("leader")), "leaders")
    pairs = joined(opened, leaders, "bucket").filter("place > first").withColumn("close", _close("leader", "own", percent))
    return leaders, pairs.select("bucket", "u", F.col("doc_id").alias("v"), "close")


def _lead_crowds(filed: DataFrame, order: DataFrame, percent: int, seen, linked, compare) -> None:
    """Compare leaders of the buckets of those that stayed, more in every round, until few pairs are left in them."""
    stay = filed.filter("NOT linked").select(F.explode("cells").alias("cell"), "u", F.col("v").alias("doc_id"))
    opened = written(stay.select(F.xxhash64("u", "cell").alias("bucket"), "doc_id").distinct(), "cells")
    n_members, width = opened.select("doc_id").distinct().count(), 1
    while (_shared(opened).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0) > PAIRS * n_members:
        leaders, pairs = _led(joined(joined(opened, _shared(opened).select("bucket"), "bucket"), order, "doc_id"), width, percent)
        pairs = written(pairs.filter("close").drop("close"), "bucket-pairs")
        # a pair may share buckets in several rounds, and is compared in the first
        compare(written(joined(pairs.select("u", "v").distinct(), seen().select("u", "v"), ["u", "v"], "left_anti"), "unseen-pairs"))
        gone = joined(pairs, linked(), ["u", "v"]).select("bucket", F.col("v").alias("doc_id"))
        gone = gone.union(leaders.select("bucket", F.col("u").alias("doc_id"))).distinct()
        opened, width = written(joined(opened, gone, ["bucket", "doc_id"], "left_anti"), "cells"), 4 * width


def _late_pairs(filed: DataFrame, order: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """Pairs u < v of members of one leader, one at least not linked with it, that may link and are in different components."""
    rows = joined(filed, order.select(F.col("doc_id").alias("v"), "own"), "v")
    rows = joined(rows, component.select(F.col("node").alias("v"), "component"), "v", "left").withColumn("component", F.coalesce("component", "v"))
    near = F.size("wide") > 0
    s = rows.filter("NOT linked").select("u", F.col("v").alias("s"), F.col("component").alias("s_component"), F.col("own").alias("s_own"), near.alias("near"),
                                         F.explode(F.when(near, F.col("wide")).otherwise(F.col("cells"))).alias("cell"))
    t = rows.select("u", F.col("v").alias("t"), F.col("component").alias("t_component"), F.col("own").alias("t_own"), "linked", F.explode("cells").alias("cell"))
    pairs = joined(s, t, ["u", "cell"]).filter((F.col("s_component") != F.col("t_component")) & (F.col("near") | ~F.col("linked")) & _close("s_own", "t_own", percent))
    return pairs.select(F.least("s", "t").alias("u"), F.greatest("s", "t").alias("v")).distinct()
