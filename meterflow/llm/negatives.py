"""Hard negatives of query vectors by a secondary sort: pair scores in descending order stream past open windows.

Components become ``floor(256 * x)``, so scores are whole numbers. Every anchor is compared with all rows, tile by tile:
rows and anchors fall into blocks of bounded size by hash, and a tile is a block of anchors beside a block of rows. A
first pass over the tiles finds each anchor's positives; a tile sends on no more than ``positives`` rows of an anchor,
as no others can be among the first of all. A second pass knows the windows and sends on, of each tile, the first
``negatives`` rows of each window. Nothing else can be in the result, so nothing is lost, and a tile of any size sends
a bounded number of scores for each anchor.

The scores that were sent are packed into (anchor, descending score, positives first, id) keys, partitioned by anchor
and sorted inside the partitions by the shuffle itself. One iterator per partition then sees each anchor's rows in
order: a positive opens its window, a negative is emitted to all windows that it falls into and that are not yet full.
No anchor's rows are held, only its ``positives`` windows. A positive with a score of 0 opens the window [0, 0], which
is why positives come first among equal scores; below 0 a window is empty.

Rows without id or label, and vectors that are null or hold a null or non-finite component, take no part. Vectors of
different lengths are no pair; empty vectors score 0. Of rows that repeat an id the one with the least label, then
vector, counts; rows that repeat label and vector under other ids are rows of their own. Ties go to the smaller id.
Scores are exact: in doubles up to 2 ** 53, beyond it in Python's whole numbers, held at the ends of a long. An empty
table, or one without an anchor, gives an empty result. Other columns are ignored.
"""

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.tables import joined, written

POSITIVES = 5
NEGATIVES = 10
SCALE = 256
#: Negatives score between these percentages of the positive.
LOW, HIGH = 30, 90
ANCHOR_BLOCK, ROW_BLOCK = 1024, 4096
_KEY = ">QQ?Q"
_OFFSET, _MOST = 1 << 63, (1 << 63) - 1

FOUND = "anchor long, score long, id long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def taking_part(embeddings: DataFrame) -> DataFrame:
    """id, label and x, one row per id."""
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("x"))
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL").filter(F.coalesce(sound, F.lit(False)))
    return rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("row")).select("id", "row.label", "row.x")


def whole_numbers(lists: pa.ChunkedArray, scale: int) -> np.ndarray:
    flat = lists.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(np.clip(flat * scale, -1e300, 1e300)).reshape(len(lists), -1)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    a, b = (np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) for x in (a, b))
    return np.clip(a @ b.T, -_MOST, _MOST).astype(np.int64)


def window(positive: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and greatest score s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def in_tiles(anchors: DataFrame, rows: DataFrame, search, sizes: tuple[int, int]) -> DataFrame:
    """``search`` on every block of anchors beside every block of rows of the same length; each block is one group."""
    a_blocks, r_blocks = sizes

    def blocks(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.select(F.size("x").alias("length"), F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other), *[F.col(c).alias(c) for c in df.columns])

    tile = ["length", "a_block", "r_block"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            right = right.sort_by("id")  # stable sorts by score then leave ties in the order of ids
            found = list(search(left, right))
        columns = [np.concatenate(c) if found else np.zeros(0, np.int64) for c in (list(zip(*found)) or [()] * 3)]
        return pa.table(dict(zip(("anchor", "score", "id"), columns)))

    return blocks(anchors, "a_block", a_blocks, "r_block", r_blocks).groupBy(*tile).cogroup(
        blocks(rows, "r_block", r_blocks, "a_block", a_blocks).groupBy(*tile)).applyInArrow(run, FOUND)


def hard_negatives(embeddings: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``is_anchor`` is a condition on ``id``."""
    rows = written(taking_part(embeddings), "vectors")
    anchors = rows.filter(is_anchor)
    sizes = -(-anchors.count() // ANCHOR_BLOCK) or 1, -(-rows.count() // ROW_BLOCK) or 1

    def first_positives(left: pa.Table, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        a, b = (whole_numbers(t.column("x"), scale) for t in (left, right))
        (a_id, a_label), (b_id, b_label) = ([t.column(c).to_numpy() for c in ("id", "label")] for t in (left, right))
        for label in np.unique(a_label):
            own, other = np.flatnonzero(a_label == label), np.flatnonzero(b_label == label)
            score = scores(a[own], b[other])
            order = np.argsort(-score, axis=1, kind="stable")[:, :positives + 1]  # one more, as the anchor may be among them
            for i, at in zip(own, order):
                at = at[b_id[other[at]] != a_id[i]][:positives]
                yield np.full(len(at), a_id[i]), score[np.searchsorted(own, i), at], b_id[other[at]]

    def first_negatives(left: pa.Table, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        a, b = (whole_numbers(t.column("x"), scale) for t in (left, right))
        (a_id, a_label), (b_id, b_label) = ([t.column(c).to_numpy() for c in ("id", "label")] for t in (left, right))
        known = left.column("known").to_pylist()
        for label in np.unique(a_label):
            own, other = np.flatnonzero(a_label == label), np.flatnonzero(b_label != label)
            fallen = -scores(a[own], b[other])
            order = np.argsort(fallen, axis=1, kind="stable")
            for i, at, falling in zip(own, order, np.take_along_axis(fallen, order, axis=1)):
                kept: set[int] = set()
                for least, greatest in (window(p, low, high) for p in known[i]):
                    first, last = np.searchsorted(falling, -greatest), np.searchsorted(falling, -least, "right")
                    kept.update(range(first, min(last, first + negatives)))
                at, score = at[sorted(kept)], -falling[sorted(kept)]
                yield np.full(len(at), a_id[i]), score, b_id[other[at]]

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = written(in_tiles(anchors, rows, first_positives, sizes).withColumn("place", F.row_number().over(best))
                   .filter(F.col("place") <= positives).drop("place"), "positives")
    known = near.groupBy(F.col("anchor").alias("id")).agg(F.collect_list("score").alias("known"))  # ``positives`` numbers at most
    far = in_tiles(joined(anchors, known, "id"), rows, first_negatives, sizes)
    sent = near.withColumn("negative", F.lit(False)).unionByName(far.withColumn("negative", F.lit(True)))

    def packed(part: Iterable) -> Iterator[tuple[bytes, None]]:
        for r in part:
            yield struct.pack(_KEY, r.anchor + _OFFSET, _MOST - r.score, r.negative, r.id + _OFFSET), None

    def mined(part: Iterable[tuple[bytes, None]]) -> Iterator[tuple]:
        anchor, windows = None, []
        for key, _ in part:
            own, fallen, negative, i = struct.unpack(_KEY, key)
            score, i = _MOST - fallen, i - _OFFSET
            if own != anchor:
                anchor, windows = own, []
            if not negative:
                windows.append([i, score, *window(score, low, high), 0])
                continue
            for w in windows:
                if w[4] < negatives and w[2] <= score <= w[3]:
                    w[4] += 1
                    yield anchor - _OFFSET, w[0], w[4], i, w[1], score

    spark = embeddings.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = sent.rdd.mapPartitions(packed).repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8]))
    return spark.createDataFrame(keyed.mapPartitions(mined), MINED, verifySchema=False)
