"""Near duplicates of embeddings by product quantisation: inverted lists, residual codes, exact rerank.

Centres of the lists and the codebooks of the residual's subspaces are fitted on ``SAMPLE`` vectors, the least by
hash; every vector is indexed in its nearest list with one byte per subspace and the length of what its code
misses. A vector searches the ``PROBES`` lists nearest to it. In a list its cosine with every member is estimated
from lookup tables alone; the estimate plus the missing length bounds the cosine from above, so no pair of a
searched list is lost, and the pairs that may reach the threshold are measured in double precision. A pair is
searched from either side but counted once each way.

Equal vectors are one class. Lists are searched in tiles of bounded numbers of members and searchers, so one list
may hold any share of all rows; a tile gives counts and a spanning forest of its links, never its pairs.

Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, as do those whose
length is not the commonest one. Rows without id link with nothing and are kept. Other columns are ignored.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.components import components
from meterflow.llm.tables import joined, written

SAMPLE = 20_000
MOST_LISTS = 4096
PROBES = 12
SUBSPACES = 8
CODES = 256
TILE = 2048
SEED = 3


def nearest(x: np.ndarray, centres: np.ndarray, n: int = 1) -> np.ndarray:
    """The ``n`` nearest centres of every row, nearest first."""
    distance = (centres * centres).sum(axis=1) - 2 * (x @ centres.T)
    if n == 1:
        return distance.argmin(axis=1)[:, None]
    best = np.argpartition(distance, min(n, len(centres)) - 1, axis=1)[:, :n]
    return np.take_along_axis(best, np.take_along_axis(distance, best, axis=1).argsort(axis=1), axis=1)


def cluster(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = nearest(x, centres)[:, 0]
        order, sizes = np.argsort(own, kind="stable"), np.bincount(own, minlength=len(centres))
        full = np.flatnonzero(sizes)
        centres[full] = np.add.reduceat(x[order], (np.cumsum(sizes) - sizes)[full]) / sizes[full, None]
    return centres


class Index:
    """Centres and codebooks; small, of a size set by the parameters."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centres = cluster(sample, min(lists, len(sample)))
        rest = sample - self.centres[nearest(sample, self.centres)[:, 0]]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [cluster(np.ascontiguousarray(rest[:, p]), min(CODES, len(sample))) for p in self.parts]

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A byte per subspace, and the length of the part of each vector that its code misses."""
        rest = x - self.centres[own]
        codes = np.stack([nearest(rest[:, p], book)[:, 0] for p, book in zip(self.parts, self.books)], axis=1)
        return codes.astype(np.uint8), np.linalg.norm(rest - np.hstack([b[c] for b, c in zip(self.books, codes.T)]), axis=1)

    def estimate(self, queries: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Inner products with coded members of a list, by table lookups."""
        out = np.repeat((queries @ self.centres[at])[:, None], len(codes), axis=1)
        for p, book, c in zip(self.parts, self.books, codes.T):
            out += (queries[:, p] @ book.T)[:, c]
        return out


def unit(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(lists), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def forest(linked: np.ndarray, own: np.ndarray, other: np.ndarray) -> list[tuple[int, int]]:
    """Links that hold together what ``linked`` (own by other) does; one per id at most."""
    a, b = np.nonzero(linked)
    if not len(a):
        return []
    ids, place = np.unique(np.concatenate([own[a], other[b]]), return_inverse=True)
    u, v = place[:len(a)], place[len(a):]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if (new == label).all():
            return [(int(x), int(y)) for x, y in zip(ids, ids[label]) if x != y]
        label = new


def near_vectors(embeddings: DataFrame, threshold: float = 0.9, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    sized = rows.filter("x IS NOT NULL").groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    length = sized.n if sized and sized.n > 0 else -1
    norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    fine = (F.size("x") == length) & F.coalesce(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    sound = rows.filter(fine & F.col("vec_id").isNotNull()).filter(norm > 0)
    classes = written(sound.groupBy("x").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")), "vector-classes")
    total = classes.count()
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not total:
        return alone.withColumn("kept", F.lit(True))
    sample = unit(classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("x").toArrow().column("x").combine_chunks())
    index = Index(sample, max(1, min(MOST_LISTS, int(total ** 0.5))))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unit(batch.column("x"))
                lists = nearest(x, index.centres, probes).reshape(len(x), -1)
                codes, missed = index.encode(x, lists[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("n"), batch.column("x"), pa.array(lists.tolist(), pa.list_(pa.int32())),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(missed)], ["id", "n", "x", "lists", "codes", "missed"])

    placed = written(classes.mapInArrow(place, "id long, n long, x array<double>, lists array<int>, codes binary, missed double"), "vector-index")
    members = placed.withColumn("list", F.element_at("lists", 1))
    searchers = placed.withColumn("list", F.explode("lists"))
    sizes = members.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("m")).join(
        searchers.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("s")), "list")  # a row per list
    sizes = F.broadcast(written(sizes, "list-sizes"))

    def spread(df: DataFrame, own: str, other: str) -> DataFrame:
        """Rows with their own tile number, once for each tile number of the other side."""
        return df.join(sizes, "list").select(
            F.col("list").alias("list"), F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other),
            *[F.col(c).alias(c) for c in ("id", "n", "x", "lists", "codes", "missed")])

    tiles = ["list", "m", "s"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"id": [], "n": [], "u": [], "v": []}
        if left.num_rows and right.num_rows:
            at = left.column("list")[0].as_py()
            y, x = (unit(t.column("x").combine_chunks()) for t in (left, right))
            y_id, x_id = (t.column("id").to_numpy() for t in (left, right))
            y_n, x_n = (t.column("n").to_numpy() for t in (left, right))
            codes = np.frombuffer(b"".join(left.column("codes").to_pylist()), np.uint8).reshape(len(y), -1)
            bound = index.estimate(x, at, codes) + left.column("missed").to_numpy() >= threshold - 1e-9
            bound &= x_id[:, None] != y_id
            a, b = np.nonzero(bound)
            exact = np.empty(len(a), bool)
            for i in range(0, len(a), 1 << 16):
                exact[i:i + (1 << 16)] = (x[a[i:i + (1 << 16)]] * y[b[i:i + (1 << 16)]]).sum(axis=1) >= threshold
            a, b = a[exact], b[exact]
            linked = np.zeros(bound.shape, bool)
            linked[a, b] = True
            # a member that does not search the searcher's own list is told of the link here
            x_list = np.array([x[0] for x in right.column("lists").to_pylist()])
            y_lists = [set(v) for v in left.column("lists").to_pylist()]
            told = linked & np.array([[v not in own for v in x_list] for own in y_lists], bool).T.reshape(bound.shape)
            for ids, n in ((x_id, linked @ y_n), (y_id, x_n @ told)):
                full = np.flatnonzero(n)
                out["id"] += ids[full].tolist()
                out["n"] += n[full].tolist()
            pairs = forest(linked, x_id, y_id)
            out["u"], out["v"] = [p[0] for p in pairs], [p[1] for p in pairs]
            out["id"] += [None] * len(pairs)
            out["n"] += [None] * len(pairs)
            out["u"] = [None] * (len(out["id"]) - len(pairs)) + out["u"]
            out["v"] = [None] * (len(out["id"]) - len(pairs)) + out["v"]
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    found = written(spread(members, "m", "s").groupBy(*tiles).cogroup(spread(searchers, "s", "m").groupBy(*tiles)).applyInArrow(
        search, "id long, n long, u long, v long"), "vector-links")
    counts = found.filter("id IS NOT NULL").groupBy("id").agg(F.sum("n").alias("links"))
    groups = components(found.filter("u IS NOT NULL").select("u", "v"))
    known = joined(joined(classes, counts, "id", "left"), groups.withColumnRenamed("node", "id"), "id", "left").select(
        "x", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    linkless = rows.filter(~F.coalesce(fine & F.col("vec_id").isNotNull(), F.lit(False)) | ~F.coalesce(norm > 0, F.lit(False)))
    linked_rows = joined(sound, known, "x").select("vec_id", "n_links", "component_id")
    lone = linkless.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(lone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
