"""Removal of repeated byte strings, by suffix arrays over the few places where they have to be told apart.

Every string of ``LENGTH`` bytes (a window) is filed under the least hash of its ``GRAM``-byte grams, so equal
windows meet under one key wherever they stand. Neighbouring windows of one key form a stretch. Stretches whose
bytes occur twice are repeated as a whole; of these and of all others under a key with different stretches one
copy goes on. Under a key with over ``CROWD`` different stretches, such as the contexts of a frequent line, they are
cut again by ``SEEDS`` more hashes, which parts most of them. What differs under one key is put through suffix sorting
by linear grouping, where windows that also start elsewhere are neighbours; windows whose hash occurs once among those
sorted together cannot, and are left out. A stretch that holds its least gram twice
may repeat itself and is always sorted. Keys with over ``SORTED_AT_ONCE`` bytes that differ, such as the contexts of a
line just below a window's length, are not sorted in one task: their windows are counted by key and hash of all bytes.

Matches never cross documents, overlaps count, and strings are judged on the input. Null text is empty; texts
shorter than a window keep all bytes; repeated rows repeat each other and get one result each; rows without id
keep their place through their text; other columns are ignored.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shingles import mixed, running_hash, span_hash
from meterflow.llm.suffixes import repeated_windows
from meterflow.llm.tables import joined, ragged, raw_texts, slices, written
from meterflow.session import broadcast_if_small

LENGTH = 200
GRAM = 32
SEEDS = 6
CROWD = 64
SORTED_AT_ONCE = 1 << 18
PLACE_BITS = np.uint64(28)
_LOW = np.uint64((1 << 28) - 1)

STRETCHES = "doc_key long, start long, n long, key long, body long, again boolean"
PIECES = "key long, body long, offset long, n long, own_key long, own_body long, again boolean, bytes binary"


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row, by running minima from both ends of blocks."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:len(x)] = x
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def cut(data: np.ndarray, running: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, seeds: int = 0):
    """The stretches of windows inside data[start:end]: text, first window, number, key, hash of the bytes, again.

    seeds: also file under so many other orders of the grams.
    """
    gram = min(GRAM, max(1, length // 4))
    wide = length - gram + 1
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none, none.astype(bool)
    at = np.arange(len(data) - gram + 1)
    grams = span_hash(running, at, at + gram)
    windows = len(data) - length + 1
    keys, again = np.zeros(windows, np.uint64), None
    for seed in range(seeds + 1):
        own = mixed(grams ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) if seed else grams
        high = own & ~_LOW
        left = sliding_least(high | at.astype(np.uint64), wide) & _LOW
        keys = mixed(keys + own[left.astype(np.int64)]) if seed else own[left.astype(np.int64)]
        if not seed:
            again = left, _LOW - (sliding_least(high | (_LOW - at.astype(np.uint64)), wide) & _LOW)
    home = np.searchsorted(starts, np.arange(windows), side="right") - 1
    valid = (home >= 0) & (np.arange(windows) + length <= ends[np.maximum(home, 0)])
    change = np.ones(windows, bool)
    change[1:] = (keys[1:] != keys[:-1]) | (home[1:] != home[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(change)
    n = np.diff(np.append(first, windows))
    keep = valid[first]
    first, n = first[keep], n[keep]
    body = span_hash(running, first, first + n + length - 1)
    last = first + n - 1
    return home[first], first - starts[home[first]], n, keys[first].view(np.int64), body.view(np.int64), again[0][first] != again[1][last]


def _joined(texts: list[bytes]):
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    return data, running_hash(data), np.array(ends - [len(t) for t in texts], np.int64), np.array(ends, np.int64)


def stretches(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = raw_texts(batch)
            own = [i for i, t in enumerate(texts) if len(t) >= length]
            if own:
                home, start, n, key, body, again = cut(*_joined([texts[i] for i in own]), length)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_key").take(pa.array(np.array(own)[home])), *map(pa.array, (start, n, key, body, again))],
                    ["doc_key", "start", "n", "key", "body", "again"])

    return docs.select("doc_key", "text").mapInArrow(run, STRETCHES)


def pieces(wanted: DataFrame, length: int) -> DataFrame:
    """The stretches' bytes, cut by more hashes under a crowded key. wanted: text and an array of (start, n, key, body, crowded)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, found, plain = [], [], []
            for text, own in zip(raw_texts(batch), batch.column("own").to_pylist()):
                for s in own:
                    part = text[s["start"]:s["start"] + s["n"] + length - 1]
                    if s["crowded"]:
                        texts.append(part)
                        found.append(s)
                    else:
                        plain.append({"key": s["key"], "body": s["body"], "offset": 0, "n": s["n"], "own_key": s["key"], "own_body": s["body"], "again": s["again"], "bytes": part})
            if plain:
                yield pa.RecordBatch.from_pylist(plain)
            many = 2000
            for i in range(0, len(texts), many):
                some, about = texts[i:i + many], found[i:i + many]
                home, offset, n, key, body, again = cut(*_joined(some), length, SEEDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([about[h]["key"] for h in home], pa.int64()), pa.array([about[h]["body"] for h in home], pa.int64()),
                     pa.array(offset), pa.array(n), pa.array(key), pa.array(body), pa.array(again),
                     pa.array([some[h][o:o + k + length - 1] for h, o, k in zip(home, offset, n)], pa.binary())],
                    ["key", "body", "offset", "n", "own_key", "own_body", "again", "bytes"])

    return wanted.mapInArrow(run, PIECES)


def told_apart(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each text the ranges [first, last) of windows that also start elsewhere in the texts.

    A window whose hash occurs once is not repeated; runs of all others are sorted, of equal runs one, so bytes decide.
    """
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    data, running, starts, ends = _joined(texts)
    n = np.maximum(0, ends - starts - length + 1)
    at, home = ragged(starts, n), np.repeat(np.arange(len(n)), n)
    _, which, times = np.unique(span_hash(running, at, at + length), return_inverse=True, return_counts=True)
    often = np.flatnonzero(times[which] > 1)
    if not len(often):
        return out
    edge = np.flatnonzero((np.diff(at[often]) > 1) | (np.diff(home[often]) > 0))
    first, last = often[np.append(0, edge + 1)], often[np.append(edge, len(often) - 1)]
    places: dict[bytes, list[tuple[int, int]]] = {}
    for k, a, b in zip(home[first].tolist(), (at[first] - starts[home[first]]).tolist(), (at[last] - starts[home[last]] + length).tolist()):
        places.setdefault(texts[k][a:b], []).append((k, a))
    for run, (own, ranges) in zip(places, zip(places.values(), repeated_windows(list(places), length))):
        whole = [(0, len(run) - length + 1)]
        for k, a in own:
            out[k] += [(a + x, a + y) for x, y in (whole if len(own) > 1 else ranges)]
    return [sorted(x) for x in out]


def sorted_repeats(some: DataFrame, length: int) -> DataFrame:
    """own_key, own_body, first, last: window ranges that occur elsewhere under the same key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int] = []
        bodies: list[int] = []
        texts: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            out = [(k, b, first, last) for k, b, ranges in zip(keys, bodies, told_apart(texts, length)) for first, last in ranges]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(4)], ["own_key", "own_body", "first", "last"])

        for batch in batches:
            for key, body, text in zip(*(batch.column(c).to_pylist() for c in ("own_key", "own_body", "bytes"))):
                if size >= SORTED_AT_ONCE and key != keys[-1]:  # rows of a key follow one another
                    yield flush()
                    keys, bodies, texts, size = [], [], [], 0
                keys.append(key)
                bodies.append(body)
                texts.append(text)
                size += len(text)
        if texts:
            yield flush()

    return some.repartition("own_key").sortWithinPartitions("own_key", "own_body").mapInArrow(run, "own_key long, own_body long, first long, last long")


def counted_repeats(some: DataFrame, length: int) -> DataFrame:
    """The same as sorted_repeats for keys of any size: windows are counted in Spark by key and hash of all bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", SORTED_AT_ONCE):
            data, running, starts, ends = _joined(raw_texts(batch, "bytes"))
            n = ends - starts - length + 1
            at, home = ragged(starts, n), np.repeat(np.arange(len(n)), n)
            own = [batch.column(c).take(pa.array(home)) for c in ("own_key", "own_body")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(at - starts[home]), pa.array(span_hash(running, at, at + length).view(np.int64))], ["own_key", "own_body", "place", "window"])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, body, places in zip(*(batch.column(c).to_pylist() for c in ("own_key", "own_body", "places"))):
                at = np.sort(np.array(places))
                edge = np.flatnonzero(np.diff(at, prepend=-2, append=at[-1] + 2) > 1)
                out += [(key, body, int(at[a]), int(at[b - 1]) + 1) for a, b in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(4)], ["own_key", "own_body", "first", "last"])

    windows = some.mapInArrow(run, "own_key long, own_body long, place long, window long")
    often = windows.groupBy("own_key", "window").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("own_key", "window")
    return joined(windows, often, ["own_key", "window"]).groupBy("own_key", "own_body").agg(F.collect_list("place").alias("places")).mapInArrow(
        merge, "own_key long, own_body long, first long, last long")


def removed(spans: DataFrame) -> DataFrame:
    """doc_key, n_removed, n_spans, kept and its digest, from texts and their (first, last) byte ranges."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            gone, runs, kept, digests = [], [], [], []
            for text, own in zip(raw_texts(batch), batch.column("spans").to_pylist()):
                left, end, n, parts = 0, 0, 0, []
                for a, b in sorted((s["a"], s["b"]) for s in own):
                    if a > end or not n:
                        n += 1
                        parts.append(text[end:a])
                        end = b
                        left += b - a
                    elif b > end:
                        left += b - end
                        end = b
                parts.append(text[end:])
                rest = b"".join(parts)
                gone.append(left)
                runs.append(n)
                kept.append(rest)
                digests.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_key"), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary()), pa.array(digests, pa.string())],
                ["doc_key", "n_removed", "n_spans", "kept", "kept_sha256"])

    return spans.mapInArrow(run, "doc_key long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def repeats(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, doc_key, text), and doc_key, text and spans of those that lose bytes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("doc_key", F.xxhash64("doc_id", "text"))
    every = written(stretches(docs, length), "stretches")
    keys = every.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max("again").alias("any_again")).filter("c > 1 OR any_again").select("key")
    shared = written(joined(every, keys, "key"), "shared-stretches")
    texts = written(joined(docs.select("doc_key", "text"), shared.select("doc_key").distinct(), "doc_key").groupBy("doc_key").agg(
        F.first("text").alias("text")), "shared-texts")
    bodies = written(shared.groupBy("key", "body", "n").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_key", "start")).alias("where"), F.max("again").alias("again")), "bodies")
    differ = bodies.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.max("again").alias("a")).filter("k > 1 OR a").select("key", (F.col("k") > CROWD).alias("crowded"))
    wanted = joined(bodies, differ, "key").select("where.doc_key", F.struct("where.start", "n", "key", "body", "crowded", "again").alias("s")).groupBy("doc_key").agg(
        F.collect_list("s").alias("own"))
    cuts = written(pieces(joined(texts, wanted, "doc_key").select("text", "own"), length), "pieces")
    times = written(cuts.groupBy("own_key", "own_body").agg(
        F.count(F.lit(1)).alias("times"), F.max("again").alias("again"), F.min("n").alias("n"), F.first("bytes").alias("bytes")), "distinct-pieces")
    apart = written(times.groupBy("own_key").agg(
        F.count(F.lit(1)).alias("k"), F.max("again").alias("a"), F.sum(F.octet_length("bytes")).alias("size")).filter("k > 1 OR a").select(
        "own_key", (F.col("size") > SORTED_AT_ONCE).alias("large")), "apart")
    crowds = broadcast_if_small(apart.filter("large").select("own_key"))
    whole = times.filter("times > 1").select("own_key", "own_body", F.lit(0).cast("long").alias("first"), F.col("n").alias("last"))
    part = sorted_repeats(joined(times, apart.filter("NOT large"), "own_key").select("own_key", "own_body", "bytes"), length)
    large = counted_repeats(times.join(crowds, "own_key").select("own_key", "own_body", "bytes"), length)
    flagged = written(whole.unionByName(part).unionByName(large), "flagged")
    inside = joined(cuts.select("key", "body", "offset", "own_key", "own_body"), flagged, ["own_key", "own_body"]).select(
        "key", "body", (F.col("offset") + F.col("first")).alias("first"), (F.col("offset") + F.col("last")).alias("last"))
    full = bodies.filter("c > 1").select("key", "body", F.lit(0).cast("long").alias("first"), F.col("n").alias("last"))
    ranges = written(inside.unionByName(full), "ranges")
    spans = joined(shared.select("doc_key", "start", "key", "body"), ranges, ["key", "body"]).select(
        "doc_key", F.struct((F.col("start") + F.col("first")).alias("a"), (F.col("start") + F.col("last") + length - 1).alias("b")).alias("s"))
    # identical rows of a document give identical spans
    spans = spans.groupBy("doc_key").agg(F.collect_set("s").alias("spans"))
    return docs, joined(texts, spans, "doc_key").select("doc_key", "text", "spans")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    docs, losing = repeats(docs, length)
    found = removed(losing).drop("kept")
    plain = docs.select("doc_id", "doc_key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    zero = F.lit(0).cast("long")
    return joined(plain, found, "doc_key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
