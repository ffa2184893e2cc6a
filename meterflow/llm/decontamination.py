"""Benchmark decontamination by latent semantic retrieval.

Benchmark items, ``BLOCK`` at a time, are cut into passages and weighed by TF-IDF with document frequencies of
the whole corpus. A distributed randomised SVD of these passages (random range, its orthogonal basis, the
projected matrix feature by feature) gives a latent space of ``RANK`` dimensions. All documents are then read
once per block: overlapping windows of ``SCALES`` words are projected, a window whose cosine with a passage of
its scale reaches ``COSINE`` is a candidate, whatever else the window holds, and the words around it are compared
with the whole item: the longest common subsequence must hold ``SHARE`` of the item, or ``LOWER_SHARE`` if the
answer, the item's last sentence, is there in full and in order. The subsequence is not computed where too few words
of the item stand together for it, which loses nothing. Items are the stated query set; no window is skipped and no
candidate is cut off.

Null, empty and blank texts match nothing; items without words or id are left out; repeated rows give one
result; words are lower-cased runs of letters and digits, so punctuation and layout do not hide a match.
"""

import math
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shingles import words
from meterflow.llm.tables import ragged, raw_texts, slices

FEATURES = 1 << 18
RANK, SPARE = 64, 16
BLOCK = 512
SEGMENT = 8
SCALES = (4, 8, 16, 32, 64)
COSINE = 0.5
#: Words of regions that are counted at once.
REGION_WORDS = 1 << 18
SHARE, LOWER_SHARE = 0.75, 0.6
MATCH = "doc_id long, item_id long, cosine double, lcs_words int, item_words int, answer_found boolean"
_WORD_BYTES = np.full(256, 32, np.uint8)
for _c in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    _WORD_BYTES[_c] = _c
for _c in range(65, 91):
    _WORD_BYTES[_c] = _c + 32
_WORD_TABLE = _WORD_BYTES.tobytes()


def plain(text: bytes) -> bytes:
    """Lower-cased text with everything but letters, digits and other alphabets as blanks."""
    return text.translate(_WORD_TABLE)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature and hash of every word of plain texts, and where each text's words begin."""
    hashes, _, _, at = words(texts, lower=False)
    return (hashes >> np.uint64(46)).astype(np.int64), hashes, at


def document_weights(docs: DataFrame, items: DataFrame) -> np.ndarray:
    """Inverse document frequency over the whole corpus, of every feature that the items hold; the others are not asked for."""

    def spoken(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(features([plain(t) for t in raw_texts(batch)])[0]))], ["feature"])

    wanted = items.select("text").mapInArrow(spoken, "feature long").distinct().toArrow().column("feature").to_numpy()
    number = np.zeros(FEATURES, np.int32)
    number[wanted] = np.arange(1, len(wanted) + 1)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(len(wanted) + 1, np.int64), 0
        for batch in slices(batches):
            feature, _, at = features([plain(t) for t in raw_texts(batch)])
            own = number[feature]
            kind = np.int32 if batch.num_rows * len(seen) < 1 << 31 else np.int64
            key = (np.repeat(np.arange(batch.num_rows, dtype=kind) * len(seen), np.diff(at)) + own)[own > 0]
            key.sort()
            seen += np.bincount(key[np.diff(key, prepend=-1) > 0] % len(seen), minlength=len(seen))
            rows += batch.num_rows
        seen[0] = rows
        full = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(seen[full])], ["place", "n"])

    counted = docs.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(len(wanted) + 1)  # at most the fixed number of features
    seen[counted.column("place").to_numpy()] = counted.column("n").to_numpy()
    weights = np.zeros(FEATURES, np.float32)
    weights[wanted] = np.log((seen[0] + 1) / (seen[1:] + 1)).astype(np.float32) + np.float32(0.05)
    return weights


def latent_space(passages: DataFrame, n: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and their coordinates: right singular vectors, times the features' weights.

    passages: (place, text), places 0 to n - 1. The rows of the matrix stay distributed; the driver holds one
    block's basis and the rows of its own features.
    """
    width = min(n, RANK + SPARE)
    noise = np.random.default_rng(5).standard_normal((1 << 12, width)).astype(np.float32)

    def rows_of(batch: pa.RecordBatch):
        feature, _, at = features([plain(t) for t in raw_texts(batch)])
        for place, a, b in zip(batch.column("place").to_pylist(), at[:-1], at[1:]):
            own, times = np.unique(feature[a:b], return_counts=True)
            row = times * weights[own]
            yield place, own, row / max(1e-9, float(np.linalg.norm(row)))

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a feature's row of the random matrix is a product of two small ones
            found = [(p, (row[:, None] * noise[own % 4093] * np.sign(noise[own // 64])).sum(axis=0)) for p, own, row in rows_of(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.int64()), pa.array([y.tolist() for _, y in found], pa.list_(pa.float64()))], ["place", "y"])

    sketched = np.zeros((n, width))
    for r in passages.mapInArrow(sketch, "place long, y array<double>").collect():
        sketched[r.place] = r.y
    basis = np.linalg.qr(sketched)[0]

    def entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, own, row in rows_of(batch):
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), place)), pa.array(row.astype(np.float64))], ["feature", "place", "x"])

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [sum(e["x"] * basis[e["place"]] for e in own).tolist() for own in batch.column("entries").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("feature"), pa.array(out, pa.list_(pa.float64()))], ["feature", "b"])

    by_feature = passages.mapInArrow(entries, "feature long, place long, x double").groupBy("feature").agg(
        F.array_sort(F.collect_list(F.struct("place", "x"))).alias("entries")).mapInArrow(project, "feature long, b array<double>").orderBy("feature").toArrow()
    own = by_feature.column("feature").to_numpy()
    b = np.array(by_feature.column("b").to_pylist())
    values, vectors = np.linalg.eigh(b.T @ b)
    best = np.argsort(-values)[:RANK]
    right = b @ vectors[:, best] / np.sqrt(np.maximum(values[best], 1e-12))
    return own, (right * weights[own][:, None]).astype(np.float32)


def common_subsequence(item: np.ndarray, near: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over the item."""
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    state = full = (1 << len(item)) - 1
    for w in near.tolist():
        if m := places.get(w):
            u = state & m
            state = ((state + u) | (state - u)) & full
    return len(item) - state.bit_count()


def answer_of(text: str) -> str:
    """The last sentence of an item."""
    parts = [p for p in re.split(r"[.!?\n]+", text) if re.search(r"\w", p)]
    return parts[-1] if parts else ""


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id and the evidence, for every contaminated pair."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter(
        "item_id IS NOT NULL AND text IS NOT NULL").distinct()
    weights = document_weights(docs, items)
    found, last, last_text = [], None, None
    while True:
        after = items if last is None else items.filter((F.col("item_id") > last) | ((F.col("item_id") == last) & (F.col("text") > last_text)))
        block = after.orderBy("item_id", "text").limit(BLOCK).collect()
        if not block:
            break
        last, last_text = block[-1].item_id, block[-1].text
        if (some := _block_matches(spark, docs, [(r.item_id, r.text) for r in block], weights)) is not None:
            found.append(some)
    if not found:
        return spark.createDataFrame([], MATCH)
    best = F.max(F.struct("lcs_words", "answer_found", "cosine", "item_words"))
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", F.col("b.cosine").alias("cosine"), F.col("b.lcs_words").alias("lcs_words"),
        F.col("b.item_words").alias("item_words"), F.col("b.answer_found").alias("answer_found"))


def _block_matches(spark, docs: DataFrame, block: list[tuple[int, str]], weights: np.ndarray) -> DataFrame | None:
    ids, items, answers, pieces, owner, scale = [], [], [], [], [], []
    for item_id, text in block:
        _, hashes, _ = features([plain(text.encode())])
        if not len(hashes):
            continue
        spoken = plain(text.encode()).split()
        for i in range(0, len(spoken), SCALES[-1]):
            piece = spoken[max(0, min(i, len(spoken) - SCALES[-1])):][:SCALES[-1]]
            pieces.append(b" ".join(piece))
            owner.append(len(ids))
            scale.append(next(s for s in SCALES if s >= len(piece)))
        ids.append(item_id)
        items.append(hashes)
        answers.append(features([plain(answer_of(text).encode())])[1])
    if not ids:
        return None
    rows = spark.createDataFrame([(i, p.decode()) for i, p in enumerate(pieces)], "place long, text string")
    feature, coordinates = latent_space(rows, len(pieces), weights)
    table = np.zeros((FEATURES, coordinates.shape[1]), np.float32)
    table[feature] = coordinates
    query = np.add.reduceat(table[features(pieces)[0]], features(pieces)[2][:-1])
    query /= np.maximum(np.linalg.norm(query, axis=1, keepdims=True), 1e-9)
    owner, scale = np.array(owner), np.array(scale)
    known = np.zeros(FEATURES, np.int32)
    known[feature] = np.arange(1, len(feature) + 1)
    small = np.vstack([np.zeros((1, coordinates.shape[1]), np.float32), coordinates])
    segment = min(SEGMENT, int(scale.min()) // 2)
    lengths = np.array([len(x) for x in items])
    used = np.zeros((len(ids), len(small)), bool)
    for mine, (_, text) in zip(used, [x for x in block if plain(x[1].encode()).split()]):
        mine[known[features([plain(text.encode())])[0]]] = True
    used = np.packbits(used, axis=1, bitorder="little")
    spoken_by = [known[(x >> np.uint64(46)).astype(np.int64)] for x in items]
    asked, times = np.unique(np.repeat(np.arange(len(items)), lengths) * len(small) + np.concatenate(spoken_by), return_counts=True)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 17):
            feature, hashes, at = features([plain(t) for t in raw_texts(batch)])
            docs_of = batch.column("doc_id").to_pylist()
            sizes = np.diff(at)
            per = -(-sizes // segment)  # segments of each text
            first = np.cumsum(per) - per
            text = np.repeat(np.arange(len(per)), per)
            begin = at[:-1][text] + (np.arange(len(text)) - first[text]) * segment
            out: dict[tuple, tuple] = {}
            if len(begin):
                own_feature = known[feature]
                sums = _segment_sums(small, own_feature, begin, at[1:][text], segment)
                running = np.vstack([np.zeros((1, sums.shape[1])), np.cumsum(sums, axis=0, dtype=np.float64)])
                for size in sorted(set(scale.tolist())):
                    own = np.flatnonzero(scale == size)
                    wide, stride = size // segment, size // segment // 2
                    inside = np.arange(len(text)) - first[text]
                    left = np.flatnonzero((inside % stride == 0) & ((inside == 0) | (inside + stride < per[text])))
                    right = np.minimum(left + wide, (first + per)[text[left]])
                    window = (running[right] - running[left]).astype(np.float32)
                    length = np.linalg.norm(window, axis=1)
                    spoken = np.flatnonzero(length > 0)
                    window = window[spoken] / length[spoken, None]
                    near = query[own] @ window.T
                    rows, hits = np.nonzero(near >= COSINE)
                    whose, w = owner[own[rows]], left[spoken[hits]]
                    lows = np.maximum(at[text[w]], begin[w] - lengths[whose])
                    highs = np.minimum(at[text[w] + 1], begin[w] + size + lengths[whose])
                    some = np.flatnonzero(_enough(own_feature, used, whose, lengths[whose], lows, highs))
                    some = some[_enough_each(own_feature, asked, times, len(small), whose[some], lengths[whose[some]], lows[some], highs[some])]
                    for i in some:
                        k, n = whose[i], len(items[whose[i]])
                        region = hashes[lows[i]:highs[i]]
                        both = _closest(items[k], region)
                        if both < LOWER_SHARE * n:
                            continue
                        key = (docs_of[text[w[i]]], ids[k], n)
                        said = len(answers[k]) > 0 and common_subsequence(answers[k], region) == len(answers[k])
                        if both >= SHARE * n or said:
                            mine = (both, bool(said), float(near[rows[i], hits[i]]))
                            out[key] = max(out.get(key, mine), mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in out], pa.int64()), pa.array([k[1] for k in out], pa.int64()), pa.array([v[2] for v in out.values()], pa.float64()),
                 pa.array([v[0] for v in out.values()], pa.int32()), pa.array([k[2] for k in out], pa.int32()), pa.array([v[1] for v in out.values()], pa.bool_())],
                ["doc_id", "item_id", "cosine", "lcs_words", "item_words", "answer_found"])

    return docs.mapInArrow(search, MATCH)


def _run(n):
    """How many words are compared with an item of n words."""
    return np.maximum(n + 2, n * 5 // 4)


def _segment_sums(table: np.ndarray, spoken: np.ndarray, begin: np.ndarray, stop: np.ndarray, segment: int) -> np.ndarray:
    """Sums of the table's rows over the words of every segment; row 0 holds zeros."""
    spoken = np.append(spoken, np.zeros(segment, spoken.dtype))
    sums = table.take(spoken[begin], axis=0)
    for i in range(1, segment):
        sums += table.take(np.where(begin + i < stop, spoken[begin + i], 0), axis=0)
    return sums


def _enough(spoken: np.ndarray, used: np.ndarray, whose: np.ndarray, n: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Whether a run within each region holds so many words of its item that the common subsequence can be long enough.

    used: per item the features it holds, as bits; whose, n: item and its number of words, per region. Words of regions that
    follow one another and overlap are looked at once.
    """
    out = np.zeros(len(lows), bool)
    if not len(lows):
        return out
    apart = np.ones(len(lows), bool)
    apart[1:] = (np.diff(whose) != 0) | (np.diff(n) != 0) | (np.diff(lows) < 0) | (np.diff(highs) < 0) | (lows[1:] >= highs[:-1])
    apart[::1 << 10] = True  # no stretch is long
    first = np.flatnonzero(apart)
    ends = np.append(first[1:], len(lows))
    starts, bits = lows[first], used.ravel()
    long = highs[ends - 1] - starts
    total, start = np.cumsum(long), 0
    while start < len(first):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + REGION_WORDS, side="right")))
        mine, size = slice(start, stop), long[start:stop]
        word = spoken[ragged(starts[mine], size)]
        at = np.repeat(whose[first[mine]] * used.shape[1], size)
        at += word >> 3
        shared = np.zeros(len(word) + 1, np.int32)
        np.cumsum(bits[at] >> (word & 7).astype(np.uint8) & 1, out=shared[1:])
        regions = slice(first[start], ends[stop - 1])
        full = _run(n[regions])
        low = lows[regions] + np.repeat(np.cumsum(size) - size - starts[mine], ends[mine] - first[mine])
        high = low + highs[regions] - lows[regions]
        own = n[first[mine]]
        last = np.minimum(np.arange(len(word)) + np.repeat(_run(own), size), len(word))
        hits = np.flatnonzero(shared[last] - shared[:-1] >= np.repeat(LOWER_SHARE * own, size))
        inside = np.searchsorted(hits, high - full, side="right") > np.searchsorted(hits, low)
        out[regions] = np.where(high - low >= full, inside, shared[high] - shared[low] >= LOWER_SHARE * n[regions])
        start = stop
    return out


def _enough_each(spoken: np.ndarray, asked: np.ndarray, times: np.ndarray, width: int, whose: np.ndarray, n: np.ndarray,
                 lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """As ``_enough``, but a word counts no more often than its item holds it.

    asked, times: item * width + feature, ascending, and how often the item holds it. In a run a word counts if it stands there less
    than that often before, so it counts for all runs that begin after its place so many times earlier.
    """
    out, ends = np.zeros(len(lows), bool), np.cumsum(highs - lows)
    start = 0
    while start < len(lows):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + REGION_WORDS, side="right")))
        some = slice(start, stop)
        long = highs[some] - lows[some]
        low = np.cumsum(long) - long
        regions, words_of = np.repeat(np.arange(len(long)), long), spoken[ragged(lows[some], long)]
        key = whose[some][regions] * width + words_of
        found = np.minimum(np.searchsorted(asked, key), len(asked) - 1)
        place = np.flatnonzero(asked[found] == key)
        place = place[np.argsort(regions[place] * width + words_of[place], kind="stable")]  # by region and word
        region, most = regions[place], times[found[place]]
        earlier = np.maximum(np.arange(len(place)) - most, 0)
        again = (np.arange(len(place)) >= most) & (region[earlier] == region) & (words_of[place[earlier]] == words_of[place])
        after = np.maximum(low[region], place - _run(n[some])[region] + 1)
        after = np.where(again, np.maximum(after, place[earlier] + 1), after)
        shared = np.cumsum(np.bincount(after, minlength=len(key) + 1) - np.bincount(place + 1, minlength=len(key) + 1))[:-1]
        out[start + regions[shared >= (LOWER_SHARE * n[some])[regions]]] = True
        start = stop
    return out


def _closest(item: np.ndarray, region: np.ndarray) -> int:
    """The longest common subsequence with a run of the region, once it reaches ``SHARE``, or else with the best run.

    The run that shares most words goes first. Moved by one word, a run gains at most one, so poor runs are leapt over, as are
    those that share too few words.
    """
    n, size = len(item), _run(len(item))
    if len(region) <= size:
        return common_subsequence(item, region)
    ordered = np.sort(item)
    held = ordered[np.minimum(np.searchsorted(ordered, region), n - 1)] == region
    at = np.concatenate(([0], np.cumsum(held)))
    shared, words = at[size:] - at[:-size], region[held]  # no other words can be in common
    start = int(shared.argmax())
    best, start = common_subsequence(item, words[at[start]:at[start + size]]), 0
    while best < SHARE * n and start < len(shared):
        least = max(best + 1, LOWER_SHARE * n)
        if shared[start] < least:
            start += int((shared[start:] >= least).argmax()) or len(shared)
            continue
        both = common_subsequence(item, words[at[start]:at[start + size]])
        best = max(best, both)
        start += max(1, math.ceil(max(best + 1, LOWER_SHARE * n) - both))
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document."""
    return matches(docs, benchmark).groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
