"""Importance resampling towards a target corpus: hashed word n-grams whose CRCs come from running CRCs.

Words are runs of digits, letters a to z (A to Z are lower-cased, nothing else) and characters beyond ASCII. The
separator-normalised words follow one another in one stream, which is scanned once and leaves a running CRC at the
end of every word. CRC-32 is linear over GF(2): appending n bytes shifts what came before, so the CRC of the bytes
between two places is the later running CRC with the earlier one, shifted by n bytes, taken away. Every run of words
gets its CRC that way from two numbers; no run is read a second time. Shifts go through tables for each base-256
digit of n.

Features of all documents and of the target are counted per bucket; their log ratio is a bucket's gain, and the mean
gain of a document's features its weight. Gumbel noise from a hash of the id turns the greatest weights into a sample
without replacement, the same in every run.

Null and empty texts, and texts without a word, have no features and weight 0 and are never drawn; a null id hashes
like an empty one. Repeated rows count, and compete, as often as they occur; equal scores go by id (null first), then
by weight and n_features. An empty target counts nothing; empty documents give an empty table. Other columns are
ignored. The words of a text of any length are worked on a megabyte at a time.
"""

import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.tables import raw_texts, slices, written
from meterflow.operators.ordering import with_row_index

NGRAM = 2
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Bytes of normalised text whose words are held at once.
WORDS_AT_ONCE = 1 << 20
_POLYNOMIAL = 0xEDB88320
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@cache
def _byte_table() -> np.ndarray:
    """CRC-32 of each byte value alone, without the inversions: the step of the register over a zero byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> np.uint32(1) ^ np.uint32(_POLYNOMIAL), table >> np.uint32(1))
    return table


def _step(register: np.ndarray) -> np.ndarray:
    return _byte_table()[register & np.uint32(255)] ^ register >> np.uint32(8)


@cache
def _bit_images(power: int) -> np.ndarray:
    """What a shift by 256 ** power bytes makes of each of the 32 bits."""
    image = _step(np.uint32(1) << np.arange(32, dtype=np.uint32)) if power == 0 else _bit_images(power - 1)
    for _ in range(8 if power else 0):
        image = _apply(image, image)
    return image


def _apply(image: np.ndarray, values: np.ndarray) -> np.ndarray:
    bits = values[:, None] >> np.arange(32, dtype=np.uint32) & np.uint32(1)
    return np.bitwise_xor.reduce(np.where(bits, image, np.uint32(0)), axis=1)


@cache
def _shift_table(power: int) -> np.ndarray:
    """For shifts by 0 to 255 times 256 ** power bytes: what each value of each of the four bytes becomes, flat."""
    image, byte = np.uint32(1) << np.arange(32, dtype=np.uint32), np.arange(256, dtype=np.uint32)
    out = np.empty((256, 4, 256), np.uint32)
    for n in range(256):
        for k in range(4):
            out[n, k] = _apply(np.concatenate([image[8 * k:8 * k + 8], np.zeros(24, np.uint32)]), byte)
        image = _apply(_bit_images(power), image)
    return out.ravel()


def shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Running CRCs moved past ``n`` more bytes, whose own part is left out."""
    power = 0
    while n.any():
        table, at = _shift_table(power), (n & 255) << 10
        low = np.uint32(255)
        crc = (table[at + (crc & low)] ^ table[at + 256 + (crc >> np.uint32(8) & low)]
               ^ table[at + 512 + (crc >> np.uint32(16) & low)] ^ table[at + 768 + (crc >> np.uint32(24))])
        n, power = n >> 8, power + 1
    return crc


def _portions(texts: Iterable[bytes]) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """Numbers of texts and their words, about WORDS_AT_ONCE bytes at a time; a longer text is cut between words."""
    owners, words, held = [], [], 0
    for i, text in enumerate(texts):
        plain, start = text.translate(_PLAIN), 0
        while start < len(plain):
            stop = start + WORDS_AT_ONCE
            if stop < len(plain):
                stop = max(plain.rfind(b" ", start, stop), 0) or plain.find(b" ", stop)
                stop = len(plain) if stop < 0 else stop + 1
            part = plain[start:stop].split()
            owners.append(i)
            words.append(part)
            held += min(stop, len(plain)) - start
            start = stop
            if held >= WORDS_AT_ONCE:
                yield owners, words
                owners, words, held = [], [], 0
    if owners:
        yield owners, words


def ngram_crcs(texts: Iterable[bytes], n: int = NGRAM) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per portion: the text that each run of 1 to ``n`` words belongs to, and the run's CRC-32."""
    # the last words of the portion before, with which runs of this one may begin
    owner, begun, ended, length = (np.zeros(0, t) for t in (np.int64, np.uint32, np.uint32, np.int64))
    crc = 0
    for numbers, parts in _portions(texts):
        words = [w for part in parts for w in part]
        if not words:
            continue
        end = np.fromiter(accumulate(words, lambda c, w: zlib.crc32(b" " + w, c), initial=crc), np.uint32, len(words) + 1)
        crc = int(end[-1])
        # the register after the blank that follows an end, or, for the first word, the text before
        start = ~_step(~end[:-1] ^ np.uint32(32))
        own = np.repeat(np.array(numbers), [len(part) for part in parts])
        fresh = len(owner)
        owner, begun = np.concatenate([owner, own]), np.concatenate([begun, start])
        ended = np.concatenate([ended, end[1:]])
        length = np.concatenate([length, np.fromiter(map(len, words), np.int64, len(words))])
        before = np.concatenate(([0], np.cumsum(length + 1)))
        for k in range(n):  # runs of k + 1 words that end in this portion
            first = np.arange(max(0, fresh - k), len(owner) - k)
            first = first[owner[first] == owner[first + k]]
            size = before[first + k + 1] - before[first] - 1
            yield owner[first], ended[first + k] ^ shifted(begun[first], size)
        keep = slice(len(owner) - min(len(owner), n - 1), None)
        owner, begun, ended, length = owner[keep], begun[keep], ended[keep], length[keep]


def bucket_counts(df: DataFrame, n: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket: ``buckets`` numbers, whatever the size of the table."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            for _, crcs in ngram_crcs(raw_texts(batch), n):
                seen += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["bucket", "n"])

    counted = df.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    table = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares in the target and in the documents."""
    s, t, many = own.astype(float), target.astype(float), float(len(own))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + many) / ((s + 1) * (t.sum() + many)))).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, n: int = NGRAM) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = raw_texts(batch)
            total, seen, words = (np.zeros(len(texts), np.int64) for _ in range(3))
            for k, (owner, crcs) in enumerate(ngram_crcs(texts, n)):
                runs = np.bincount(owner, minlength=len(texts))
                seen += runs
                if k % n == 0:
                    words += runs
                # in doubles, as all sums of a slice stay far below 2 ** 53
                total += np.bincount(owner, gain[crcs % np.uint32(len(gain))], len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words), pa.array(seen), pa.array(total // np.maximum(seen, 1))],
                                             ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """Thousandths of a Gumbel variate from a hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resampled(docs: DataFrame, target: DataFrame, n: int = NGRAM, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
              percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score of every row, and its rank if it is drawn."""
    gain = gains(bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets))
    rows = written(weighed(docs, gain, n).withColumn("score", F.col("weight") + noise(seed)), "weights")
    fit = rows.filter(F.col("n_words") >= least_words)
    drawn = fit.count() * percent // 100
    listed = with_row_index(fit.select((-F.col("score")).alias("worst"), "doc_id", "weight", "n_features"),
                            ["worst", "doc_id", "weight", "n_features"], "place")
    ranked = listed.select("doc_id", "n_features", "weight", (-F.col("worst")).alias("score"),
                           F.when(F.col("place") <= drawn, F.col("place")).cast("long").alias("rank"))
    rest = rows.filter(F.col("n_words") < least_words).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
