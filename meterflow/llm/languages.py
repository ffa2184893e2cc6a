"""Language identification as a mixture: each word of a text comes from one language of a small set.

Training counts byte 3-grams, hashed to ``BUCKETS``, over all labelled texts and smooths them into a distribution
per label. A word's likelihood in a language is the product over its grams. Expectation-maximisation finds the
shares of the languages in a text; then languages leave the set, the weakest first, as long as the likelihood,
less half the logarithm of the number of words for each language, does not fall. The prediction is the language
with the greatest share, ties going to the first label; the score is that share.

Null texts and texts without a letter are ``und`` with score 0, as is every text when nothing was learnt. Rows
without label or id teach nothing. Repeated rows count as often as they occur. Other columns are ignored.
"""

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.tables import raw_texts, slices

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
ROUNDS = 30
PRECISION = 1e-3
UNKNOWN = "und"
PREDICTED = "doc_id long, lang_pred string, score double, n_langs int, mixture array<struct<lang:string,share:double>>"
_LETTER = re.compile(r"[^\W\d_]")
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PLAIN = np.arange(256, dtype=np.uint32)
_PLAIN[:128] = 32
for _c in range(97, 123):
    _PLAIN[_c] = _PLAIN[_c - 32] = _c


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all grams inside words, where each word's grams begin, and where each text's words begin."""
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    blank = _SPACE[data]
    edge = np.flatnonzero(np.diff(blank))  # the joined text begins and ends with a blank
    starts, ends = edge[::2] + 1, edge[1::2] + 1
    plain = _PLAIN[data]
    hashed = (plain[:-2] | plain[1:-1] << np.uint32(8) | plain[2:] << np.uint32(16)) * np.uint32(2654435761) >> np.uint32(32 - BUCKET_BITS)
    inside = hashed[~blank[1:-1]]
    lengths = ends - starts
    text_starts = 1 + np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return inside, np.cumsum(lengths) - lengths, np.searchsorted(starts, text_starts)


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Labels and the logarithm of each gram's probability in each label; the label set is small by nature."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            labels, texts = batch.column("lang").to_pylist(), raw_texts(batch)
            for lang in set(labels):
                inside = grams([t for t, own in zip(texts, labels) if own == lang])[0]
                seen[lang] = seen.get(lang, 0) + np.bincount(inside, minlength=BUCKETS)
        for lang, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"])

    counts = docs.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # a row per label and bucket at most
    labels = sorted(set(table.column("lang").to_pylist()))
    seen = np.full((len(labels), BUCKETS), SMOOTHING)
    if labels:
        place = {x: i for i, x in enumerate(labels)}
        seen[[place[x] for x in table.column("lang").to_pylist()], table.column("bucket").to_numpy()] += table.column("n").to_numpy()
    return labels, np.log(seen / seen.sum(axis=1, keepdims=True)).astype(np.float32)


def fit_shares(likely: np.ndarray, at: np.ndarray, texts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages in each text, and each text's log likelihood, by expectation-maximisation.

    likely: words by languages, relative likelihoods; at: first word of each text; texts: the text of each word.
    """
    sizes = np.diff(np.append(at, len(likely))).astype(np.float32)
    shares = (allowed / allowed.sum(axis=1, keepdims=True)).astype(np.float32)
    for _ in range(ROUNDS):
        weighed = shares[texts] * likely
        weighed /= np.maximum(weighed.sum(axis=1, keepdims=True), 1e-30)
        new = np.add.reduceat(weighed, at) / sizes[:, None]
        moved = np.abs(new - shares).max()
        shares = new
        if moved < PRECISION:
            break
    fit = np.log(np.maximum((shares[texts] * likely).sum(axis=1), 1e-30))
    return shares, np.add.reduceat(fit.astype(np.float64), at)


def infer(texts: list[bytes], model: np.ndarray) -> np.ndarray:
    """Shares of the languages in each text, each of which has a word."""
    inside, word_at, text_at = grams(texts)
    scores = np.add.reduceat(model[inside], word_at)
    likely = np.exp(scores - scores.max(axis=1, keepdims=True))
    at, sizes = text_at[:-1], np.diff(text_at)
    penalty = 0.5 * np.log(sizes + 1.0)
    allowed = np.ones((len(texts), model.shape[1]), bool)
    shares, fit = fit_shares(likely, at, np.repeat(np.arange(len(texts)), sizes), allowed)
    open_, bulk = np.arange(len(texts)), True
    while len(open_) and model.shape[1] > 1:
        less = allowed[open_].copy()
        own = np.where(less, shares[open_], np.inf)
        if bulk:  # at first, all that make up less than a word
            less &= shares[open_] * sizes[open_, None] >= 1
            less[np.arange(len(open_)), shares[open_].argmax(axis=1)] = True
        else:
            less[np.arange(len(open_)), own.argmin(axis=1)] = False
        gone = allowed[open_].sum(axis=1) - less.sum(axis=1)
        ok = less.any(axis=1) & (gone > 0)
        tried, less, gone = open_[ok], less[ok], gone[ok]
        if len(tried):
            rows = np.concatenate([np.arange(text_at[i], text_at[i + 1]) for i in tried])
            n = sizes[tried]
            new_shares, new_fit = fit_shares(likely[rows], np.cumsum(n) - n, np.repeat(np.arange(len(tried)), n), less)
            better = new_fit + gone * penalty[tried] >= fit[tried]
            won = tried[better]
            allowed[won], shares[won], fit[won] = less[better], new_shares[better], new_fit[better]
        else:
            won = tried
        open_ = open_ if bulk else won
        open_ = open_[allowed[open_].sum(axis=1) > 1]
        bulk = False
    return np.where(allowed, shares, 0)


def predict(docs: DataFrame, labels: list[str], model: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score, number of languages and their shares, from the text alone."""
    by_bucket = np.ascontiguousarray(model.T)
    most = max(1 << 16, (4 << 20) // max(1, len(labels)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=most):
            texts = raw_texts(batch)
            known = [i for i, t in enumerate(texts) if labels and _LETTER.search(t.decode(errors="replace"))]
            found = [(UNKNOWN, 0.0, 0, [])] * len(texts)
            if known:
                for i, own in zip(known, infer([texts[i] for i in known], by_bucket)):
                    best = int(own.argmax())
                    mixture = [{"lang": labels[j], "share": float(own[j])} for j in np.argsort(-own, kind="stable") if own[j] > 0]
                    found[i] = labels[best], min(1.0, float(own[best])), len(mixture), mixture
            pred, score, n, mixture = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int32()),
                 pa.array(mixture, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                ["doc_id", "lang_pred", "score", "n_langs", "mixture"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PREDICTED)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def teaching(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())


def identify(docs: DataFrame) -> DataFrame:
    """Learn from two thirds of the labelled documents and predict all."""
    labels, model = learn(teaching(docs))
    return predict(docs, labels, model)


def without_unknown(docs: DataFrame, labels: list[str], model: np.ndarray) -> DataFrame:
    """The rows whose language is known, all columns as they were; no join, no shuffle.

    Where nothing was learnt no language can be told from another, and every text with a letter stays.
    """
    by_bucket = np.ascontiguousarray(model.T)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=max(1 << 16, (4 << 20) // max(1, len(labels)))):
            texts = raw_texts(batch)
            known = [i for i, t in enumerate(texts) if _LETTER.search(t.decode(errors="replace"))]
            shares = infer([texts[i] for i in known], by_bucket) if known and labels else np.ones((len(known), 1))
            yield batch.take(pa.array([i for i, own in zip(known, shares) if own.max() > 0], pa.int64()))

    return docs.mapInArrow(run, docs.schema)
