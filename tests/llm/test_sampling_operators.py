"""Resampling, fingerprints and hard negatives against plain code: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.llm import fingerprints, negatives, resampling

SCHEMA = "doc_id long, text string, score long, rank string, weight int, next_key string, id int, key string"


def documents(spark, n=70, seed=4):
    rng = random.Random(seed)

    def say(k):
        return " ".join("".join(rng.choice("abcdéXY9") for _ in range(rng.randint(1, 4))) for _ in range(k))

    rows = [(i, say(rng.randint(0, 60))) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(6)]  # copies under other ids
    rows += [(n + 10, None), (n + 11, ""), (n + 12, " \t\n-"), (n + 13, "x" * 5000), (n + 14, " ½ Ünï-cödé_text " * 30),
             (None, rows[3][1]), (None, rows[3][1]), (3, rows[3][1]), (4, "other text under the same id " * 5), (n + 15, say(4000))]
    return spark.createDataFrame([(d, t, 1, "r", 2, "k", 3, "c") for d, t in rows], SCHEMA)


# ---------------------------------------------------------------- resampling

def runs(text, n):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


@pytest.mark.parametrize("at_once", [1 << 20, 50, 999])
def test_crcs_of_runs_come_out_of_running_crcs(monkeypatch, at_once):
    monkeypatch.setattr(resampling, "WORDS_AT_ONCE", at_once)
    rng = random.Random(at_once)
    texts = ["", "  ", "x" * 70_000 + " yy " + "z" * 300] + ["".join(rng.choice("ab XY-\né9") for _ in range(rng.randint(0, 300))) for _ in range(150)]
    for n in (1, 2, 4):
        found = [[] for _ in texts]
        for owner, crcs in resampling.ngram_crcs([t.encode() for t in texts], n):
            for i, crc in zip(owner.tolist(), crcs.tolist()):
                found[i].append(crc)
        assert [sorted(f) for f in found] == [sorted(runs(t, n)[1]) for t in texts]


def test_shifts_of_any_length_append_zero_bytes():
    rng = np.random.default_rng(2)
    for n in (0, 1, 255, 256, 65_537, 3_000_000):
        head, tail = rng.bytes(9), bytes(n)
        got = resampling.shifted(np.array([zlib.crc32(head)], np.uint32), np.array([n]))[0]
        assert int(got) ^ zlib.crc32(tail) == zlib.crc32(head + tail)


def plain_resampling(rows, target, buckets, least_words, percent, seed):
    s, t = Counter(), Counter()
    for texts, counts in (([x for _, x in rows], s), (target, t)):
        for text in texts:
            counts.update(c % buckets for c in runs(text, 2)[1])
    many, wanted = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (many + buckets) / ((s[b] + 1) * (wanted + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        words, features = runs(text, 2)
        weight = sum(gain[c % buckets] for c in features) // max(1, len(features))
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), words >= least_words))
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2], r[1]))
    drawn = fit[:percent * len(fit) // 100]
    return sorted([(*r[:4], i + 1) for i, r in enumerate(drawn)] + [(*r[:4], 0) for r in fit[len(drawn):]] + [(*r[:4], 0) for r in out if not r[4]],
                  key=str)


def test_resampling(spark):
    df = documents(spark)
    target = spark.createDataFrame([(1, "ab Xé 9a ab Xé"), (2, None), (3, "d d d")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = resampling.resampled(df, target, buckets=500)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain_resampling(rows, [r.text for r in target.collect()], 500, 20, 25, 7)
    assert sorted(((*r[:4], r.rank or 0) for r in got.collect()), key=str) == want
    assert resampling.resampled(df.limit(0), target).count() == 0
    assert resampling.resampled(df, target.limit(0), buckets=500).filter("rank IS NOT NULL").count() == sum(1 for r in want if r[4])


def test_resampling_draws_what_looks_like_the_target(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["lime", "pear", "plum"] if i % 2 else ["iron", "zinc", "lead"]) for _ in range(40))) for i in range(200)]
    target = spark.createDataFrame([("lime pear plum pear lime plum " * 2000,)], "text string")
    got = resampling.resampled(spark.createDataFrame(rows, "doc_id long, text string"), target).filter("rank IS NOT NULL").collect()
    assert len(got) == 50 and sum(r.doc_id % 2 for r in got) >= 49


# ---------------------------------------------------------------- fingerprints

def terms(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]{1,12}", text))


def plain_likeness(a, b):
    a, b = terms(a), terms(b)
    return sum(min(a[k], b[k]) for k in a | b) / sum(max(a[k], b[k]) for k in a | b) if a or b else 1.0


def test_compared_documents(spark):
    df = documents(spark)
    rows = [(r.doc_id, r.text or "") for r in df.collect()]
    got = fingerprints.compared(df)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = got.collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((d, len(t)) for d, t in rows)
    # documents of one id follow each other in the order of a hash, so any of them may come first
    texts = {}
    for d, t in rows:
        texts.setdefault(d, set()).add(t)
    ids = sorted((d for d in texts if d is not None), reverse=True) + [None]
    following = dict(zip(ids, ids[1:] + ids[:1]))
    for r in got:
        candidates = [(t, n) for t in texts[r.doc_id] for n in texts[following[r.doc_id]] | texts[r.doc_id]]
        edited = [t[:len(t) - len(t) // 3] + n[:len(t) // 3] for t, n in candidates]
        assert any(hashlib.sha256(e.encode()).hexdigest() == r.edited_sha256 for e in edited)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by_text = {}
    single = {d: next(iter(ts)) for d, ts in texts.items() if len(ts) == 1}
    for r in got:
        if r.doc_id in single:
            by_text.setdefault(single[r.doc_id], set()).add(r.fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())  # equal texts, equal fingerprints
    assert by_text[""] == {""} and len(by_text["x" * 5000].pop()) == 4 * fingerprints.SAMPLES
    assert fingerprints.compared(df.limit(0)).count() == 0
    assert fingerprints.compared(df.filter("doc_id = 5")).first().near_next == 1.0  # a lone document follows itself


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    """The same texts in six alphabets, each with draws of its own: 6 * 192 samples for every pair.

    A share of 1152 samples has a standard deviation of 0.015 at most. Pairs share their draws, so the mean of all
    their misses is hardly steadier than one of them; three deviations bound it, five the worst pair.
    """
    rng = random.Random(9)
    texts = [" ".join(str(w) for w in rng.choices(range(60), weights=[1 / (i + 1) for i in range(60)], k=200)) for _ in range(5)]
    texts += [t + " " + " ".join(str(w) for w in rng.choices(range(60), k=60)) for t in texts] + ["0 " * 50, "0 " * 100]
    rows = [(n, x, re.sub(r"(\d+)", rf"{x}\1", t)) for n, t in enumerate(texts) for x in "abcdef"]
    df = spark.createDataFrame(rows, "n long, x string, text string")
    prints = {(r.n, r.x): r.fingerprint for r in fingerprints.fingerprints(df, ["n", "x"], "text", samples=192).collect()}
    pairs = [(a, b, prints[a, x], prints[b, x]) for a in range(len(texts)) for b in range(a + 1) for x in "abcdef"]
    found = spark.createDataFrame(pairs, "a long, b long, pa string, pb string").groupBy("a", "b").agg(
        F.avg(fingerprints.likeness(F.col("pa"), F.col("pb"))).alias("like")).collect()
    misses = [r.like - plain_likeness(texts[r.a], texts[r.b]) for r in found]
    assert max(map(abs, misses)) < 0.075 and abs(sum(misses) / len(misses)) < 0.045
    assert all(r.like == 1 for r in found if r.a == r.b)


# ---------------------------------------------------------------- hard negatives

def plain_negatives(rows, positives=5, negatives_=10):
    known = {}
    for i, label, x in rows:
        if i is not None and label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            known[i] = min(known.get(i, (label, x)), (label, x))
    whole = {i: (label, [math.floor(256 * v) for v in x]) for i, (label, x) in known.items()}
    out = set()
    for a, (label, x) in whole.items():
        if a % 100:
            continue
        score = {i: max(-2 ** 63 + 1, min(2 ** 63 - 1, sum(p * q for p, q in zip(x, y)))) for i, (_, y) in whole.items() if i != a and len(y) == len(x)}
        ordered = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ordered if whole[i][0] == label][:positives]:
            fit = [i for i in ordered if whole[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out |= {(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fit[:negatives_])}
    return out


def vectors(seed=3, n=900, width=6):
    rng = random.Random(seed)
    rows = [(i * 4, rng.randint(-1, 3), [rng.gauss(0.3, 1) for _ in range(width)]) for i in range(n)]
    rows += [(100 * k + 1, 1, list(rows[25][2])) for k in range(40)]  # many copies, many ties
    rows += [(5, None, [1.0] * width), (6, 1, None), (7, 1, [None] + [1.0] * (width - 1)), (9, 1, [math.nan] * width), (10, 1, [math.inf] * width),
             (None, 1, [1.0] * width), (200, 0, [9.0] * width), (200, 0, [9.0] * width), (11, 1, [1.0, 2.0]), (5000, 0, [1.0, 2.0]), (13, 0, [1.0, 1.0]),
             (5100, 1, []), (14, 1, []), (15, 2, []), (5200, 1, [0.0] * width), (5300, 1, [1e15] * width), (17, 1, [2e15] * width), (19, 0, [1.5e15] * width)]
    return rows


@pytest.mark.parametrize("sizes", [(1024, 4096), (20, 400)])
def test_hard_negatives(spark, monkeypatch, sizes):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", sizes[0])
    monkeypatch.setattr(negatives, "ROW_BLOCK", sizes[1])
    rows = vectors()
    df = spark.createDataFrame([(i, x, label, 1, 2, "a") for i, label, x in rows], "vec_id long, embedding array<double>, label int, id int, score int, anchor string")
    got = negatives.hard_negatives(df, F.col("id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain_negatives(rows)
    assert negatives.hard_negatives(df.limit(0), F.col("id") % 100 == 0).count() == 0
    assert negatives.hard_negatives(df, F.col("id") < 0).count() == 0


def test_windows_are_exact_beyond_doubles():
    for positive in (0, 1, 7, -3, 2 ** 62 + 1):
        least, greatest = negatives.window(positive)
        assert 100 * (least - 1) < 30 * positive <= 100 * least and 100 * greatest <= 90 * positive < 100 * (greatest + 1)
