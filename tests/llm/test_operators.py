"""Each operator against plain code on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.llm import chat, decontamination, languages, licenses, mixing, near_duplicates, pages, repeats, suffixes, token_files, vectors

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, doc string, draws int, bucket string"


def documents(spark, seed=1, n=60):
    rng = random.Random(seed)
    syllables = "tha ren ould ing stre vol mi ka po le".split()

    def say(k):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(k))

    base = [say(rng.randint(1, 90)) for _ in range(n)]
    rows = [(i, t, "en" if i % 3 else "xx", f"s{i % 4}" if i % 5 else None) for i, t in enumerate(base)]
    rows += [(n + i, base[i], "en", "s0") for i in range(8)]  # exact copies
    rows += [(n + 20 + i, base[i] + " more " + say(2), None, "s1") for i in range(8)]  # near copies
    rows += [(n + 40, None, "en", "s0"), (n + 41, "", "en", "s0"), (n + 42, " \n\t", None, None), (n + 43, "12 34", "en", "s2"),
             (None, base[0], "en", "s1"), (n + 44, say(6000), "xx", "s1"), (3, base[3], "en", "s3")]
    return spark.createDataFrame([(a, b, c, d, 0, 7, "x", 1, "y") for a, b, c, d in rows], SCHEMA)


def plain_rows(df):
    return [(r.doc_id, (r.text or "")) for r in df.collect()]


def test_token_files(spark):
    from tokenizers import Tokenizer

    df = documents(spark)
    tokenizer = Tokenizer.from_file(token_files.TOKENIZER)
    got = sorted(token_files.token_files(df).collect(), key=lambda r: r.start)
    want = sorted((-1 if d is None else d, len(ids := tokenizer.encode(t, add_special_tokens=False).ids + [2]), zlib.crc32(np.array(ids, "<u4").tobytes()))
                  for d, t in plain_rows(df))
    assert [(-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == want
    assert [r.start for r in got] == list(itertools.accumulate([0] + [r.n_tokens for r in got]))[:-1]
    assert token_files.token_files(df.limit(0)).count() == 0


def test_blocks_decode_from_every_checkpoint_and_tell_damage():
    rng = np.random.default_rng(1)
    scaled = np.full(50, (1 << token_files.SCALE_BITS) // 50, np.int64)
    scaled[0] += (1 << token_files.SCALE_BITS) - scaled.sum()
    below, symbol = np.cumsum(scaled) - scaled, np.repeat(np.arange(50, dtype=np.uint16), scaled)
    for n in (1, 7, 511, 513, 200_000):
        ids = rng.integers(0, 50, n).astype(np.uint16)
        block = token_files.code_block(ids, scaled, below)
        size, words = token_files.STEPS * block["lanes"], np.frombuffer(block["words"], "<u4").astype(np.uint64)
        for i, (state, place, crc) in reversed(list(enumerate(zip(block["states"], block["places"], block["segment_crc32"])))):
            own = token_files.decode_segment(words, state, place, min(size, n - i * size), scaled.astype(np.uint64), below.astype(np.uint64), symbol)
            assert (own == ids[i * size:(i + 1) * size]).all() and token_files.crc_of(own) == crc


def jaccard_groups(rows, size, percent):
    sets = {}
    for d, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        sets[d] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    df = documents(spark, 2)
    got = near_duplicates.near_duplicates(df, size, percent).collect()
    want = jaccard_groups([r for r in plain_rows(df) if r[0] is not None], size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got) and len(got) == df.count()
    assert near_duplicates.near_duplicates(df.limit(0)).count() == 0


def test_a_large_group_of_near_copies_is_not_paired_out(spark, monkeypatch):
    rng = random.Random(11)
    base, other = ([f"{x}{i}" for i in range(120)] for x in "wv")
    rows = [(0, " ".join(base))]
    for i in range(1, 300):
        text = list(base)
        for place in rng.sample(range(120), rng.choice([0, 1, 1, 2, 2, 3, 5, 6, 8, 10])):
            text[place] = f"x{i}" if i % 7 else f"y{place}"  # some of them share what sets them apart
        rows.append((i, " ".join(text + [f"z{i}"] * (i % 2))))
    rows += [(300 + i, " ".join(base[:100] + other[:30] + [f"u{i}"] * (i % 3))) for i in range(40)]  # a second group, not linked with the first
    rows += [(400, " ".join(base[:111] + other[:8])), (401, " ".join(base[:106] + other[:20])), (402, " ".join(base[:102] + other[:28]))]  # a chain
    compared, plausible = [], near_duplicates.plausible
    monkeypatch.setattr(near_duplicates, "plausible", lambda pairs, *rest: compared.append(pairs.count()) or plausible(pairs, *rest))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(df, 3, 85).collect()}
    assert got == jaccard_groups(rows, 3, 85)
    assert sum(compared) < 20 * len(rows), compared  # all pairs are 58,653


@pytest.mark.parametrize("pairs", [0, near_duplicates.PAIRS])
def test_copies_of_one_text_that_are_no_copies_of_another_are_hardly_compared(spark, monkeypatch, pairs):
    rng = random.Random(5)
    base, common = [f"w{i}" for i in range(150)], [f"c{i}" for i in range(6)]
    rows = [(0, " ".join(base))]
    for i in range(1, 250):
        text = list(base)
        for place in rng.sample(range(0, 150, 5), rng.choice([1, 2, 3, 4, 5, 6, 7, 9])):
            text[place] = rng.choice(common)  # what sets them apart is common too
        rows.append((i, " ".join(text)))
    far = list(base)
    far[::15] = common[:1] * 10  # not linked with the base
    for i in range(30):  # a crowd that stays, linked with one another
        text = list(far)
        text[rng.randrange(150)] = rng.choice(common)
        rows.append((300 + i, " ".join(text[:150 - i % 3])))
    rows.append((400, " ".join(base[:120])))  # short of the base, and linked with what is less short of it
    rows.append((401, " ".join(base[:133])))
    compared, plausible = [], near_duplicates.plausible
    monkeypatch.setattr(near_duplicates, "PAIRS", pairs)
    monkeypatch.setattr(near_duplicates, "plausible", lambda pairs, *rest: compared.append(pairs.count()) or plausible(pairs, *rest))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(df, 3, 85).collect()}
    assert got == jaccard_groups(rows, 3, 85)
    assert sum(compared) < 4 * len(rows), compared


def test_vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 16))
    x = np.vstack([x, x[:20] + 0.1 * rng.normal(size=(20, 16)), x[:3]])
    rows = [(i, [float(np.float32(v)) for v in row], 1) for i, row in enumerate(x)]
    odd = [(100, None, 1), (101, [0.0] * 16, 1), (102, [float("nan")] * 16, 1), (103, [], 1), (104, [1.0, 2.0], 1), (105, [None] + [1.0] * 15, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, id int")
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    assert [got[i].n_links for i in range(len(rows))] == (linked.sum(axis=1) - 1).tolist()
    for i in range(len(rows)):
        assert got[i].component_id <= i and all(got[j].component_id == got[i].component_id for j in np.flatnonzero(linked[i]))
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(100, 106))
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_suffix_array_and_repeats(spark):
    rng = random.Random(5)
    for _ in range(200):
        s = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(1, 40))] + [0]
        assert suffixes.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 300))) for _ in range(10)] + ["a" * 400, "ab" * 100, None, "", "ä" * 60]
    texts += [texts[0], texts[1][:90] + "ZZ" + texts[2]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[3]), (2, texts[2])]
    length = 40
    data = [(d, (t or "").encode()) for d, t in rows]
    times = {}
    for _, t in data:
        for i in range(len(t) - length + 1):
            times[t[i:i + length]] = times.get(t[i:i + length], 0) + 1
    want = []
    for d, t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        want.append((str(d), len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, key int")
    got = repeats.without_repeats(df, length).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert repeats.without_repeats(df.limit(0), length).count() == 0


def test_contexts_of_a_line_just_below_the_length_do_not_meet_in_one_sort(spark, monkeypatch):
    rng = random.Random(8)
    line = "".join(rng.choice("abcdefghij ") for _ in range(190))
    beside = ["".join(rng.choice("klmnopqrst") for _ in range(60)) for _ in range(4000)]
    beside[1::40] = [x[:-6] + y[-6:] for x, y in zip(beside[1::40], beside[::40])]  # six bytes before and four after
    after = ["".join(rng.choice("klmnopqrst") for _ in range(60)) for _ in beside]
    after[1::40] = [y[:4] + x[4:] for x, y in zip(after[1::40], after[::40])]
    texts = [a + line + b for a, b in zip(beside, after)]
    times = {}
    for t in texts:
        for i in range(len(t) - 199):
            times[t[i:i + 200]] = times.get(t[i:i + 200], 0) + 1
    want = {}
    for d, t in enumerate(texts):
        gone = set()
        for i in range(len(t) - 199):
            if times[t[i:i + 200]] > 1:
                gone.update(range(i, i + 200))
        want[d] = len(gone)
    sorted_repeats, seen = repeats.sorted_repeats, []

    def watched(some, length):
        seen.append(some.groupBy("own_key").agg(F.sum(F.octet_length("bytes")).alias("n")).agg(F.max("n")).first()[0] or 0)
        return sorted_repeats(some, length)

    monkeypatch.setattr(repeats, "sorted_repeats", watched)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in repeats.without_repeats(df).collect()} == want and sum(map(bool, want.values())) >= 200
    assert seen and max(seen) <= repeats.SORTED_AT_ONCE


def test_hypergeometric_draws_invert_exactly_in_a_small_expression(spark):
    rng = random.Random(3)
    cases = [(0, 0, 0, 0.5), (5, 5, 0, 0.9), (5, 0, 9, 0.1), (3, 7, 2, 0.0), (1500, 4000, 20, 0.7), (4096, 4096, 4096, 0.999999)]
    for _ in range(60):
        own, others = rng.randint(0, 300), rng.randint(0, 300)
        cases.append((rng.randint(0, own + others), own, others, rng.random()))
    k = mixing.hypergeometric(F.col("drawn"), F.col("own"), F.col("others"), F.col("u"))
    assert len(str(k)) < 4_000  # every plan of the splitting tree holds four of it
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, drawn long, own long, others long, u double")
    for i, got in df.select("i", k.alias("k")).collect():
        drawn, own, others, u = cases[i]
        every, mass, want = math.comb(own + others, drawn), 0, min(drawn, own)
        for n in range(max(0, drawn - others), want + 1):
            mass += math.comb(own, n) * math.comb(others, drawn - n)
            if mass / every >= u:
                want = n
                break
        assert got == want, cases[i]


def test_mixing_comes_near_its_targets(spark):
    df = documents(spark, 3, 400)
    rows = mixing.planned(df).collect()
    words = re.compile(r"[^\x20\x09-\x0D]+")
    assert len(rows) == df.count() and all(r["size"] == len(words.findall(r.doc.text or "")) for r in rows)
    total, sizes = sum(r["size"] for r in rows), {}
    for r in rows:
        sizes[r.doc.source] = sizes.get(r.doc.source, 0) + r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, goal, open_ = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, {}, set(order)
    while True:
        left = total - sum(goal.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        if not (over := {s for s in open_ if share[s] > 3 * sizes[s]}):
            break
        goal |= {s: 3 * sizes[s] for s in over}
        open_ -= over
    goal |= share
    for s in order:
        own = [r for r in rows if r.doc.source == s]
        taken = sum(len(r.draws) * r["size"] for r in own)
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(goal[s]) and len(r.draws) <= 3 for r in own)
        assert abs(taken - goal[s]) <= max(0.02 * goal[s], min(r["size"] for r in own if r["size"]))
    assert mixing.mixed(df).columns == df.columns and mixing.mixed(df).count() == sum(len(r.draws) for r in rows)
    assert mixing.planned(df.limit(0)).count() == 0


def test_chat_round_trip_and_layouts(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nhi", "a\\b\\\\<\\|x", "", None, "\\n", "ünïcode 😀 <|"]
    rows = [(1, i, role, t, 5) for i, (role, t) in enumerate(zip(["user", "assistant", None, "assistant", "us\ner", "assistant"], nasty))]
    rows += [(2, 0, "user", "x", 5), (2, 0, "user", "x", 5), (None, None, "assistant", "y", 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    done = chat.format_conversations(df)
    read = done.select("conv_id", chat.read_back(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    got = {r.conv_id: r for r in read.collect()}
    assert [(t.role, t.text) for t in got[1].t] == [(r[2] or "", r[3] or "") for r in rows[:6]]
    assert got[1].loss == "".join(r[3] or "" for r in rows[:6] if r[2] == "assistant") and len(got[2].t) == 2 and got[None].loss == "y"
    layouts = ['{"prompt":"p","completion":"c"}', '{"instruction":"i","input":"","output":"o"}', '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
               '{"request":{"system":"s","prompt":"p"},"response":{"text":"t"}}', '{"odd":1}', "no json", None]
    turns = chat.canonical(spark.createDataFrame([(x, i) for i, x in enumerate(layouts)], "record string, i int")).orderBy("i").collect()
    assert [r.layout for r in turns] == ["prompt", "instruction input", "conversations", "nested prompt", "unknown", "unknown", "unknown"]
    assert [[(t.role, t.text) for t in r.turns] for r in turns[:3]] == [
        [("user", "p"), ("assistant", "c")], [("user", "i"), ("assistant", "o")], [("user", "q"), ("assistant", "a")]]


def test_chat_keeps_turns_beyond_the_limits_of_json(spark):
    df = spark.range(3).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn")).select(
        "conv_id", "turn", F.when(F.col("turn") == 1, "assistant").otherwise("user").alias("role"),
        F.when(F.col("turn") == 1, F.expr("repeat('a', 21000000)")).otherwise("q").alias("text"))
    row = chat.format_conversations(df).select("layout", F.transform("turns", lambda t: F.struct(t["role"], F.length(t["text"]))).alias("t"),
                                               F.length("formatted").alias("n"), "loss_mask").first()
    assert row.layout == "messages" and [tuple(x) for x in row.t] == [("user", 1), ("assistant", 21_000_000), ("user", 1)]
    assert row.n > 21_000_000 and [m.length for m in row.loss_mask] == [21_000_000]
    with pytest.raises(Exception, match="too long"):
        chat.canonical(spark.range(1).select(F.expr("concat('{\"prompt\":\"', repeat('a', 21000000), '\",\"completion\":\"c\"}')").alias("record"))).select(F.size("turns")).collect()


def test_language_id(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(9001, None, "en"), (9002, "", "en"), (9003, "12 !", None), (None, "the of and that", "en")], "doc_id long, text string, lang string")
    rows = languages.identify(df.unionByName(extra)).join(df.select("doc_id", "lang"), "doc_id", "left").withColumn("held", languages.held_out()).collect()
    held = [r for r in rows if r.held and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) > 30
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id and r.doc_id > 9000} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in rows) and languages.identify(df.limit(0)).count() == 0


def test_decontamination_finds_items_and_paraphrases(spark):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    first = items.orderBy("item_id").first()
    words = first.text.split()
    changed = " ".join("zzyx" if i % 9 == 4 else w.upper() for i, w in enumerate(words))
    extra = spark.createDataFrame([(9001, "lorem " * 30 + changed + " ipsum" * 40), (9002, None), (9003, "")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(docs.unionByName(extra), items).collect()}
    exact = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if d.text and i.text in d.text}
    assert exact <= got and (9001, first.item_id) in got and len(got) <= len(exact) + 2
    assert decontamination.matches(docs, items.limit(0)).count() == 0 and decontamination.matches(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("size", [4, 6, 10])
def test_decontamination_finds_short_items_whatever_stands_beside_them(spark, size):
    rng = random.Random(size)
    prose = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    full = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").orderBy("item_id").collect()
    items = [(r.item_id, " ".join(r.text.split()[:size])) for r in full]
    unique = iter(range(10**6))

    def rare(k):
        return " ".join(f"q{next(unique)}x" for _ in range(k))

    rows = [(9000 + i, f"{rare(rng.randint(20, 40))} {t} {rare(rng.randint(20, 40))}") for i, t in items]
    docs = prose.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(9000 + i, i) for i, _ in items} <= got


def test_closest_run_of_a_region():
    item = np.arange(4)
    region = np.array([9] * 4 + [3, 2, 1, 0, 3, 2] + [9] * 5 + [0, 1, 2, 3] + [9] * 5)  # more of the item's words stand elsewhere, in disorder
    assert decontamination._closest(item, region) >= decontamination.SHARE * len(item)


def test_regions_of_all_items_are_counted_together(monkeypatch):
    monkeypatch.setattr(decontamination, "REGION_WORDS", 100)  # several turns
    rng = np.random.default_rng(4)
    spoken, held = rng.integers(0, 30, 500), rng.random((6, 30)) < 0.5
    held[:, 0] = False
    whose, n = rng.integers(0, 6, 80), rng.integers(4, 30, 80)
    lows = rng.integers(0, 480, 80)
    highs = np.minimum(500, lows + rng.integers(1, 90, 80))
    got = decontamination._enough(spoken, np.packbits(held, axis=1, bitorder="little"), whose, n, lows, highs)
    want = []
    for k, m, low, high in zip(whose, n, lows, highs):
        mine, size = held[k][spoken[low:high]], max(m + 2, m * 5 // 4)
        want.append(any(mine[i:i + size].sum() >= decontamination.LOWER_SHARE * m for i in range(max(1, high - low - size + 1))))
    assert got.tolist() == want and 0 < sum(want) < len(want)


def test_regions_that_follow_one_another_are_looked_at_once():
    rng = np.random.default_rng(5)
    spoken, held = rng.integers(0, 60, 9000), rng.random((4, 64)) < 0.4
    starts = np.arange(0, 8900, 4)  # more than fit one stretch
    whose, lows = np.repeat(np.arange(4), len(starts)), np.tile(starts, 4)
    n = np.array([8, 15, 30, 40])[whose]
    highs = np.minimum(9000, lows + 16 + n)
    got = decontamination._enough(spoken, np.packbits(held, axis=1, bitorder="little"), whose, n, lows, highs)
    want = []
    for k, m, low, high in zip(whose, n, lows, highs):
        mine, size = held[k][spoken[low:high]], max(m + 2, m * 5 // 4)
        want.append(any(mine[i:i + size].sum() >= decontamination.LOWER_SHARE * m for i in range(max(1, high - low - size + 1))))
    assert got.tolist() == want and 0 < sum(want) < len(want)


def test_words_count_no_more_often_than_an_item_holds_them(monkeypatch):
    monkeypatch.setattr(decontamination, "REGION_WORDS", 100)  # several turns
    rng = np.random.default_rng(6)
    items = [rng.integers(1, 9, m) for m in (4, 6, 12, 20)]
    items.append(np.arange(1, 9))
    asked, times = np.unique(np.concatenate([k * 20 + x for k, x in enumerate(items)]), return_counts=True)
    spoken = np.concatenate([rng.integers(0, 20, 300), np.full(100, 3), rng.integers(0, 12, 300)])
    whose, lows = rng.integers(0, 5, 300), rng.integers(0, 690, 300)
    whose[:2], lows[:2] = 4, 310
    highs = np.minimum(700, lows + rng.integers(1, 60, 300))
    n = np.array([len(x) for x in items])[whose]
    got = decontamination._enough_each(spoken, asked, times, 20, whose, n, lows, highs)
    want = []
    for k, m, low, high in zip(whose, n, lows, highs):
        size, region = max(m + 2, m * 5 // 4), spoken[low:high].tolist()
        runs = [Counter(region[i:i + size]) & Counter(items[k].tolist()) for i in range(max(1, high - low - size + 1))]
        want.append(max(r.total() for r in runs) >= decontamination.LOWER_SHARE * m)
        both = max(decontamination.common_subsequence(items[k], np.array(region[i:i + size])) for i in range(max(1, high - low - size + 1)))
        assert want[-1] or both < decontamination.LOWER_SHARE * m  # nothing is lost
    assert got.tolist() == want and 0 < sum(want) < len(want) and not got[:2].any()
    assert decontamination._enough_each(spoken, asked, times, 20, whose[:0], n[:0], lows[:0], highs[:0]).tolist() == []


def test_segment_sums():
    rng = np.random.default_rng(7)
    table = np.vstack([np.zeros(3), rng.integers(0, 100, (9, 3))]).astype(np.float32)
    spoken = rng.integers(0, 10, 23).astype(np.int32)
    begin, stop = np.array([0, 8, 11, 19]), np.array([11, 11, 23, 23])  # texts of 11 and 12 words
    want = [table[spoken[a:min(a + 8, b)]].sum(axis=0).tolist() for a, b in zip(begin, stop)]
    assert decontamination._segment_sums(table, spoken, begin, stop, 8).tolist() == want


def test_weights_of_the_words_of_items(spark):
    docs = spark.createDataFrame([(1, "Pear fig, pear"), (2, "fig plum"), (3, ""), (4, "kiwi")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a fig or a pear")], "item_id long, text string")
    got = decontamination.document_weights(docs, items)

    def place(word):
        return int(decontamination.features([word.encode()])[0][0])

    for word, n in (("fig", 2), ("pear", 1), ("or", 0)):
        assert abs(got[place(word)] - (np.log(5 / (n + 1)) + 0.05)) < 1e-6
    assert np.count_nonzero(got) == 4 and got[place("kiwi")] == 0


def test_main_text(spark):
    html = ("<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
            "<div class='cookie-banner'>We use cookies.</div><article><h1>Big &amp; small</h1><p>First   paragraph of the\n story goes on.</p><p>Second one follows here.</p></article>"
            "<div class='comments'><p>Nice post!</p></div><footer>&copy; 2020 somebody</footer></body></html>")
    df = spark.createDataFrame([(1, "u", html, 1), (2, None, None, 1), (3, "v", "", 1), (None, "w", "<script>x</script>", 1)], "page_id long, url string, html string, text int")
    got = {r.page_id: r for r in pages.extract(df).collect()}
    assert got[1].text == "Big & small\n\nFirst paragraph of the story goes on.\n\nSecond one follows here." and got[1].n_chars == len(got[1].text)
    assert [got[i].text for i in (2, 3, None)] == ["", "", ""] and pages.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    "<html><head><title>x</title><meta charset=u><body>{}</body></html>", "<head><title>x</title>{}",
    "<script>var a='<!--';</script>{}", "<script>s=\"<p class='x\";</script>{}", "<style>a:after{{content:'<!--'}}</STYLE >{}",
    "<!-- no end >{}", "<!-->{}<!-- x -->", "<![CDATA[ no end >{}", "<iframe src=a>{}", "<svg><path d='M0'>{}", "<svg><path>{}<svg></svg>", "<noscript>{}",
    "<svg><foreignObject><p>z</p></foreignObject></svg>{}", "<head></head><noscript><p>z</p></noscript>{}", "<title>a <b> c</title>{}"])
def test_leaf_blocks_keep_the_page_after_odd_markup(page):
    assert [text for _, text, _ in pages.leaf_blocks(page.format("<p>It's a long text.</p><p>It's more.</p>"))] == ["It's a long text.", "It's more."]


def test_licence_scan(spark):
    lines = ["some text\nLicensed under the Apache License, Version 2.0.", "Released under the MIT License.\nmore", "Licensed under CC BY-NC 4.0.",
             "A driver needs a valid licence to rent a car.", None, ""]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(9000 + i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    got = {(r.doc_id, r.paragraph): r.family for r in licenses.scan(docs.unionByName(extra)).collect() if r.doc_id >= 9000}
    assert {k: v for k, v in got.items() if v != licenses.UNKNOWN} == {(9000, 1): "apache-2.0", (9001, 0): "mit", (9002, 0): "cc-by-nc"}


def test_licence_triggers_between_underscores(spark):
    lines = ["MIT_LICENSE", "_MIT_", "see _the_mit_license_", "permit", "mits"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    pattern = licenses.trigger_pattern(["mit", "mit license"])
    assert [r[0] for r in df.select(F.lower("line").rlike(pattern)).collect()] == [True, True, True, False, False]


def test_licences_write_only_runs_that_count(spark, monkeypatch):
    plain = " ".join(f"word{i}" for i in range(3000))
    texts = [plain, plain + " Released under the MIT License. " + plain, "nothing\nReleased under the MIT License."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables, written = {}, licenses.written
    monkeypatch.setattr(licenses, "written", lambda df, label: tables.setdefault(label, []).append(out := written(df, label)) or out)
    got = {(r.doc_id, r.paragraph): r.family for r in licenses.scan(docs).collect()}
    assert got[2, 1] == "mit" and (0, 0) not in got
    for label, each in tables.items():
        if label not in ("licence-sample", "licence-training"):
            assert all(len(str(r)) < 2000 for df in each for r in df.collect()), label


ODD_WORDS = ["it's", "don't'll", "'sé", "abc,def", "x1y22", "ét́", "Été's", "İstanbul", "Kelvin", "한", "a b", "“quoted”", "日本語テキスト",
             "<|endoftext|>", "x<|EndOfText|>y", "<|STARTOFTEXT|>", "²³½", "x\x00y", "\x1cz", "a̸=b", "ªº", "ſ'ſ", "'LL", "\U0001f600ok", "--", "</w>", "ǅ", "ͅα"]


def test_numbers_of_words_cost_no_python_call_each():
    import pyarrow as pa

    numbers = token_files._Numbers()
    at, new = numbers.of(pa.array(["b", "a", "b", ""]))
    assert at.tolist() == [0, 1, 0, 2] and new.to_pylist() == ["b", "a", ""]
    at, new = numbers.of(pa.array(["c", "a", "c"]))
    assert at.tolist() == [3, 1, 3] and new.to_pylist() == ["c"] and len(numbers) == 4
    assert "__missing__" not in vars(token_files._Numbers)


def test_word_pieces_have_the_ids_of_the_whole_text():
    """Special tokens are matched before the text is lower-cased; a word's pieces are joined with others' and told apart again."""
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    own, draw = token_files.WordCoder(token_files.TOKENIZER), random.Random(3)
    assert own.splits
    texts = [*ODD_WORDS, "", None, "  ", " ".join(ODD_WORDS)]
    texts += [" ".join("".join(draw.choices(["e", "st", "N", "'s", "'", ",", "7", "é", "́", "ß", "<|endoftext|>", " ", "-"], k=draw.randint(1, 5))) for _ in range(9)) for _ in range(300)]
    plain = Tokenizer.from_file(token_files.TOKENIZER)
    for _ in range(2):  # the second time from the cache
        ids, counts = own.code(pa.array(texts, pa.string()))
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(own.pieces) < len(own.words)


def test_only_windows_whose_hash_occurs_twice_are_sorted(monkeypatch):
    draw, sorted_bytes, sort = random.Random(4), [], repeats.repeated_windows

    def counted(texts, size):
        sorted_bytes.append(sum(map(len, texts)))
        return sort(texts, size)

    monkeypatch.setattr(repeats, "repeated_windows", counted)
    for _ in range(200):
        base = bytes(draw.choices(b"abcdefgh", k=60))
        texts = [bytes(draw.choices(b"ab", k=draw.randint(0, 4))) + base[a:a + draw.randint(8, 40)] + bytes(draw.choices(b"abc", k=draw.randint(0, 9)))
                 for a in (draw.randint(0, 30) for _ in range(draw.randint(1, 6)))]
        assert repeats.told_apart(texts, 12) == sort(texts, 12)
    sorted_bytes.clear()
    line, fresh = b"a line of thirty-two bytes, here", lambda: bytes(draw.choices(range(97, 123), k=100))
    assert repeats.told_apart([fresh() + line + fresh() for _ in range(50)], 200) == [[]] * 50
    some = fresh() + line + fresh()
    assert repeats.told_apart([fresh() + bytes([k]) + some + bytes([k]) + fresh() for k in range(50)], 200) == [[(101, 134)]] * 50
    assert sum(sorted_bytes) == len(some)
