"""Document fingerprints by consistent weighted sampling, in SQL functions alone.

Terms are runs of characters other than space and 9 to 13, cut after ``LONGEST`` characters; a term weighs as often as
it occurs. For each of ``SAMPLES`` samples every term has two gamma variates (shape 2, of 256 equally likely values) and
one uniform shift, all from one hash of the term. They place the term's weight on a log grid of its own and give it a
value whose minimum over the terms of a text is the sample: term and grid step. Two texts agree in a sample with a probability equal to their
generalised Jaccard similarity, the sum of the lesser weights over the sum of the greater ones; a fingerprint holds 16
bits of every sample, and the likeness of two is the share of samples in which they agree.

A minimum is taken over one long, the value's leading bits followed by those of the sample, so all samples of a text
are plain minima: terms are counted and reduced inside the task that holds the document, and no term is shuffled.

Documents are rows told apart by id and text; copies that share both are one document that comes out as often as it
occurs. The next document is the one that follows in descending order of id, then of the text's hash; rows without id come
last, and the first document follows the last. Null texts are empty. Texts without a term have an empty fingerprint,
which is fully like another empty one and unlike any other. An empty table gives an empty result. Other columns are
ignored. A text is held whole in one row, but never with others of a group.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.tables import joined, written
from meterflow.operators.ordering import with_row_index

SAMPLES = 48
LONGEST = 12
TERM = rf"[^\x20\x09-\x0D]{{1,{LONGEST}}}"
#: A hash of 64 bits has, from the top, the places of two gamma variates, the sample's own bits, and the uniform shift.
GAMMA_BITS, SAMPLE_BITS, SHIFT_BITS = 8, 16, 28
#: Values keep 32 bits after the point, and are moved to stay above 0.
VALUE_BITS, ABOVE = 32, 100
COPIES_AT_ONCE = 10_000


def gamma_quantiles(bits: int = GAMMA_BITS) -> list[float]:
    """The middle quantile of each of 2 ** bits equal shares of the gamma distribution of shape 2, by bisection."""
    out = []
    for i in range(1 << bits):
        share, low, high = (i + 0.5) / (1 << bits), 0.0, 60.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if 1 - math.exp(-middle) * (1 + middle) < share else (low, middle)
        out.append((low + high) / 2)
    return out


def _numbers(values: list[float]) -> Column:
    return F.expr(f"array({', '.join(f'{v!r}D' for v in values)})")


def packed_sample(k: int) -> Column:
    """Value and sample of one term in sample ``k``; ``steps`` and ``ln_steps`` are the quantiles and their logarithms."""
    x = f"xxhash64(hashed + {k << 32}L)"
    step = f"get(steps, int(shiftrightunsigned({x}, {64 - GAMMA_BITS})))"
    ln_c = f"get(ln_steps, int(shiftrightunsigned({x}, {64 - 2 * GAMMA_BITS}) & {(1 << GAMMA_BITS) - 1}L))"
    shift = f"(({x} & {(1 << SHIFT_BITS) - 1}L) * {1 / (1 << SHIFT_BITS)!r}D)"
    t = f"floor(ln_weight / {step} + {shift})"
    value = f"floor(({ln_c} - {step} * ({t} + 1D - {shift}) + {float(ABOVE)}D) * {float(1 << VALUE_BITS)!r}D)"
    own = f"((shiftrightunsigned({x}, {SHIFT_BITS}) + {t}) & {(1 << SAMPLE_BITS) - 1}L)"
    return F.expr(f"{value} * {1 << SAMPLE_BITS}L + {own}")


def fingerprints(texts: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """keys and the fingerprint of every text that has a term; rows of one key must be in one text.

    Where ``texts`` is partitioned by some of the keys already, nothing is shuffled.
    """
    quantiles = gamma_quantiles()
    terms = texts.select(*keys, F.explode(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("term"))
    counted = terms.select(*keys, F.crc32(F.col("term").cast("binary")).alias("hashed")).groupBy(*keys, "hashed").agg(F.count(F.lit(1)).alias("weight"))
    parts = counted.select(*keys, "hashed", F.log("weight").alias("ln_weight"), _numbers(quantiles).alias("steps"),
                           _numbers([math.log(q) for q in quantiles]).alias("ln_steps"))
    least = [F.min(packed_sample(k)).alias(f"s{k}") for k in range(samples)]
    bits = F.transform(F.array(*[f"s{k}" for k in range(samples)]),
                       lambda s: F.lpad(F.lower(F.hex(s.bitwiseAND((1 << SAMPLE_BITS) - 1))), SAMPLE_BITS // 4, "0"))
    return parts.groupBy(*keys).agg(*least).select(*keys, F.array_join(bits, "").alias("fingerprint"))


def likeness(one: Column, other: Column) -> Column:
    """Share of samples in which two fingerprints agree."""
    width = SAMPLE_BITS // 4
    places = F.sequence(F.lit(0), F.floor(F.length(one) / width).cast("int") - 1)
    same = F.size(F.filter(places, lambda i: one.substr(i * width + 1, F.lit(width)) == other.substr(i * width + 1, F.lit(width))))
    full = (F.length(one) > 0) & (F.length(other) > 0)
    return F.when(full, same / (F.length(one) / width)).otherwise((F.length(one) == F.length(other)).cast("double"))


def with_next(docs: DataFrame) -> DataFrame:
    """key, h (id and text's hash), doc_id, copies, n_chars, next_key, next_h: one row per document, without texts."""
    named = docs.groupBy("key", "h", "doc_id").agg(F.count(F.lit(1)).alias("copies"), F.first(F.length("text")).cast("long").alias("n_chars"))
    placed = written(with_row_index(named, ["doc_id", "h"], "place"), "places")
    total = placed.count()
    following = placed.select(F.when(F.col("place") == total, 1).otherwise(F.col("place") + 1).cast("long").alias("place"),
                              F.col("key").alias("next_key"), F.col("h").alias("next_h"))
    return written(joined(placed, following, "place").drop("place"), "next-documents")


def compared(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Every document beside an edited one, whose last third is the beginning of the next document, and beside the next.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select(F.coalesce("doc_id", F.lit(0).cast("long")).alias("key"), F.xxhash64(F.col("doc_id").isNull(), "text").alias("h"), "doc_id", "text")
    known = with_next(rows)
    once = rows.select("key", "h", "text").groupBy("key", "h").agg(F.first("text").alias("text"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    given = joined(once.select(F.col("key").alias("next_key"), F.col("h").alias("next_h"), F.col("text").alias("next_text")), known, ["next_key", "next_h"])
    given = given.select(*known.columns, F.col("next_text").substr(F.lit(1), third).alias("piece"))
    whole = joined(once, given, ["key", "h"]).withColumn(
        "edited", F.concat(F.col("text").substr(F.lit(1), (F.col("n_chars") - third).cast("int")), "piece"))
    both = whole.select("key", "h", F.explode(F.array(
        F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("said")),
        F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("said")))).alias("x")).select("key", "h", "x.*")
    prints = fingerprints(both, ["key", "h", "is_edited"], "said", samples).groupBy("key", "h").agg(
        F.max(F.when(~F.col("is_edited"), F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("is_edited"), F.col("fingerprint"))).alias("edited_fingerprint"))
    full = joined(whole.select(*known.columns, F.sha2("edited", 256).alias("edited_sha256")), prints, ["key", "h"], "left")
    full = written(full.fillna("", ["fingerprint", "edited_fingerprint"]), "fingerprints")
    after = full.select(F.col("key").alias("next_key"), F.col("h").alias("next_h"), F.col("fingerprint").alias("next_fingerprint"))
    out = joined(full, after, ["next_key", "next_h"]).select(
        "copies", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
    names = [c for c in out.columns if c != "copies"]
    # a document of very many copies is never one long array
    some = out.withColumn("done", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_AT_ONCE).cast("long"))))
    return some.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES_AT_ONCE).cast("long"), F.col("copies") - F.col("done"))))).select(*names)
