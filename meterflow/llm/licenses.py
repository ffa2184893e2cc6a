"""Licence scan: a trained paragraph classifier whose findings a comparison with templates confirms; SQL functions alone.

Training rows are the templates below in several wordings, sentences that only speak of licences, and
``SAMPLE`` lines of ``SAMPLE_DOCS`` documents, the least by hash, that share no two-word run with a template. Their one- to
three-word runs are counted, and a multinomial logistic regression with an L1 penalty keeps few of them. A line
is a paragraph. Runs whose weight favours a family over ``none`` are the triggers: a paragraph without any
cannot leave ``none``, so only documents with a trigger are taken apart, and nothing is lost.

Calibration, on the fifth of the rows that the fit does not see: the probability that all but ``FALSE_SHARE``
of the ``none`` rows stay below. A family below it, or whose best template is covered by less than ``COVERED``,
is reported as ``unknown``.

Null, empty and blank texts have no paragraphs; repeated rows are reported as often as they occur; other columns
are ignored; an empty table trains on the templates alone.
"""

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.tables import joined, written

SAMPLE_DOCS, SAMPLE = 300, 3000
FALSE_SHARE = 0.002
COVERED = 0.6
NONE, UNKNOWN = "none", "unknown"

#: How the notices of common licences read.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0",
                   "you may not use this file except in compliance with the License"],
    "mit": ["Released under the MIT License", "SPDX-License-Identifier: MIT", "This project is licensed under the terms of the MIT license",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-or-later",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1", "SPDX-License-Identifier: LGPL-2.1-only",
             "redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "agpl": ["Licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0-only"],
    "bsd": ["Released under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc0": ["Dedicated to the public domain under CC0 1.0", "No rights reserved: released under CC0 1.0 Universal"],
    "proprietary": ["All rights reserved", "Copyright (c) 2020. All rights reserved", "Proprietary and confidential, unauthorized copying of this file is prohibited"],
}
SPEAKING_OF = [
    "A driver needs a valid licence to rent a car", "The license plate was hard to read", "She lost her fishing licence last summer",
    "The copyright law of the country changed twice", "Public transport is free of charge on Sundays", "They granted permission to build the bridge",
    "The general public was not admitted", "All seats were reserved for the guests", "The terms of the treaty were never published",
    "Version 2 of the plan was released under pressure", "The Apache helicopter landed near the source of the river", "He studied at MIT for four years",
    "His rights were denied", "The creative commons room is on the second floor", "The software was free and the users were happy",
    "Use of the work without attribution is common", "The licence fee rose again", "The mozilla is a made-up animal",
]
WORDINGS = ["{}.", "{}", "# {}", "Notice: {}.", "The text below: {}", "{} See the file for details.", "By the authors. {}",
            "This material is made available as follows. {}.", "{}, as stated by the publisher."]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+)"), F.lit(1))


def runs(own: Column, longest: int = 3, shortest: int = 1) -> Column:
    """Distinct runs of words, joined by blanks; there are none where there are fewer words."""
    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(own) - n + 1)
        return F.when(F.size(own) >= n, F.transform(starts, lambda i: F.array_join(F.slice(own, i, F.lit(n)), " "))).otherwise(
            F.expr("CAST(array() AS array<string>)"))

    parts = [of_length(n) for n in range(shortest, longest + 1)]
    return F.array_distinct(F.concat(*parts))


def paragraphs(docs: DataFrame) -> DataFrame:
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    return lines.filter(F.trim("line") != "")


def training_rows(docs: DataFrame) -> DataFrame:
    """label, family, line, held_out."""
    spark = docs.sparkSession
    said = [(family, w.format(t)) for family, own in TEMPLATES.items() for t in own for w in WORDINGS]
    said += [(NONE, w.format(t)) for t in SPEAKING_OF for w in WORDINGS]
    known = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(x).alias("line")) for f, x in said])).alias("r")).select("r.*")
    some = paragraphs(docs.filter("text IS NOT NULL").orderBy(F.xxhash64("doc_id", "text")).limit(SAMPLE_DOCS))
    taught = F.array(*[F.lit(x) for x in sorted({p for own in TEMPLATES.values() for t in own for p in _pairs(t)})])
    # written, so that the words are found once and not again for every run of them
    some = written(some.select("line", words(F.col("line")).alias("own")), "licence-sample")
    plain = some.filter(~F.arrays_overlap(runs(F.col("own"), 2, 2), taught))
    plain = plain.orderBy(F.xxhash64("line"), "line").limit(SAMPLE).select(F.lit(NONE).alias("family"), "line")
    names = [NONE, *TEMPLATES]
    label = reduce(lambda when, n: when.when(F.col("family") == n[1], F.lit(float(n[0]))), list(enumerate(names))[1:], F.when(F.col("family") == NONE, F.lit(0.0)))
    return known.unionByName(plain).withColumn("label", label).withColumn("held_out", F.pmod(F.xxhash64("line"), F.lit(5)) == 0)


def _pairs(text: str) -> list[str]:
    own = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return [" ".join(p) for p in zip(own, own[1:])]


def fit(docs: DataFrame) -> tuple[dict[str, list[float]], list[float], float]:
    """Weights of the runs that have any, the intercepts, and the calibrated bound; classes are none, then TEMPLATES."""
    rows = written(training_rows(docs).withColumn("words", words(F.col("line"))), "licence-training").withColumn("runs", runs(F.col("words")))
    rows = written(rows.drop("words").coalesce(1), "licence-training")  # a few thousand short rows
    counter = CountVectorizer(inputCol="runs", outputCol="features", binary=True, minDF=2.0, vocabSize=1 << 15).fit(rows.filter("NOT held_out"))
    counted = counter.transform(rows)
    model = LogisticRegression(family="multinomial", regParam=0.0015, elasticNetParam=0.9, maxIter=40, labelCol="label").fit(counted.filter("NOT held_out"))
    most = F.array_max(F.slice(vector_to_array("probability"), 2, len(TEMPLATES)))
    high = model.transform(counted.filter("held_out AND family = 'none'")).agg(F.percentile(most, 1 - FALSE_SHARE)).first()[0]
    matrix = model.coefficientMatrix.toArray()
    weights = {term: [float(x) for x in column] for term, column in zip(counter.vocabulary, matrix.T) if abs(column).max() > 1e-9}
    return weights, [float(x) for x in model.interceptVector.toArray()], max(0.5, float(high or 0.0))


def trigger_pattern(triggers: list[str]) -> str:
    """Matches lower-cased text with any of the runs of words; as in words(), only letters and digits hold a word together."""
    return r"(?<![a-z0-9])(?:" + "|".join(t.replace(" ", r"[^a-z0-9]+") for t in triggers) + r")(?![a-z0-9])" if triggers else r"\b\B"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph, family, probability, covered: one row per paragraph that is not ``none``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weights, intercepts, bound = fit(docs)
    if max(intercepts) > intercepts[0]:
        raise ValueError("without any trigger a paragraph must be none")
    names = [NONE, *TEMPLATES]
    triggers = sorted(t for t, w in weights.items() if max(w[1:]) > w[0])
    pattern = trigger_pattern(triggers)
    found = paragraphs(docs.filter(F.lower("text").rlike(pattern))).filter(F.lower("line").rlike(pattern))
    # of all runs of a paragraph's words, only those with a weight or in a template are written; a lambda's words are found once
    taught = sorted({p for own in TEMPLATES.values() for t in own for p in _pairs(t)})
    known, some = (F.array(*map(F.lit, x)).cast("array<string>") for x in (sorted(weights), taught))
    kept = F.transform(F.array(words(F.col("line"))), lambda own: F.struct(
        F.array_intersect(runs(own), known).alias("runs"), F.array_intersect(runs(own, 2, 2), some).alias("pairs")))
    found = written(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "paragraph", kept[0].alias("kept")), "licence-runs")
    found = found.select("row", "doc_id", "paragraph", "kept.runs", "kept.pairs")
    weighed = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(term).alias("run"), F.array(*map(F.lit, w)).alias("w")) for term, w in sorted(weights.items())])).alias("x")).select("x.*")
    # the weights are one row per run that the penalty has left, a number set by the training rows
    sums = [(F.coalesce(F.sum(F.col("w")[i]), F.lit(0.0)) + b).alias(f"c{i}") for i, b in enumerate(intercepts)]
    logits = found.select("row", F.explode("runs").alias("run")).join(F.broadcast(weighed), "run").groupBy("row").agg(*sums)
    scored = logits.select("row", F.array(*[f"c{i}" for i in range(len(names))]).alias("logits"))
    top = F.array_max("logits")
    scored = written(scored.select("row", F.element_at(F.array(*map(F.lit, names)), F.array_position("logits", top).cast("int")).alias("guess"),
                                   (1 / F.aggregate(F.transform("logits", lambda x: F.exp(x - F.array_max("logits"))), F.lit(0.0), lambda a, x: a + x)).alias("probability")), "licence-scores")
    found = joined(found, scored.filter(F.col("guess") != NONE), "row")

    def covered(template: str) -> Column:
        own = sorted(set(_pairs(template)))
        return F.size(F.array_intersect(F.array(*map(F.lit, own)), "pairs")) / F.lit(float(len(own)))

    by_family = [F.when(F.col("guess") == family, F.greatest(F.lit(0.0), *[covered(t) for t in own])) for family, own in TEMPLATES.items()]
    found = found.withColumn("covered", F.coalesce(*by_family))
    sure = (F.col("probability") >= bound) & (F.col("covered") >= COVERED)
    return found.select("doc_id", "paragraph", F.when(sure, F.col("guess")).otherwise(F.lit(UNKNOWN)).alias("family"), "probability", "covered")
