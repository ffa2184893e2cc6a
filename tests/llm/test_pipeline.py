"""The pipeline's stages, each on what the one before it kept."""

import corpus_pipeline
from meterflow.llm import languages
from meterflow.llm.tables import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [{r.doc_id for r in docs.select("doc_id").collect()}]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert seen[-1] <= seen[-2], name
    assert seen[1] == seen[0]  # every text has a letter
    assert 0 < len(seen[2]) < len(seen[1])  # copies go
    kept = docs.collect()
    assert not any(i in r.text for r in kept for i in items)
    rows = sorted(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect(), key=lambda r: r.start)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in kept)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))


def test_without_labels_texts_with_a_letter_stay(spark):
    rows = [(1, "some words"), (2, None), (3, "12 34"), (4, ""), (5, "слова")]
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = languages.without_unknown(docs, *languages.learn(languages.teaching(docs)))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5] and kept.columns == docs.columns
