"""From raw documents to token files: the stages of a training corpus, each one reading what the last one wrote.

1. language id: texts of no known language (``und``: null, or without a letter) go.
2. near duplicates: five-word shingles, similarity of 0.8 or more; one document of each group stays.
3. decontamination: documents that hold a benchmark item go.
4. source mixing: documents come as often as the target weights of their sources want them.
5. token files: what is left is tokenised and written; the result is read back from the files.

Rows without id pass the second and third stage, which tell documents by it.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterflow.llm import decontamination, languages, mixing, near_duplicates, token_files
from meterflow.llm.tables import read, tuned, written
from meterflow.session import broadcast_if_small, prepare


def _without(docs: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    gone = written(ids.select("doc_id").distinct(), label)
    return docs.join(broadcast_if_small(gone), "doc_id", "left_anti").select(*docs.columns)


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(prepare(spark))
    return languages.without_unknown(docs, *languages.learn(languages.teaching(docs)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(prepare(spark))
    return _without(docs, near_duplicates.near_duplicates(docs, shingle=5, percent=80).filter("NOT kept"), "copies")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(prepare(spark))
    return _without(docs, decontamination.matches(docs, read(spark, sf_dir, "benchmark")), "contaminated")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(prepare(spark))
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, one row for each copy that the mix holds."""
    tuned(prepare(spark))
    return token_files.token_files(docs, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language id", known_languages),
    ("near duplicates", one_of_each_group),
    ("decontamination", decontaminated),
    ("source mixing", mixed_sources),
    ("token files", token_ids),
]

#: Language models, MinHash, singular vectors and token files are beyond SQL; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(tuned(prepare(spark)), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
