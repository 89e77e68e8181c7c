"""The corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes the documents that the one before kept, written as a table in
the shared folder and read again, so a lost executor costs no more than its
tasks of the running stage. All stages take documents of any length, repeated
rows and ids, null ids and texts, further columns of any name, and no rows at all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import store
from pagemill.llm.langid import identified
from pagemill.llm.mixing import mixed_documents
from pagemill.llm.near_dup import without_near_duplicates
from pagemill.llm.packing import pack
from pagemill.llm.pii import pseudonymised
from pagemill.llm.queries import pseudonym_key

# rows that go to Python at once: documents are long, and memory is for the work on them
ROWS_AT_ONCE = 1000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, with that language in `lang`.

    Without a letter, or with no language more probable than all others together, a document goes.
    """
    return identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; those without words all stay."""
    return without_near_duplicates(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with pseudonyms in place of personal data; null texts stay null."""
    return pseudonymised(docs, pseudonym_key(spark))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, once or twice."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their token ids; a null text is its end id."""
    return pack(docs)


def _bounded(stage: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language ID", _bounded(language_id)),
    ("MinHash near-dedup", _bounded(near_dedup)),
    ("PII", _bounded(pii)),
    ("mixing", _bounded(mixing)),
    ("packing", _bounded(packing)),
]

# language models, sampled signatures and tokens are not expressible in SQL:
# tests/llm/test_pipeline.py compares each stage with a brute-force version on its own input
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
