"""From raw documents to packed token sequences, in four stages.

    python -c "import corpus_pipeline as p; p.run(spark, folder)"

Each stage takes the documents that the one before kept, and its result is written as Parquet to the shared
work folder and read back, so a lost executor costs the tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import line_dedup, packing, quality_rules, shingle_dedup, simhash
from strata.llm.common import shipped
from strata.session import prepare, settle, work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines their host repeats too often."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that a later document has as well."""
    return line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are alike to 0.8 or more: linked by SimHash
    fingerprints first, then by bands of minima what these leave apart."""
    return simhash.first_of_each(docs, shingle_dedup.near_duplicates(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of token sequences."""
    return packing.pack(docs).drop("ids")


def _stage(fn):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        shipped(prepare(spark))
        return fn(spark, docs, sf_dir)

    run_stage.__name__, run_stage.__doc__ = fn.__name__, fn.__doc__
    return run_stage


STAGES = [
    ("quality_rules", _stage(quality)),
    ("line_dedup", _stage(lines)),
    ("simhash_near_dedup", _stage(near_duplicates)),
    ("packing", _stage(sequences)),
]

# Fingerprints and token ids have no SQL; the tests compare with a plain interpreter.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), work_path(spark, name))
    return docs
