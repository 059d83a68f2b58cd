"""The corpus pipeline over ``documents``: five stages, each an operator of ``vacancylake.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
``documents``. ``run`` writes every stage's rows to the shared folder and reads them back for the next one, so a lost
executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vacancylake.llm import queries
from vacancylake.llm.decontamination import without_contaminated
from vacancylake.llm.line_dedup import drop_document_lines
from vacancylake.llm.packing import pack_documents
from vacancylake.llm.quality_rules import without_low_quality
from vacancylake.llm.simhash import one_of_each
from vacancylake.llm.texts import read_documents
from vacancylake.plans.queries import Registered
from vacancylake.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned rules keep."""
    return without_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that over a tenth of their source's documents hold."""
    return drop_document_lines(docs, host="source")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near copies."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 ids."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality), ("line dedup", lines), ("simhash near-dedup", near_copies),
    ("benchmark decontamination", decontamination), ("best-fit packing", packing),
]

#: Learned rules, fingerprints and packing can't be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{k + 1}")
    return docs


def registered() -> Registered:
    return queries.registered() | {"pipeline": (run, ORACLE_SQL)}
