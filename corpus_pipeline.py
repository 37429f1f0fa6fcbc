"""The corpus pipeline: quality rules, near-duplicates, repeated passages,
personal data, packing.  Each stage takes (spark, docs, sf_dir) and works on
all documents that its predecessor kept; all but the last return the columns
of ``documents``.  ``run`` stores each stage's rows as Parquet in the shared
folder and reads them again for the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.llm import minhash, packing, personal_data, quality_rules, suffix_dedup
from velolake.llm.common import stored, table
from velolake.llm.queries import WORD_MODEL


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return minhash.deduplicated(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a document with a smaller id has."""
    return counted(suffix_dedup.deduplicated(docs))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data and what gives it away."""
    return counted(personal_data.sanitised(docs))


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents, packed into sequences."""
    return packing.pack_documents(docs, WORD_MODEL)


STAGES = [
    ("quality rules", keep_good),
    ("near-duplicates", drop_near_copies),
    ("repeated passages", drop_repeats),
    ("personal data", sanitise),
    ("packing", pack),
]

#: SQL has no tokenizer, so it can't give the rows of the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
