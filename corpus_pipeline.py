"""Corpus pipeline: quality, near-duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on everything that its
predecessor kept; all but the last return the columns of ``documents``. ``run``
writes every stage to the shared checkpoint folder and reads it again, so a lost
executor costs one stage at most.

Defined results: rows with a null doc_id are kept by the filtering stages and
packed; null texts count as empty; repeated rows are copies (of rows with equal
doc_id all are kept or none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackwise.llm.common import materialize, read_table
from trackwise.llm.decontam import drop_contaminated
from trackwise.llm.jaccard import drop_near_duplicates
from trackwise.llm.packing import pack
from trackwise.llm.pii import redact_pii
from trackwise.llm.quality import drop_low_quality
from trackwise.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (it learns from all labels)."""
    return drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    out = redact_pii(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 4096 tokens."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmarks),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Training, tokenising and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage_{name}")
    return docs
