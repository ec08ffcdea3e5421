"""A training-data pipeline: the documents that are worth it, cleaned, thinned and packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the shared
folder and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.llm import decontamination, line_dedup, near_dedup, packing, quality
from sentrylake.session import materialise


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts are scored like any other; rows that repeat stay or go together; rows with a
    null id are scored and never train. Columns of any name stay as they are. An empty table stays empty.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.7)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated content-defined chunks go, then what an exact check finds of repeated passages of two lines or more; a document of which nothing is left goes with them.

    n_chars follows the text where lines went. A null text stays null, an empty text stays. Null ids
    come before any other; rows that repeat an id and a text lose the same lines. Columns of any other
    name stay as they are. An empty table stays empty.
    """
    made = line_dedup.drop_repeats(docs, counter="__removed")
    left = made.where("NOT (__removed > 0 AND text = '')")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("__removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the least id.

    Texts without words and rows without an id stay; rows that repeat an id stay or go together.
    Columns of any name stay as they are. An empty table stays empty.
    """
    return near_dedup.keep_one(docs, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go.

    Null and empty texts have none and stay; repeated rows and null ids are met each by itself. Columns
    of any name stay as they are. An empty table stays empty; an empty benchmark takes nothing.
    """
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, packed into sequences.

    A null text counts as empty and is one token; rows that repeat are packed each by itself. Columns
    other than id and text are ignored. An empty table gives no pieces.
    """
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("MinHash near-dedup", near_deduplication),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", token_packing),
]

#: Trees, automata and tokenizers are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


#: Texts that pass between the JVM and Python at once: some are very long, and both sides hold a batch.
BATCH_ROWS = 1_000


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(BATCH_ROWS))
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    finally:
        spark.conf.set(setting, before)
    return docs
