"""A training corpus in four stages; each stage's rows are written and read again by the next.

1. quality rules: documents that they reject go;
2. n-gram Jaccard join: of each group of near duplicates the document with the smallest id stays;
3. substring dedup: words that repeat a passage of a smaller document are taken out of texts;
4. packing: what is left becomes sequences of at most 1024 ids.

The first three return the columns of their input. Rows with a null id cannot be named as
rejected or as copies and stay; rows that share an id stay or go together, and go only if all
of them are rejected. A text that loses all its words stays as an empty one.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixloom.llm.ngram_join import near_duplicates_dropped
from mixloom.llm.packing import pack_documents
from mixloom.llm.quality import rejected_dropped
from mixloom.llm.substring import remove_repeats
from mixloom.storage import scratch_path

#: Text of a block of stage 3: executors that have run the stages before keep what those
#: needed, so this stage gets by with half of what it takes alone.
BLOCK_BYTES = 1 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rejected_dropped(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates_dropped(docs, words=5, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(docs, block_bytes=BLOCK_BYTES)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality), ("ngram_join", near_duplicates), ("substring_dedup", substrings), ("packing", packing)]

#: Tokenised packing has no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
