"""The corpus pipeline: five operators in a row over the table of documents.

Each stage is (name, function); a function takes (spark, docs, sf_dir), with the rows that the stage
before kept, and returns a DataFrame. All but the last return the columns of documents. Models are
fitted on the labelled rows of the data folder that the operators don't hold out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shroud.llm import catalog, compression_quality, decontamination, near_copies, packing, toxicity
from shroud.llm.common import discard, release, shared_dir, small_batches, table


#: Words that a worker remembers while it packs: the stages before have left memories of their own in it.
PACKING_MEMORY = 30_000


def _begin(spark: SparkSession) -> None:
    """Before each stage: bounded batches, and memory of the stages before goes back to the system."""
    small_batches(spark)
    release(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; null and empty texts stay, repeated rows share their fate, very long ones count by their worst words, clashing columns pass through."""
    _begin(spark)
    return toxicity.keep_clean(docs, toxicity.train(spark, sf_dir))


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model doesn't reject; null and empty texts count as average good ones, repeated rows share their fate, long ones are scored whole, clashing columns pass through."""
    _begin(spark)
    return compression_quality.keep_good(docs, compression_quality.train(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id: five-word shingles, Jaccard similarity of at least 0.8. Null and empty texts are one group; rows without an id stay; of rows that repeat a kept id one stays."""
    _begin(spark)
    return near_copies.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts stay, copies share their fate, long and repetitive ones are tiled whole, clashing columns pass through."""
    _begin(spark)
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of tokens; a null or empty text is its end token alone, repeated rows are documents of their own."""
    _begin(spark)
    return packing.pack_documents(docs, catalog.tokenizer("word_bpe_49k.json"), memory=PACKING_MEMORY, keep=False)


STAGES = [("toxicity", drop_toxic), ("quality", drop_bad), ("near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated), ("packing", pack)]

#: Trained models, tokenizers and graph search have no SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written to the shared folder and read again, and goes once the next one is written."""
    docs, folder = table(spark, sf_dir, "documents"), shared_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
            if k:
                discard(spark, [f"{folder}/{k - 1}-{STAGES[k - 1][0]}"])
    return docs
