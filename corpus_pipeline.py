"""From raw documents to packed training bins, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; its result is written as Parquet and read again as the next one's docs.
All stages but the last return the columns of ``documents``:

1. toxicity: documents scored 0.5 or more by the weakly supervised classifier go;
2. exact dedup: of equal texts (A-Z lower-cased) the largest doc_id stays;
3. SimHash near-dedup (4-word shingles, 4 bits): the least doc_id of each group;
4. mixing: sources to weights 1, 2, 3, ..., a document as often as it is taken;
5. packing: one row per piece with its bin and offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featspark.llm import exact_dedup, mixing, packing, simhash, toxicity
from featspark.llm.common import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_rows(docs, exact_dedup.exact_dedup(docs).filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_exact_copies), ("simhash near-dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack)]

#: Hash-based learning, chunking and packing have no SQL form; the tests hold
#: the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.write(str(i), stage(spark, docs, sf_dir))
        if i:
            scratch.drop(str(i - 1))
    return docs
