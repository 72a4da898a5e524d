"""The registered queries of the corpus operators: each reads its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featspark.llm import exact_dedup as exact
from featspark.llm import (mixing, packing, pii, prefix_trie, quality, rules, runs, sharding, simhash, suffix, syncmers,
                           toxicity)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Graded rating of a labelled document: 0 poor, 1 good but toxic, 2 good.
GRADE = "CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END"


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"), GRADE, 3)
    return quality.grade_documents(docs, model, wanted=1)


def op2_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.fair_queue_mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "finish")


def op3_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pii.personal_data(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])
    return d.select("doc_id", *[pii.count_kind(F.col("spans"), k).alias(f"n_{k}") for k in pii.KINDS],
                    F.sha2(pii.span_digest(base), 256).alias("base_sha256"),
                    pii.span_digest(F.col("spans")).alias("spans"))


def op4_conflict_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(_table(spark, sf_dir, "documents"))


def op5_splitter_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_splitters(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_weak_supervision_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op7_chunk_recipe_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.robust_outliers(_table(spark, sf_dir, "documents"))


def op9_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op10_deep_shallow_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_branching_tandem_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = runs.periodic_runs(runs.repeated_tails(_table(spark, sf_dir, "documents")))
    # exact comparison of length / period by cross products
    best = F.expr("""array_sort(runs, (x, y) -> CASE
        WHEN x.length * y.period > y.length * x.period THEN -1 WHEN x.length * y.period < y.length * x.period THEN 1
        WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1
        WHEN x.period < y.period THEN -1 WHEN x.period > y.period THEN 1 ELSE 0 END)""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return d.withColumn("best", F.get(best, F.lit(0))).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op13_van_emde_boas_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.rebuilt_turns(_table(spark, sf_dir, "conversations")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_ordinal_quality, op2_fair_queue_mix, op3_weak_supervision_pii, op4_conflict_best_fit,
    op5_splitter_shards, op6_weak_supervision_toxicity, op7_chunk_recipe_dedup, op8_robust_outliers,
    op9_gray_simhash, op10_deep_shallow_suffixes, op11_branching_tandem_runs, op12_closed_syncmers,
    op13_van_emde_boas_trie, pipeline)}
