"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm import (
    centroids,
    decontamination,
    host_rules,
    html_text,
    jaccard,
    mixing,
    personal,
    pitman_yor,
    quality_model,
    ranking,
    secrets,
    sharding,
    substrings,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def of(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    every = F.array_sort(F.concat("base", "more"))
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(secrets.span_list(F.col("base")), 256).alias("base_sha256"),
        secrets.span_list(every).alias("spans"),
        F.size("more").cast("long").alias("n_entropy"),
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.similarity_groups(docs, size=3, percent=90)


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def fold(doc_id: Column, parts: int) -> Column:
    """The part a row belongs to when ids are dealt out by checksum (a null id: as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def quality_machine(docs: DataFrame, labels: DataFrame) -> quality_model.Machine | None:
    """Learned from the labels outside the held-out quarter."""
    return quality_model.fit(docs, labels.filter(fold(F.col("doc_id"), 4) != 2))


def op4_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality_machine(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality_model.score(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op5_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.placements(docs, sharding.even_map(docs, 16))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        "grown_shard", "vslot",
    )


def op6_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pitman_yor.scores(docs, fold(F.col("doc_id"), 5) != 1)


def op7_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs)


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op9_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.hits(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark").select("item_id", "text"),
    )
    items = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    n_hit = decontamination.covered_words(F.col("spans"))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.copies(docs).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__size") * F.col("__copies")).alias("taken"),
        F.col("__copies").alias("copies"),
    )


def op11_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    assigned, centres, _ = centroids.cluster(vectors)
    return centroids.with_inertia(assigned, centres)


def op12_anchored_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.personal_spans(table(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*personal.BASE_KINDS))
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in personal.KINDS],
        F.sha2(personal.span_list(base), 256).alias("base_sha256"),
        personal.span_list(F.col("spans")).alias("spans"),
    )


def op13_best_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark").select("item_id", "text"),
    )


QUERIES: dict[str, Query] = {
    "op1_secret_spans": op1_secret_spans,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_main_text": op3_main_text,
    "op4_factorisation_machine": op4_factorisation_machine,
    "op5_virtual_slots": op5_virtual_slots,
    "op6_pitman_yor": op6_pitman_yor,
    "op7_fm_index": op7_fm_index,
    "op8_host_rules": op8_host_rules,
    "op9_benchmark_windows": op9_benchmark_windows,
    "op10_mix_sources": op10_mix_sources,
    "op11_simplex_clusters": op11_simplex_clusters,
    "op12_anchored_personal_data": op12_anchored_personal_data,
    "op13_best_positions": op13_best_positions,
}
