"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm import bpe, caps, collocations, divergence, language, minhash, packing, pii, quality, topk, toxicity, url_filters, warc


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id", of: int = 5, rest: int = 0) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % of == rest, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.concat("base", "terms")).alias("spans"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
    return classes.select("doc_id", "n_shingles", "component_id", "kept")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    both = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks), ranks)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality.score(docs, quality.fit(docs))
    return judged.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("kept", F.col("score") >= 0.5)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives, ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = language.predict(docs, language.fit(docs, ~held_out(of=3, rest=1)))
    spans = F.size("spans").cast("long").alias("n_spans")
    return told.select("doc_id", held_out(of=3, rest=1).alias("held_out"), "lang_pred", "score", spans)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_toxicity,
        op2_url_filters,
        op3_topk,
        op4_pii,
        op5_packing,
        op6_caps,
        op7_minhash,
        op8_bpe,
        op9_quality,
        op10_warc,
        op11_language,
        op12_collocations,
        op13_divergence,
    )
    return {f.__name__: f for f in every}
