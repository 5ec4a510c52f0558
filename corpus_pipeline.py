"""The corpus pipeline: stages that each work on what the one before kept.

Every stage takes (spark, docs, sf_dir), where docs has the columns of ``documents``,
and returns the same columns, except the last, which returns packed pieces. A stage's
result is written and read again before the next, and deleted when the next is written.

In all stages a verdict is the row's own: rows that share a doc_id are judged each by its
own text, and a null doc_id is judged like any other. Null and empty texts are neither
toxic nor near-duplicates. Further columns are carried along; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm import minhash, packing, pii, quality, toxicity
from fathom.llm._stage import cut, delete, scratch
from fathom.llm.queries import held_out, table, vocabulary


#: Rejected rows up to which their keys are broadcast (16 bytes each), so that no text is shuffled.
BROADCAST_ROWS = 2_000_000


def _kept(docs: DataFrame, score: Callable[..., DataFrame], model, keeps: Column) -> DataFrame:
    """The rows of ``docs`` that their own score keeps."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    other = F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))
    scored = score(docs.select("doc_id", "text", other.alias("__rest")), model, ("text", "__rest"))
    return scored.filter(keeps).select(*(F.col(c) if c in ("doc_id", "text") else F.col("__rest")[c].alias(c) for c in docs.columns))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out rows whose toxicity score is 0.5 or more; held-out labels are not learnt from."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return _kept(docs, toxicity.score, model, F.col("score") < 0.5)


def poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out rows that the quality scorer holds for bad; null and empty texts go by the labellers' votes."""
    return _kept(docs, quality.score, quality.fit(docs), F.col("score") >= 0.5)


def repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (five-word shingles, 0.8), that of the least doc_id.

    Of rows with the same doc_id and text one is kept, of any that are otherwise alike. A null
    doc_id is in no group, but its repeated rows are one too.
    """
    text_hash, n = F.xxhash64("text"), "__n"
    verdicts = minhash.near_duplicates(docs).groupBy("doc_id", "text_hash").agg(F.bool_and("kept").alias("kept"), F.count("*").alias(n))
    verdicts = cut(verdicts.filter(~F.col("kept") | (F.col(n) > 1)).withColumnsRenamed({"doc_id": "__of", "text_hash": "__hash"}))

    def of(rows: DataFrame, how: str) -> DataFrame:
        rows = F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
        return docs.join(rows, F.col("doc_id").eqNullSafe(F.col("__of")) & (text_hash == F.col("__hash")), how)

    alone = of(verdicts, "left_anti")
    twice = of(verdicts.filter("kept"), "left_semi").dropDuplicates(["doc_id", "text"])
    return alone.unionByName(twice)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take personal data and the terms that disclose it out of the texts; every row stays, null texts as they are."""
    return pii.sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into windows of 1024 ids; a null or empty text is its end id alone."""
    pieces = packing.pack(docs, vocabulary("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", toxic),
    ("quality", poor),
    ("near-duplicates", repeated),
    ("personal data", private),
    ("packing", packed),
]
#: The stages are trained models, hashes and a packer; none is SQL. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs, folder, last = table(spark, sf_dir, "documents"), scratch(spark, "pipeline"), None
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            delete(spark, last)
        last = path
    return docs
