"""The corpus pipeline: five stages from raw documents to token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's ``docs``. All but the last keep the columns of ``documents``. Null or empty texts fail the quality rules and
go there; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import line_chunks, mixing, pieces, quality, simhash
from marquee.llm.text import text_digest
from marquee.session import materialize, prepare
from marquee.sources.star_schema import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Every text is judged by itself, also those that share an id or have none."""
    prepare(spark)
    judged = quality.judge(docs, table(spark, sf_dir, "labels"), digests=True)
    rejected = judged.filter("NOT kept").select(F.col("doc_id").alias("_id"), F.col("text_digest").alias("_digest")).distinct()
    same = docs["doc_id"].eqNullSafe(rejected["_id"]) & (text_digest(docs["text"]) == rejected["_digest"])
    return docs.join(rejected, same, "left_anti")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks of lines that repeat earlier ones; ``n_chars`` follows the text."""
    prepare(spark)
    cut = line_chunks.deduplicated(docs)
    counted = F.when(F.col("removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", counted).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return simhash.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Ids may be null or repeat: documents are told apart by their texts too."""
    prepare(spark)
    mixed = mixing.mix(mixing.sized_documents(docs, table(spark, sf_dir, "labels")), carried=("digest",))
    return mixing.repeated(docs, mixed, digest=text_digest(docs["text"]))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of every copy; the copies of a text are cut anew."""
    prepare(spark)
    return pieces.encoded(docs, copies=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mix sources", mix_sources),
    ("encode", encode),
]
#: The forest and the merge-dropout cannot be stated in SQL; tests hold the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
