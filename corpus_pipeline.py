"""A training corpus from raw documents: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir); docs has the columns of `documents`. All stages but the last
return these columns; the last returns tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.llm import byte_bpe, decontaminate, language, line_dedup, simhash
from tapewatch.llm.queries import BYTE_RANKS, documents, held_out
from tapewatch.llm.support import new_folder, small_batches, unused

#: A document whose predicted language has less than this probability is rejected, as one without letters is.
MIN_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; without a labelled document nothing can be, and all stay."""
    small_batches(spark)
    model = language.train(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    if not model.languages:
        return docs
    found = unused(docs, "found")
    told = docs.withColumn(found, language.predicted(F.col("text"), model))
    sure = (F.col(f"{found}.lang") != language.UNDETERMINED) & (F.col(f"{found}.score") >= MIN_LANGUAGE_SCORE)
    return told.filter(sure).drop(found)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate in their source; n_chars follows the text."""
    kept = line_dedup.drop_boilerplate(docs)
    if "n_chars" not in docs.columns:
        return kept.select(docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id.

    Rows without an id cannot be told apart by it: they stay. Of repeated rows with one id all stay if
    that id is kept.
    """
    small_batches(spark)
    classes = simhash.simhash_components(docs)
    kept = (
        classes.filter(F.col("doc_id") == F.col("component_id"))
        .select(F.col("component_id").alias("kept_id"))
        .distinct()
    )
    own = unused(docs, "kept_id")
    with_id = docs.join(kept.withColumnRenamed("kept_id", own), F.col("doc_id") == F.col(own), "left_semi")
    return with_id.unionByName(docs.filter(F.col("doc_id").isNull()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    matches = unused(docs, "matches")
    marked = decontaminate.with_contamination(docs, benchmark, matches=matches)
    return marked.filter(F.size(matches) == 0).drop(matches)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers of each document, with the check that they decode to its text."""
    small_batches(spark)
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    rows = docs.select("doc_id", "text", digest.alias("text_sha256"))
    return byte_bpe.with_tokens(rows, BYTE_RANKS, decoded="decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        "offsets",
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("exact"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: Alignment, fingerprints and byte pair merging are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = documents(spark, sf_dir)
    folder = new_folder(spark, "corpus-pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
