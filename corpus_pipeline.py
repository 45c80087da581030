"""Documents to token ids in five stages, each written as Parquet and read again.

Language ID drops texts of no language, line dedup cuts site boilerplate, near-dedup
keeps one document of each group, decontamination drops documents that hold a
benchmark item, and the byte-level BPE turns what is left into ids.

Every stage takes (spark, docs, sf_dir) with the columns of ``documents``; rows
without id are kept by the stages that decide by id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.llm import bpe, decontam, langid, linededup, neardup
from saldo.llm.queries import fold, table
from saldo.llm.textarrays import bound_batches
from saldo.session import ensure_checkpoint_dir, work_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BROADCAST_ROWS = 1_000_000
#: Models and digests have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not among ``ids`` (one checked row each); broadcast up to a size."""
    gone = ids.select("doc_id").distinct().checkpoint()
    known = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return docs.join(known, "doc_id", "left_anti").select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those that do not fit the language that fits best."""
    bound_batches(spark)
    model = langid.fit(docs.filter(F.coalesce(fold(4) != 2, F.lit(True))))
    judged = docs.withColumn("_judged", langid.predicted(docs, model))
    return judged.filter((F.col("_judged.lang_pred") != langid.UNDETERMINED) & F.col("_judged.fits")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the boilerplate lines of each site; n_chars follows the text.

    Pages with nothing left are dropped: a page with the same lines stays whole.
    """
    cleaned = linededup.remove_boilerplate(docs, spare_copies=True)
    cleaned = cleaned.filter((F.col("lines_dropped") == 0) | F.col("text_kept").rlike(r"[^\x20\x09-\x0D]"))
    same = [F.col(f"row.{c}").alias(c) for c in ("doc_id", "lang", "source")]
    return cleaned.select(*same, F.col("text_kept").alias("text"), F.length("text_kept").cast("long").alias("n_chars")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class, the one with the smallest id, once.

    Documents are told apart by id and text, so a text that shares its id with another
    one is decided on its own; so are rows without id.
    """
    bound_batches(spark)
    ensure_checkpoint_dir(spark)
    found = neardup.grouped(docs).checkpoint()
    hashed = docs.withColumn("_h", F.xxhash64("text"))

    def only(rows: DataFrame, pairs: DataFrame, how: str) -> DataFrame:
        chosen = pairs.select(F.col("doc_id").alias("_id"), F.col("h").alias("_of")).checkpoint()
        known = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
        return rows.join(known, rows["doc_id"].eqNullSafe(known["_id"]) & (rows["_h"] == known["_of"]), how)

    kept = only(hashed, found.filter(~F.col("kept")).distinct(), "left_anti")
    repeated = found.filter("kept").groupBy("doc_id", "h").count().filter("count > 1").checkpoint()
    if not repeated.isEmpty():
        once = only(kept, repeated, "left_semi").dropDuplicates(["doc_id", "_h"])
        kept = only(kept, repeated, "left_anti").unionByName(once)
    return kept.select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, exactly or with few edits."""
    bound_batches(spark)
    ensure_checkpoint_dir(spark)
    return without(docs, decontam.matches(docs, table(spark, sf_dir, "benchmark")))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of ids and decoded bytes."""
    bound_batches(spark)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encoded(docs, bpe.Codec(ranks, public_tokenizers.PATTERN))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        place = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
