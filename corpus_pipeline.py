"""The corpus pipeline: documents by language, one of each near-duplicate group, without long repeats, decontaminated, mixed to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import decontaminate, jaccard_join, language_id, raking, substring_dedup
from postmill.llm.common import table
from postmill.session import write_stage

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
REPEAT_WORDS = 50
BUDGET = 0.9

ARROW_BYTES = 4 << 20
"""Rows go to Python in batches of so many bytes; batches by number alone hold tens of MB of whole documents, on both sides."""

ORACLE_SQL = None


def _in_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: null texts, texts without a letter and texts unlike every learned language go.

    Rows are judged one by one, so that repeated rows and ties have no influence.
    """
    _in_small_batches(spark)
    model = language_id.fit(docs, language_id.learned_from())
    found = language_id.identified(docs, model, keep="*", reject=True)
    return found.where(F.col("lang_pred") != "und").select("row.*")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates (five words, similarity 0.8)."""
    _in_small_batches(spark)
    return jaccard_join.one_of_each_group(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that also stand in a document with a smaller id; n_chars follows the text.

    Null texts stay null. Rows of equal id do not lose what only they share.
    """
    _in_small_batches(spark)
    found = substring_dedup.deduplicated(docs, REPEAT_WORDS)
    columns = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item. Null and empty texts hold none and stay; repeated rows are judged alike."""
    _in_small_batches(spark)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), keep="*")
    return found.where("n_hit = 0").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents by calibrated probabilities, with the weight of each.

    Rows without a language or source are of the class ``unknown``; texts without words all stay, with weight 0. Rows of one id and text
    are kept or left together.
    """
    found = raking.standard_mix(docs, BUDGET).where("mix_kept")
    return found.select(*docs.columns, F.col("mix_probability").alias("probability"), F.col("mix_weight").alias("weight"))


STAGES = [
    ("language ID", in_a_language),
    ("n-gram Jaccard join", one_of_near_duplicates),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
