"""The corpus pipeline: raw documents to a training mix, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as parquet
and read again before the next one starts, so a lost executor costs at most one stage.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.decontamination import decontaminated
from tally.llm.line_frequency import drop_frequent_lines
from tally.llm.mixture import mix
from tally.llm.ngram_join import copied_rows, drop_near_duplicates
from tally.llm.quality import keep_good
from tally.llm.texts import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return keep_good(docs).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go, and documents that were nothing else; ``n_chars`` follows the text.

    Copies and near copies of a text are one page: they are for the next stage to drop, not to lose here
    the text that they share.
    """
    cleaned = drop_frequent_lines(docs, copied=copied_rows(docs))
    emptied = (F.col("n_dropped") > 0) & ~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    return cleaned.filter(~emptied).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the least id."""
    return drop_near_duplicates(docs).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark go."""
    judged = decontaminated(docs, table(spark, sf_dir, "benchmark"))
    return judged.filter(~F.col("contaminated")).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with the number of copies it takes of them."""
    return mix(docs).filter("copies > 0").select(*COLUMNS, "copies", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
]

#: Trained references, MinHash classes and whole-text rules have no SQL; tests hold the run
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
