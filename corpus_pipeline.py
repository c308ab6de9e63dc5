"""A corpus pipeline: five stages over documents, each written before the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns they were given. Names of added helper columns are made fresh,
so extra columns of the input may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rushline.llm import decontam, jaccard, lines, mixing, toxicity
from rushline.llm.common import fresh, stored, table

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: Some stages end in SQL-free operators (classifier, similarity join, automaton).
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    scored = docs.withColumn(score, toxicity.score(docs, model))
    return scored.where(F.col(score) < toxicity.REJECTED_FROM).select(*docs.columns)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sources go; every document stays. Copies of a text
    that is mostly such lines are left to the next stage."""
    cleaned = lines.clean(docs, F.col("source"), into=fresh(docs, "lines"))
    return cleaned.select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return jaccard.one_per_component(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = fresh(docs, "found")
    scanned = decontam.find(docs, table(spark, sf_dir, "benchmark"), into=found)
    return scanned.where(~F.col(f"{found}.contaminated")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of copies of each."""
    mix = fresh(docs, "mix")
    mixed = mixing.with_copies(docs, WEIGHTS, into=mix)
    return mixed.where(F.col(f"{mix}.copies") > 0).select(
        *docs.columns, F.col(f"{mix}.size").alias(fresh(docs, "size")),
        F.col(f"{mix}.target").alias(fresh(docs, "target")),
        F.col(f"{mix}.copies").alias(fresh(docs, "copies")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's result; every stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage_{number}")
    return docs
