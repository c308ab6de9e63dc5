"""Category indices, one-hots and the feature vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rushline.functions import calendar as cal
from rushline.operators.ranking import numbered
from rushline.operators.split import key_hash
from rushline.spec import LEVEL_INDEX, FeatureSpec


def vocabulary_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for several category columns from one scan; NULLs left out.

    Counts fold per column and value in the map tasks, so what is shuffled grows
    with the sum of the vocabularies, not with their product.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns
    ])
    return (
        df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def category_index(df: DataFrame, column: str) -> DataFrame:
    """Index of each value by falling frequency, ties in value order.

    A table (value, n, index) of any length. The vocabulary is sorted by ranges
    and numbered where it lies: positions follow from the sizes of the ranges
    before, so neither the driver nor one task ever holds the values.
    """
    counts = vocabulary_counts(df, [column]).select("value", "n")
    return numbered(counts, [F.desc("n"), F.asc("value")], "index").select(
        "value", "n", F.col("index").cast("double").alias("index"))


def fit_vocabulary(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Known values per column, by falling frequency, then value.

    All of them: an indexer model of Spark ML holds its labels, and the vector has
    a slot for each, so the model is what bounds a category here. Categories
    without a bound belong in ``FeatureSpec.hashed``.
    """
    vocabulary: dict[str, list[str]] = {c: [] for c in columns}
    if not columns:
        return vocabulary
    for row in vocabulary_counts(df, columns).orderBy(F.desc("n"), F.asc("value")).toLocalIterator():
        vocabulary[row["column"]].append(row["value"])
    for column, values in vocabulary.items():
        if not values:
            raise ValueError(f"{column!r} has no values to index")
    return vocabulary


def hash_slot(column: str, value: Column, slots: int) -> Column:
    """The slot of a value: a hash of column and value, the same in any engine."""
    return (key_hash(F.concat(F.lit(f"{column}="), value)) % slots).cast("double")


def hashed_stages(spark: SparkSession, columns: Sequence[str], slots: int) -> list:
    """A slot per value by its hash, one-hot, for categories of any number of values.

    Nothing is learned and no value is kept: the stages hold the column names and
    ``slots`` alone, on the driver as in a saved model. Values that share a slot
    share its weight. A NULL gets the extra slot, which the encoder drops.
    """
    if not columns:
        return []
    # the SQL form of hash_slot(), as a stage that a saved model can hold
    parts = ", ".join(
        f"coalesce(cast(cast(conv(substring(md5(concat('{c}=', cast(`{c}` as string))), 1, 8), 16, 10)"
        f" as bigint) % {slots} as double), {slots}D) as `{c}_slot`" for c in columns)
    widest = spark.range(1).select(*[F.lit(float(slots)).alias(f"{c}_slot") for c in columns])
    encoder = OneHotEncoder(inputCols=[f"{c}_slot" for c in columns],
                            outputCols=[f"{c}_hash" for c in columns])
    return [SQLTransformer(statement=f"select *, {parts} from __THIS__"), encoder.fit(widest)]


def feature_stages(
    spec: FeatureSpec, vocabulary: dict[str, list[str]], spark: SparkSession | None = None,
) -> list:
    """Indexers, one encoder (none without categories), hashed categories and the assembler.

    An unknown or NULL category gets the extra index, which the encoder drops:
    all zeros. The vector width is the scalars plus the known categories. NULL
    scalars become NaN in the vector; rows with them are dropped before a fit
    and get no prediction at scoring.
    """
    indexers = [
        StringIndexerModel.from_labels(
            vocabulary[c], inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep")
        for c in spec.categories
    ]
    encoders = [OneHotEncoder(
        inputCols=[f"{c}_idx" for c in spec.categories],
        outputCols=[f"{c}_vec" for c in spec.categories],
    )] if spec.categories else []
    assembler = VectorAssembler(
        inputCols=[*spec.scalars, *(f"{c}_vec" for c in spec.categories),
                   *(f"{c}_hash" for c in spec.hashed)],
        outputCol="features",
        handleInvalid="keep",
    )
    hashed = hashed_stages(spark, spec.hashed, spec.hash_slots) if spec.hashed else []
    return [*indexers, *encoders, *hashed, assembler]


def fit_features(train: DataFrame, spec: FeatureSpec = FeatureSpec()) -> PipelineModel:
    """Fit the feature stages on training rows only.

    One small job for the vocabulary; the encoder takes its sizes from column
    metadata and reads no rows.
    """
    vocabulary = fit_vocabulary(train, spec.categories)
    return Pipeline(stages=feature_stages(spec, vocabulary, train.sparkSession)).fit(train)


def add_label(df: DataFrame, level: str = "congestion", out: str = "label") -> DataFrame:
    """Alphabetical label index (high 0, low 1, medium 2) from the fixed list."""
    return df.withColumn(out, cal.level_index(F.col(level), LEVEL_INDEX))


def complete_rows(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Rows whose scalar inputs are all present: what a fit may see."""
    return df.dropna(subset=list(spec.scalars))


def slot_names(features: DataFrame, column: str = "features") -> list[str]:
    """Name of every vector slot, from the column's metadata."""
    groups = features.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a for group in groups.values() for a in group), key=lambda a: a["idx"])
    return [a["name"] for a in slots]


def slot_source(name: str, spec: FeatureSpec = FeatureSpec()) -> str:
    """Source column of a slot: itself for a scalar, the category for a one-hot."""
    for c, ending in [*((c, "vec") for c in spec.categories), *((c, "hash") for c in spec.hashed)]:
        if name.startswith(f"{c}_{ending}_"):
            return c
    return name
