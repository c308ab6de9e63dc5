"""Nested documents as rows of (path, value) (K2, K8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

LEAF = "array<struct<path:string,value:string>>"


def leaf_paths(value: Column, kind: DataType, path: Column | None = None) -> Column:
    """Every leaf below a column of any nested type, as an array of (path, value).

    Fields and map keys are joined by dots, array elements are ``[0]``, ``[1]``, ...
    A value is its text; a NULL leaf is a row with a NULL value, and so is an empty
    or NULL array, map or struct, so no field of a document is lost.
    """
    here = F.lit("") if path is None else path
    alone = F.array(F.struct(here.alias("path"), F.lit(None).cast("string").alias("value"))).cast(LEAF)

    def below(name: Column) -> Column:
        return F.concat(here, F.when(here == "", "").otherwise("."), name)

    if isinstance(kind, StructType) and kind.fields:
        parts = [leaf_paths(value.getField(f.name), f.dataType, below(F.lit(f.name)))
                 for f in kind.fields]
        return F.when(value.isNull(), alone).otherwise(F.concat(*parts))
    if isinstance(kind, ArrayType):
        nested = F.flatten(F.transform(value, lambda x, i: leaf_paths(
            x, kind.elementType, F.concat(here, F.lit("["), i.cast("string"), F.lit("]")))))
        return F.when(F.coalesce(F.size(value), F.lit(0)) <= 0, alone).otherwise(nested)
    if isinstance(kind, MapType):
        nested = F.flatten(F.transform(F.map_entries(value), lambda e: leaf_paths(
            e["value"], kind.valueType, below(e["key"].cast("string")))))
        return F.when(F.coalesce(F.size(value), F.lit(0)) <= 0, alone).otherwise(nested)
    return F.array(F.struct(here.alias("path"), value.cast("string").alias("value"))).cast(LEAF)


def flatten_documents(documents: DataFrame, *keep: str) -> DataFrame:
    """One row (path, value) per leaf of every document, beside the columns to ``keep``.

    Narrow: each document is unfolded where it lies.
    """
    columns = [f for f in documents.schema.fields if f.name not in keep]
    leaves = F.concat(*[leaf_paths(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name)) for f in columns])
    return documents.select(*keep, F.inline(leaves))


def read_document_paths(spark: SparkSession, uri: str) -> DataFrame:
    """(document, path, value) of the JSON documents below ``uri``; ``document`` is the file."""
    read = spark.read.option("multiLine", True).json(uri)
    return flatten_documents(read.withColumn("document", F.col("_metadata.file_path")), "document")
