"""A table whose rows are replaced by key (K5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class KeyedTable:
    """Parquet rows in one partition per key.

    ``put`` replaces the rows of the keys it is given and no others, so a step that
    is repeated never doubles its rows, and several writers may put different keys
    at once. A key's rows appear when the job that writes them commits.
    """

    def __init__(self, spark: SparkSession, uri: str, schema: str, keys: Sequence[str]):
        self.spark = spark
        self.uri = uri
        self.schema = StructType.fromDDL(schema)
        self.keys = list(keys)

    def put(self, rows: DataFrame) -> None:
        """Replace the rows of every key that ``rows`` holds."""
        ordered = rows.select(*self.schema.names)
        (ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.keys).parquet(self.uri))

    def read(self) -> DataFrame:
        """All rows; none where nothing was put yet."""
        try:
            return self.spark.read.schema(self.schema).parquet(self.uri).select(*self.schema.names)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def clear(self) -> None:
        """Forget every key."""
        self.spark.createDataFrame([], self.schema).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy(*self.keys).parquet(self.uri)
