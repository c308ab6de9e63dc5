"""Typed scans.

A path may name a local folder, HDFS or an object store (``s3a://``): the
connector is part of the session, not of this code.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

logger = logging.getLogger(__name__)

# Columns of the hourly observation file, in file order.
RAW_SCHEMA = StructType([
    StructField("holiday", StringType()),
    StructField("temp", DoubleType()),
    StructField("rain_1h", DoubleType()),
    StructField("snow_1h", DoubleType()),
    StructField("clouds_all", IntegerType()),
    StructField("weather_main", StringType()),
    StructField("weather_description", StringType()),
    StructField("date_time", TimestampType()),
    StructField("traffic_volume", IntegerType()),
])


def join_uri(base: str, *parts: str) -> str:
    """``join_uri("s3a://b/x/", "raw", "f.csv")`` -> ``s3a://b/x/raw/f.csv``."""
    return "/".join([base.rstrip("/"), *(p.strip("/") for p in parts)])


def read_observations(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | None = RAW_SCHEMA,
    fmt: str = "csv",
    rebalance: bool = False,
) -> DataFrame:
    """Scan CSV (plain or ``.gz``) with a declared schema, or Parquet.

    Fields that do not parse become NULL. A gzip file is one task per file;
    ``rebalance`` spreads its rows by size before further narrow work. It is
    off by default because the dedupe that normally follows shuffles anyway.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.load(paths if isinstance(paths, str) else list(paths))
    return df.hint("rebalance") if rebalance else df


def first_available(
    spark: SparkSession, uris: Sequence[str], lenient: bool = False, **read_options
) -> tuple[DataFrame, str]:
    """Scan the first URI that exists; returns the table and the URI used.

    Only a missing path moves on to the next URI. With ``lenient`` any failure
    to open one (no credentials, no connector) is logged and skipped as well.
    """
    for uri in uris:
        try:
            return read_observations(spark, uri, **read_options), uri
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND" and not lenient:
                raise
            logger.warning("skipping %s: %s", uri, error.getCondition())
        except Exception as error:
            if not lenient:
                raise
            logger.warning("skipping %s: %s", uri, error)
    raise FileNotFoundError(f"none of these exist: {list(uris)}")


def read_report_csv(spark: SparkSession, uri: str, schema: StructType | str) -> DataFrame:
    """A report table written earlier, with its declared schema."""
    return spark.read.schema(schema).option("header", True).csv(uri)


def read_report_json(spark: SparkSession, uri: str, schema: StructType | str | None = None) -> DataFrame:
    """A report document; accepts one document per line and pretty-printed files."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(uri)
