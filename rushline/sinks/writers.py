"""Writers (K1-K8, K10, K11). Every target is a URI, local or object store."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from rushline.sources import join_uri


def write_csv(df: DataFrame, uri: str, single_file: bool = False) -> str:
    """CSV with a header, replacing the target.

    ``single_file`` is for report tables of a few rows: the query itself keeps
    its parallelism, only its sorted result is put into one file.
    """
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(uri)
    return uri


def write_json(df: DataFrame, uri: str, single_file: bool = False) -> str:
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option(
        "ignoreNullFields", False).json(uri)
    return uri


def write_table(df: DataFrame, uri: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write Parquet and return the written table.

    Reading it back cuts the lineage: later stages start from durable files
    with column pruning, also after an executor is lost.
    """
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def append_table(df: DataFrame, uri: str) -> str:
    df.write.mode("append").parquet(uri)
    return uri


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only a local session without that setting falls back to a temporary folder
    of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="rushline-")
    return join_uri(base, f"rushline-{uuid.uuid4().hex}", name)
