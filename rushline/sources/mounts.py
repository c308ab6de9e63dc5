"""Names for stores, so tables are read and written by URIs of another scheme."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def mount(spark: SparkSession, name: str, links: Mapping[str, str]) -> str:
    """``viewfs://name``, whose folders are the URIs of ``links``; returns that URI.

    ``mount(spark, "lake", {"/raw": "s3a://bucket/raw", "/out": "hdfs:///out"})`` lets a
    job name ``viewfs://lake/raw/obs.csv``; where the data lies is then a setting of
    the session. Any URI of this package may be such a one. A name is read once per
    file system, so a mounted name keeps its links.
    """
    for folder, target in links.items():
        spark.conf.set(f"fs.viewfs.mounttable.{name}.link.{folder}", target)
    return f"viewfs://{name}"
