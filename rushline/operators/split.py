"""Train/test split and deterministic sampling by key hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


def key_text(df: DataFrame, key: str) -> Column:
    """The key as text that is the same in every session time zone."""
    if isinstance(df.schema[key].dataType, TimestampType):
        return F.unix_micros(key).cast("string")
    return F.col(key).cast("string")


# The hash is the first eight hexadecimal digits of an MD5.
HASH_RANGE = 1 << 32


def key_hash(key: Column, salt: str = "") -> Column:
    """0 .. 2^32-1 from the text of a key: the same under any partitioning or engine."""
    if salt:
        key = F.concat(F.lit(salt), key)
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def hash_percent(key: Column, salt: str = "") -> Column:
    return key_hash(key, salt) % 100


def add_split(df: DataFrame, key: str, train_share: float = 0.8, salt: str = "",
              out: str = "split") -> DataFrame:
    """``train`` or ``test`` per row; narrow, no shuffle. A NULL key is test.

    ``salt`` draws another split. Shares of whole percents go by the hash modulo
    100, finer ones by a millionth.
    """
    percent = train_share * 100
    if abs(percent - round(percent)) < 1e-9:
        trained = hash_percent(key_text(df, key), salt) < round(percent)
    else:
        trained = key_hash(key_text(df, key), salt) % 1_000_000 < round(train_share * 1_000_000)
    return df.withColumn(out, F.when(trained, "train").otherwise("test"))


def add_fold(df: DataFrame, key: str, folds: int = 3, out: str = "fold") -> DataFrame:
    """Fold number for cross-validation, independent of the split hash."""
    return df.withColumn(
        out, F.coalesce(key_hash(key_text(df, key), "fold") % folds, F.lit(0)).cast("int"))


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))


def sample_rows(df: DataFrame, key: str, n: int = 4000) -> DataFrame:
    """``n`` rows in hash order of the key: unbiased and repeatable.

    Plans as take-ordered: each task keeps ``n`` rows, nothing is fully sorted.
    """
    return df.orderBy(F.md5(key_text(df, key)), F.col(key)).limit(n)
