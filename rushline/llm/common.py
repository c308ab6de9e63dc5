"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rushline.sinks import scratch_uri, write_table

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the cluster's shared folder.

    Cuts the lineage: what follows survives lost executors without repeating
    the work above, and row numbers given before are fixed.
    """
    return write_table(df, scratch_uri(df.sparkSession, name))


#: Most rows of a table that is broadcast, some hundred bytes each.
MOST_BROADCAST_ROWS = 50_000


def join_few(rows: DataFrame, few: DataFrame, left: str, right: str, salt: Column,
             how: str = "inner", most: int = MOST_BROADCAST_ROWS, salts: int = 16) -> DataFrame:
    """``rows`` joined to a stored table that has one row per key, NULL equal to NULL.

    Up to a checked number of rows the table is broadcast and ``rows`` stay where they
    are. Beyond it every row of the table stands once per salt, and ``rows`` are dealt by
    key and salt, so a key that a third of them share goes to many tasks.
    """
    same = F.col(left).eqNullSafe(F.col(right))
    if few.count() <= most:
        return rows.join(F.broadcast(few), same, how)
    part, copy = fresh(rows, "salt"), fresh(few, "salt_copy")
    dealt = rows.withColumn(part, F.pmod(salt, F.lit(salts)).cast("int"))
    copies = few.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, same & (F.col(part) == F.col(copy)), how).drop(part, copy)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for an empty text."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lambda_range(n: Column) -> Column:
    """0 .. n-1; empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(
        F.array().cast("array<int>"))


def running_starts(lengths: Column, block: int = 128) -> Column:
    """The sum of all lengths before each element, for an array of lengths.

    Sums over blocks first: n elements cost n * block / 2 additions, not n * n.
    """
    def total(part):
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    def with_heads(v):
        n = F.size(v)
        blocks = F.transform(
            lambda_range(F.ceil(n / block)), lambda b: total(F.slice(v, b * block + 1, block)))
        heads = let(blocks, lambda bs: F.transform(
            bs, lambda _, i: total(F.slice(bs, F.lit(1), i))))
        return let(heads, lambda hs: F.transform(v, lambda _, i: F.get(
            hs, F.floor(i / block).cast("int")) + total(F.slice(
                v, (F.floor(i / block) * block + 1).cast("int"), i % block))))

    return let(lengths, with_heads)


_SHIPPED: set[str] = set()
#: Most rows and bytes of an Arrow batch: texts may be long, and a batch is held whole
#: by the executor, outside its heap, and by the Python worker.
BATCH_ROWS, BATCH_BYTES = 2000, 1 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application, and keep
    Arrow batches small.

    Python workers import the operators by name; a cluster's machines need no
    installed copy. Spark serves the archive, also to executors that come later.
    """
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    held = spark.conf.get(BYTES_SETTING, None) or ""
    if not held.isdigit() or not 0 < int(held) <= BATCH_BYTES:
        spark.conf.set(BYTES_SETTING, str(BATCH_BYTES))
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="rushline-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)
