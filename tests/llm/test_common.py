"""The join with a small table, and numbering of sources."""

import pytest
from pyspark.sql import functions as F

from rushline.llm import mixing
from rushline.llm.common import BATCH_BYTES, join_few, ship_package, stored


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_with_few_rows_is_the_same_beyond_its_bound(spark, how):
    """Broadcast or salted: NULL keys, keys of one side only, clashing names."""
    rows = spark.createDataFrame(
        [(None if i % 7 == 0 else "hot" if i % 3 else f"k{i % 5}", i, "s") for i in range(500)],
        "k string, i long, salt string")
    few = stored(spark.createDataFrame(
        [(None, 1), ("hot", 2), ("k0", 3), ("k4", 4), ("unused", 5)], "k_ string, v int"), "few")
    found = [sorted(map(tuple, join_few(rows, few, "k", "k_", F.xxhash64("i"), how, most=most).collect()), key=repr)
             for most in (100, 0)]
    assert found[0] == found[1]
    assert len(found[0]) == (500 if how == "left" else sum(r[3] is None or r[3] != "" for r in found[0]))
    assert sum(r[0] is None and r[4] == 1 for r in found[0]) == 72


def test_a_salted_join_spreads_a_hot_key(spark):
    rows = spark.range(4_000).select(F.lit("hot").alias("k"), "id")
    few = stored(spark.createDataFrame([("hot", 2)], "k_ string, v int"), "few")
    joined = join_few(rows.hint("merge"), few, "k", "k_", F.xxhash64("id"), most=0)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 4_000


def test_weights_repeat_in_order_of_code_points(spark):
    sources = spark.createDataFrame([(s, 1) for s in ("b", None, "é", "a", "B", "z", "")], "source string, tokens long")
    rows = mixing.ranked_weights(sources, (5, 2, 1)).collect()
    order = ["", "B", "a", "b", "z", "é", None]
    assert {r["source"]: r["weight"] for r in rows} == {
        s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    assert rows[0].asDict().keys() == {"source", "tokens", "weight"}
    plan = mixing.ranked_weights(sources, (5, 2, 1))._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan and "Python" not in plan


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    """The pipeline's executors hold a batch outside their heap, the workers once more."""
    ship_package(spark)

    def measured(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    texts = spark.range(0, 1_000, numPartitions=1).select(F.repeat(F.lit("long text "), 2_000).alias("text"))
    found = texts.mapInArrow(measured, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 1_000
    assert max(r["size"] for r in found) <= 2 * BATCH_BYTES
