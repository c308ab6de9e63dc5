"""Generated inputs beside plain Python."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rushline.functions import text
from rushline.operators import alerts as al
from rushline.operators import cleaning as cl
from rushline.operators import quantiles as qu

FEW = settings(max_examples=8, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])

small = st.one_of(st.none(), st.integers(-3, 3))


@FEW
@given(rows=st.lists(st.tuples(small, small, st.one_of(st.none(), st.text(max_size=3))),
                     min_size=1, max_size=40))
def test_distinct_on_keeps_the_smallest_row(spark, rows):
    def rank(row):
        return [(v is not None, v if v is not None else 0) for v in row[1:2]] + [
            (row[2] is not None, (row[2] or "").encode())]

    rows = [(k, v, s if s is None else s.encode("utf-8", "ignore").decode()) for k, v, s in rows]
    expected = {}
    for row in rows:
        if row[0] not in expected or rank(row) < rank(expected[row[0]]):
            expected[row[0]] = row
    df = spark.createDataFrame(rows, "k int, v int, s string")
    found = {r["k"]: tuple(r) for r in cl.distinct_on(df, ["k"], ["v"]).collect()}
    assert found == expected


@FEW
@given(values=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_fixed_text_equals_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(text.fixed(F.col("v"), 1)).collect()] == [
        f"{v:.1f}" for v in values]


@FEW
@given(values=st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=200),
       p=st.floats(0, 1))
def test_exact_quantile_is_between_its_neighbours(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = qu.exact_quantiles(df, "v", [p], accuracy=10).first()["value"]
    ranked = sorted(values)
    place = p * (len(values) - 1)
    low, high = ranked[int(place)], ranked[min(int(place) + 1, len(values) - 1)]
    assert low - 1e-6 <= found <= high + 1e-6


blocks = st.lists(st.one_of(
    st.fixed_dictionaries({"text": st.text(alphabet="ab \n\t\"\\é", max_size=6)}),
    st.fixed_dictionaries({"type": st.just("tool")}),
    st.integers(0, 9), st.none(), st.just("stray"),
), max_size=5)


@FEW
@given(bodies=st.lists(blocks, min_size=1, max_size=20))
def test_response_text_equals_python(spark, bodies):
    texts = [json.dumps({"id": "r", "content": b}) for b in bodies]
    expected = ["".join(x.get("text", "") for x in b if isinstance(x, dict)).strip()
                for b in bodies]
    df = spark.createDataFrame([(t,) for t in texts], "b string")
    assert [r[0] for r in df.select(al.response_text(F.col("b"))).collect()] == expected
