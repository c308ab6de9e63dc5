"""Every query of the subpackage beside its SQL."""

import pytest

from rushline.llm import oracles, queries
from tests.oracle_check import compare, connect


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_names():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(oracles.ORACLES) <= names


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, db, name):
    ours = queries.queries()[name](spark, sf_dir).toPandas()
    assert compare(ours, db.execute(oracles.ORACLES[name]).fetchdf()) is None
