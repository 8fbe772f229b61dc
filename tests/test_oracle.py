"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

from quartier.plans import verify
from quartier.plans.catalog import ORACLE, QUERIES, load_all

load_all()
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return verify.duck(SF)


@pytest.fixture(autouse=True)
def exact():
    # sums are exact (integer units), so results must be bit-identical to the
    # oracle, not merely close
    verify.EXACT = True
    yield
    verify.EXACT = False


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = verify.compare(spark, name, SF, con)
    if name in ORACLE:
        assert res["status"] == "match", res
    else:
        assert res["spark_rows"] > 0


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
