import pytest

import __spark_entry__ as contract
from check_sql import compare

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "BuyerInfo_BuyerEmail" in df.columns


def test_every_query_has_check_sql():
    commerce = {**contract.QUERIES, **contract.FEED_QUERIES}
    assert set(commerce) == {**contract.SQL, **contract.FEED_SQL}.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, name):
    text, _, ok = compare(spark, SF, name, contract.queries()[name], contract.oracle_sql()[name])
    assert ok, text
