"""The driver's contract, with or without the training-data operators."""

import importlib.util

import __spark_entry__
from larkspur.plans import catalog


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["l_returnflag", "l_extendedprice_sum", "l_quantity_mean"]
    assert df.count() == 3


def test_queries_and_sql():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert catalog.queries().keys() <= queries.keys() and sql.keys() <= queries.keys()
    if importlib.util.find_spec("larkspur.llm"):
        from larkspur.llm import queries as own

        assert own.QUERIES.keys() <= queries.keys() and own.ORACLES.keys() <= sql.keys()
