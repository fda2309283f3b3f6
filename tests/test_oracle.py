"""Every registered query against its SQL, on the smallest tables."""

import math
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registered

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
# The optional training-data operators; those without SQL are tested in their own folder.
OPTIONAL = {n for n in registered.queries() if re.match(r"op\d+_", n) or n == "pipeline"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if value is None or value is pd.NA:
        return None
    value = value.item() if hasattr(value, "item") else value
    if isinstance(value, float):
        # pandas holds whole numbers with a null among them as floats.
        return None if math.isnan(value) else int(value) if value.is_integer() else value
    return value


def rows(frame):
    ordered = frame[sorted(frame.columns)]
    return sorted(repr(tuple(map(plain, row))) for row in ordered.itertuples(index=False, name=None))


def test_names_match():
    assert set(registered.queries()) - set(registered.oracle_sql()) - OPTIONAL == set()
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_flagship(spark):
    assert registered.entry(spark).columns == ["word", "definition"]


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, duck, name):
    got = registered.queries()[name](spark, SF).toPandas()
    assert len(got)
    if name not in registered.oracle_sql():
        return
    expected = duck.execute(registered.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)
