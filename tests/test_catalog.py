"""Every registered query against its SQL over the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from sievewright.plans import catalog, deliveries, verdicts  # noqa: F401

DIR = "/root/testdata/sf0.001"


def rows(names, values, order):
    return sorted((tuple(v[names.index(c)] for c in order) for v in values), key=str)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_against_sql(spark, name):
    df = catalog.QUERIES[name](spark, DIR)
    order = sorted(df.columns)
    mine = rows(df.columns, [tuple(r) for r in df.collect()], order)
    con = duckdb.connect()
    for f in os.listdir(DIR):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DIR}/{f}'")
    cur = con.execute(catalog.ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == order
    assert mine == rows(names, cur.fetchall(), order)


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["room", "doc_id", "slots", "pick_rank"]
