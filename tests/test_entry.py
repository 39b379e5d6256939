import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from rotorwatch.plans.catalog import QUERIES
from rotorwatch.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0 and df.columns


def test_every_query_has_oracle_or_is_declared(spark):
    missing = set(QUERIES) - set(entry_mod.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = entry_mod.queries()[name](spark, SF)
    res = con.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    assert sorted(scols) == sorted(dcols)
    order_s = [scols.index(c) for c in sorted(scols)]
    order_d = [dcols.index(c) for c in sorted(dcols)]
    norm = lambda v: v.replace(tzinfo=None) if hasattr(v, "tzinfo") and v.tzinfo else v
    a = sorted((tuple(repr(norm(r[i])) for i in order_s) for r in srows))
    b = sorted((tuple(repr(norm(r[i])) for i in order_d) for r in drows))
    assert a == b
