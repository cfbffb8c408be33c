"""Registered queries run, and a choice of them equals their SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SOME = ["weekly_anomaly_brand", "dq_metrics", "aspect_sentiment_pivot", "rrf_fusion", "retrieval_metrics", "largest_remainder_quota", "absa_status", "route_questions"]


def plain(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", SOME)
def test_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = catalog.queries()[name](spark, sf)
    cols = sorted(df.columns)
    found = con.execute(catalog.oracle_sql()[name])
    at = [[d[0] for d in found.description].index(c) for c in cols]
    assert sorted([plain(r[c]) for c in cols] for r in df.collect()) == sorted([plain(r[i]) for i in at] for r in found.fetchall())


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() >= 0
