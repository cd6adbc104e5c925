"""Every query against its DuckDB twin, on the smallest tables."""

import decimal

import duckdb
import pytest

from tests.conftest import SF
from threadloom.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return int(v) if v.is_integer() else round(v, 5)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows_of(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df, twin = catalogue.QUERIES[name](spark, SF), duck.sql(catalogue.ORACLES[name])
    assert sorted(df.columns) == sorted(twin.columns)
    assert rows_of(df.collect(), df.columns) == rows_of(twin.fetchall(), twin.columns)


#: Queries that SQL can't express, and what must hold of their rows.
FREE = {
    "m01_embedded_texts": lambda rows: all(abs(sum(x * x for x in r["embedding"]) - 1) < 1e-5 for r in rows),
    "m06_pca_reduction": lambda rows: len({tuple(r["coords"]) for r in rows}) == len(rows) and all(len(r["coords"]) == 5 for r in rows),
    "m07_reduction_quality": lambda rows: all(r["variance"] > 0 and r["duplicate_share"] == 0 and 0.5 < r["trustworthiness"] <= 1 for r in rows),
    "m08_density_clusters": lambda rows: len({r["label"] for r in rows}) > 3 and all(0 <= r["probability"] <= 1 for r in rows),
    "m15_bootstrap": lambda rows: all(0 < r["ari"] <= 1 and 0 < r["nmi"] <= 1 for r in rows),
    "w09_representatives": lambda rows: all(1 <= r["position"] <= 5 for r in rows) and len({(r["label"], r["position"]) for r in rows}) == len(rows) and len({(r["label"], r["rank"]) for r in rows}) == len(rows),
}


def test_every_query_has_a_twin_or_a_property():
    assert set(catalogue.QUERIES) - set(catalogue.ORACLES) == set(FREE)


@pytest.mark.parametrize("name", sorted(FREE))
def test_query_without_oracle_holds(spark, name):
    rows = catalogue.QUERIES[name](spark, SF).collect()
    assert rows and FREE[name](rows)
