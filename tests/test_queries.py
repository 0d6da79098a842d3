"""Every query of the engine against its DuckDB twin."""

import duckdb
import pytest

from weftline.plans import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"create view {t} as from read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_against_sql(spark, sf_dir, con, name):
    want = con.sql(catalog.ORACLES[name]).df()
    got = catalog.QUERIES[name](spark, sf_dir).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    rows = lambda d: sorted(map(repr, d[columns].astype(object).where(d[columns].notna(), None).values.tolist()))
    assert rows(got) == rows(want)


def test_every_record_gets_matches(spark, sf_dir):
    rows = catalog.gbt_match(spark, sf_dir).collect()
    want = {r.s1_id for r in catalog._s1_ids(spark, sf_dir).collect()}
    assert len(rows) == len(want) and {r.s1_id for r in rows} == want
    assert all(set(filter(None, r.matched_entity_ids.split(","))) <= set(r.candidate_entity_ids.split(",")) for r in rows)
