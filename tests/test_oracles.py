"""A representative subset of the catalogue against its DuckDB oracle at sf0.001
(the full set runs with scripts/oracle_check.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
KEYS = ["indicators_all", "indicators_events", "fill_prices_blocked", "fill_median", "clean_bars",
        "cleaning_report", "feed_company_news", "feed_social", "feed_quarantine", "latest_series",
        "prefer_processed", "status_latest", "summary_steps", "round_display", "parse_batch"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF)
    srows, scols = [tuple(r) for r in sdf.collect()], sdf.columns
    rel = duck.sql(E.oracle_sql()[key])
    drows, dcols = rel.fetchall(), rel.columns
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(scols, srows) == rows_of(dcols, drows)
