"""Plan shape: one exchange for all indicator windows, pushdown, no Python UDFs."""

import __spark_entry__ as E
from marketframe.plans import catalog
from marketframe.functions.scalar import for_symbol
from marketframe.operators import indicators as I
from marketframe.sources import bindings as B

SF = "/root/testdata/sf0.001"


import contextlib
import io


def physical(df):
    """The physical plan text via the public explain()."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_indicators_single_window_exchange(spark):
    bars = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "event_type AS symbol", "CAST(ts AS DATE) AS date", "value AS close").groupBy("symbol", "date").avg("close") \
        .withColumnRenamed("avg(close)", "close")
    plan = physical(I.indicators(bars))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    lines = plan.splitlines()
    wins = [i for i, ln in enumerate(lines) if "Window [" in ln and "_mf_b" in ln]
    assert len(wins) >= 2
    # the stacked window operators of all 13 indicators share one exchange and sort
    between = lines[wins[0]:wins[-1]]
    assert not any("Exchange" in ln or "Sort [" in ln for ln in between)
    below = [ln for ln in lines[wins[-1]:] if "Exchange" in ln]
    assert "hashpartitioning(symbol" in below[0] and "_mf_b" in below[0]


def test_symbol_filter_pushed_to_scan(spark):
    li = spark.read.parquet(f"{SF}/part.parquet")
    plan = physical(for_symbol(li.withColumnRenamed("p_brand", "symbol"), "Brand#1", "symbol"))
    assert "PushedFilters: [IsNotNull(p_brand), EqualTo(p_brand,Brand#1)]" in plan


def test_entry_and_catalogue(spark):
    out = E.entry(spark).collect()
    assert len(out) == 5 and all(r.sma_20 is not None for r in out)
    assert set(E.oracle_sql()) <= set(E.queries())
    names = set(catalog.QUERIES)  # those of the library itself
    assert names <= set(E.queries())
    assert not any(n.startswith("op") or "pipeline" in n for n in names)


def test_brand_bars_scan_prunes_columns(spark):
    plan = physical(B.bars_brand(spark, SF))
    scan = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln][0]
    assert "l_partkey" in scan and "l_shipdate" in scan
    for unused in ("l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_suppkey"):
        assert unused not in scan


def test_rolling_frames_are_taken_once(spark):
    """Bands, averages and RSI share their rolling means and deviations, and only the halo rows that
    rolling frames reach go through them."""
    bars = spark.createDataFrame([("A", i, float(i)) for i in range(30)], "symbol string, date int, close double")
    plan = physical(I.indicators(bars))
    wins = [ln for ln in plan.splitlines() if "Window [" in ln and "_mf_b" in ln]
    rolling = [ln for ln in wins if "avg(" in ln]
    assert len(rolling) == 1 and rolling[0].count("avg(") == 4 and rolling[0].count("stddev_samp(") == 2
    at = next(i for i, ln in enumerate(plan.splitlines()) if ln == rolling[0])
    assert any("Filter (" in ln and "_mf_i#" in ln for ln in plan.splitlines()[at + 1:at + 4])
