"""SQL building blocks of the oracles (DuckDB dialect).

The bindings here are the SQL twins of ``marketframe.sources.bindings``;
the indicator CTEs compute pandas' rolling/ewm semantics in plain SQL (EWM
by a self-join over the series) so that the Spark results are checked
against an independent formulation.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..operators.indicators import INDICATOR_COLUMNS

FETCH_BATCH = "20240131_000000"


def r4(x: str) -> str:
    """Comparison rounding, identical IEEE steps on both engines. The 1e-6
    (of the last place) nudge settles exact decimal ties - frequent when
    2-decimal prices are averaged - the same way on both engines, whatever
    their last-bit differences."""
    return f"floor(({x}) * 10000.0::DOUBLE + 0.500001::DOUBLE) / 10000.0::DOUBLE"


def r6(x: str) -> str:
    """As ``r4`` to 6 places, for returns and volatilities, which are small."""
    return f"floor(({x}) * 1000000.0::DOUBLE + 0.500001::DOUBLE) / 1000000.0::DOUBLE"


def rnd(x: str, n: int = 2) -> str:
    """numpy's round: rint(x * 10^n) / 10^n with ties to even."""
    y = f"(({x}) * {float(10 ** n)!r}::DOUBLE)"
    return (f"((CASE WHEN {y} - floor({y}) = 0.5 THEN CASE WHEN floor({y}) % 2 = 0 THEN floor({y}) "
            f"ELSE floor({y}) + 1 END ELSE floor({y} + 0.5) END) / {float(10 ** n)!r}::DOUBLE)")


B1 = """SELECT event_type AS symbol, CAST(ts AS DATE) AS date,
  arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume
FROM events GROUP BY 1, 2"""

B2 = """SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
  arg_min(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_extendedprice, l_quantity)) AS open,
  max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
  arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_extendedprice, l_quantity)) AS close,
  sum(l_quantity) AS volume
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""

B3 = """SELECT b.symbol, b.close AS current_price, b.high AS high_price, b.low AS low_price,
  b.open AS open_price, p.close AS previous_close, b.close - p.close AS change,
  (b.close - p.close) / nullif(p.close, 0) * 100 AS change_percent,
  CAST(b.date AS TIMESTAMP) AS timestamp, strftime(b.date, '%Y%m%d') || '_000000' AS batch_id
FROM b1 b LEFT JOIN b1 p ON p.symbol = b.symbol AND p.date + 1 = b.date"""

B4 = """SELECT *, '20240131_000000' AS batch_id FROM (
  SELECT symbol, date, open, high, low,
    CASE WHEN day(date) % 7 <> 3 THEN close END AS close,
    CASE WHEN day(date) % 7 <> 3 THEN volume END AS volume FROM b1
  UNION ALL
  SELECT symbol, date, open, high, low,
    CASE WHEN day(date) % 7 <> 3 THEN close END AS close,
    CASE WHEN day(date) % 7 <> 3 THEN volume END AS volume FROM b1 WHERE day(date) IN (5, 6))"""

B7 = """SELECT * EXCLUDE (l_orderkey) FROM (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'HOT' ELSE 'S' || (l_suppkey % 50) END AS symbol,
    CASE WHEN l_linenumber % 3 <> 2 THEN l_extendedprice / l_quantity END AS current_price,
    CASE WHEN l_linenumber % 4 <> 1 THEN l_extendedprice / 30 END AS previous_close,
    CASE WHEN l_orderkey % 5 <> 1 THEN l_tax END AS change, l_shipdate AS timestamp,
    strftime(l_shipdate, '%Y%m') || '01_000000' AS batch_id, l_orderkey FROM lineitem
  UNION ALL
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'HOT' ELSE 'S' || (l_suppkey % 50) END,
    CASE WHEN l_linenumber % 3 <> 2 THEN l_extendedprice / l_quantity END,
    CASE WHEN l_linenumber % 4 <> 1 THEN l_extendedprice / 30 END,
    CASE WHEN l_orderkey % 5 <> 1 THEN l_tax END, l_shipdate,
    strftime(l_shipdate, '%Y%m') || '01_000000', l_orderkey FROM lineitem WHERE l_orderkey % 10 = 0)"""

B8 = """SELECT symbol, date, open, high, low, CASE WHEN day(date) % 7 <> 3 THEN close END AS close,
    CASE WHEN day(date) % 5 <> 2 THEN volume END AS volume, strftime(date, '%Y') || '1231_000000' AS batch_id
  FROM (SELECT * FROM b2 UNION ALL SELECT * FROM b2 WHERE day(date) IN (5, 6))"""

# processed quotes of B7: duplicates, price fill per (batch, symbol) by time (ties by the other
# columns, nulls first), median of the rest per batch, change % and sentiment.
_QF = ("(PARTITION BY batch_id, symbol ORDER BY timestamp, current_price NULLS FIRST, previous_close NULLS FIRST, "
       "change NULLS FIRST ROWS BETWEEN {0})")
CLEAN_LINES = f"""cl0 AS (SELECT * REPLACE (coalesce(current_price,
    last_value(current_price IGNORE NULLS) OVER {_QF.format('UNBOUNDED PRECEDING AND CURRENT ROW')},
    first_value(current_price IGNORE NULLS) OVER {_QF.format('CURRENT ROW AND UNBOUNDED FOLLOWING')}) AS current_price)
  FROM (SELECT DISTINCT * FROM b7)),
clm AS (SELECT batch_id, median(previous_close) AS mp, median(change) AS mc FROM cl0 GROUP BY 1),
cl1 AS (SELECT cl0.* REPLACE (coalesce(previous_close, mp) AS previous_close, coalesce(change, mc) AS change) FROM cl0 JOIN clm USING (batch_id)),
cl2 AS (SELECT *, (current_price - previous_close) / nullif(previous_close, 0) * 100 AS change_percent_calc FROM cl1),
cl AS (SELECT *, CASE WHEN change_percent_calc > 2 THEN 'Strong Bullish'
    WHEN change_percent_calc > 0 THEN 'Bullish' WHEN change_percent_calc > -2 THEN 'Bearish'
    WHEN change_percent_calc IS NOT NULL THEN 'Strong Bearish' END AS sentiment FROM cl2)"""

B6 = """SELECT event_type AS service,
  ['status', 'message', 'timestamp', 'files'][CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 + 1] AS field,
  printf('%.2f', value) AS value, ts, event_id AS seq FROM events"""

# processed quotes: price fill is a no-op on B3 (prices never null), median
# fill per batch of the other numeric columns, then change % and sentiment.
CLEAN_QUOTES = """cq0 AS (SELECT * REPLACE (
    coalesce(previous_close, median(previous_close) OVER (PARTITION BY batch_id)) AS previous_close,
    coalesce(change, median(change) OVER (PARTITION BY batch_id)) AS change,
    coalesce(change_percent, median(change_percent) OVER (PARTITION BY batch_id)) AS change_percent)
  FROM (SELECT DISTINCT * FROM b3)),
cq1 AS (SELECT *, (current_price - previous_close) / nullif(previous_close, 0) * 100 AS change_percent_calc FROM cq0),
cq AS (SELECT *, CASE WHEN change_percent_calc > 2 THEN 'Strong Bullish'
    WHEN change_percent_calc > 0 THEN 'Bullish' WHEN change_percent_calc > -2 THEN 'Bearish'
    WHEN change_percent_calc IS NOT NULL THEN 'Strong Bearish' END AS sentiment FROM cq1)"""


def ewm_d(span: float) -> str:
    return repr(1.0 - 2.0 / (span + 1.0))


def indicator_ctes(src: str, out: str, keys: Sequence[str] = ("symbol",), price: str = "close",
                   gate: str | None = None, order: str = "date", reach: int | None = None) -> str:
    """CTEs ending in ``out`` = src columns + the 13 indicator columns. ``reach`` bounds the
    rows that the EWM self-joins look back, for a series too long to join whole."""
    near = "" if reach is None else f" AND b.i > a.i - {reach}"
    K = ", ".join(keys)
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    ak = ", ".join(f"a.{k}" for k in keys)
    p = out

    def W(n):
        return f"(PARTITION BY {K} ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    def roll(agg, x, n):
        return f"CASE WHEN count({x}) OVER {W(n)} = {n} THEN {agg}({x}) OVER {W(n)} END"

    def ewm(x, span, tbl):
        d = ewm_d(span)
        return (f"sum(b.{x} * pow({d}, a.i - b.i)) / "
                f"sum(CASE WHEN b.{x} IS NOT NULL THEN pow({d}, a.i - b.i) END)")
    g = (lambda e: f"CASE WHEN {gate} THEN {e} END") if gate else (lambda e: e)
    jk = " AND ".join(f"x.{k} = m.{k}" for k in keys)
    jk2 = " AND ".join(f"x.{k} = s.{k}" for k in keys)
    return f"""{p}0 AS (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY {order}) - 1 AS i FROM {src}),
{p}1 AS (SELECT *, {price} - lag({price}) OVER (PARTITION BY {K} ORDER BY i) AS _delta,
    {price} / nullif(lag({price}) OVER (PARTITION BY {K} ORDER BY i), 0) - 1 AS daily_return FROM {p}0),
{p}2 AS (SELECT *, CASE WHEN _delta > 0 THEN _delta ELSE 0.0 END AS _gain,
    CASE WHEN _delta < 0 THEN -_delta ELSE 0.0 END AS _loss FROM {p}1),
{p}3 AS (SELECT *, {roll('avg', price, 5)} AS sma_5, {roll('avg', price, 20)} AS sma_20,
    {roll('avg', '_gain', 14)} AS _gm, {roll('avg', '_loss', 14)} AS _lm,
    {roll('avg', price, 20)} AS bb_middle, {roll('stddev_samp', price, 20)} AS _sd,
    {roll('stddev_samp', 'daily_return', 20)} AS volatility FROM {p}2),
{p}e AS (SELECT {ak}, a.i, {ewm(price, 12, p)} AS ema_12, {ewm(price, 26, p)} AS ema_26
    FROM {p}0 a JOIN {p}0 b ON {on} AND b.i <= a.i{near} GROUP BY {ak}, a.i),
{p}m AS (SELECT *, ema_12 - ema_26 AS macd FROM {p}e),
{p}s AS (SELECT {ak}, a.i, {ewm('macd', 9, p)} AS macd_signal
    FROM {p}m a JOIN {p}m b ON {on} AND b.i <= a.i{near} GROUP BY {ak}, a.i),
{p} AS (SELECT x.* EXCLUDE (i, _delta, _gain, _loss, _gm, _lm, _sd, sma_5, sma_20, bb_middle, daily_return, volatility),
    {g('x.sma_5')} AS sma_5, {g('x.sma_20')} AS sma_20, {g('m.ema_12')} AS ema_12, {g('m.ema_26')} AS ema_26,
    {g('m.macd')} AS macd, {g('s.macd_signal')} AS macd_signal, {g('m.macd - s.macd_signal')} AS macd_histogram,
    {g('CASE WHEN _lm = 0 THEN CASE WHEN _gm > 0 THEN 100.0 END ELSE 100.0 - 100.0 / (1.0 + _gm / _lm) END')} AS rsi,
    {g('x.bb_middle')} AS bb_middle, {g('x.bb_middle + x._sd * 2.0')} AS bb_upper,
    {g('x.bb_middle - x._sd * 2.0')} AS bb_lower, {g('x.daily_return')} AS daily_return,
    {g('x.volatility')} AS volatility
  FROM {p}3 x JOIN {p}m m ON {jk} AND x.i = m.i JOIN {p}s s ON {jk2} AND x.i = s.i)"""


INDICATORS = INDICATOR_COLUMNS


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def cte(name: str, sql: str) -> str:
    return f"{name} AS ({sql})"


# processed bars of B4: dedup, price fill per (batch, symbol) by date,
# median fill of volume per batch, 13 indicators.
def clean_bars_ctes(src: str = "b4", out: str = "cb") -> list[str]:
    wf = "(PARTITION BY batch_id, symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    wb = "(PARTITION BY batch_id, symbol ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    fills = ", ".join(f"coalesce({c}, last_value({c} IGNORE NULLS) OVER {wf}, first_value({c} IGNORE NULLS) OVER {wb}) AS {c}"
                      for c in ("open", "high", "low", "close"))
    return [
        cte(f"{out}_d", f"SELECT DISTINCT * FROM {src}"),
        cte(f"{out}_f", f"SELECT batch_id, symbol, date, {fills}, volume FROM {out}_d"),
        cte(f"{out}_m", f"SELECT * REPLACE (coalesce(volume, median(volume) OVER (PARTITION BY batch_id)) AS volume) FROM {out}_f"),
        indicator_ctes(f"{out}_m", out, ("batch_id", "symbol")),
    ]
