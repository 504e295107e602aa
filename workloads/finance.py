"""Finance products and their operators on lineitem, orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from harbormill.functions.temporal import epoch_micros
from harbormill.models import catalog
from harbormill.operators import aggregates, columns, joins, windows
from harbormill.operators.asof import asof_join, asof_scan
from harbormill.plans import finance
from workloads.inputs import CASH_FLOWS, DIVIDENDS, HISTORY, STATEMENTS, StandIn, text
from workloads.registry import stamp, table, whole_sum, workload

YEAR_END = "make_date(year, 12, 31)"
YEARLY_SQL = f"""SELECT symbol, year, {YEAR_END} AS date,
        arg_max(close, struct_pack(d := date, c := close)) FILTER (close IS NOT NULL) AS close
        FROM (SELECT *, year(date) AS year FROM {HISTORY.sql}) GROUP BY symbol, year"""


def _change(column: str, key: str, order: str) -> str:
    """Relative change after forward fill, by the window form of SQL."""
    w = f"PARTITION BY {key} ORDER BY {order}"
    current = f"last_value({column} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = f"last_value({column} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return (
        f"(CASE WHEN {before} <> 0 THEN {current} / {before} WHEN {before} = 0 AND {current} > 0 THEN 'inf'::DOUBLE "
        f"WHEN {before} = 0 AND {current} < 0 THEN '-inf'::DOUBLE END - 1)"
    )


def _finite(c: str) -> str:
    return f"CASE WHEN isinf({c}) OR isnan({c}) THEN NULL ELSE {c} END"


def _exact_mean(condition: str) -> str:
    value = f"CASE WHEN {condition} THEN value END"
    return f"({whole_sum(value)} / nullif(count({value}), 0))"


RETURNS_SQL = f"SELECT *, {_change('close', 'symbol', 'date')} AS annual_return FROM ({YEARLY_SQL})"
NET = _exact_mean("metric = 'net_income'")
REV = _exact_mean("metric = 'total_revenue'")
WIDE_SQL = f"""SELECT * FROM (SELECT symbol, date, {NET} AS net_income, {REV} AS total_revenue FROM {STATEMENTS.sql}
        WHERE metric IN ('net_income', 'total_revenue') GROUP BY symbol, date)
        WHERE net_income IS NOT NULL OR total_revenue IS NOT NULL"""
REPORTED_SQL = f"""SELECT *, {_change('total_revenue', 'symbol', 'date')} AS revenue_growth,
        {_change('net_income', 'symbol', 'date')} AS net_income_growth FROM ({WIDE_SQL})"""
GROWTH_SQL = f"""SELECT h.symbol, {stamp('CAST(h.date AS TIMESTAMP)')} AS date, {_finite('close')} AS close,
        {_finite('annual_return')} AS annual_return, {_finite('net_income')} AS net_income,
        {_finite('total_revenue')} AS total_revenue, {_finite('revenue_growth')} AS revenue_growth,
        {_finite('net_income_growth')} AS net_income_growth
        FROM ({RETURNS_SQL}) h ASOF LEFT JOIN ({REPORTED_SQL}) s ON h.symbol = s.symbol AND CAST(h.date AS TIMESTAMP) >= s.date"""


@workload("growth_asof", "E05 J06 A10 A09 W02 P20", GROWTH_SQL)
def growth_asof(spark, d):
    return finance.growth(HISTORY.df(spark, d), STATEMENTS.df(spark, d))


@workload(
    "yearly_last",
    "A10 F14",
    f"SELECT symbol, {stamp('CAST(date AS TIMESTAMP)')} AS date, close FROM ({YEARLY_SQL})",
)
def yearly_last(spark, d):
    return aggregates.year_end_last(HISTORY.df(spark, d), "symbol", "date", "close")


@workload(
    "pct_change",
    "W02 P20",
    f"""SELECT symbol, {stamp('CAST(date AS TIMESTAMP)')} AS date, close, {_finite('annual_return')} AS annual_return
        FROM ({RETURNS_SQL})""",
)
def pct_change(spark, d):
    from harbormill.functions.numeric import finite

    yearly = aggregates.year_end_last(HISTORY.df(spark, d), "symbol", "date", "close")
    changed = windows.pct_change(yearly, ["symbol"], "date", {"annual_return": "close"})
    return changed.withColumn("annual_return", finite(F.col("annual_return")))


# one key holds a third of the orders: the join must not gather it in one task
HOT_ORDERS = StandIn(
    "orders",
    {
        "key": "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % 100 END",
        "at": "o_orderdate",
        "orderkey": "o_orderkey",
    },
)
SHIPMENTS = StandIn(
    "lineitem",
    {"key": "l_suppkey", "at": "l_shipdate", "price": "l_extendedprice", "quantity": "l_quantity"},
)


HOT_SQL = f"""SELECT o.key, {stamp('o."at"')} AS "at", o.orderkey, s.price, s.quantity FROM {HOT_ORDERS.sql} o
        ASOF LEFT JOIN (SELECT key, "at", max(struct_pack(price := price, quantity := quantity)).price AS price,
            max(struct_pack(price := price, quantity := quantity)).quantity AS quantity FROM {SHIPMENTS.sql}
            GROUP BY key, "at") s ON o.key = s.key AND o."at" >= s."at" """


@workload("asof_hot_key", "J06", HOT_SQL)
def asof_hot_key(spark, d):
    return asof_join(HOT_ORDERS.df(spark, d), SHIPMENTS.df(spark, d), ["key"], "at")


@workload("asof_scan", "J06 W02", HOT_SQL)
def asof_scan_hot_key(spark, d):
    return asof_scan(HOT_ORDERS.df(spark, d), SHIPMENTS.df(spark, d), ["key"], "at", 32)


SUSTAIN_SQL = f"""WITH paid AS (SELECT bank, year(payment_date) AS year,
            coalesce(CAST(sum(CAST(dividend_per_share AS DECIMAL(38,8))) AS DOUBLE), 0.0) AS dividend_per_share
            FROM {DIVIDENDS.sql} GROUP BY 1, 2),
        cash AS (SELECT symbol, year(date) AS year,
            coalesce(CAST(sum(CAST(value AS DECIMAL(38,8))) AS DOUBLE), 0.0) AS operating_cash_flow_thousands
            FROM {CASH_FLOWS.sql} WHERE metric = 'operating_cash_flow' GROUP BY 1, 2),
        both_sides AS (SELECT paid.*, operating_cash_flow_thousands FROM paid JOIN (SELECT *, CASE symbol
            WHEN 'ANZ.AX' THEN 'ANZ' WHEN 'MQG.AX' THEN 'Macquarie' WHEN 'WBC.AX' THEN 'Westpac' ELSE symbol END AS bank
            FROM cash) c ON paid.bank = c.bank AND paid.year = c.year),
        trends AS (SELECT *, {_change('dividend_per_share', 'bank', 'year')} AS dividend_yield_trend,
            {_change('operating_cash_flow_thousands', 'bank', 'year')} AS ocf_trend FROM both_sides),
        gaps AS (SELECT *, CASE WHEN isnan(dividend_yield_trend - ocf_trend) THEN NULL
            ELSE dividend_yield_trend - ocf_trend END AS gap FROM trends)
        SELECT bank, year, dividend_per_share, operating_cash_flow_thousands,
            {_finite('dividend_yield_trend')} AS dividend_yield_trend, {_finite('ocf_trend')} AS ocf_trend,
            {_finite('gap')} AS dividend_growth_vs_ocf_growth,
            CASE WHEN gap > 0.1 THEN 'GROWING FASTER THAN OCF' WHEN gap > 0 THEN 'MODERATE GROWTH'
            ELSE 'CONSERVATIVE GROWTH' END AS sustainability_flag FROM gaps"""


@workload("dividend_sustainability", "E06 A11 J08 J02 W02 P06 P20 F14", SUSTAIN_SQL)
def dividend_sustainability(spark, d):
    return finance.sustainability_trends(DIVIDENDS.df(spark, d), CASH_FLOWS.df(spark, d))


@workload(
    "sustainability_published",
    "E06 P01 A11",
    f"""SELECT * REPLACE (CAST(TRY_CAST(dividend_per_share AS DECIMAL(4,2)) AS DOUBLE) AS dividend_per_share,
        CAST(year AS BIGINT) AS year), avg(CASE WHEN TRY_CAST(dividend_per_share AS DECIMAL(4,2)) IS NULL THEN 1.0 ELSE 0.0 END)
        OVER () AS null_share FROM ({SUSTAIN_SQL})""",
)
def sustainability_published(spark, d):
    """The published model with its decimals, beside the share of amounts that did not fit them."""
    published = finance.dividend_sustainability(DIVIDENDS.df(spark, d), CASH_FLOWS.df(spark, d))
    share = published.agg(F.avg(F.col("dividend_per_share").isNull().cast("double"))).scalar()
    return published.withColumn("null_share", share)


@workload(
    "metric_pivot",
    "A09",
    f"SELECT symbol, {stamp('date')} AS date, net_income, total_revenue FROM ({WIDE_SQL})",
)
def metric_pivot(spark, d):
    return aggregates.pivot_mean(
        STATEMENTS.df(spark, d), ["symbol", "date"], "metric", "value", finance.GROWTH_METRICS
    )


@workload(
    "type_pivot",
    "A08",
    """SELECT l_suppkey, max(l_extendedprice) FILTER (l_returnflag = 'A') AS a,
        max(l_extendedprice) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1""",
)
def type_pivot(spark, d):
    rows = table(spark, d, "lineitem")
    return aggregates.pivot_by_type(
        rows, ["l_suppkey"], "l_returnflag", "l_extendedprice", {"a": "A", "r": "R"}, "decimal(12,2)"
    )


# wide statements: one row per order and metric name, one column per period
WIDE_STATEMENTS = StandIn(
    "orders",
    {
        "metric": "CASE o_orderkey % 6 WHEN 0 THEN 'TotalRevenue' WHEN 1 THEN 'NormalizedEBITDA' WHEN 2 THEN 'NetPPE' "
        "WHEN 3 THEN 'DilutedEPS' WHEN 4 THEN 'EBIT' ELSE 'DilutedNIAvailtoComStockholders' END",
        "symbol": text("o_orderkey"),
        "2023-06-30": "o_totalprice",
        "2024-06-30": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice * 2 END",
    },
)
_names = (
    "CASE metric WHEN 'TotalRevenue' THEN 'total_revenue' WHEN 'NormalizedEBITDA' THEN 'normalized_ebitda' "
    "WHEN 'NetPPE' THEN 'net_ppe' WHEN 'DilutedEPS' THEN 'diluted_eps' WHEN 'EBIT' THEN 'ebit' "
    "ELSE 'diluted_ni_availto_com_stockholders' END"
)


@workload(
    "melt_statements",
    "E13 P16 F11 P01",
    f"""SELECT {_names} AS metric, '2023-06-30 00:00:00.000000' AS date, "2023-06-30" AS value, symbol
        FROM {WIDE_STATEMENTS.sql} UNION ALL SELECT {_names}, '2024-06-30 00:00:00.000000', "2024-06-30", symbol
        FROM {WIDE_STATEMENTS.sql}""",
)
def melt_statements(spark, d):
    acronyms = (*finance.INCOME_ACRONYMS, *finance.BALANCE_ACRONYMS)
    return finance.statements_long(WIDE_STATEMENTS.df(spark, d), ["2023-06-30", "2024-06-30"], acronyms)


_panel = {"Open": "o_totalprice", "High": "o_totalprice + 2", "Low": "o_totalprice - 1", "Close": "o_totalprice + 1"}
_panel |= {"Volume": "o_custkey", "Dividends": "0.5", "Stock Splits": "0.0"}
PANEL = StandIn(
    "orders",
    {"Date": "o_orderdate"}
    | {f"{m}_X": e for m, e in _panel.items()}
    | {f"{m}_Y": "o_orderkey" if m == "Volume" else "o_totalprice * 3" for m in _panel},
)


@workload(
    "price_panel_long",
    "E14 P17",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS symbol, {stamp('"Date"')} AS date, "Open_{t}" AS open, "High_{t}" AS high, "Low_{t}" AS low,
        "Close_{t}" AS close, "Volume_{t}" AS volume, CAST("Dividends_{t}" AS DOUBLE) AS dividends,
        CAST("Stock Splits_{t}" AS DOUBLE) AS stock_splits FROM {PANEL.sql}"""
        for t in "XY"
    ),
)
def price_panel_long(spark, d):
    return finance.price_history(PANEL.df(spark, d), "Date", ["X", "Y"])


# --- dividends ----------------------------------------------------------------

BANK_A = StandIn(
    "orders",
    {
        "pay_date": f"'Paid ' || {text('1 + o_orderkey % 28')} || '/0' || {text('1 + o_custkey % 9')} || '/2024 (final)'",
        "dividend": f"{text('o_custkey % 90')} || '.5 cents'",
    },
)
BANK_B = StandIn(
    "orders",
    {
        "payment_date": f"{text('1 + o_orderkey % 28')} || '/0' || {text('1 + o_custkey % 9')} || '/2023'",
        "dividend_per_share": f"{text('o_custkey % 300')}",
    },
)
BANK_C = StandIn(
    "events",
    {
        "payment_date": "CASE WHEN event_id % 25 = 0 THEN '1H20' ELSE "
        f"lpad({text('1 + event_id % 29')}, 2, '0') || '/01/2024' END",
        "rate": f"CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE {text('event_id % 400')} || '.25c' END",
    },
)


def landed_rates(spark, d):
    """Daily rate documents: one per working day of the events, with an array of one point."""
    daily = (
        table(spark, d, "events")
        .where("weekday(ts) < 5")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    midnight = epoch_micros(F.col("day").cast("timestamp_ntz"))
    point = F.struct(
        (midnight / 1000).cast("bigint").alias("PointInTime"),
        (F.col("n") % 100 / 64 + 1).alias("InterbankRate"),
    )
    return daily.select(F.array(point).alias("historicalPoints"))


FX_SQL = """SELECT CAST(ts AS DATE) AS payment_date, CAST(count(*) % 100 / 64 + 1 AS DECIMAL(12,6)) AS interbank_rate
        FROM events WHERE isodow(ts) < 6 GROUP BY 1"""


@workload(
    "fx_left_join",
    "J03 F22 F13",
    f"""SELECT CAST(e.day AS VARCHAR) AS payment_date, CAST(round(amount * interbank_rate, 2) AS DOUBLE) AS converted,
        event_id FROM (SELECT event_id, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(12,2)) AS amount FROM events) e
        LEFT JOIN ({FX_SQL}) f ON e.day = f.payment_date""",
)
def fx_left_join(spark, d):
    rates = finance.exchange_rates(landed_rates(spark, d))
    facts = table(spark, d, "events").select(
        F.to_date("ts").alias("payment_date"), "event_id", F.col("value").cast("decimal(12,2)").alias("amount")
    )
    return joins.convert_by_date(facts, rates, "payment_date", "amount", "interbank_rate", "converted").drop("amount")


@workload(
    "dividends",
    "E07 N08 F01 F02 F12 F13 F21 F22 J03 U01",
    f"""SELECT 'ANZ' AS bank, CAST(strptime(regexp_extract(pay_date, '\\d{{1,2}}/\\d{{2}}/\\d{{4}}'), '%d/%m/%Y') AS DATE)::VARCHAR
        AS payment_date, CAST(round(CAST(regexp_extract(dividend, '[0-9]+(\\.[0-9]+)?') AS DECIMAL(14,4)) * 0.01::DECIMAL(3,2), 2) AS DOUBLE) AS dividend_per_share FROM {BANK_A.sql}
        UNION ALL SELECT 'Macquarie', CAST(strptime(payment_date, '%d/%m/%Y') AS DATE)::VARCHAR,
        CAST(dividend_per_share AS DOUBLE)/100 FROM {BANK_B.sql}
        UNION ALL SELECT 'Westpac', CAST(r.day AS VARCHAR), CAST(round(r.rate * f.interbank_rate, 2) AS DOUBLE) FROM (
        SELECT CAST(strptime(payment_date, '%d/%m/%Y') AS DATE) AS day,
        CAST(TRY_CAST(nullif(regexp_extract(rate, '[0-9.]+'), '') AS DECIMAL(6,2)) * 0.01::DECIMAL(3,2) AS DECIMAL(9,4)) AS rate
        FROM {BANK_C.sql} WHERE payment_date <> '1H20') r LEFT JOIN ({FX_SQL}) f ON r.day = f.payment_date""",
)
def dividends(spark, d):
    rates = finance.exchange_rates(landed_rates(spark, d))
    return finance.dividends(BANK_A.df(spark, d), BANK_C.df(spark, d), BANK_B.df(spark, d), rates)


@workload(
    "code_mapping",
    "J08",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status
        FROM orders""",
)
def code_mapping(spark, d):
    codes = {"F": "filled", "O": "open"}
    return table(spark, d, "orders").select("o_orderkey", joins.map_codes(F.col("o_orderstatus"), codes).alias("status"))


@workload(
    "conform_overflow",
    "P01 K13",
    """SELECT CASE WHEN o_totalprice < 99.995 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS dividend_per_share,
        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS payment_date, o_orderpriority AS bank FROM orders""",
)
def conform_overflow(spark, d):
    rows = table(spark, d, "orders").selectExpr(
        "o_orderpriority AS bank", "o_orderdate AS payment_date", "o_totalprice AS dividend_per_share"
    )
    return columns.conform(rows, catalog.DIVIDENDS, safe=True)
