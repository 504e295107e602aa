"""Joins, sets, windows, rankings and column functions on the plain tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from harbormill.functions import nested, numeric, temporal
from harbormill.functions import text as texts
from harbormill.lookups import queries as lookups
from harbormill.operators import aggregates, columns, exact, joins, ranking, sets, windows
from harbormill.plans import trips
from harbormill.sources.tables import sample_model
from workloads.inputs import CASH_FLOWS, HISTORY, STATEMENTS
from workloads.finance import GROWTH_SQL, SUSTAIN_SQL, growth_asof
from workloads.finance import dividend_sustainability as sustainability
from workloads.registry import half_even, half_up, stamp, table, whole_sum, workload

# --- joins --------------------------------------------------------------------


@workload(
    "enriched_totals",
    "J01 A01 P07",
    """SELECT c_custkey, c_name, coalesce(n, 0) AS n, coalesce(total, 0.0) AS total FROM customer LEFT JOIN (
        SELECT o_custkey AS c_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders
        WHERE o_orderdate < TIMESTAMP '1995-06-01' GROUP BY 1) USING (c_custkey)""",
)
def enriched_totals(spark, d):
    facts = table(spark, d, "orders").where("o_orderdate < TIMESTAMP_NTZ '1995-06-01'").withColumnRenamed("o_custkey", "c_custkey")
    totals = {"n": F.count(F.lit(1)), "total": F.sum(numeric.money(F.col("o_totalprice")))}
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    return joins.enrich_with_totals(customers, facts, "c_custkey", totals, {"n": 0, "total": 0})


@workload(
    "two_key_join",
    "J02",
    """SELECT k, year, a, b FROM (SELECT o_custkey % 20 AS k, year(o_orderdate) AS year, count(*) AS a FROM orders GROUP BY 1, 2)
        JOIN (SELECT l_suppkey % 30 AS k, year(l_shipdate) AS year, count(*) AS b FROM lineitem GROUP BY 1, 2) USING (k, year)""",
)
def two_key_join(spark, d):
    left = table(spark, d, "orders").groupBy((F.col("o_custkey") % 20).alias("k"), F.year("o_orderdate").alias("year"))
    right = table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 30).alias("k"), F.year("l_shipdate").alias("year"))
    return left.agg(F.count(F.lit(1)).alias("a")).join(right.agg(F.count(F.lit(1)).alias("b")), ["k", "year"])


@workload(
    "inactive_with_orders",
    "J05",
    """SELECT count(DISTINCT c_custkey) AS parents, count(o_orderkey) AS children FROM customer JOIN orders ON c_custkey = o_custkey
        WHERE c_mktsegment = 'MACHINERY'""",
)
def inactive_with_orders(spark, d):
    parents = table(spark, d, "customer").where("c_mktsegment = 'MACHINERY'").withColumnRenamed("c_custkey", "k")
    return joins.children_of(parents, table(spark, d, "orders").withColumnRenamed("o_custkey", "k"), "k")


@workload(
    "dimension_reach",
    "J09",
    """SELECT n_name, count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation
        ON c_nationkey = n_nationkey GROUP BY 1""",
)
def dimension_reach(spark, d):
    per_customer = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    customers = joins.one_row_per_key(table(spark, d, "customer"), "c_custkey", ["c_nationkey"])
    per_nation = per_customer.join(customers, "c_custkey", "left").groupBy(F.col("c_nationkey").alias("n_nationkey"))
    nations = joins.one_row_per_key(table(spark, d, "nation"), "n_nationkey", ["n_name"])
    counted = per_nation.agg(F.sum("n").alias("n")).join(nations, "n_nationkey", "left")
    return counted.groupBy("n_name").agg(F.sum("n").alias("n"))


@workload(
    "skip_processed",
    "J10",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders
        WHERE o_orderdate < TIMESTAMP '1996-01-01')""",
)
def skip_processed(spark, d):
    done = table(spark, d, "orders").where("o_orderdate < TIMESTAMP_NTZ '1996-01-01'").withColumnRenamed("o_custkey", "c_custkey")
    return joins.not_yet_done(table(spark, d, "customer").select("c_custkey", "c_name"), done, ["c_custkey"])


# --- windows and aggregates ---------------------------------------------------

LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@workload(
    "first_seen",
    "W04",
    f"""SELECT {LINE}, {stamp('l_shipdate')} AS l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
        ORDER BY l_shipdate, {LINE}) AS rn FROM lineitem) WHERE rn = 1""",
)
def first_seen(spark, d):
    return windows.first_seen(table(spark, d, "lineitem"), "l_partkey", [F.col("l_shipdate")])


@workload(
    "distinct_rows",
    "W05 U05",
    "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_discount FROM lineitem",
)
def distinct_rows(spark, d):
    return table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_discount").distinct()


@workload(
    "tier_lead",
    "W01",
    """SELECT p_brand, CAST(p_size AS BIGINT) AS p_size, CAST(lead(p_size) OVER (PARTITION BY p_brand ORDER BY p_size) AS BIGINT) AS next_size
        FROM (SELECT DISTINCT p_brand, p_size FROM part)""",
)
def tier_lead(spark, d):
    tiers = table(spark, d, "part").select("p_brand", "p_size").distinct()
    return windows.next_tier(tiers, ["p_brand"], "p_size", "next_size")


@workload(
    "global_totals",
    "A13 A16",
    f"""SELECT count(*) AS total, count(*) FILTER (l_discount > 0.05) AS discounted,
        {half_even('100*count(*) FILTER (l_discount > 0.05)', 'count(*)', 2)} AS pct, {stamp('max(l_shipdate)')} AS newest FROM lineitem""",
)
def global_totals(spark, d):
    hit = aggregates.count_where(F.col("l_discount") > 0.05)
    total = F.count(F.lit(1))
    return table(spark, d, "lineitem").agg(
        total.alias("total"), hit.alias("discounted"), numeric.percent(hit, total).alias("pct"), F.max("l_shipdate").alias("newest")
    )


@workload(
    "grouped_measures",
    "A01 A02 A06",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(38,8))) AS DOUBLE) AS price,
        CAST(sum(CAST(l_quantity AS DECIMAL(38,8))) AS DOUBLE) / count(l_quantity) AS quantity,
        count(*) FILTER (l_linestatus IN ('F')) AS filled, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1, 2""",
)
def grouped_measures(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        aggregates.exact_sum(F.col("l_extendedprice")).alias("price"),
        aggregates.exact_mean(F.col("l_quantity")).alias("quantity"),
        aggregates.count_where(F.col("l_linestatus").isin("F")).alias("filled"),
        F.count_distinct("l_suppkey").alias("suppliers"),
    )


@workload(
    "rates_and_costs",
    "A03 A04 F19 F20",
    f"""SELECT l_suppkey, {half_up("count(*) FILTER (l_returnflag = 'R')", 'count(*)', 4)} AS rate,
        coalesce({half_up("sum(CAST(round(l_extendedprice*100) AS BIGINT))", "100*count(*) FILTER (l_returnflag = 'R')", 2)}, 0.0) AS cost
        FROM lineitem GROUP BY 1""",
)
def rates_and_costs(spark, d):
    returned = F.col("l_returnflag") == "R"
    price = F.sum(numeric.money(F.col("l_extendedprice")))
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        aggregates.share_where(returned).alias("rate"),
        aggregates.cost_per(price, aggregates.count_where(returned)).alias("cost"),
    )


@workload("yearly_sum", "A11 F14",
    """SELECT symbol, year(date) AS year, coalesce(CAST(sum(CAST(value AS DECIMAL(38,8))) AS DOUBLE), 0.0) AS value FROM (
        SELECT 'S' || l_suppkey AS symbol, l_shipdate AS date, CASE WHEN l_suppkey % 5 > 0 THEN l_extendedprice END AS value FROM lineitem) GROUP BY 1, 2""",
)
def yearly_sum(spark, d):
    rows = table(spark, d, "lineitem").selectExpr(
        "'S' || CAST(l_suppkey AS STRING) AS symbol",
        "l_shipdate AS date",
        "CASE WHEN l_suppkey % 5 > 0 THEN l_extendedprice END AS value",
    )
    return aggregates.yearly_sum(rows, "symbol", "date", "value")


TAXED = "l_extendedprice * (l_tax - CAST(0.04 AS DOUBLE)) / 7"
SHARES = "l_tax / (l_extendedprice * 1000)"


@workload(
    "sums_of_doubles",
    "A02 A11 M03",
    f"""SELECT l_suppkey, {whole_sum(TAXED)} AS taxed, count({TAXED}) AS taxed_n, {whole_sum(SHARES, 34)} AS shares, count({SHARES}) AS shares_n
        FROM lineitem GROUP BY 1""",
)
def sums_of_doubles(spark, d):
    # values of 17 digits and both signs; shares of some 1e-10, whose digits reach beyond the 25th decimal
    return exact.exact_totals(table(spark, d, "lineitem"), ["l_suppkey"], {"taxed": F.expr(TAXED), "shares": F.expr(SHARES)})


@workload("value_set", "A15 U05", "SELECT DISTINCT p_type FROM part")
def value_set(spark, d):
    return aggregates.value_set(table(spark, d, "part"), "p_type")


@workload(
    "melt_metrics",
    "P16",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS metric, {c} AS value FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)
def melt_metrics(spark, d):
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return columns.melt(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], measures)


@workload(
    "trip_metrics",
    "E22 A01",
    """SELECT pickup_zip, count(*) AS trip_count, CAST(sum(CAST(fare AS DECIMAL(38,8))) AS DOUBLE) / count(fare) AS avg_fare
        FROM (SELECT 'Z' || user_id AS pickup_zip, value AS fare FROM events) GROUP BY 1""",
)
def trip_metrics(spark, d):
    rides = table(spark, d, "events").selectExpr("'Z' || CAST(user_id AS STRING) AS pickup_zip", "value AS fare")
    return trips.trip_metrics(rides)


@workload(
    "run_summary",
    "E22",
    """SELECT event_type AS pipeline, CASE WHEN bool_and(value < 120) THEN 'success' ELSE 'failed' END AS status,
        count(*) AS rows_processed FROM events GROUP BY 1""",
)
def run_summary(spark, d):
    return trips.pipeline_summary(table(spark, d, "events").selectExpr("event_type AS pipeline", "value < 120 AS ok"))


# --- sets ---------------------------------------------------------------------


@workload(
    "union_provider",
    "U01 U02 P03",
    "SELECT s_name AS name, 'supplier' AS provider FROM supplier UNION ALL SELECT c_name, 'customer' FROM customer",
)
def union_provider(spark, d):
    parts = {
        "supplier": table(spark, d, "supplier").select(F.col("s_name").alias("name")),
        "customer": table(spark, d, "customer").select(F.col("c_name").alias("name")),
    }
    return sets.union_tagged(parts, "provider")


@workload(
    "union_lists",
    "U03",
    "SELECT p_partkey AS k, p_name AS n FROM part UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def union_lists(spark, d):
    parts = [
        table(spark, d, "part").selectExpr("p_partkey AS k", "p_name AS n"),
        table(spark, d, "supplier").selectExpr("s_suppkey AS k", "s_name AS n"),
    ]
    return sets.union_conformed(parts)


@workload(
    "except_values",
    "U04",
    "SELECT DISTINCT p_type FROM part WHERE p_type NOT IN ('SMALL', 'LARGE', 'ECONOMY')",
)
def except_values(spark, d):
    return sets.unexpected_values(table(spark, d, "part"), "p_type", ["SMALL", "LARGE", "ECONOMY"])


@workload(
    "row_difference",
    "U04",
    "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'",
)
def row_difference(spark, d):
    orders = table(spark, d, "orders")
    return sets.difference(
        orders.where("o_orderstatus = 'F'").selectExpr("o_custkey AS k"),
        orders.where("o_orderstatus = 'P'").selectExpr("o_custkey AS k"),
    )


@workload(
    "required_columns",
    "U06",
    "SELECT 'l_vat' AS missing, count(*) AS n FROM lineitem",
)
def required_columns(spark, d):
    rows = table(spark, d, "lineitem")
    absent = sets.missing_columns(rows, ["l_orderkey", "l_vat", "l_tax"])
    return rows.agg(F.count(F.lit(1)).alias("n")).withColumn("missing", F.lit(",".join(absent)))


# --- ranking and lookups ------------------------------------------------------


@workload(
    "multi_key_sort",
    "O01",
    "SELECT c_nationkey, c_mktsegment, c_custkey FROM customer ORDER BY 1, 2, 3",
)
def multi_key_sort(spark, d):
    return table(spark, d, "customer").select("c_nationkey", "c_mktsegment", "c_custkey").orderBy(
        "c_nationkey", "c_mktsegment", "c_custkey"
    )


@workload(
    "newest_orders",
    "O03",
    f"SELECT o_orderkey, {stamp('o_orderdate')} AS o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey",
)
def newest_orders(spark, d):
    return ranking.newest_first(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", ["o_orderkey"])


REVENUE_SQL = "metric = 'operating_cash_flow' AND date >= TIMESTAMP '{y}-01-01' AND date < TIMESTAMP '{z}-01-01'"


@workload(
    "top_revenue",
    "R05 O02 F14 S13",
    f"""SELECT symbol, 1997 AS year, value AS revenue FROM {CASH_FLOWS.sql} WHERE {REVENUE_SQL.format(y=1997, z=1998)}""",
)
def top_revenue(spark, d):
    return lookups.top_revenue(CASH_FLOWS.df(spark, d), 1997)


@workload(
    "revenue_of_company",
    "R04 O04 P09",
    f"""SELECT symbol, 1996 AS year, value AS revenue FROM {CASH_FLOWS.sql} WHERE {REVENUE_SQL.format(y=1996, z=1997)}
        AND symbol ILIKE '%wbc%' ORDER BY date DESC, symbol DESC, value DESC LIMIT 1""",
)
def revenue_of_company(spark, d):
    return lookups.revenue_of(CASH_FLOWS.df(spark, d), "wbc", 1996)


@workload("revenue_of_nobody", "R04 O04", "SELECT 'nobody' AS symbol, 1996 AS year, CAST(NULL AS DOUBLE) AS revenue FROM lineitem LIMIT 1")
def revenue_of_nobody(spark, d):
    return lookups.revenue_of(CASH_FLOWS.df(spark, d), "nobody", 1996)


@workload("lookup_growth", "R02 O03 P09", f"SELECT * FROM ({GROWTH_SQL}) WHERE symbol ILIKE '%s1%' ORDER BY date DESC, symbol LIMIT 1000")
def lookup_growth(spark, d):
    return lookups.growth_of(growth_asof(spark, d), "s1")


@workload("lookup_sustainability", "R03 O03 P09", f"SELECT * FROM ({SUSTAIN_SQL}) WHERE bank ILIKE '%b1%' ORDER BY year DESC, bank LIMIT 1000")
def lookup_sustainability(spark, d):
    return lookups.dividend_sustainability_of(sustainability(spark, d), "b1")


@workload(
    "bank_symbols",
    "R01 P11 U05",
    f"""SELECT DISTINCT symbol, {stamp('date')} AS date FROM {STATEMENTS.sql} WHERE date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""",
)
def bank_symbols(spark, d):
    return lookups.bank_symbols(STATEMENTS.df(spark, d), 1996)


@workload(
    "samples",
    "S14",
    "SELECT least(100, count(*)) AS head_rows, true AS share_is_plausible FROM lineitem",
)
def samples(spark, d):
    rows = table(spark, d, "lineitem")
    head = sample_model(rows, "head", 100).agg(F.count(F.lit(1)).alias("head_rows"))
    drawn = sample_model(rows, "random", fraction=0.2).agg(F.count(F.lit(1)).alias("n"))
    share = drawn.select("n").scalar() / rows.agg(F.count(F.lit(1))).scalar()
    return head.withColumn("share_is_plausible", share.between(0.15, 0.25))


# --- column functions ---------------------------------------------------------


@workload(
    "text_functions",
    "F01 F02 F03 F05 F06 F07 F08 F09 F10 F32 P10",
    """SELECT c_custkey, regexp_extract(c_name, '[0-9]+') AS digits, regexp_extract(c_name, '([A-Z])[a-z]+#', 1) AS initial,
        regexp_replace(c_name, '^Customer', '') AS tail, rtrim(c_name, '0#5') AS trimmed, ends_with(c_name, '7') AS ends7,
        contains(c_mktsegment, 'URN') AS has_urn, lower(c_mktsegment) AS low, upper(c_name) AS up,
        upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || '-' || 'Ab' AS titled, length(CAST(c_custkey AS VARCHAR)) AS digits_n,
        regexp_full_match(c_mktsegment, 'F.*E') AS whole FROM customer""",
)
def text_functions(spark, d):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, d, "customer").select(
        "c_custkey",
        texts.first_match(name, "[0-9]+").alias("digits"),
        texts.first_match(name, "([A-Z])[a-z]+#", 1).alias("initial"),
        texts.strip_prefix(name, "Customer").alias("tail"),
        texts.strip_trailing_chars(name, "0#5").alias("trimmed"),
        name.endswith("7").alias("ends7"),
        segment.contains("URN").alias("has_urn"),
        F.lower(segment).alias("low"),
        F.upper(name).alias("up"),
        texts.title_case(F.concat(segment, F.lit("-aB"))).alias("titled"),
        texts.digit_count(F.col("c_custkey")).alias("digits_n"),
        texts.matches_whole(segment, "F.*E").alias("whole"),
    )


@workload(
    "date_functions",
    "F12 F13 F14 F15 F16",
    f"""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS parsed,
        CAST(CAST(ts AS DATE) AS VARCHAR) AS from_epoch, year(ts) AS year, strftime(ts, '%Y-%m') AS month,
        {stamp("date_trunc('second', ts) + INTERVAL 5 HOUR")} AS utc FROM events""",
)
def date_functions(spark, d):
    ts = F.col("ts")
    written = F.when(F.col("event_id") % 7 == 0, "soon").otherwise(F.date_format(ts, "dd/MM/yyyy"))
    return table(spark, d, "events").select(
        "event_id",
        temporal.day_first_date(written).alias("parsed"),
        temporal.epoch_ms_date((temporal.epoch_micros(ts) / 1000).cast("bigint")).alias("from_epoch"),
        F.year(ts).alias("year"),
        temporal.month_key(ts).alias("month"),
        temporal.utc_timestamp(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))).alias("utc"),
    )


@workload(
    "number_functions",
    "F17 F18 F19 F20 F21 P15 P20",
    f"""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE CAST(p_size AS BIGINT) END AS coerced, p_size % 2 <> 0 AS flagged,
        CASE WHEN p_partkey % 3 > 0 THEN CAST(CAST(p_retailprice AS DECIMAL(8,2)) AS DOUBLE) END AS price,
        CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE CAST(p_size AS BIGINT) END AS whole, CAST(p_partkey AS DOUBLE) / 100 AS currency,
        CASE WHEN p_size % 10 <> 0 THEN 100.0::DOUBLE / (p_size % 10) END AS finite, {half_even('p_partkey', '8', 2)} AS even,
        {half_up('p_partkey', '8', 2)} AS up FROM part""",
)
def number_functions(spark, d):
    key, size = F.col("p_partkey"), F.col("p_size")
    price = F.when(key % 3 == 0, " ").otherwise(F.concat(F.lit(" "), F.col("p_retailprice").cast("decimal(8,2)").cast("string")))
    exact = key.cast("decimal(20,4)") / 8
    return table(spark, d, "part").select(
        "p_partkey",
        numeric.number_or_zero(F.when(key % 4 == 0, "n/a").otherwise(size.cast("string"))).alias("coerced"),
        numeric.flag_from_text((size % 2).cast("string")).alias("flagged"),
        numeric.price_or_null(price).alias("price"),
        numeric.whole_number(numeric.blank_as(F.when(key % 5 == 0, "").otherwise(size.cast("string")), "0")).alias("whole"),
        numeric.cents(key).alias("currency"),
        numeric.finite(numeric.divide(F.lit(100), size % 10)).alias("finite"),
        numeric.rounded(exact, 2, "half_even").alias("even"),
        numeric.rounded(exact, 2).alias("up"),
    )


@workload(
    "json_props",
    "F24 F25 F29",
    """SELECT event_id, 'k' AS name, CAST(json_extract(props, '$.k') AS VARCHAR) AS value, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
        CAST(NULL AS BIGINT) AS absent, '{"id":' || event_id || ',"type":"' || event_type || '"}' AS meta FROM events""",
)
def json_props(spark, d):
    rows = table(spark, d, "events").select(
        "event_id",
        nested.variant_field(F.col("props"), "$.k", "bigint").alias("k"),
        nested.variant_field(F.col("props"), "$.none", "bigint").alias("absent"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("meta"),
        F.from_json("props", "map<string,string>").alias("entries"),
    )
    return nested.unnest_map(rows, "entries", "name", "value")


@workload(
    "array_functions",
    "F22 F23 F26 F27 F28 J11",
    """SELECT event_id, i AS n, event_type || i AS label, CAST(json_extract(props, '$.k') AS VARCHAR) AS first_value,
        '["' || event_type || '1","' || event_type || '2"]' AS labels, CAST(json_extract(props, '$.k') AS BIGINT) AS unwrapped
        FROM events, (VALUES (1), (2)) v(i) WHERE event_id % 3 > 0""",
)
def array_functions(spark, d):
    item = lambda i: F.struct(F.lit(i).alias("n"), F.concat("event_type", F.lit(str(i))).alias("label"))
    items = F.array(item(1), item(2))
    kept = F.when(F.col("event_id") % 3 > 0, items).otherwise(F.slice(items, 1, 0))
    wrapped = F.concat(F.lit("callback("), "props", F.lit(")"))
    rows = table(spark, d, "events").select(
        "event_id",
        kept.alias("items"),
        nested.first_map_value(F.from_json("props", "map<string,string>")).alias("first_value"),
        nested.pluck(items, "label").alias("labels"),
        F.from_json(nested.unwrap_jsonp(wrapped, "callback"), "k bigint")["k"].alias("unwrapped"),
    )
    return nested.unnest_structs(rows, "items")


@workload(
    "filters",
    "P07 P08 P09 P10 P11 P13",
    f"""SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'none') AS status FROM orders WHERE o_orderstatus <> 'O'
        AND o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderpriority NOT LIKE '%HIGH' AND o_orderpriority ILIKE '%u%'
        AND regexp_full_match(o_orderpriority, '[0-9]-[A-Z]+') AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
        AND o_totalprice >= 1000 AND o_totalprice < 300000 AND o_totalprice IS NOT NULL""",
)
def filters(spark, d):
    priority = F.col("o_orderpriority")
    kept = table(spark, d, "orders").where(
        (F.col("o_orderstatus") != "O")
        & priority.isin("1-URGENT", "5-LOW")
        & ~priority.like("%HIGH")
        & priority.ilike("%u%")
        & texts.matches_whole(priority, "[0-9]-[A-Z]+")
        & temporal.year_range(F.col("o_orderdate"), 1996)
        & (F.col("o_totalprice") >= 1000)
        & (F.col("o_totalprice") < 300000)
        & F.col("o_totalprice").isNotNull()
    )
    status = F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit("none"))
    return kept.select("o_orderkey", status.alias("status"))


@workload(
    "stamped_rows",
    "P03 P04 P05",
    f"""SELECT s_suppkey, s_acctbal - 100 AS gap, 'TPC' AS origin, '2024-02-01 12:00:00.000000' AS process_timestamp FROM supplier""",
)
def stamped_rows(spark, d):
    at = F.lit(dt.datetime(2024, 2, 1, 12)).cast("timestamp")
    rows = table(spark, d, "supplier").select("s_suppkey", (F.col("s_acctbal") - 100).alias("gap"))
    return columns.tagged(rows, origin="TPC").withColumn("process_timestamp", at)


@workload(
    "history_conformed",
    "E14 P01",
    f"""SELECT symbol, {stamp('date')} AS date, open, high, low, close, volume, dividends, stock_splits FROM {HISTORY.sql}""",
)
def history_conformed(spark, d):
    from harbormill.models import catalog

    return columns.conform(HISTORY.df(spark, d), catalog.HISTORY)
