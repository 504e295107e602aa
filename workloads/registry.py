"""Registry of workloads and the helpers both sides share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.session import prepare

# The supplied tables. Declared schemas spare a pass over file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TABLES = tuple(SCHEMAS)


@dataclass(frozen=True)
class Workload:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


WORKLOADS: dict[str, Workload] = {}

# Columns that a twin's constants would make INTEGER; both sides are compared as bigint.
WHOLE_NUMBERS = {
    "quality_schema": "total bad",
    "quality_files": "bad",
    "publication_gate": "missing",
    "html_cards": "position",
    "html_tables": "position",
    "disclosures": "tables",
    "bank_a_deposits": "min_amount max_amount",
    "bank_c_deposits": "min_amount max_amount",
    "bank_a_loans": "min_lvr max_lvr min_loan",
    "bank_b_loans": "min_lvr max_lvr min_loan",
    "bank_c_loans": "min_lvr max_lvr min_loan max_loan",
    "home_loan_rates": "min_lvr max_lvr min_loan",
    "home_loans_of_bank": "min_lvr max_lvr min_loan",
    "bracket_targets": "l_linenumber",
    "first_seen": "l_linenumber",
    "melt_metrics": "l_linenumber",
    "multi_key_sort": "c_nationkey",
    "top_revenue": "year",
    "revenue_of_company": "year",
    "revenue_of_nobody": "year",
    "array_functions": "n",
    "model_inventory": "fields dimensions pii",
    "column_links": "hops",
    "json_array_files": "portfolioid",
    "json_array_splits": "size",
    "slice_copy": "min_amount max_amount",
    "json_contract": "total bad",
    "batch_quality": "null_timestamp",
}


def _widened(name: str, sql: str | None) -> str | None:
    if sql is None or name not in WHOLE_NUMBERS:
        return sql
    casts = ", ".join(f'CAST("{c}" AS BIGINT) AS "{c}"' for c in WHOLE_NUMBERS[name].split())
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Types that both engines represent alike: bigint, double, string, boolean."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def workload(name: str, covers: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under ``name``; ``covers`` lists operator ids."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in WORKLOADS:
            raise ValueError(f"workload {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(prepare(spark), sf_dir))

        WORKLOADS[name] = Workload(name, tuple(covers.split()), run, _widened(name, sql))
        return fn

    return register


# --- SQL text helpers ---------------------------------------------------------


def half_up(num: str, den: str, scale: int) -> str:
    """Exact half-up rounding of a quotient of non-negative whole numbers."""
    p = 10**scale
    return f"(CASE WHEN ({den}) > 0 THEN CAST((2*({num})*{p} + ({den})) // (2*({den})) AS DOUBLE)/{p} END)"


def half_even(num: str, den: str, scale: int) -> str:
    """Exact half-to-even rounding of a quotient of whole numbers, divisor positive."""
    p = 10**scale
    n = f"(abs({num})*{p})"
    q, r = f"({n} // ({den}))", f"({n} % ({den}))"
    up = f"(CASE WHEN 2*{r} > ({den}) OR (2*{r} = ({den}) AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"(CASE WHEN ({den}) > 0 THEN sign({num}) * CAST({q} + {up} AS DOUBLE)/{p} END)"


def whole_sum(value: str, scale: int = 20) -> str:
    """Sum of the decimal numbers that doubles are written as, rounded to a double once; casts go by text, which is exact."""
    return f"CAST(CAST(sum(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,{scale}))) AS VARCHAR) AS DOUBLE)"


def stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def check_sql(name: str, model: str, total: str, bad: str, severity: str, source: str) -> str:
    """One result row of a row check."""
    return (
        f"SELECT '{name}' AS check, '{model}' AS model, CASE WHEN bad > 0 THEN '{severity}' ELSE 'PASS' END AS status, "
        f"total, bad, coalesce({half_even('100*bad', 'total', 2)}, 0.0) AS bad_pct FROM "
        f"(SELECT CAST({total} AS BIGINT) AS total, CAST(coalesce({bad}, 0) AS BIGINT) AS bad FROM {source})"
    )
