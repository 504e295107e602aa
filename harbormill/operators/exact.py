"""Sums of doubles that drop nothing and do not depend on the order of the rows.

A double is taken as the decimal number it is written as (at most 17 digits). Numbers whose last digits stand near each
other share a band, in which they are whole numbers of one unit and add up exactly. The bands of a group are put together by carrying, and
the total is rounded to a double once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Decimal places per band. A number has at most 17 + 7 digits in units of its band, so 10^13 of them fit decimal(38).
PLACES = 8
SHORT = 4  # decimals of the numbers that are recognised by arithmetic alone
WHOLE = "decimal(38,0)"
NAN, PLUS, MINUS = 1, 2, 4  # bits of the values that are no numbers


def with_units(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Adds, for each value, its band ``_b_<name>``, its whole number of units ``_u_<name>`` and what it is if no number, ``_x_<name>``.

    Band and units are null for null and for what is no finite number. The steps are columns of their own, so that a number is spelled out once.
    """
    read = df.withColumns({f"_v_{n}": c.cast("double") for n, c in values.items()})
    scaled = {n: F.rint(F.col(f"_v_{n}") * 10.0**SHORT) for n in values}
    # the double nearest to a number of up to four decimals and 14 digits is written as that number
    short = {n: (F.abs(s) < 1e14) & (s / 10.0**SHORT == F.col(f"_v_{n}")) for n, s in scaled.items()}
    other = {n: F.when(F.isnan(f"_v_{n}"), NAN).when(F.col(f"_v_{n}") == float("inf"), PLUS).when(F.col(f"_v_{n}") == float("-inf"), MINUS) for n in values}
    told = read.withColumns(
        {f"_s_{n}": F.when(short[n], s.cast("bigint") * 10 ** (PLACES - SHORT)) for n, s in scaled.items()}
        | {f"_x_{n}": F.coalesce(o, F.lit(0)) for n, o in other.items()}
    )
    spelled = told.withColumns(
        {f"_t_{n}": F.when(F.col(f"_s_{n}").isNull() & (F.col(f"_x_{n}") == 0), F.col(f"_v_{n}").cast("string")) for n in values}
    )
    split = spelled.withColumns(
        {f"_m_{n}": F.substring_index(f"_t_{n}", "E", 1) for n in values}
        | {f"_e_{n}": F.when(F.contains(f"_t_{n}", F.lit("E")), F.substring_index(f"_t_{n}", "E", -1).cast("int")).otherwise(0) for n in values}
    )
    # place of the last digit as a power of ten
    placed = split.withColumns({f"_p_{n}": F.col(f"_e_{n}") - F.length(f"_m_{n}") + F.instr(f"_m_{n}", ".") for n in values})
    steps = [f"_{k}_{n}" for n in values for k in "vstmep"]
    return placed.withColumns(
        {f"_b_{n}": F.when(F.col(f"_s_{n}").isNotNull(), -1).otherwise(F.floor(F.col(f"_p_{n}") / PLACES).cast("int")) for n in values}
        | {f"_u_{n}": F.coalesce(F.col(f"_s_{n}").cast(WHOLE), _padded(f"_m_{n}", f"_p_{n}")) for n in values}
    ).drop(*steps)


def _padded(mantissa: str, place: str) -> Column:
    digits = F.translate(mantissa, ".", "")
    return F.rpad(digits, F.length(digits) + F.pmod(F.col(place), F.lit(PLACES)), F.lit("0")).cast(WHOLE)


def partial_sums(name: str) -> list[Column]:
    """Aggregates for rows ``with_units`` grouped by ``_b_<name>`` too."""
    return [
        F.sum(f"_u_{name}").alias(f"_u_{name}"),
        (F.count(f"_u_{name}") + F.count(F.nullif(F.col(f"_x_{name}"), F.lit(0)))).alias(f"_n_{name}"),
        F.bit_or(f"_x_{name}").alias(f"_x_{name}"),
    ]


def merged_sums(name: str) -> list[Column]:
    """Aggregates that merge partial sums of one band."""
    return [
        F.sum(f"_u_{name}").cast(WHOLE).alias(f"_u_{name}"),
        F.sum(f"_n_{name}").alias(f"_n_{name}"),
        F.bit_or(f"_x_{name}").alias(f"_x_{name}"),
    ]


def _carried(entries: Column, sign: int) -> Column:
    """Whole number above all bands and, as text, the digits of the bands below it, none negative."""
    lowest = F.array_min(F.transform(entries, lambda e: e["band"]))
    highest = F.array_max(F.transform(entries, lambda e: e["band"]))
    zero = F.lit(0).cast(WHOLE)

    def step(state: Column, at: Column) -> Column:
        here = F.filter(entries, lambda e: e["band"] == at)
        total = F.aggregate(here, state["above"], lambda s, e: (s + e["units"] * F.lit(sign).cast("decimal(1,0)")).cast(WHOLE))
        digits = F.pmod(total, F.lit(10**PLACES).cast(WHOLE)).cast(WHOLE)
        rest = (total - digits).cast(WHOLE).cast("string")
        above = F.when(F.length(rest) > PLACES, F.substr(rest, F.lit(1), F.length(rest) - PLACES)).otherwise(F.lit("0"))
        text = F.concat(F.lpad(digits.cast("string"), PLACES, "0"), state["digits"])
        return F.struct(above.cast(WHOLE).alias("above"), text.alias("digits"))

    start = F.struct(zero.alias("above"), F.lit("").alias("digits"))
    walked = F.aggregate(F.sequence(lowest, highest), start, step)
    return F.struct(walked["above"].alias("above"), walked["digits"].alias("digits"), (lowest * PLACES).alias("place"))


def _as_double(state: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), state["above"].cast("string"), state["digits"], F.lit("E"), state["place"].cast("string")).cast("double")


def total_of(name: str) -> Column:
    """Aggregate: the sum, as double, of partial sums grouped by ``_b_<name>`` before; null without a value.

    A group holds a row per combination of bands. NaN, or infinities of both signs, give NaN; a sum beyond all doubles is infinite.
    """
    entry = F.struct(F.col(f"_b_{name}").alias("band"), F.col(f"_u_{name}").alias("units"))
    entries = F.collect_list(F.when(F.col(f"_u_{name}").isNotNull(), entry))
    odd = F.bit_or(f"_x_{name}")
    plain, negated = _carried(entries, 1), _carried(entries, -1)
    one_band = F.concat(F.sum(f"_u_{name}").cast("string"), F.lit("E"), (F.min(f"_b_{name}") * PLACES).cast("string")).cast("double")
    number = (
        F.when(F.min(f"_b_{name}") == F.max(f"_b_{name}"), one_band)
        .when(plain["above"] < 0, _as_double(negated, "-"))
        .otherwise(_as_double(plain, ""))
    )
    return (
        F.when((odd.bitwiseAND(NAN) > 0) | (odd.bitwiseAND(PLUS | MINUS) == (PLUS | MINUS)), F.lit(float("nan")))
        .when(odd.bitwiseAND(PLUS) > 0, F.lit(float("inf")))
        .when(odd.bitwiseAND(MINUS) > 0, F.lit(float("-inf")))
        .when(F.size(entries) > 0, number)
    )


def exact_totals(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """One row per key: for each value its sum ``<name>`` and the number of its non-null values, ``<name>_n``.

    Rows are folded by key and band on the map side, so a hot key is no hot task.
    """
    partial = with_units(df, values).groupBy(*keys, *[f"_b_{n}" for n in values]).agg(*[a for n in values for a in partial_sums(n)])
    return partial.groupBy(*keys).agg(
        *[a for n in values for a in (total_of(n).alias(n), F.coalesce(F.sum(f"_n_{n}"), F.lit(0)).alias(f"{n}_n"))]
    )
