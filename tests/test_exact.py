"""Exact sums against fractions, in any order of the rows."""

from __future__ import annotations

import math
import random
from decimal import Context, Decimal

from pyspark.sql import functions as F

from harbormill.operators.exact import exact_totals

WIDE = Context(prec=1200, Emax=10**6, Emin=-(10**6))


def _sum(values):
    total = Decimal(0)
    for v in values:
        total = WIDE.add(total, Decimal(repr(v)))
    return float(total)


def _groups():
    rng = random.Random(11)
    return {
        "money": [round(rng.uniform(-1e6, 1e6), 2) for _ in range(400)],
        "cancel": [1e31, 1e-12, -1e31, 3.0, -3.0],
        "small": [1e-12, 5e-324, 2.5e-320],
        "large": [1e300, 1.7e308, -1.7e308, 12345.678],
        "beyond": [1.7e308, 1.7e308],
        "below": [-1e20, 1.5, -0.25, 7e-9],
        "zero": [0.0, -0.0],
        "tenths": [0.1] * 30,
        "carry": [9999.0, 0.9999, 0.0001, 9.9999e11, -1e-4],
        "spread": [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-300, 300) for _ in range(300)],
        "digits": [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-6, 9) for _ in range(500)],
    }


def test_sums_equal_fractions_and_do_not_depend_on_the_order(spark):
    groups = _groups()
    data = [(k, v) for k, vs in groups.items() for v in vs] + [("money", None), ("none", None), (None, 2.5)]
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, v double").repartition(3 + 4 * seed)
        got = {r.k: (r.v, r.v_n) for r in exact_totals(df, ["k"], {"v": F.col("v")}).collect()}
        assert got == {k: (_sum(vs), len(vs)) for k, vs in groups.items()} | {"none": (None, 0), None: (2.5, 1)}
        assert math.copysign(1, got["zero"][0]) == 1


def test_values_that_are_no_numbers(spark):
    inf, nan = float("inf"), float("nan")
    data = [("n", nan), ("n", 1.0), ("p", inf), ("p", 1.0), ("m", -inf), ("b", inf), ("b", -inf)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r.v for r in exact_totals(df, ["k"], {"v": F.col("v")}).collect()}
    assert math.isnan(got.pop("n")) and math.isnan(got.pop("b"))
    assert got == {"p": inf, "m": -inf}


def test_several_values_without_keys_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 1e-9), (1e18, None), (0.5, -3.0)], "a double, b double")
    total = exact_totals(df, [], {"a": F.col("a"), "b": F.col("b") * 2})
    assert tuple(total.first()) == (_sum([1.0, 1e18, 0.5]), 3, _sum([2e-9, -6.0]), 2)
    assert exact_totals(df.limit(0).withColumn("k", F.lit(1)), ["k"], {"a": F.col("a")}).collect() == []
