import math
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumetry.functions import ANY_COST, Measure
from lumetry.operators.summaries import windowed_sums

M = Measure("m", "x", "float")
D = Measure("m", "x", "double")
INT = Measure("m", "x")


def report(spark, values, measure=M, kind="float", digits=None):
    frame = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    settled = frame.repartition(3).groupBy().agg(*measure.partials())
    return tuple(settled.select(measure.total(digits), measure.mean()).first())


def written(value):
    """The decimal a float is written as."""
    return Decimal(np.format_float_positional(np.float32(value), unique=True))


def half_up(value):
    return float(value.quantize(Decimal("0.01"), ROUND_HALF_UP))


floats = st.one_of(
    st.none(),
    st.integers(-20_000_000, 20_000_000).map(lambda n: float(np.float32(n / 100))),
    st.integers(-9_999_999, 9_999_999).map(lambda n: float(np.float32(n / 10_000))),
    st.integers(-9_999_999, 9_999_999).map(lambda n: float(np.float32(n / 10**9))),
    st.sampled_from([0.1, 0.2, 1.005, -0.005, 99999.99, 100000.0, 123456.78, 1e9, -1.25]).map(
        lambda v: float(np.float32(v))
    ),
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(floats, min_size=1, max_size=12), min_size=40, max_size=80))
def test_sum_and_mean_are_those_of_the_written_decimals(spark, groups):
    rows = [(g, v) for g, values in enumerate(groups) for v in values]
    frame = spark.createDataFrame(rows, "g int, x float").repartition(3)
    settled = frame.groupBy("g").agg(*M.partials()).select("g", M.total().alias("total"), M.mean().alias("mean"))
    expected = {}
    for g, values in enumerate(groups):
        present = [written(v) for v in values if v is not None]
        total = sum(present)
        expected[g] = (float(total), half_up(total / len(present))) if present else (None, None)
    assert {row["g"]: (row["total"], row["mean"]) for row in settled.collect()} == expected


@pytest.mark.parametrize(
    ("value", "total"), [(1e-7, 1e-4), (4e-7, 4e-4), (1.23456789, 1234.56789), (1e-18, 1e-15), (123456.1234567, 123456123.4567)]
)
def test_small_parts_add_up(spark, value, total):
    assert report(spark, [value] * 1000, D, "double")[0] == total


def test_the_smallest_are_added_as_doubles(spark):
    assert report(spark, [1e-30] * 1000, D, "double")[0] == pytest.approx(1e-27)
    assert report(spark, [1e-30, 0.5, 1e-7], D, "double")[0] == pytest.approx(0.5000001)


def test_tenths_add_up(spark):
    assert report(spark, [0.1, 0.2]) == (0.3, 0.15)


def test_means_round_half_up(spark):
    assert report(spark, [1.0, 1.01])[1] == 1.01
    assert report(spark, [-1.0, -1.01])[1] == -1.01
    assert report(spark, [1, 2, 2, 2, 2, 2, 2, 2], INT, "int") == (15, 1.88)


def test_totals_round_once(spark):
    assert report(spark, [0.004, 0.004], digits=2)[0] == 0.01


def test_large_figures_are_as_precise_as_a_float(spark):
    assert report(spark, [2.5e11, 16777216.0])[0] == pytest.approx(2.5e11 + 16777216, rel=1e-7)


def test_figures_beyond_decimals_are_not_lost(spark):
    huge = float(np.float32(3e30))
    assert report(spark, [huge, 1.5])[0] == pytest.approx(huge)
    assert math.isinf(report(spark, [math.inf, 1.0])[0])
    assert all(math.isnan(v) for v in report(spark, [math.nan, 1.0]))
    assert report(spark, [1e13, 0.25], D, "double")[0] == 1e13 + 0.25


def test_partial_sums_add_up(spark):
    values = [0.1, 0.25, 1.005, 123456.78, None, 7e20, -3.3]
    frame = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "k int, x float")
    parts = frame.groupBy("k").agg(*M.partials())
    merged = parts.groupBy().agg(*M.merged())
    assert dict(merged.dtypes) == {part: kind.lower() for part, kind in M.parts.items()}
    assert tuple(merged.select(M.total(), M.mean()).first()) == report(spark, values)


def test_doubles(spark):
    assert report(spark, [0.1, 0.2, 1234567.891], D, "double") == (1234568.191, 411522.73)


def test_any_float_is_added_exactly_in_any_order(spark):
    chance = random.Random(9)
    powers = [*range(-44, -20), *range(14, 38)]
    values = [float(np.float32(chance.choice([-1, 1]) * chance.random() * 10.0 ** chance.choice(powers))) for _ in range(900)]
    values += [-v for v in values[:600]] + [1e-45, 3.4e38, -3.4e38]
    decimals = ["0.1", "12.5", "-3.25", "0.2"]
    measure = Measure("cost", "v", "float", any_float=True)
    for kept in (values, [v for v in values if abs(v) < 1e-20]):
        exact, found = sum(Fraction(float(np.float32(v))) for v in kept) + sum(map(Fraction, decimals)), set()
        for seed in range(3):
            rows = [*kept, *map(float, decimals)]
            random.Random(seed).shuffle(rows)
            frame = spark.createDataFrame([(v,) for v in rows], "v FLOAT").repartition(1 + 3 * seed)
            found.add(frame.agg(*measure.partials()).select(measure.total()).first()[0])
            if not seed:
                parts = frame.withColumn("half", F.col("v") > 0).groupBy("half").agg(*measure.partials())
                found.add(parts.agg(*measure.merged()).select(measure.total()).first()[0])
        (total,) = found
        assert abs(Fraction(total) - exact) <= abs(exact) * Fraction(1, 10**14)


def test_any_float_with_what_is_no_number(spark):
    measure = Measure("cost", "v", "float", any_float=True)
    inf, nan = float("inf"), float("nan")

    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "v FLOAT").agg(*measure.partials()).select(measure.total()).first()[0]

    assert total(1e30, inf) == inf and total(-inf, 1.0) == -inf
    assert str(total(inf, -inf)) == str(total(nan, 1.0)) == "nan"
    assert total(None) is None or total(None) == 0
    assert total(1e30, -1e30, 0.1, 0.2) == pytest.approx(0.3, abs=1e-15)


def test_what_is_left_of_a_reading_is_worked_out_once(spark):
    values = [0.1, 12.5, -3.25, 1e30, -1e30, 2.0**-100, -(2.0**90), float("inf"), 1e-45, None]
    for kept in (values, [v for v in values if v != float("inf")]):
        rows = [(i % 2, v) for i, v in enumerate(kept * 3)]
        frame = spark.createDataFrame(rows, "DID INT, COST FLOAT").selectExpr("TIMESTAMP'2024-01-01' AS STIME", "*")
        sums = windowed_sums(frame, "STIME", "1 hour", ["DID"], [ANY_COST])
        plan = sums._jdf.queryExecution().executedPlan().toString()
        assert "transform" not in plan and "lambda" not in plan
        plain = frame.groupBy("DID").agg(*ANY_COST.partials())
        assert sorted(sums.drop("w").collect()) == sorted(plain.select(sums.drop("w").columns).collect())
