"""Sums of any doubles against fractions: rounded once, in every order."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from orderstream.operators import exact, reports


def plain(values):
    """The double next to the sum of cents and of all other doubles as they are."""
    found = Fraction(0)
    for value in values:
        cents = round(value * 100) if abs(value) < 1e15 else 0
        whole = abs(cents) < 1e15 and cents / 100 == value
        found += Fraction(cents, 100) if whole else Fraction(value)
    return float(found)


def frame(spark, groups):
    rows = [(name, value) for name, values in groups.items() for value in values]
    return spark.createDataFrame(rows, "city STRING, money DOUBLE")


def by_city(rows):
    return {r.city: r.total_amt for r in reports.amt_by_city(rows).collect()}


def cases():
    rng = random.Random(3)

    def wide(low, high):
        return math.ldexp(rng.uniform(1, 2) * rng.choice((-1, 1)), rng.randint(low, high))

    tiny, huge, least = math.ulp(0.0), math.ldexp(1, 1023), 2.0**-1022
    groups = {
        "fine": [rng.uniform(-5, 5) for _ in range(300)],
        "fine_positive": [rng.uniform(0, 1e4) for _ in range(300)],
        "all_sizes": [wide(-1074, 1010) for _ in range(400)],
        "beyond_cents": [wide(40, 110) for _ in range(300)],
        "tiny": [wide(-1074, -1000) for _ in range(300)],
        "least": [tiny, tiny, -3 * tiny, least, -least],
        "cents_and_fine": [round(rng.uniform(-500, 500), rng.randint(0, 5)) for _ in range(400)],
        "huge_cancels": [huge, 1.1, -huge, 0.001, -huge, huge],
        "above_largest_on_the_way": [1.7e308, 1.7e308, -1.7e308],
        "cents_cancel": [0.1, -0.1 + 2**-56],
        "to_zero": [0.1234567, -0.1234567],
        "half_up": [1.0, 2.0**-53, 2.0**-80],
        "half_even": [1.0, 2.0**-53],
        "half_minus": [1.0, 2.0**-53, -(2.0**-1000)],
        "negative_half": [-1.0, -(2.0**-53), -tiny],
        "borders": [math.ldexp(s, 70 * k - 1074 + d) for k in range(1, 29) for d in (-1, 0, 1) for s in (1, -1.5)],
        "below_borders": [math.nextafter(math.ldexp(1, 70 * k - 1074), 0) for k in range(1, 29)],
        "cents_at_the_limit": [9.999999999999e12 + 0.01, 1e13, 1e13 + 0.25, -1e13],
    }
    for n in range(40):
        low = rng.randint(-1074, 900)
        groups[f"random{n}"] = [wide(low, low + rng.randint(0, 100)) for _ in range(rng.randint(1, 30))]
    return groups


def test_any_doubles_are_summed_exactly_and_rounded_once(spark):
    groups = cases()
    expected = {name: plain(values) for name, values in groups.items()}
    assert expected["huge_cancels"] == 1.101 and expected["half_minus"] == 1.0
    rows = frame(spark, groups)
    assert by_city(rows) == expected
    for parts in (1, 7):
        shuffled = rows.orderBy(F.xxhash64("money", F.lit(parts))).repartition(parts)
        assert by_city(shuffled) == expected


def test_sums_of_sums_of_any_doubles(spark):
    groups = cases()
    rows = frame(spark, groups).withColumn("province", F.hash("money") % 5)
    places = reports.amt_by_place(rows.withColumn("province", F.col("province").cast("string")))
    assert by_city(places) == {name: plain(values) for name, values in groups.items()}
    assert by_city(reports.amt_by_place(places)) == by_city(places)


def test_values_that_are_no_finite_numbers_decide(spark):
    inf, nan = float("inf"), float("nan")
    found = by_city(frame(spark, {
        "inf": [inf, 1.0, 0.001], "minus": [-inf, 1e300], "both": [inf, -inf, 1.0], "nan": [nan, inf, 2.0],
        "null": [None], "some": [None, 0.125, 2.5], "beyond": [1.7e308, 1.7e308], "zero": [0.0, -0.0],
    }))
    assert found["inf"] == inf and found["minus"] == -inf and found["beyond"] == inf
    assert math.isnan(found["both"]) and math.isnan(found["nan"])
    assert found["null"] is None and found["some"] == 2.625 and found["zero"] == 0.0


def test_tasks_sum_before_they_shuffle(spark):
    plan = reports.amt_by_city(frame(spark, {"a": [1.0]}))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.index("partial_sum") > plan.index("Exchange hashpartitioning")
    assert exact.WINDOWS * exact.WIDTH >= exact.LOWEST + 1024


@pytest.mark.parametrize("value", [0.005, 1 / 3, -1e-320, 5e-324, 1.5e308, 2.0**62 / 3, 12345.678901])
def test_one_amount_is_itself(spark, value):
    assert by_city(frame(spark, {"a": [value]})) == {"a": value}
