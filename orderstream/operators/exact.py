"""Sums of doubles that do not depend on the row order and are rounded once.

An amount in whole cents is an integer. Any other finite amount is an integer number of the
smallest doubles, 2^-1074; its bits are cut at the borders of windows of WIDTH bits, and each
window has a sum of its own. All sums are exact decimals, so they merge in any order; only
``total_of`` rounds. All steps are plain column expressions.

Sums of a group are kept as rows, one for each window in use, which are addends themselves and
can be added up again. A stream that hands on changed groups only needs all of a group in one
row; it keeps a sum for every window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Below this many cents a double still tells neighbouring cents apart.
_MAX_CENTS = 1e15

# A window's sum has 126 bits: room for 2^56 amounts.
WIDTH = 70
# The smallest double is 2^-LOWEST; the windows reach to the largest.
LOWEST = 1074
WINDOWS = -(-(LOWEST + 1024) // WIDTH)

# Amounts, each with the window of its highest bit and its parts there and in the next lower one.
ADDENDS = ("cents", "odd", "window", "high", "low")
SCHEMA = "cents DECIMAL(38,0), odd DOUBLE, window INT, high DECIMAL(38,0), low DECIMAL(38,0)"

_WHOLE = "decimal(38,0)"


def _number(value: int) -> Column:
    return F.lit(str(value)).cast(_WHOLE)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is mentioned."""
    return F.transform(F.array(value), then)[0]


def _scaled(value: Column, bits: Column) -> Column:
    """A double times a power of two, in two steps, as the power itself may be no double."""
    half = F.floor(bits / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), bits - half)


# -- addends and their sums ---------------------------------------------------------


def with_addends(rows: DataFrame, money: str = "money") -> DataFrame:
    """Rows with ADDENDS in place of ``money``; rows that have them already are left as they are.

    ``odd`` is an amount that is infinite or no number. A null amount has nulls only.
    """
    if set(ADDENDS) <= set(rows.columns):
        return rows
    amount = F.col(money)
    size = F.abs(amount)
    cents = F.rint(amount * 100)
    whole = (F.abs(cents) < _MAX_CENTS) & (cents / 100 == amount)
    finite = ~F.isnan(amount) & (size != float("inf"))
    # The logarithm may be off by a little at a border, the comparison is not.
    guess = F.floor((F.log2(size) + LOWEST) / WIDTH)
    border = _scaled(F.lit(1.0), guess * WIDTH - LOWEST)
    beyond = _scaled(F.lit(1.0), guess * WIDTH - LOWEST + WIDTH)
    window = guess + F.when(size < border, -1).when(size >= beyond, 1).otherwise(0)
    rows = rows.withColumns({
        "cents": F.when(whole, cents.try_cast("bigint").cast(_WHOLE)),
        "odd": F.when(~whole & ~finite, amount),
        "window": F.when(~whole & finite, window.cast("int")),
    })
    rows = rows.withColumn("_y", _scaled(amount, LOWEST - F.col("window") * WIDTH))
    y = F.col("_y")
    above = F.rint(y)
    # A cast to decimal goes through the shortest text, which only whole numbers survive;
    # from 2^62 on the lowest nine bits are zeros.
    small = F.abs(y) < float(1 << 62)
    high = F.when(small, above.try_cast("bigint").cast(_WHOLE)).otherwise(
        (y / 512).cast("bigint").cast(_WHOLE) * _number(512)
    )
    low = ((y - above) * float(1 << 52)).cast("bigint").cast(_WHOLE) * _number(1 << (WIDTH - 52))
    parts = {"high": high.cast(_WHOLE), "low": low.cast(_WHOLE)}
    return rows.withColumns(parts).drop(money, "_y")


def added(addends: DataFrame, *keys: str) -> DataFrame:
    """Addends added up: a row per key and window, apart from rows without a window."""
    sums = [F.sum(name).alias(name) for name in ADDENDS if name != "window"]
    return addends.groupBy(*keys, "window").agg(*sums).select(*keys, *ADDENDS)


def totals(addends: DataFrame, *keys: str) -> DataFrame:
    """``total_amt`` per key: the sum, rounded once."""
    if addends.isStreaming:
        whole, odd, bits = F.sum("cents"), F.sum("odd"), F.array(*_every_window())
        return addends.groupBy(*keys).agg(total_of(whole, odd, bits).alias("total_amt"))
    part = F.when(F.col("window").isNotNull(), F.struct("window", "high", "low"))
    parts = added(addends, *keys).groupBy(*keys)
    return parts.agg(total_of(F.sum("cents"), F.sum("odd"), _by_window(F.collect_list(part))).alias("total_amt"))


def _every_window() -> list[Column]:
    """One sum per window, lowest first."""
    at = F.col("window")
    return [
        F.sum(F.when(at == i, F.col("high")).when(at == i + 1, F.col("low"))) for i in range(WINDOWS)
    ]


def _by_window(parts: Column) -> Column:
    """The sums of a group's windows, one row each, as an array; empty without any."""

    def placed(parts: Column) -> Column:
        highs = F.map_from_entries(F.transform(parts, lambda part: F.struct(part["window"], part["high"])))
        lows = F.map_from_entries(F.transform(parts, lambda part: F.struct(part["window"], part["low"])))

        def one(at: Column) -> Column:
            here, next_up = F.try_element_at(highs, at), F.try_element_at(lows, at + 1)
            none = _number(0)
            return (F.coalesce(here, none) + F.coalesce(next_up, none)).cast(_WHOLE)

        return F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), one)

    none = F.array().cast(f"array<{_WHOLE}>")
    return F.when(F.size(parts) > 0, _let(parts, placed)).otherwise(none)


def total_of(cents: Column, odd: Column, bits: Column) -> Column:
    """The double next to the sum; null if nothing went into it.

    Infinite amounts and those that are no numbers decide, as they do in a sum of doubles.
    """
    exact = (cents * F.lit("0.01").cast("decimal(3,2)")).cast("double")
    plain = ~F.exists(bits, lambda part: part.isNotNull())
    return F.when(odd.isNotNull(), odd).when(plain, exact).otherwise(_rounded(cents, bits))


# -- rounding -----------------------------------------------------------------------


def _digits(parts: Column) -> Column:
    """Window sums of any sign as digits of WIDTH bits, lowest first, and a signed carry."""
    base = _number(1 << WIDTH)

    def step(done: Column, part: Column) -> Column:
        def cut(value: Column) -> Column:
            def shared(digit: Column) -> Column:
                carry = ((value - digit).cast(_WHOLE) / base).cast(_WHOLE)
                return F.struct(F.array_append(done["digits"], digit).alias("digits"), carry.alias("carry"))

            return _let(F.pmod(value, base).cast(_WHOLE), shared)

        return _let((part + done["carry"]).cast(_WHOLE), cut)

    start = F.struct(F.array().cast(f"array<{_WHOLE}>").alias("digits"), _number(0).alias("carry"))
    return F.aggregate(parts, start, step, lambda done: F.array_append(done["digits"], done["carry"]))


def _hundredth(digits: Column) -> Column:
    """``digits`` (highest first) and ``rest`` of digits (highest first) divided by 100."""
    base, hundred = _number(1 << WIDTH), _number(100)

    def step(done: Column, digit: Column) -> Column:
        def cut(value: Column) -> Column:
            def shared(rest: Column) -> Column:
                each = ((value - rest).cast(_WHOLE) / hundred).cast(_WHOLE)
                return F.struct(F.array_append(done["digits"], each).alias("digits"), rest.alias("rest"))

            return _let(F.pmod(value, hundred).cast(_WHOLE), shared)

        return _let((done["rest"] * base + digit).cast(_WHOLE), cut)

    start = F.struct(F.array().cast(f"array<{_WHOLE}>").alias("digits"), _number(0).alias("rest"))
    return F.aggregate(digits, start, step)


def _rounded(cents: Column, bits: Column) -> Column:
    """Cents and window sums as the nearest double.

    Everything is counted in hundredths first, so that cents are whole, and divided at the end.
    """
    filled = F.transform(bits, lambda part: F.coalesce(part, _number(0)))
    # Cents begin at the bit of 1, which lies inside a window.
    window, bit = divmod(LOWEST, WIDTH)
    shifted = (F.coalesce(cents, _number(0)) * _number(1 << bit)).cast(_WHOLE)
    hundredths = F.transform(
        _digits(filled),
        lambda part, at: ((part * _number(100)).cast(_WHOLE) + F.when(at == window, shifted).otherwise(_number(0)))
        .cast(_WHOLE),
    )

    def signed(parts: Column) -> Column:
        negative = F.element_at(_digits(parts), -1) < 0
        return _let(negative, lambda minus: _unsigned(parts, minus))

    return _let(hundredths, signed)


def _unsigned(parts: Column, minus: Column) -> Column:
    size = F.transform(parts, lambda part: F.when(minus, -part).otherwise(part).cast(_WHOLE))
    sign = F.when(minus, -1.0).otherwise(1.0)
    return _let(_hundredth(F.reverse(_digits(size))), lambda found: sign * _double(found))


def _double(found: Column) -> Column:
    """The double next to ``digits`` (highest first) and ``rest``.

    Its first two digits hold more bits than a double; a lowest bit is set if anything
    follows, so that one cast rounds rightly. Scaling is exact: a result too small for all
    its bits has none that would be lost.
    """
    digits, rest = found["digits"], found["rest"]
    kept = WIDTH - 14  # bits of the second digit that still fit a decimal behind the first
    cut = _number(1 << 14)

    def value(first: Column) -> Column:
        head = F.get(digits, first)
        second = F.coalesce(F.get(digits, first + 1), _number(0))
        dropped = F.pmod(second, cut).cast(_WHOLE)
        follows = F.exists(
            F.transform(digits, lambda digit, at: (at > first + 1) & (digit != 0)), lambda hit: hit
        )
        lead = (head * _number(1 << kept) + ((second - dropped).cast(_WHOLE) / cut).cast(_WHOLE)).cast(_WHOLE)
        sticky = ((dropped != 0) | follows | (rest != 0)) & (F.pmod(lead, _number(2)) == 0)
        exact = (lead + F.when(sticky, _number(1)).otherwise(_number(0))).cast(_WHOLE)
        place = F.size(digits) - 1 - first
        return _scaled(exact.cast("double"), place * WIDTH - kept - LOWEST)

    first = F.array_position(F.transform(digits, lambda digit: digit != 0), True) - 1
    return _let(first.cast("int"), lambda at: F.when(at < 0, 0.0).otherwise(value(at)))
