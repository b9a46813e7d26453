"""Sales reports over rows ``money DOUBLE, province, city``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstream.functions.text import stored_name
from orderstream.operators import exact
from orderstream.operators.messages import POSITION

# Constant columns of the wide reports.
GLOBAL = "global"
TOTAL = "total"

# Longest list of cities that is written into a plan as such.
LONG_LIST = 1000


def amt_total(rows: DataFrame) -> DataFrame:
    """``total_amt``; like every sum here the same in any order of rows, also of sums of sums."""
    return exact.totals(exact.with_addends(rows))


def amt_by_province(rows: DataFrame) -> DataFrame:
    return exact.totals(exact.with_addends(rows), "province")


def amt_by_city(rows: DataFrame) -> DataFrame:
    return exact.totals(exact.with_addends(rows), "city")


def amt_by_place(rows: DataFrame) -> DataFrame:
    """Exact sums by ``province, city``, as addends from which all other sums follow.

    Nothing is rounded, so any report taken of the result equals that of the rows.
    ``rows`` may be such sums themselves.
    """
    return exact.added(exact.with_addends(rows), "province", "city")


def key_city_rows(rows: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Rows of the listed cities; rows without a city are dropped.

    A long list is joined rather than written into the plan. It comes from the
    settings, so it is small enough to broadcast.
    """
    if len(cities) <= LONG_LIST:
        return rows.where(F.col("city").isin(*cities))
    listed = rows.sparkSession.createDataFrame([(city,) for city in set(cities)], "_city STRING")
    return rows.join(F.broadcast(listed), F.col("city") == F.col("_city"), "left_semi")


def with_key_city(rows: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Rows with ``key_city``: whether ``key_city_rows`` has them."""
    if len(cities) <= LONG_LIST:
        chosen = F.col("city").isin(*cities) if cities else F.lit(False)
        return rows.withColumn("key_city", F.coalesce(chosen, F.lit(False)))
    listed = rows.sparkSession.createDataFrame([(city,) for city in set(cities)], "_city STRING")
    joined = rows.join(F.broadcast(listed), F.col("city") == F.col("_city"), "left")
    return joined.withColumn("key_city", F.col("_city").isNotNull()).drop("_city")


def key_city_amount(rows: DataFrame, cities: Sequence[str]) -> DataFrame:
    return amt_by_city(key_city_rows(rows, cities))


def key_city_latest(rows: DataFrame, cities: Sequence[str] | None) -> DataFrame:
    """Newest row per city by its position in the topic, whenever it arrives.

    A stream keeps the newest row and its position as state, so a late row that is older
    changes nothing. ``cities=None`` keeps every city.
    """
    if cities is None:
        chosen = rows.where(F.col("city").isNotNull())
    else:
        chosen = key_city_rows(rows, cities)
    newest = F.max_by(F.struct("money", "province"), F.struct(*POSITION))
    return chosen.groupBy("city").agg(newest.alias("newest")).select("city", "newest.*")


def pivot_total(total: DataFrame) -> DataFrame:
    """``global, type``: the total as one wide row."""
    wide = total.withColumn("total", F.lit(GLOBAL)).groupBy()
    return wide.pivot("total", [GLOBAL]).sum("total_amt").withColumn("type", F.lit(TOTAL))


def pivot_city(by_city: DataFrame, cities: Sequence[str] | None = None) -> DataFrame:
    """``total, <city> ...``: one column per city.

    With a list only those cities become columns and no extra job is needed.
    Without one the columns are found in the data, a missing city as ``null``.
    That reads the sums twice, so they should be stored or cached by then.
    """
    groups = by_city.withColumn("total", F.lit(GLOBAL)).groupBy("total")
    wide = groups.pivot("city") if cities is None else groups.pivot("city", list(cities))
    return wide.sum("total_amt")


def city_map(by_city: DataFrame) -> DataFrame:
    """``total, amounts``: all cities in one row, as a map from city to amount.

    However many cities there are, the row has two columns and is found without a look
    at the names. A missing city is called as it is in stored hashes.
    """
    entries = F.collect_list(F.struct(stored_name(F.col("city")), F.col("total_amt")))
    row = by_city.agg(F.map_from_entries(entries).alias("amounts"))
    return row.select(F.lit(GLOBAL).alias("total"), "amounts").where(F.size("amounts") > 0)
