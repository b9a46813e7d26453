"""Rows of the sales bar chart, from the newest row per city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: name of the chart's only series.
SERIES = "销售额"


def _complete(cities: DataFrame) -> DataFrame:
    return cities.where(F.col("province").isNotNull() & F.col("money").isNotNull())


def dashboard_feed(cities: DataFrame) -> DataFrame:
    """``series, category, value`` from ``city, money, province``.

    One bar per province. Several cities of a province compete for it; the last
    one by name wins, so the result does not depend on reading order.
    """
    value = F.col("money").try_cast("double")
    return (
        _complete(cities)
        .withColumn("value", value)
        .where(F.col("value").isNotNull())
        .groupBy("province")
        .agg(F.max_by("value", "city").alias("value"))
        .select(F.lit(SERIES).alias("series"), F.col("province").alias("category"), "value")
    )


def dashboard_rejects(cities: DataFrame) -> DataFrame:
    """Complete rows whose money is not a number."""
    return (
        _complete(cities)
        .where(F.col("money").try_cast("double").isNull())
        .select("city", "province", "money")
    )
