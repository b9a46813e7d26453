"""The address dictionary as a table ``lo, hi, province, city``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.config import Settings
from orderstream.functions.text import region_city, region_province
from orderstream.operators.geo import GeoIndex, build_index


def split_regions(ranges: DataFrame) -> DataFrame:
    """``lo, hi, region`` with the region text split once, while loading."""
    region = F.col("region")
    return ranges.select(
        F.col("lo").cast("bigint").alias("lo"),
        F.col("hi").cast("bigint").alias("hi"),
        region_province(region).alias("province"),
        region_city(region).alias("city"),
    )


def load_ranges(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A dictionary table with region texts or with the two names split already."""
    if fmt == "csv":
        table = spark.read.option("header", "true").csv(path)
    else:
        table = spark.read.format(fmt).load(path)
    if "region" in table.columns:
        return split_regions(table)
    bounds = [F.col(name).cast("bigint").alias(name) for name in ("lo", "hi")]
    return table.select(*bounds, "province", "city")


def load_index(spark: SparkSession, settings: Settings) -> GeoIndex:
    """The dictionary of a deployment, checked and ready to join."""
    ranges = load_ranges(spark, settings.region_path, settings.region_format)
    return build_index(ranges, settings.geo_broadcast_bytes)
