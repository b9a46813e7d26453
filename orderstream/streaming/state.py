"""Running sums read out of a checkpoint, and taken over by a query of another width."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from orderstream.config import Settings
from orderstream.operators import exact
from orderstream.streaming import jobs

SEED_SCHEMA = f"{exact.SCHEMA}, province STRING, city STRING"


def state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``partition_id, key, value``: what a query keeps, the parts numbered ``_0, _1`` ...

    Spark names two running sums alike, so parts go by their place.
    """
    state = spark.read.format("statestore").load(checkpoint)
    numbered = []
    for name in ("key", "value"):
        fields = state.schema[name].dataType.fields
        kind = StructType([StructField(f"_{i}", field.dataType) for i, field in enumerate(fields)])
        numbered.append(F.col(name).cast(kind).alias(name))
    return state.select("partition_id", *numbered)


def state_width(spark: SparkSession, checkpoint: str) -> int:
    found = spark.read.format("state-metadata").load(checkpoint)
    return found.agg(F.max("numPartitions")).first()[0]


def place_sums(spark: SparkSession, settings: Settings) -> DataFrame:
    """Addends with ``province, city`` as the query of all sums keeps them.

    A decimal sum has two parts in the state, itself and whether it is still empty; the
    sum of odd amounts, which are doubles, has one.
    """
    state = state_rows(spark, settings.checkpoint(jobs.PLACES_QUERY))

    def decimal(at: int) -> Column:
        return F.when(~F.col(f"value._{at + 1}"), F.col(f"value._{at}")).cast("decimal(38,0)")

    return state.select(
        decimal(0).alias("cents"),
        F.col("value._2").alias("odd"),
        F.col("key._2").alias("window"),
        decimal(3).alias("high"),
        decimal(5).alias("low"),
        F.col("key._0").alias("province"),
        F.col("key._1").alias("city"),
    )


def widen(spark: SparkSession, old: Settings, new: Settings, seed: str) -> None:
    """Write the sums of a stopped query as the seed of one with another number of state stores.

    ``new`` has its own checkpoint folder. The seed is spread over as many files as the
    new query has stores; ``start_seeded_sums`` reads it in its first batch.
    """
    if old.checkpoint(jobs.PLACES_QUERY) == new.checkpoint(jobs.PLACES_QUERY):
        raise ValueError("the new query needs a checkpoint of its own")
    sums = place_sums(spark, old)
    sums.repartition(new.state_partitions, "province", "city").write.mode("overwrite").parquet(seed)


def start_seeded_sums(
    spark: SparkSession, settings: Settings, rows: DataFrame, seed: str
) -> StreamingQuery:
    """All sums together, going on from a seed. ``rows`` are those the old query has not read."""
    seeds = spark.readStream.schema(SEED_SCHEMA).parquet(seed)
    fresh = exact.with_addends(rows.select("money", "province", "city"))
    return jobs.start_sums(spark, settings, seeds.unionByName(fresh))
