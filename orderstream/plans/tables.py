"""Order messages and an address dictionary derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.functions.ipv4 import ipv4_text
from orderstream.functions.orders import ORDER_TIME
from orderstream.operators import messages as msg
from orderstream.operators.geo import GeoIndex, build_index
from orderstream.session import changed_at
from orderstream.sources.ranges import split_regions

# Key cities of the derived dictionary.
KEY_CITIES = tuple(f"CITY_{n}" for n in range(0, 99, 11))

# Every range of the derived dictionary ends this much before the next begins.
RANGE_WIDTH = 42949672
RANGE_GAP = 2000000

# Lines that carry no order, one shape after the other.
NOISE = (None, ",", ",,,", " , ", "\t,\n", "", " ", ", ,", ",a", "a,,", "{bad")

_indexes: dict[tuple[str, str, int], GeoIndex] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Deal rows out to all cores where the scan gives too few tasks for that.

    A small table may be one file that cannot be split, which would leave all the
    text work to one task. A scan with enough tasks is left as it is: no shuffle.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if 2 * rows.rdd.getNumPartitions() <= cores else rows


def address_number() -> Column:
    """An address 0..4294967295 for each order; keys are reduced first to stay within 64 bits."""
    half = 2147483648
    mixed = F.col("o_custkey") % half * 2654435761 + F.col("o_orderkey") % half * 40503
    return mixed % 4294967296


def order_records(orders: DataFrame) -> DataFrame:
    """Orders as order records with a topic position; some have no usable address."""
    address = F.when(F.col("o_orderkey") % 97 == 0, F.lit("unknown")).otherwise(
        ipv4_text(address_number())
    )
    status = F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "P", 1)
    return orders.select(
        F.col("o_orderkey").cast("string").alias("orderId"),
        F.col("o_custkey").cast("string").alias("userId"),
        F.date_format("o_orderdate", ORDER_TIME).alias("orderTime"),
        address.alias("ip"),
        F.col("o_totalprice").alias("orderMoney"),
        status.otherwise(2).alias("orderStatus"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        (F.col("o_custkey") % 3).cast("int").alias("partition"),
        F.col("o_orderkey").alias("offset"),
    )


def finished(lines: DataFrame) -> DataFrame:
    """Message lines as a topic hands them out: text that is there, not to be computed.

    Made from columns, the text is an expression; the optimizer would move filters on it
    below and write each JSON line three times. No filter passes a generator's output.
    """
    others = [name for name in lines.columns if name != "value"]
    return lines.select(F.explode(F.array("value")).alias("value"), *others).select(*lines.columns)


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table as messages ``value, timestamp, partition, offset``."""
    records = order_records(spread(table(spark, sf_dir, "orders")))
    return finished(msg.order_envelope(records, msg.POSITION))


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages, some with an amount that is no number, and all noise lines."""
    records = order_records(spread(table(spark, sf_dir, "orders")))
    odd = F.when(F.col("offset") % 89 == 0, F.lit("n/a")).otherwise(F.col("orderMoney").cast("string"))
    orders = msg.order_envelope(records.withColumn("orderMoney", odd), msg.POSITION)
    position = [F.timestamp_seconds(F.lit(0)), F.lit(0), F.col("event_id")]
    named = [column.alias(name) for column, name in zip(position, msg.POSITION, strict=True)]
    return finished(orders.unionByName(noise_lines(spark, sf_dir).select("value", *named)))


def noise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The properties text of every event, and one junk line besides."""
    kind = F.col("event_id") % len(NOISE)
    junk = F.lit(None).cast("string")
    for i, text in enumerate(NOISE):
        junk = F.when(kind == i, F.lit(text)).otherwise(junk)
    lines = F.array(
        F.struct(F.lit("props").alias("source"), F.col("props").alias("value")),
        F.struct(F.lit("noise").alias("source"), junk.alias("value")),
    )
    events = table(spark, sf_dir, "events").select("event_id", F.explode(lines).alias("line"))
    return events.select("line.source", "event_id", "line.value")


def region_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four ranges per nation with region texts: ``lo, hi, region``."""
    numbered = table(spark, sf_dir, "nation").select(
        "n_name",
        F.explode(F.expr("transform(sequence(0, 3), i -> n_nationkey * 4L + i)")).alias("n"),
    )
    lo = F.col("n") * RANGE_WIDTH
    region = F.concat(
        F.lit("XX|0|"), "n_name", F.lit("|CITY_"), F.col("n").cast("string"), F.lit("|ISP")
    )
    return numbered.select(
        lo.alias("lo"), (lo + RANGE_WIDTH - 1 - RANGE_GAP).alias("hi"), region.alias("region")
    )


def geo_index(spark: SparkSession, sf_dir: str) -> GeoIndex:
    """The derived dictionary, checked once per application and state of its table."""
    path = f"{sf_dir}/nation.parquet"
    place = (spark.sparkContext.applicationId, path, changed_at(spark, path))
    if place not in _indexes:
        _indexes[place] = build_index(split_regions(region_ranges(spark, sf_dir)))
    return _indexes[place]


def supplier_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One range of one to four addresses per supplier, all side by side."""
    lo = F.col("s_suppkey") * 4
    return table(spark, sf_dir, "supplier").select(
        lo.alias("lo"),
        (lo + F.col("s_suppkey") % 4).alias("hi"),
        F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("province"),
        F.col("s_name").alias("city"),
    )
