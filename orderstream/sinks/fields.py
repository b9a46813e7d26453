"""Report rows as fields of hashes, and as rows for a keyed sink of the deployment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstream.config import Settings
from orderstream.functions.text import stored_name


def hash_key(table: str, key: Column) -> Column:
    return F.concat(F.lit(f"{table}:"), stored_name(key))


def _named(name: str) -> Column:
    """A column by its exact name; a city as a column name may have dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def hash_fields(rows: DataFrame, table: str, key: str, whole: bool = False) -> DataFrame:
    """Wide rows to one row per key and field.

    Null fields are not stored, unless a row is stored ``whole``: then they replace what
    an older row of the key had.
    """
    names = [name for name in rows.columns if name != key]
    texts = rows.select(
        hash_key(table, F.col(key)).alias("key"),
        *(_named(name).cast("string").alias(name) for name in names),
    )
    fields = texts.unpivot(["key"], [_named(name) for name in names], "field", "value")
    return fields if whole else fields.where(F.col("value").isNotNull())


def city_fields(by_city: DataFrame, table: str, key: str) -> DataFrame:
    """``city, total_amt`` as fields of one hash, without making the wide row first."""
    return by_city.select(
        hash_key(table, F.lit(key)).alias("key"),
        stored_name(F.col("city")).alias("field"),
        F.col("total_amt").cast("string").alias("value"),
    ).where(F.col("value").isNotNull())


def map_fields(rows: DataFrame, table: str, key: str, amounts: str) -> DataFrame:
    """A row with a map to one row per entry: its key names the field. Nulls are not stored."""
    entries = rows.select(hash_key(table, F.col(key)).alias("key"), F.explode(amounts).alias("field", "value"))
    return entries.select("key", "field", F.col("value").cast("string")).where(F.col("value").isNotNull())


def write_external(rows: DataFrame, table: str, key: str, settings: Settings) -> None:
    """Hand wide rows to the deployment's own keyed sink."""
    options = {
        "host": settings.store_host,
        "port": str(settings.store_port),
        "dbNum": str(settings.store_db),
        **settings.store_options,
        "table": table,
        "key.column": key,
    }
    rows.write.mode("append").format(settings.store_format).options(**options).save()
