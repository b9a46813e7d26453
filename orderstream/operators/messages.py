"""From message lines to fields, and back to messages.

A message frame has ``value STRING``. Any further columns (topic partition,
offset, timestamp) travel along where a function says so.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstream.functions.text import is_usable

# Field names inside an order message and an ETL message.
ORDER_FIELDS = ("orderId", "userId", "orderTime", "ip", "orderMoney", "orderStatus")
ORDER_NUMBERS = ("orderMoney", "orderStatus")
ETL_FIELDS = ("orderId", "userId", "orderTime", "province", "city", "orderMoney", "orderStatus")

# Position of a message in its topic; the newest message has the greatest one.
POSITION = ("timestamp", "partition", "offset")


def position_columns(df: DataFrame) -> list[str]:
    return [name for name in POSITION if name in df.columns]


def message_filter(messages: DataFrame) -> DataFrame:
    """Drop null lines and lines of commas only."""
    return messages.where(is_usable(F.col("value")))


def json_fields(
    messages: DataFrame,
    names: Sequence[str],
    keep: Sequence[str] = (),
    numbers: Sequence[str] = (),
) -> DataFrame:
    """Top-level JSON members as strings, null where absent or not JSON.

    One parse gives all members, but takes the last of repeated members where a
    path lookup takes the first. So the parse is trusted where no member can
    repeat: the line equals the plain text of its members (``numbers`` without
    quotes), or names each found member once. Any other line is read by path.
    """
    value = F.col("value")
    parsed = messages.select(
        *keep, "value", F.json_tuple(value, *names).alias(*(f"_{name}" for name in names))
    )
    once = F.coalesce(_is_plain(names, numbers), F.lit(False)) | _names_each_once(names)

    def member(name: str) -> Column:
        by_path = F.get_json_object(value, f"$.{name}")
        return F.when(F.col("_once"), F.col(f"_{name}")).otherwise(by_path).alias(name)

    return parsed.withColumn("_once", once).select(*keep, *(member(name) for name in names))


def _is_plain(names: Sequence[str], numbers: Sequence[str]) -> Column:
    """The line is ``{"name":"text","name":number,...}`` of exactly these members, unescaped."""
    value = F.col("value")
    text: list[Column] = []
    for i, name in enumerate(names):
        quote = "" if name in numbers else '"'
        text += [F.lit(f'{"," if i else "{"}"{name}":{quote}'), F.col(f"_{name}"), F.lit(quote)]
    plain = F.concat(*text, F.lit("}"))
    return (value == plain) & ~value.contains("\\") & ~value.contains("'")


def _names_each_once(names: Sequence[str]) -> Column:
    """As many quoted member names as members found; escapes and single quotes count too."""
    named = F.regexp_count("value", F.lit(f"""[\\\\']|"(?:{'|'.join(names)})\""""))
    return named == reduce(add, (F.col(f"_{name}").isNotNull().cast("int") for name in names))


def order_fields(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The six fields of an order message, all strings."""
    return json_fields(message_filter(messages), ORDER_FIELDS, keep, ORDER_NUMBERS)


def report_rows(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``money DOUBLE, province, city`` of ETL messages."""
    fields = json_fields(message_filter(messages), ETL_FIELDS, keep)
    return typed_rows(fields, keep)


def typed_rows(fields: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``money DOUBLE, province, city`` of rows that already have the fields as strings."""
    money = F.col("orderMoney").try_cast("double").alias("money")
    return fields.select(*keep, money, "province", "city")


def to_messages(rows: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One JSON line per row; null fields are left out of the JSON."""
    return rows.select(*keep, F.to_json(F.struct(*names)).alias("value"))


def order_envelope(orders: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Order records as messages for the raw topic."""
    return to_messages(orders, ORDER_FIELDS, keep)


def etl_envelope(etl_rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """ETL rows as messages for the ETL topic."""
    return to_messages(etl_rows, ETL_FIELDS, keep)
