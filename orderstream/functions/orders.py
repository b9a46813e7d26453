"""Formats of the fields of an order record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the order time and of the time inside an order id.
ORDER_TIME = "yyyy-MM-ddHH:mm:ss.SSS"
ORDER_ID_TIME = "yyyyMMddHHmmssSSS"

# Order status codes.
STATUS = {0: "open", 1: "cancelled", 2: "closed", 3: "finished"}


def order_time(millis: Column, pattern: str = ORDER_TIME) -> Column:
    """Text of an epoch-millisecond time in the session time zone."""
    return F.date_format(F.timestamp_millis(millis), pattern)


def order_id(millis: Column, sequence: Column) -> Column:
    """Time in milliseconds followed by a sequence number of at least six digits."""
    number = F.format_string("%06d", sequence.cast("bigint"))
    return F.concat(order_time(millis, ORDER_ID_TIME), F.when(sequence.isNotNull(), number))


def user_id(group: Column, member: Column) -> Column:
    """Group number followed by a member number of at least eight digits."""
    number = F.format_string("%08d", member.cast("bigint"))
    return F.concat(group.cast("string"), F.when(member.isNotNull(), number))


def money_text(units: Column, cents: Column) -> Column:
    """``units.cc`` with two decimals."""
    text = F.format_string("%d.%02d", units.cast("bigint"), cents.cast("bigint"))
    return F.when(units.isNotNull() & cents.isNotNull(), text)


def order_timestamp(text: Column) -> Column:
    """Timestamp of an order time text, null when it does not parse."""
    return F.try_to_timestamp(text, F.lit(ORDER_TIME))


def status_label(code: Column) -> Column:
    """Name of a status code (text or number), null for an unknown one."""
    number = code.try_cast("int")
    label = F.lit(None).cast("string")
    for value, name in STATUS.items():
        label = F.when(number == value, F.lit(name)).otherwise(label)
    return label
