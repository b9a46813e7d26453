"""Column functions: every one is a plain JVM expression."""

from orderstream.functions.ipv4 import ipv4_number, ipv4_text
from orderstream.functions.orders import (
    money_text,
    order_id,
    order_time,
    order_timestamp,
    status_label,
    user_id,
)
from orderstream.functions.text import (
    is_usable,
    read_name,
    region_city,
    region_province,
    stored_name,
)

__all__ = [
    "ipv4_number", "ipv4_text", "is_usable", "money_text", "order_id", "order_time",
    "order_timestamp", "read_name", "region_city", "region_province", "status_label", "stored_name",
    "user_id",
]
