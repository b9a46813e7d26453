"""IPv4 addresses as text and as numbers 0..4294967295."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_IPV4 = 4294967295

_DOTTED = r"\A[0-9]{1,3}(\.[0-9]{1,3}){3}\z"


def ipv4_text(number: Column) -> Column:
    """Dotted text of an address given as a 32-bit integer, signed or not."""
    octets = [F.shiftright(number, shift).bitwiseAND(F.lit(255)) for shift in (24, 16, 8, 0)]
    return F.when(number.isNotNull(), F.concat_ws(".", *(o.cast("string") for o in octets)))


def ipv4_number(text: Column) -> Column:
    """LONG value of a dotted address: four octets 0..255 in digits, otherwise null."""
    parts = F.split(text, r"\.")
    octets = [F.try_element_at(parts, F.lit(i)).try_cast("bigint") for i in (1, 2, 3, 4)]
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return F.when(text.rlike(_DOTTED) & (F.greatest(*octets) <= 255), value)
