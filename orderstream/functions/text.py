"""Message lines, region texts and stored names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: lines of this shape hold no field at all - one unbroken run of
# commas, with blanks or control characters around it.
_ONLY_COMMAS = r"\A[\x00-\x20]*,+[\x00-\x20]*\z"

# A region text is country|area|province|city|provider.
_REGION_FIELDS = 5
_PROVINCE = 3
_CITY = 4


def is_usable(value: Column) -> Column:
    """True for a line worth parsing; empty and blank lines count as usable."""
    return value.isNotNull() & ~value.rlike(_ONLY_COMMAS)


def _region_field(region: Column, position: int) -> Column:
    parts = F.split(region, "[|]")
    return F.when(F.size(parts) == _REGION_FIELDS, F.try_element_at(parts, F.lit(position)))


def region_province(region: Column) -> Column:
    """Third field of a five-field region text, otherwise null."""
    return _region_field(region, _PROVINCE)


def region_city(region: Column) -> Column:
    """Fourth field of a five-field region text, otherwise null."""
    return _region_field(region, _CITY)


# Stands for a missing key or field name; texts that look like it get a backslash in front.
MISSING = "null"


def stored_name(name: Column) -> Column:
    """A key or field name as it is stored: a missing one apart from every text."""
    text = name.cast("string")
    escaped = F.when(text.rlike(rf"^\\*{MISSING}$"), F.concat(F.lit("\\"), text)).otherwise(text)
    return F.coalesce(escaped, F.lit(MISSING))


def read_name(stored: Column) -> Column:
    """The name that was stored, null if it was missing."""
    plain = F.when(stored.rlike(rf"^\\+{MISSING}$"), F.substring(stored, 2, 1 << 30)).otherwise(stored)
    return F.when(stored != MISSING, plain)
