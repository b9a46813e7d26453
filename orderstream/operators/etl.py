"""Order messages to located order rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.operators.counts import Counts
from orderstream.operators.geo import GeoIndex, locate
from orderstream.operators.messages import ETL_FIELDS, order_fields, position_columns

# Fixed value: status code of an open order.
OPEN = "0"


def order_etl(
    messages: DataFrame, index: GeoIndex, keep: Sequence[str] = (), counts: Counts | None = None
) -> DataFrame:
    """All orders whatever their status: seven string columns."""
    return _located(_fields(messages, keep, counts), index, keep, counts)


def order_etl_open(
    messages: DataFrame, index: GeoIndex, keep: Sequence[str] = (), counts: Counts | None = None
) -> DataFrame:
    """Open orders only; the others are dropped before the address is looked up."""
    fields = _fields(messages, keep, counts).where(F.col("orderStatus") == OPEN)
    return _located(fields, index, keep, counts)


def _located(
    fields: DataFrame, index: GeoIndex, keep: Sequence[str], counts: Counts | None
) -> DataFrame:
    found = locate(fields, "ip", index)
    if counts:
        found = counts.places(found)
    return found.select(*keep, *ETL_FIELDS)


def _fields(messages: DataFrame, keep: Sequence[str], counts: Counts | None) -> DataFrame:
    """Order fields with the message position, which a shuffled lookup spreads rows by."""
    position = [name for name in position_columns(messages) if name not in keep]
    if counts:
        messages = counts.lines(messages)
    fields = order_fields(messages, (*keep, *position))
    return counts.fields(fields) if counts else fields
