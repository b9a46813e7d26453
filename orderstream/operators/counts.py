"""Counts of what a pass drops or cannot read, taken in that pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderstream.functions.text import is_usable
from orderstream.operators.messages import ORDER_FIELDS

# What is counted, as it is called in the progress reports of a stream.
LINES, DROPPED = "lines.lines", "lines.dropped"
UNPARSED = "fields.unparsed"
UNKNOWN = "places.unknown_address"
NO_NUMBER = "amounts.no_number"
ALL = (LINES, DROPPED, UNPARSED, UNKNOWN, NO_NUMBER)


class Counts:
    """Observes frames on their way. One object counts one query, each place once.

    A stream reports the counts of every batch under the names above. A batch query
    reports them here, once it has run.
    """

    def __init__(self, streaming: bool = False) -> None:
        self._streaming = streaming
        self._seen: list[Observation] = []

    def _observe(self, rows: DataFrame, **counts: Column) -> DataFrame:
        """``place__name`` for each count; all of one call have the same place."""
        place = next(iter(counts)).partition("__")[0]
        columns = [count.alias(name.partition("__")[2]) for name, count in counts.items()]
        if self._streaming:
            return rows.observe(place, *columns)
        self._seen.append(Observation(place))
        return rows.observe(self._seen[-1], *columns)

    def lines(self, messages: DataFrame) -> DataFrame:
        """All lines, and those that the message filter drops."""
        dropped = F.count_if(~F.coalesce(is_usable(F.col("value")), F.lit(False)))
        return self._observe(messages, lines__lines=F.count(F.lit(1)), lines__dropped=dropped)

    def fields(self, fields: DataFrame) -> DataFrame:
        """Lines that have none of the members of an order."""
        none = F.coalesce(*ORDER_FIELDS).isNull()
        return self._observe(fields, fields__unparsed=F.count_if(none))

    def places(self, located: DataFrame) -> DataFrame:
        """Rows with an address that no range has, or that is none."""
        unknown = F.col("ip").isNotNull() & F.col("province").isNull() & F.col("city").isNull()
        return self._observe(located, places__unknown_address=F.count_if(unknown))

    def amounts(self, fields: DataFrame) -> DataFrame:
        """Rows whose amount is there but no number."""
        odd = F.col("orderMoney").isNotNull() & F.col("orderMoney").try_cast("double").isNull()
        return self._observe(fields, amounts__no_number=F.count_if(odd))

    def found(self) -> dict[str, int]:
        """The counts of a batch query that has run, by name."""
        return {key: value for seen in self._seen for key, value in seen.get.items()}
