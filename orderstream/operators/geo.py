"""IPv4 address to province and city: a left range join made of one equi-join.

Ranges are cut at /16 borders, so that an address and its range meet on the
address's upper 16 bits and the range test is left as a residual. A /16 bucket
may still hold up to 65,536 ranges; buckets above CROWDED pieces are cut again
at /24 borders and met on the upper 24 bits. Ranges never overlap, so one
address compares with at most CROWDED coarse or 256 fine pieces, and one row
in gives one row out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderstream.functions.ipv4 import MAX_IPV4, ipv4_number

COARSE_BITS = 16
FINE_BITS = 8
CROWDED = 64
# Fine keys follow the coarse ones.
FINE_KEYS = 65536
NO_ADDRESS = -1

# Most buckets that are looked for as hot, and the counters with which they are found:
# a bucket of more than one row in that many cannot be missed.
HOT_BUCKETS = 1024
HOT_COUNTERS = 8192

# Upper bound of a broadcast row: five fixed fields, two texts and the row's share
# of the hash table, whose memory grows by doubling.
_ROW_BYTES = 224


class BadRanges(ValueError):
    """The dictionary has empty, reversed, out-of-range or overlapping ranges."""


@dataclass(frozen=True)
class GeoIndex:
    """Cut ranges ready to join: ``_bucket, _lo, _hi, province, city``.

    ``crowded`` lists the /16 buckets that are cut at /24 borders, if any. ``hot`` has
    the keys that many rows share and over how many tasks to spread each of them.
    """

    pieces: DataFrame
    crowded: DataFrame | None
    size_bytes: int
    broadcast_bytes: int
    hot: dict[int, int] = field(default_factory=dict)

    @property
    def broadcast(self) -> bool:
        return self.size_bytes <= self.broadcast_bytes

    def persist(self) -> GeoIndex:
        """Keep the cut ranges for a stream, which joins them in every batch."""
        crowded = self.crowded.persist() if self.crowded is not None else None
        return replace(self, pieces=self.pieces.persist(), crowded=crowded)

    def unpersist(self) -> None:
        self.pieces.unpersist()
        if self.crowded is not None:
            self.crowded.unpersist()


def build_index(
    ranges: DataFrame, broadcast_bytes: int = 512 * 1024 * 1024
) -> GeoIndex:
    """Check a dictionary ``lo, hi, province, city`` and cut it into buckets.

    Checking first bounds what cutting can produce: non-overlapping ranges give
    at most 65,536 pieces more than there are ranges.
    """
    ranges = ranges.select("lo", "hi", "province", "city")
    lo, hi = F.col("lo"), F.col("hi")
    sound = F.coalesce((lo >= 0) & (lo <= hi) & (hi <= MAX_IPV4), F.lit(False))
    spans = F.shiftright(hi, COARSE_BITS) - F.shiftright(lo, COARSE_BITS) + 1
    text = F.coalesce(F.octet_length("province"), F.lit(0)) + F.coalesce(
        F.octet_length("city"), F.lit(0)
    )
    facts = ranges.agg(
        F.count("*").alias("rows"),
        F.count_if(~sound).alias("bad"),
        F.coalesce(F.sum(F.when(sound, spans)), F.lit(0)).alias("pieces"),
        F.coalesce(F.max(text), F.lit(0)).alias("text"),
    ).first()
    if facts.bad:
        raise BadRanges(f"{facts.bad} ranges are empty, reversed or outside 0..{MAX_IPV4}")
    if facts.pieces > facts.rows + 65536:
        raise BadRanges("ranges overlap")

    cut = _cut(ranges, COARSE_BITS)
    bucket = Window.partitionBy("bucket")
    checked = (
        cut.select("bucket", "lo", "hi")
        .withColumn("next_lo", F.lead("lo").over(bucket.orderBy("lo")))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"), F.count_if(F.col("next_lo") <= F.col("hi")).alias("overlaps"))
    )
    seen = checked.agg(
        F.coalesce(F.sum("overlaps"), F.lit(0)).alias("overlaps"),
        F.count_if(F.col("n") > CROWDED).alias("crowded"),
    ).first()
    if seen.overlaps:
        raise BadRanges(f"{seen.overlaps} ranges overlap the next one")

    pieces, crowded = cut, None
    if seen.crowded:
        # There are 65,536 buckets at most, so this list is always small.
        crowded = cut.groupBy("bucket").count().where(F.col("count") > CROWDED).select("bucket")
        base = F.shiftleft("bucket", COARSE_BITS)
        inside = cut.join(F.broadcast(crowded), "bucket", "left_semi").select(
            F.greatest("lo", base).alias("lo"),
            F.least("hi", base + 65535).alias("hi"),
            "province",
            "city",
        )
        fine = _cut(inside, FINE_BITS).withColumn("bucket", F.col("bucket") + FINE_KEYS)
        coarse = cut.join(F.broadcast(crowded), "bucket", "left_anti")
        pieces = coarse.unionByName(fine)
    pieces = pieces.withColumnsRenamed({"bucket": "_bucket", "lo": "_lo", "hi": "_hi"})
    rows = facts.pieces + 256 * seen.crowded
    size = rows * (_ROW_BYTES + 2 * facts.text)
    return GeoIndex(pieces, crowded, size, broadcast_bytes)


def _cut(ranges: DataFrame, bits: int) -> DataFrame:
    buckets = F.sequence(F.shiftright("lo", bits), F.shiftright("hi", bits))
    return ranges.select(F.explode(buckets).alias("bucket"), "lo", "hi", "province", "city")


def _keyed(rows: DataFrame, ip: str, index: GeoIndex) -> DataFrame:
    """Rows with the number of their address and the key on which they meet its range."""
    # Never null: a nullable join key makes the optimizer test it for null ahead of
    # the join, which would parse every address (and its message) a second time.
    number = F.coalesce(ipv4_number(F.col(ip)), F.lit(NO_ADDRESS))
    numbered = rows.withColumn("_ip", number)
    key = F.shiftright("_ip", COARSE_BITS)
    if index.crowded is not None:
        crowded = F.broadcast(index.crowded.withColumnRenamed("bucket", "_crowded"))
        numbered = numbered.join(crowded, key == F.col("_crowded"), "left")
        fine = F.shiftright("_ip", FINE_BITS) + FINE_KEYS
        key = F.when(F.col("_crowded").isNotNull(), fine).otherwise(key)
    return numbered.withColumn("_key", key)


def with_hot_keys(index: GeoIndex, rows: DataFrame, ip: str) -> GeoIndex:
    """The index with the keys that are hot among ``rows``, for a lookup that shuffles.

    One pass counts keys in a sketch of HOT_COUNTERS counters per task; sketches of tasks
    merge. A key with more rows than half a task's share is hot and cut into quarters of
    such a share. A stream takes what its topic has so far. A broadcast lookup needs none
    of it.
    """
    if index.broadcast:
        return index
    keys = _keyed(rows.select(ip), ip, index).where(F.col("_ip") != NO_ADDRESS)
    sketch = F.expr(f"approx_top_k(_key, {HOT_BUCKETS}, {HOT_COUNTERS})").alias("top")
    found = keys.agg(sketch, F.count("*").alias("n")).first()
    share = max(found.n / _tasks(rows), 4)
    hot = {row.item: math.ceil(4 * row["count"] / share) for row in found.top or [] if row["count"] > share / 2}
    return replace(index, hot=hot)


def locate(rows: DataFrame, ip: str, index: GeoIndex) -> DataFrame:
    """Add ``province`` and ``city`` of a dotted address; null where none is known."""
    found = _join(_keyed(rows, ip, index), index)
    return found.select(*rows.columns, "province", "city")


def _join(rows: DataFrame, index: GeoIndex) -> DataFrame:
    same_bucket = F.col("_key") == F.col("_bucket")
    inside = (F.col("_ip") >= F.col("_lo")) & (F.col("_ip") <= F.col("_hi"))
    if index.broadcast:
        return rows.join(F.broadcast(index.pieces), same_bucket & inside, "left")

    # Too large to broadcast: both sides are shuffled. Rows of a hot key spread over its
    # salts, and only its pieces are sent to all of them; rows without an address
    # get buckets of their own below zero instead of meeting in one task.
    turn = F.col("_turn")
    alone = F.when(F.col("_ip") == NO_ADDRESS, -1 - F.pmod(turn, F.lit(1 << 20)))
    spread = (
        rows.withColumn("_turn", _turn(rows))
        .withColumn("_salt", F.pmod(turn, _salts(index, "_key")).cast("int"))
        .withColumn("_key", alone.otherwise(F.col("_key")))
        .drop("_turn")
    )
    pieces, copy = index.pieces, F.lit(0)
    if index.hot:
        copies = F.explode(F.sequence(F.lit(0), _salts(index, "_bucket") - 1))
        hot = pieces.where(F.col("_bucket").isin(*index.hot))
        pieces = (
            pieces.where(~F.col("_bucket").isin(*index.hot)).withColumn("_copy", copy)
            .unionByName(hot.withColumn("_copy", copies))
        )
    else:
        pieces = pieces.withColumn("_copy", copy)
    pieces = pieces.hint(_shuffle_join(rows, index))
    return spread.join(pieces, same_bucket & (F.col("_salt") == F.col("_copy")) & inside, "left")


def _salts(index: GeoIndex, key: str) -> Column:
    """Over how many tasks the rows of a key go."""
    if not index.hot:
        return F.lit(1)
    known = F.create_map(*(F.lit(part) for pair in index.hot.items() for part in pair))
    return F.coalesce(F.try_element_at(known, F.col(key).cast("int")), F.lit(1))


def _tasks(rows: DataFrame) -> int:
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def _turn(rows: DataFrame) -> Column:
    """A number to spread rows by, the same whenever a lost task is run again.

    The position of a message tells even equal messages apart. Rows without one
    go by their content and the task that reads them; a random number would differ
    when rows are fetched again.
    """
    if {"partition", "offset"} <= set(rows.columns):
        return F.xxhash64("partition", "offset")
    return F.xxhash64(*rows.columns, F.spark_partition_id())


def _shuffle_join(rows: DataFrame, index: GeoIndex) -> str:
    """Hash the dictionary while its share of a task is small, else sort and merge."""
    per_task = index.size_bytes // _tasks(rows)
    return "shuffle_hash" if per_task <= 128 * 1024 * 1024 else "merge"
