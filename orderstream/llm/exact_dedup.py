"""Exact dedup: filters over an immutable snapshot screen the digests of a new batch."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import SPACES, chosen_rows, stored

# Digests of the snapshot that share one filter.
SHARD_ROWS = 1 << 16

# A digest of more rows than this, and than its share of all rows, is hot: the texts of it are
# dealt in pieces. At most HOT digests can be, so a list of them is small.
PIECE_ROWS = 1 << 12
HOT = 1 << 14


def normalised(text: Column) -> Column:
    """Runs of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


# -- binary fuse filters ------------------------------------------------------------


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Keys spread over 64 bits, differently for each seed."""
    h = keys + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


class FuseFilter:
    """A static set of 64-bit keys in about 18 bits each; one in 65,536 others passes too.

    A binary fuse filter: a key owns a slot in each of three neighbouring segments, and
    the slots are filled so that their combination gives the key's fingerprint.
    """

    def __init__(self, seed: int, segment: int, table: np.ndarray) -> None:
        self.seed, self.segment, self.table = seed, segment, table

    @staticmethod
    def _slots(keys: np.ndarray, seed: int, segment: int, starts: int) -> tuple:
        h = _mixed(keys, seed)
        first = (h >> np.uint64(32)) * np.uint64(starts) >> np.uint64(32)
        low, mask = np.uint64(segment), np.uint64(segment - 1)
        second = (first + low) ^ (h >> np.uint64(14) & mask)
        third = (first + low + low) ^ (h & mask)
        print_ = (h ^ h >> np.uint64(32)).astype(np.uint16)
        return np.stack([first, second, third]).astype(np.int64), print_

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(keys.astype(np.uint64))
        count = max(len(keys), 2)
        segment = 1 << max(2, int(np.log(count) / np.log(3.33) + 2.25))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(count))
        segments = max(1, int(np.ceil(count * factor / segment)) - 2)
        for seed in range(1, 200):
            slots, prints = cls._slots(keys, seed, segment, segments * segment)
            order = cls._peeled(slots, (segments + 2) * segment)
            if order is not None:
                break
        else:
            raise RuntimeError("no filter found")  # chance below 2 ** -200
        table = np.zeros((segments + 2) * segment, np.uint16)
        for which, own in reversed(order):
            # The own slot is still 0, so all three slots can be combined.
            a, b, c = slots[:, which]
            table[own] = prints[which] ^ table[a] ^ table[b] ^ table[c]
        return cls(seed, segment, table)

    @staticmethod
    def _peeled(slots: np.ndarray, size: int) -> list | None:
        """Keys in rounds, each with a slot that no key of this or a later round shares."""
        count = np.bincount(slots.ravel(), minlength=size)
        index = np.tile(np.arange(slots.shape[1]), 3)
        total = np.bincount(slots.ravel(), weights=index, minlength=size).astype(np.int64)
        order, left = [], slots.shape[1]
        alone = np.flatnonzero(count == 1)
        while len(alone):
            which, at = np.unique(total[alone], return_index=True)
            own = alone[at]
            order.append((which, own))
            left -= len(which)
            gone = slots[:, which].ravel()
            np.subtract.at(count, gone, 1)
            np.subtract.at(total, gone, np.tile(which, 3))
            near = np.unique(gone)
            alone = near[count[near] == 1]
        return order if left == 0 else None

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        starts = len(self.table) - 2 * self.segment
        slots, prints = self._slots(keys.astype(np.uint64), self.seed, self.segment, starts)
        a, b, c = self.table[slots]
        return (a ^ b ^ c) == prints

    def to_bytes(self) -> bytes:
        return np.array([self.seed, self.segment], "<i8").tobytes() + self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> FuseFilter:
        seed, segment = np.frombuffer(data, "<i8", 2).tolist()
        return cls(seed, segment, np.frombuffer(data, np.uint16, offset=16))


def _keyed(groups: DataFrame, shards: int) -> DataFrame:
    """Groups with a 64-bit ``key`` of their digest and the ``shard`` it falls into."""
    key = F.xxhash64("digest")
    return groups.withColumns({"key": key, "shard": F.pmod(F.xxhash64(key), F.lit(shards))})


def build_filters(snapshot: DataFrame, shards: int) -> DataFrame:
    """``shard, filter`` over the distinct digests of a snapshot."""

    def build(shard: pa.Table) -> pa.Table:
        keys = shard["key"].to_numpy().view(np.uint64)
        return pa.table({"shard": shard["shard"][:1], "filter": [FuseFilter.build(keys).to_bytes()]})

    keyed = _keyed(snapshot.select("digest"), shards).select("shard", "key")
    return keyed.groupBy("shard").applyInArrow(build, "shard bigint, filter binary")


def screen(batch: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Rows ``digest, ...`` of distinct digests that pass the filter of their shard.

    Shards hold a bounded number of digests on average and meet their filter in a
    cogroup; a digest the filter does not know is certainly new.
    """
    columns = batch.columns
    keyed = _keyed(batch, shards)
    schema = batch.withColumn("known", F.lit(True)).schema

    def pick(rows: pa.Table, found: pa.Table) -> pa.Table:
        known = np.zeros(len(rows), bool)
        if len(found) and len(rows):
            keys = rows["key"].to_numpy().view(np.uint64)
            known = FuseFilter.from_bytes(found["filter"][0].as_py()).may_hold(keys)
        return rows.select(columns).append_column("known", pa.array(known))

    pairs = keyed.groupBy("shard").cogroup(filters.groupBy("shard"))
    return pairs.applyInArrow(pick, schema)


# -- dedup --------------------------------------------------------------------------


def _groups(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows by key, pre-aggregated: size, and the row that stays."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "pos")).alias("first"),
    )


def dedup(
    docs: DataFrame,
    in_snapshot: Column | None = None,
    digest: Callable[[Column], Column] = sha256,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest, copies`` for every row of ``doc_id, text``.

    Texts are equal if they are after runs of white space became one space; null counts
    as empty. ``in_snapshot`` tells the rows that are the snapshot from those of the new
    batch; by default the lower half of the ids. The digests of either are grouped by
    themselves, those of the batch are screened by the snapshot's filters, and only
    positives join the snapshot's digests. Texts of equal digests are then grouped by
    their bytes, and digests shared by different texts are resolved by the texts.

    Of equal texts the smallest doc_id stays, null last; of its repeated rows one.
    ``copies`` counts the rows of the same doc_id and text. Empty tables give no rows.
    A group of any size is reduced within each task before it is shuffled.
    """
    texts = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    rows = texts.select("doc_id", digest(F.col("norm")).alias("digest"))
    rows = stored(rows.withColumn("pos", F.monotonically_increasing_id()), "exact-rows")
    if in_snapshot is None:
        # Ids that are no numbers are told apart by a number made of them.
        number = F.coalesce(F.col("doc_id").try_cast("double"), F.xxhash64("doc_id").cast("double"))
        middle = rows.agg(F.percentile_approx(number, 0.5)).first()[0]
        in_snapshot = F.col("doc_id").isNotNull() & (number <= F.lit(middle))
    old = F.coalesce(in_snapshot, F.lit(False))

    snapshot = stored(_groups(rows.where(old), "digest"), "exact-snapshot")
    batch = stored(_groups(rows.where(~old), "digest"), "exact-batch")
    # A shard meets its filter in one task, so neither side may be large in it.
    shards = max(snapshot.count(), batch.count()) // shard_rows + 1
    screened = stored(screen(batch, build_filters(snapshot, shards), shards), "exact-screened")

    known = screened.where("known").select(
        "digest", F.col("size").alias("more"), F.col("first").alias("other")
    )
    seen = snapshot.join(known, "digest", "left").select(
        "digest",
        (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"),
        F.least("first", "other").alias("first"),
    )
    passed = screened.where("known").join(snapshot, "digest", "left_anti")
    fresh = screened.where(~F.col("known")).unionByName(passed).drop("known")
    groups = stored(seen.unionByName(fresh), "exact-groups")

    differing = _differing(texts, groups, digest)
    if differing.isEmpty():
        return _result(rows, groups, ["digest"])
    equal = rows.join(differing, "digest", "left_anti")
    apart = texts.withColumn("digest", digest(F.col("norm"))).join(differing, "digest", "left_semi")
    apart = stored(apart.withColumn("pos", F.monotonically_increasing_id()), "exact-apart")
    resolved = _result(apart, _groups(apart, "digest", "norm"), ["digest", "norm"])
    return _result(equal, groups, ["digest"]).unionByName(resolved)


def _differing(texts: DataFrame, groups: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests that stand for several texts, found by grouping the texts themselves.

    Only texts of digests seen twice are grouped. Those of a hot digest are dealt over as many
    keys as it has pieces, where copies meet first. The join is a sort-merge join at every
    size, as its smaller side grows with the data.
    """
    shared = groups.where("size > 1").select("digest", "size")
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    limit = F.lit(max(total // HOT, PIECE_ROWS))
    pieces = F.ceil(F.col("size") / limit).cast("bigint")
    hot = stored(shared.where(F.col("size") > limit).select("digest", pieces.alias("pieces")), "exact-hot")
    salt = F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)).alias("salt")
    shared = stored(shared.select("digest", salt), "exact-shared")
    rows = texts.withColumn("digest", digest(F.col("norm"))).join(F.broadcast(hot), "digest", "left")
    own = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.coalesce("pieces", F.lit(1)))
    salted = rows.withColumn("salt", own).drop("pieces")
    checked = salted.join(shared.hint("merge"), ["digest", "salt"], "left_semi")
    each = checked.select("digest", "norm").distinct()
    return stored(
        each.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"),
        "exact-differing",
    )


def _result(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    # Stored, so that both sides of the join are plain shuffles: a digest of very many
    # rows is then a skewed key, which the adaptive plan splits.
    groups = stored(groups.join(_copies(rows, keys), keys), "exact-copies")
    joined = rows.join(groups, keys)
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos"))
    return joined.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        kept.alias("kept"),
        "digest",
        F.when(kept, F.col("copies")).alias("copies"),
    )


def _copies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """By key: how many rows have the doc_id that stays."""
    each = rows.groupBy(*keys, "doc_id").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id")
    return each.groupBy(*keys).agg(F.min_by("copies", order).alias("copies"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, one of each group of equal texts: see ``dedup``."""
    found = dedup(docs).where("kept")
    chosen = stored(found.select("doc_id", "digest", "copies"), "exact-kept")
    keys = {"doc_id": F.col("doc_id"), "digest": sha256(normalised(F.col("text")))}
    return chosen_rows(docs, keys, chosen)
