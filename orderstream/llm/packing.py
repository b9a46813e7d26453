"""Packing into length buckets whose boundaries minimise padding."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderstream.llm.common import stored
from orderstream.llm.mixing import words

MAX_LENGTH = 4096
BUCKETS = 16
BATCH_TOKENS = 1 << 16

# Pieces that are numbered together in one task, on average.
SHARD_ROWS = 1 << 16


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` length buckets with the least padding in all.

    Dynamic programming over the distinct lengths, ascending: the best cost of the first
    j lengths in k buckets comes from the best split i < j. The cost of a bucket is its
    count times its longest length less its tokens; the second part is the same for any
    choice. Integers throughout; of equal costs the lowest split is taken.
    """
    size = len(lengths)
    if not size:
        return []
    before = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
    tops = lengths.astype(np.int64)
    best = before[1:] * tops  # one bucket
    splits = []
    for _ in range(1, min(buckets, size)):
        cost = np.empty(size, np.int64)
        split = np.zeros(size, np.int64)
        for j in range(size):
            # First bucket set ends before length i, the new bucket is i .. j.
            options = best[:j] + (before[j + 1] - before[1 : j + 1]) * tops[j]
            at = int(options.argmin()) if j else -1
            if j and options[at] < best[j]:
                cost[j], split[j] = options[at], at + 1
            else:
                cost[j], split[j] = best[j], -1
        splits.append(split)
        best = cost
    ends, j = [], size - 1
    for split in reversed(splits):
        if split[j] >= 0:
            ends.append(int(tops[j]))
            j = int(split[j]) - 1
    ends.append(int(tops[j]))
    return sorted(ends)


def pieces(docs: DataFrame, tokens: Column, max_length: int) -> DataFrame:
    """``doc_id, piece, start, length``: whole documents, overlong ones cut without loss."""
    sized = docs.select("doc_id", tokens.cast("bigint").alias("n"), F.xxhash64("doc_id", "text").alias("h"))
    count = F.ceil(F.col("n") / max_length).cast("bigint")
    places = F.when(F.col("n") > 0, F.sequence(F.lit(0).cast("bigint"), count - 1))
    cut = sized.select("doc_id", "h", "n", F.explode(places).alias("piece"))
    start = F.col("piece") * max_length
    length = F.least(F.lit(max_length), F.col("n") - start)
    return cut.select("doc_id", "h", "piece", start.alias("start"), length.alias("length"))


def pack(
    docs: DataFrame,
    tokens: Column | None = None,
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``doc_id, piece, start, length, padded, batch, slot`` for every piece of a document.

    ``tokens`` is the length of a document, words by default. Documents longer than
    ``max_length`` are cut into pieces that follow each other. The histogram of lengths,
    at most ``max_length`` counts, goes to the driver, which finds the buckets. Pieces of
    a bucket are padded to its longest length; a batch takes as many as fit into
    ``batch_tokens``, at least one, and only the last batch of a bucket may be short.

    Pieces are numbered within hashed shards of each bucket, and shards follow one
    another, so a bucket of any size is spread over tasks. Documents without tokens (null
    or empty text) have no piece. Rows of the same doc_id are packed each. An empty table
    gives no rows.
    """
    if not 0 < max_length <= batch_tokens:
        raise ValueError("a batch must hold a piece of the greatest length")
    cut = pieces(docs, words(F.col("text")) if tokens is None else tokens, max_length)
    cut = stored(cut, "pack-pieces")
    histogram = cut.groupBy("length").agg(F.count("*").alias("n")).orderBy("length").toArrow()
    lengths, counts = histogram["length"].to_numpy(), histogram["n"].to_numpy()
    ends = boundaries(lengths, counts, buckets)
    if not ends:
        return _placed(cut.withColumns({"padded": F.col("length"), "at": F.lit(0)}), batch_tokens)

    padded = F.lit(None).cast("bigint")
    for end in reversed(ends):
        padded = F.when(F.col("length") <= end, F.lit(end).cast("bigint")).otherwise(padded)
    shards = int(counts.sum()) // shard_rows + 1
    shard = F.pmod(F.xxhash64("h", "piece"), F.lit(shards))
    rows = cut.withColumns({"padded": padded, "shard": shard})
    inside = Window.partitionBy("padded", "shard").orderBy("h", "piece", "doc_id")
    rows = rows.withColumn("place", F.row_number().over(inside) - 1)
    sizes = rows.groupBy("padded", "shard").agg(F.count("*").alias("size"))
    before = Window.partitionBy("padded").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "padded", "shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")
    )
    numbered = rows.join(stored(offsets, "pack-offsets"), ["padded", "shard"])
    return _placed(numbered.withColumn("at", F.col("offset") + F.col("place")), batch_tokens)


def _placed(rows: DataFrame, batch_tokens: int) -> DataFrame:
    room = F.floor(F.lit(batch_tokens) / F.col("padded"))
    return rows.select(
        "doc_id", "piece", "start", "length", "padded",
        F.floor(F.col("at") / room).alias("batch"),
        F.pmod(F.col("at"), room).alias("slot"),
    )
