"""SimHash near-duplicates, found without misses by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderstream.llm.common import chosen_rows, stored, text_bytes, word_blocks
from orderstream.llm.components import components

SEED = 42
BITS = 64

# Most fingerprints of one bucket that a task compares with each other. Larger
# buckets are linked through midpoints, with the same result.
BUCKET = 1024


# -- fingerprints -------------------------------------------------------------------


def fingerprint(data: bytes, shingle: int = 4) -> int:
    """SimHash of a text in UTF-8: bit set if set in over half of the shingle hashes.

    A-Z are lower-cased; fewer words than a shingle are hashed as one; no words give 0.
    Long texts are taken in blocks, so memory does not grow with them.
    """
    ones, total = np.zeros(BITS, np.int64), 0
    carried: list[bytes] = []
    seen = 0
    for block in word_blocks(data.lower()):
        words = carried + block
        seen += len(block)
        if len(words) >= shingle:
            hashes = _shingle_hashes(words, shingle)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
            total += len(hashes)
            carried = words[len(words) - shingle + 1 :]
        else:
            carried = words
    if not seen:
        return 0
    if seen < shingle:
        return xxhash.xxh64_intdigest(b" ".join(carried), SEED)
    packed = np.packbits(2 * ones > total)
    return int.from_bytes(packed.tobytes(), "big")


def _shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """Hashes of all shingles as big-endian words, so that unpacked bits are in order."""
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    return np.array(found, dtype=">u8")


def fingerprints(docs: DataFrame, shingle: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``fp``, the fingerprint as a signed 64-bit number."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = np.fromiter(
                (fingerprint(text.as_py(), shingle) for text in texts), np.uint64, len(texts)
            )
            columns = batch.columns[:-1] + [pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "fp"])

    rows = docs.select(*keep, text_bytes().alias("_text_utf8"))
    schema = rows.drop("_text_utf8").withColumn("fp", F.lit(0).cast("bigint")).schema
    return rows.mapInArrow(per_batch, schema)


# -- covering masks -----------------------------------------------------------------


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """``2 ** (radius + 1) - 1`` masks; any two words within ``radius`` agree under one.

    Bit position i gets a nonzero vector of radius + 1 binary digits, all vectors in
    turn. Mask v has the positions whose vector has an odd product with v. The vectors
    of at most ``radius`` differing positions do not span the whole space, so some v is
    orthogonal to all of them, and its mask leaves those positions out.
    """
    vectors = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, vectors + 1):
        chosen = (i for i in range(bits) if bin(v & (1 + i % vectors)).count("1") % 2)
        masks.append(sum(1 << i for i in chosen))
    return masks


def _signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def links(distinct_fps: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that connect exactly the fingerprints within ``radius`` of each other.

    ``distinct_fps`` has every fingerprint once, as ``fp``. Fingerprints equal under a
    mask share a bucket. A bucket of up to ``bucket`` fingerprints is compared in one
    task. In a larger one every fingerprint names all words within half the radius that
    differ outside the mask: two fingerprints are within the radius just if they name a
    common word, so each word links those that name it to the smallest of them. That
    grows in proportion to the bucket. Both give links for the connected components,
    not every pair.
    """
    if radius % 2:
        raise ValueError("midpoints need an even radius")
    masks = covering_masks(radius)
    tables = F.array(
        *(
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for t, m in enumerate(masks)
        )
    )
    members = distinct_fps.select("fp", F.explode(tables).alias("e")).select("fp", "e.t", "e.key")
    sizes = members.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(members.join(sizes, ["t", "key"]), "simhash-buckets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            for group in batch.column(0):
                for x, y in _bucket_links(np.array(group.as_py(), np.int64), radius):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

    small = members.where(F.col("n") <= bucket).groupBy("t", "key")
    close = small.agg(F.collect_list("fp").alias("fps")).select("fps")
    found = close.mapInArrow(compare, "a bigint, b bigint")
    crowded = members.where(F.col("n") > bucket).select("t", "fp")
    return found.unionByName(_midpoint_links(crowded, masks, radius // 2))


def _bucket_links(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that join the fingerprints of one bucket as all their pairs would."""
    rest = np.sort(fps)
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            here = reached.pop()
            near = np.bitwise_count((rest ^ here).view(np.uint64)) <= radius
            for there in rest[near]:
                reached.append(there)
                yield int(here), int(there)
            rest = rest[~near]


def _midpoint_links(crowded: DataFrame, masks: list[int], half: int) -> DataFrame:
    """Links within crowded buckets ``t, fp`` through midpoints at most ``half`` bits away."""
    patterns = []
    for t, mask in enumerate(masks):
        free = [1 << i for i in range(BITS) if not mask >> i & 1]
        chosen = (some for k in range(half + 1) for some in combinations(free, k))
        patterns.append((t, [_signed(sum(some)) for some in chosen]))
    table = crowded.sparkSession.createDataFrame(patterns, "t int, p array<bigint>")
    # One row per mask: a fixed size.
    named = crowded.join(F.broadcast(table), "t").select("t", "fp", F.explode("p").alias("p"))
    named = named.select("t", "fp", F.col("fp").bitwiseXOR(F.col("p")).alias("mid"))
    # Few fingerprints lie so near to one midpoint, whatever the bucket: as many as patterns.
    least = F.min("fp").over(Window.partitionBy("t", "mid"))
    pairs = named.withColumn("b", least).where(F.col("fp") != F.col("b"))
    return pairs.select(F.col("fp").alias("a"), "b").distinct()


# -- near-duplicates ----------------------------------------------------------------


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id, text_key, fp, root, component_id`` for every row of ``doc_id, text``.

    Documents link if their fingerprints differ in at most ``radius`` bits; the
    component id is the smallest doc_id reachable, itself included, ``root`` the
    smallest fingerprint reachable. Fingerprints are computed once and kept in the
    shared folder; equal ones are one node from there on. ``text_key`` is a hash of
    the text.

    A null text counts as empty: fingerprint 0, linked like any other. A null doc_id
    keeps its row and is passed over by the smallest doc_id, null if there is no other.
    Repeated rows stay repeated. An empty table gives no rows. Other columns are not read.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    rows = stored(fingerprints(keyed, shingle, ("doc_id", "text_key")), "simhash")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "simhash-roots")
    classes = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(classes, "root").select("fp", "root", "component_id")
    # Stored, so that a fingerprint of very many rows is a skewed key of a plain join.
    by_fp = stored(by_fp, "simhash-classes")
    return rows.join(by_fp, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """Rows of ``docs``, all columns, one of each group of near-duplicates.

    The row of the smallest doc_id stays (null is largest); among rows that share it
    the one of the smallest fingerprint and text hash, then any one of the equal rows.
    Columns keep their names, whatever these are. An empty table stays empty.
    """
    found = near_duplicates(docs, shingle, radius)
    same = found.groupBy("root", "doc_id", "fp", "text_key").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "text_key")
    least = same.groupBy("root").agg(F.min_by(F.struct("*"), order).alias("first"))
    chosen = stored(least.select("first.doc_id", "first.text_key", "first.copies"), "simhash-first")
    return chosen_rows(docs, {"doc_id": F.col("doc_id"), "text_key": F.xxhash64("text")}, chosen)
