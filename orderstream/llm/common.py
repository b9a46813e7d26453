"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.session import scratch

# The white space that separates words, as a Java and Python pattern.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = re.compile(rb"[\x20\x09-\x0D]")

# Bytes of a text that are split into words at once.
BLOCK = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read again: computed once, whoever is lost."""
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 for Arrow code, empty if null."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def decoded(value: pa.Scalar) -> str:
    """A text of ``text_bytes`` as code points; bytes that are no UTF-8 become U+FFFD."""
    return value.as_py().decode("utf-8", "replace")


def word_blocks(data: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """Words of a text in order, a bounded block of them at a time.

    Blocks end at white space, so only a single word longer than a block exceeds it.
    """
    if len(data) <= size:
        yield data.split()
        return
    begin = 0
    while begin < len(data):
        found = _SPACE.search(data, min(begin + size, len(data)))
        end = found.start() if found else len(data)
        yield data[begin:end].split()
        begin = end


def ranked(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rows with their place 0, 1, 2 ... in a global order as column ``name``.

    Range-partitioned sort; only one count per partition meets in one task.
    """
    sorted_rows = rows.orderBy(*order).withColumn(name, F.monotonically_increasing_id())
    sorted_rows = stored(sorted_rows, "ranked")
    part, place = F.shiftright(F.col(name), 33), F.col(name).bitwiseAND((1 << 33) - 1)
    counts = {
        row["part"]: row["count"] for row in sorted_rows.groupBy(part.alias("part")).count().collect()
    }
    offset, total = F.lit(0).cast("bigint"), 0
    starts = []
    for key in sorted(counts):
        starts += [F.lit(key).cast("bigint"), F.lit(total).cast("bigint")]
        total += counts[key]
    if starts:
        offset = F.create_map(*starts)[part]
    return sorted_rows.withColumn(name, offset + place)


def chosen_rows(docs: DataFrame, keys: dict[str, Column], chosen: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose keys are in ``chosen``, one for each of its rows.

    ``chosen`` has the keys by name, each combination once, and ``copies``, how many
    rows of ``docs`` share them. Nulls are equal. Columns keep their names, also those
    called like a key.
    """
    rows = docs.select(*(key.alias(name) for name, key in keys.items()), F.struct("*").alias("row"))

    def among(some: DataFrame) -> DataFrame:
        same = [rows[name].eqNullSafe(some[name]) for name in keys]
        return rows.join(some, same, "left_semi")

    found = among(chosen.where("copies = 1")).select("row.*")
    repeated = chosen.where("copies > 1")
    if repeated.isEmpty():
        return found
    once = among(repeated).dropDuplicates(list(keys)).select("row.*")
    return found.unionByName(once)
